"""Statistics of entities over wide tables, written as Spark DataFrame functions."""
