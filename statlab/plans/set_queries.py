"""Cubes, multisets and summaries on the tables, one query each; ``set_sql`` holds the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlab.operators import cubes, multisets, sketches
from statlab.plans.table_queries import table

SHARES = (0.1, 0.5, 0.9)


def cube_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts and suppliers by flag, status and line, for all eight grouping sets."""
    lines = table(spark, sf, "lineitem")
    return cubes.grouped(
        lines, ["l_returnflag", "l_linestatus", "l_linenumber"], {"n_parts": "l_partkey", "n_suppliers": "l_suppkey"},
        {"n": ("count", F.lit(1)), "quantity": ("sum", "l_quantity"), "dearest": ("max", "l_extendedprice")})


def rollup_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Users by kind of event and day, with a null kind, the kinds and the total."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    events = table(spark, sf, "events").select(kind.alias("kind"), F.dayofmonth("ts").alias("day"), "user_id", "event_id")
    dims = ["kind", "day"]
    return cubes.grouped(events, dims, {"n_users": "user_id"}, {"n": ("count", F.lit(1)), "first_event": ("min", "event_id")}, cubes.rollup_sets(dims))


def _rows_of(spark: SparkSession, sf: str, status: str) -> DataFrame:
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == status)
    kind = F.when(F.col("o_custkey") % 7 != 0, F.col("o_orderpriority"))
    return orders.select(F.when(F.col("o_orderkey") % 3 == 0, 0).otherwise(F.col("o_custkey") % 40).cast("long").alias("bucket"), kind.alias("priority"))


def intersect_all(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in orders of all three states, a third of them alike, with how often."""
    return multisets.combined([_rows_of(spark, sf, s) for s in "OFP"], "intersect")


def except_all(spark: SparkSession, sf: str) -> DataFrame:
    """Open orders' rows without the other states' ones, written out and counted again."""
    left = multisets.written_out(multisets.combined([_rows_of(spark, sf, s) for s in "OFP"], "except"))
    return left.groupBy("bucket", "priority").agg(F.count("*").alias("copies"))


def except_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' buckets of the lines of one flag that the other flags' lines have not."""
    lines = table(spark, sf, "lineitem")
    keys = [lines.where(F.col("l_returnflag") == f).select("l_suppkey", "l_quantity") for f in "RAN"]
    return multisets.combined(keys, "except", distinct=True).drop("copies")


def sketch_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Per kind of event, from summaries per kind and day: rows, and whether quantiles and users are within the bounds."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    found = sketches.answers(sketches.merged(sketches.summarised(events, ["event_type", "day"], "value", "user_id"), ["event_type"]), ["event_type"], SHARES)
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    errors = sketches.rank_errors(events, found, ["event_type"], "value", SHARES)
    near = F.abs(F.col("n_entities") - F.col("n_users")) <= sketches.DISTINCT_ERROR * F.col("n_users")
    return found.join(exact, "event_type").join(errors, "event_type").select(
        "event_type", "n", "n_users", near.alias("users_near"), (F.col("rank_error") <= sketches.RANK_ERROR).alias("quantiles_near"))


QUERIES = {
    f.__name__: f
    for f in [cube_distinct_counts, rollup_distinct_counts, intersect_all, except_all, except_distinct, sketch_quality]
}
