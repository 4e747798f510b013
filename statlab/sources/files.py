"""Reading and writing the files the analyses exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlab.functions.clean import MISSING


BAD = "_bad"


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False, keep_bad: bool = False
) -> DataFrame:
    """UTF-8 CSV with a header, columns by name; ``N/A`` is null and a byte-order mark is skipped.

    The columns of ``schema`` may stand in any order among others; a missing one is an error, and so are files whose
    headers differ. A row with a cell that does not fit its type is an error as well, or with ``keep_bad`` a row of
    what fits whose text is in the column ``_bad``. Plain files are split between tasks. A file with line breaks
    inside quotes (``multiline``) cannot be, so such a source should come as many files.
    """
    options = dict(header=True, nullValue=MISSING, multiLine=multiline, escape='"')
    header = [c.lstrip("\ufeff") for c in spark.read.csv(path, **options).columns]
    missing = [c for c in schema.names if c not in header]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    fields = [schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in header]
    marked = [T.StructField(BAD, T.StringType())] if keep_bad else []
    reader = spark.read.schema(T.StructType([*fields, *marked]))
    mode = dict(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD) if keep_bad else dict(mode="FAILFAST")
    found = reader.csv(path, enforceSchema=False, **options, **mode)
    return found.select(*[F.col(f"`{c}`") for c in [*schema.names, *(f.name for f in marked)]])


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """CSV with a header in a fixed column order, nulls as ``N/A``."""
    (df.select(*[F.col(f"`{c}`") for c in columns or df.columns])
       .write.mode(mode).csv(path, header=True, nullValue=MISSING, escape='"'))


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[Column | str], mode: str = "errorifexists") -> None:
    """CSV files that hold the rows in one global order, by range partitions and not in one task."""
    write_csv(df.orderBy(*order), path, mode=mode)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet table; with a schema no file is opened to find it out."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def write_lines(df: DataFrame, path: str, order: Sequence[str], mode: str = "errorifexists") -> None:
    """The ``line`` column as text in the given order."""
    df.orderBy(*order).select("line").write.mode(mode).text(path)
