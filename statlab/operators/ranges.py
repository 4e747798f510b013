"""Ranges of an order: times as numbers, bounds from the data, and a table numbered range by range."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlab.session import stage

DAY = 86_400_000_000
#: More bounds than this are not sent along; ranges grow instead.
MOST_BOUNDS = 4096


def ticks(df: DataFrame, column: str) -> Column:
    """A date or time as microseconds, in no time zone if it has none; a number as it is."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        seconds = F.hour(c) * 3600 + F.minute(c) * 60
        return F.unix_date(F.to_date(c)) * F.lit(DAY) + seconds.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c) * F.lit(DAY)
    return c.cast("double") if isinstance(kind, (T.FractionalType, T.DecimalType)) else c.cast("long")


def quantile_bounds(df: DataFrame, column: str, parts: int) -> list:
    """Up to ``parts - 1`` ascending values that cut the column in parts of about equal size; only they go to the driver."""
    parts = min(parts, MOST_BOUNDS + 1)
    if parts < 2:
        return []
    probes = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(column, probes, max(10_000, 4 * parts))).first()[0]
    return sorted(set(found or []))


def range_of(key: Column, bounds: Sequence, kind: str) -> Column:
    """How many of the ascending ``bounds`` (of the SQL type ``kind``) are at or below ``key``, searched in blocks."""
    if not bounds:
        return F.lit(0)
    blocks = [list(bounds[i:i + 64]) for i in range(0, len(bounds), 64)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= key))

    block = below(F.lit([b[0] for b in blocks]).cast(f"array<{kind}>"))
    inside = below(F.get(F.lit(blocks).cast(f"array<array<{kind}>>"), block - 1))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * 64 + inside)


@dataclass
class Ordered:
    """Rows with ``_part``, the range they lie in, and ``_pos``, their place in the whole order from 0."""

    rows: DataFrame
    starts: list[int]  # the place of each range's first row, and after them the number of rows

    @property
    def n(self) -> int:
        return self.starts[-1]

    def of_part(self, values: Sequence, kind: str) -> Column:
        """The value that belongs to a row's range."""
        return F.get(F.lit(list(values)).cast(f"array<{kind}>"), F.col("_part"))


def ordered(df: DataFrame, order: Sequence[Column | str], rows_per_range: int = 1_000_000) -> Ordered:
    """The table in ranges of the order, numbered through; rows equal in it are numbered in one way that stays.

    Equal rows may lie in several ranges, so a value that many rows share fills no task. To the driver comes one
    count per range.
    """
    known = stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    parts = min(max(8, known.count() // rows_per_range + 1), MOST_BOUNDS)
    ranged = stage(known.repartitionByRange(parts, *order, "_row").withColumn("_part", F.spark_partition_id()), "ranged")
    counts = {r["_part"]: r["count"] for r in ranged.groupBy("_part").count().collect()}
    starts = [0]
    for i in range(max(counts, default=-1) + 1):
        starts.append(starts[-1] + counts.get(i, 0))
    found = Ordered(ranged, starts)
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_row"))
    found.rows = stage(ranged.withColumn("_pos", found.of_part(starts[:-1], "bigint") + place - 1).drop("_row"), "numbered")
    return found
