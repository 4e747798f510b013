"""As-of join: to each row of one table the latest row of another at or before its time, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlab.operators.ranges import quantile_bounds, range_of, ticks
from statlab.session import stage

#: Rows a time range has on average, and rows of one key and range above which they are dealt to several tasks.
ROWS_PER_RANGE = 500_000
HOT_ROWS = 2_000_000


def asof_join(
    left: DataFrame, right: DataFrame, left_time: str, right_time: str, by: Sequence[str | tuple[str, str]] = (),
    tie: Sequence[str] = (), direction: str = "backward", allow_equal: bool = True, tolerance: int | float | None = None,
    how: str = "left", prefix: str = "right_", rows_per_range: int = ROWS_PER_RANGE, hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Columns of ``left`` and, with ``prefix`` before their names, of the row of ``right`` that is as of its time.

    ``by`` names the columns that have to be equal (a pair where their names differ). ``backward`` takes the last row at or
    before the time (before it without ``allow_equal``), ``forward`` the first at or after it. Of rows of one key and time
    the one with the greatest ``tie`` counts (``forward``: the smallest), where nothing is said by all columns in order.
    ``tolerance`` bounds the distance, in microseconds for dates and times. Null keys and times match nothing: such rows
    of ``left`` have no match, and ``how="inner"`` leaves rows without one out.

    Both tables are cut in time ranges from their quantiles; a task gets the rows of one key and range, so the rows of
    a hot key are many tasks. What a range does not know, the last row of all ranges before it, is found among one row
    per key and range and put in front of the range. A key that has very many rows at one time is dealt out further,
    with the few rows of ``right`` it can meet, which are one for each time.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError("direction is backward or forward, how is left or inner")
    forward = direction == "forward"
    pairs = [(b, b) if isinstance(b, str) else tuple(b) for b in by]
    keys = [f"_k{i}" for i in range(len(pairs))]

    def prepared(df: DataFrame, time: str, side: int, name: str) -> DataFrame:
        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
        return df.select(*[F.col(f"`{p[side]}`").alias(k) for p, k in zip(pairs, keys)], ticks(df, time).alias("_t"), whole)

    l, r = prepared(left, left_time, 0, "l"), prepared(right, right_time, 1, "r")
    complete = F.lit(True)
    for c in (*keys, "_t"):
        complete = complete & F.col(c).isNotNull()
    tie = [f"r.`{c}`" for c in (tie or right.columns)]
    chosen = F.min_by if forward else F.max_by
    r = r.where(complete).groupBy(*keys, "_t").agg(chosen("r", F.struct(*tie)).alias("r"))
    r = stage(r.select(*keys, "_t", F.struct(F.col("_t").alias("at"), F.col("r").alias("row")).alias("r")), "asof-right")
    able = l.where(complete)

    times = able.select("_t").unionAll(r.select("_t"))
    kind = dict(times.dtypes)["_t"]
    bounds = quantile_bounds(times, "_t", times.count() // rows_per_range + 1)
    span = range_of(F.col("_t"), bounds, kind).alias("_span")
    able, r = able.select("*", span), r.select("*", span)

    cell = [*keys, "_span"]
    edge = (F.min_by if forward else F.max_by)("r", "_t")
    counts = able.groupBy(*cell).agg(F.count("*").alias("_n"))
    lasts = r.groupBy(*cell).agg(edge.alias("edge"))
    cells = counts.withColumn("edge", F.lit(None).cast(r.schema["r"].dataType)).unionByName(lasts.withColumn("_n", F.lit(0).cast("long")))
    cells = cells.groupBy(*cell).agg(F.sum("_n").alias("_n"), F.first("edge", ignorenulls=True).alias("edge"))
    # At most one row per key and range, so a key brings no more rows here than there are ranges.
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.desc("_span") if forward else F.asc("_span")).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("r", F.last("edge", ignorenulls=True).over(before)).where("_n > 0")
    cells = stage(cells.select(*cell, "r", F.ceil(F.col("_n") / hot_rows).cast("int").alias("_deal")), "asof-cells")

    hot = cells.where("_deal > 1").select(*cell, "_deal")
    if hot.isEmpty():
        able, r = able.withColumn("_share", F.lit(0)), r.withColumn("_share", F.lit(0))
    else:
        deal = F.coalesce("_deal", F.lit(1))
        able = able.join(hot, cell, "left").withColumn("_share", F.floor(F.rand(7) * deal).cast("int")).drop("_deal")
        r = r.join(hot, cell, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), deal - 1))).drop("_deal")
        able = stage(able, "asof-left")  # so that a repeated task deals its rows as before
    first = cells.select(*cell, "r", F.explode(F.sequence(F.lit(0), F.col("_deal") - 1)).alias("_share")).where("r IS NOT NULL")

    no_l, no_r = F.lit(None).cast(able.schema["l"].dataType).alias("l"), F.lit(None).cast(r.schema["r"].dataType).alias("r")
    no_t = F.lit(None).cast(kind).alias("_t")
    columns = [*cell, "_share"]
    own_side = 1 if allow_equal else 0
    rows = first.select(*columns, F.lit(0).alias("_in"), no_t, F.lit(0).alias("_side"), no_l, "r") \
        .unionByName(r.select(*columns, F.lit(1).alias("_in"), "_t", F.lit(1 - own_side).alias("_side"), no_l, "r")) \
        .unionByName(able.select(*columns, F.lit(1).alias("_in"), "_t", F.lit(own_side).alias("_side"), "l", no_r))
    order = Window.partitionBy(*columns).orderBy("_in", F.desc("_t") if forward else F.asc("_t"), "_side").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.withColumn("r", F.last("r", ignorenulls=True).over(order)).where("l IS NOT NULL")
    if tolerance is not None:
        met = met.withColumn("r", F.when(F.abs(F.col("_t") - F.col("r.at")) <= tolerance, F.col("r")))
    met = met.select("l", "r")
    if how == "inner":
        met = met.where("r IS NOT NULL")
    else:
        met = met.unionByName(l.where(~complete).select("l", no_r))
    return met.select(*[F.col(f"l.`{c}`").alias(c) for c in left.columns], *[F.col(f"r.row.`{c}`").alias(prefix + c) for c in right.columns])

