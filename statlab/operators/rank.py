"""The first rows per group under an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlab.operators.reshape import aggregate_long, batches, number, stacked, to_long


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of each group with their ``rank``.

    The bound on ``row_number`` lets Spark cut every task's rows to ``k`` per group before the shuffle.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def _bounds(
    df: DataFrame, ident: str, metrics: Sequence[str], k: int
) -> dict[str, tuple[float | None, float | None]]:
    """Per metric a high and a low value that at least ``k`` rows reach; None where that is not certain.

    Rows fall into buckets by their id. The extremes of ``k`` buckets belong to ``k`` rows, so the
    k-th best of them is such a value. Two numbers per metric come to the driver.
    """
    buckets = max(64, 4 * k)
    marked = df.withColumn("_bucket", F.pmod(F.xxhash64(ident), F.lit(buckets)))
    best = aggregate_long(marked, ["_bucket"], metrics, {"high": F.max, "low": F.min}, 2)
    kth = best.groupBy("metric").agg(
        F.get(F.sort_array(F.collect_list("high"), asc=False), F.lit(k - 1)).alias("high"),
        F.get(F.sort_array(F.collect_list("low")), F.lit(k - 1)).alias("low"),
    )
    return {r["metric"]: (r["high"], r["low"]) for r in kth.collect()}


def extremes(
    df: DataFrame, ident: str, metrics: Sequence[str], sides: Sequence[str] = ("high", "low"), k: int = 3
) -> DataFrame:
    """The ``k`` highest and lowest entities per metric, nulls left out, ties in order of the id.

    ``metric, side, rank, id, value``. A first pass over the wide rows, run when the function is
    called, finds a bound per metric and side, so that the second sorts the few values beyond it
    and not every value of the table.
    """
    bounds = _bounds(df, ident, metrics, k)

    def beyond(metric: str, side: str) -> Column:
        high, low = bounds.get(metric, (None, None))
        value = number(metric)
        if side == "high":
            return value if high is None else F.when(value >= high, value)
        return value if low is None else F.when(value <= low, value)

    def far_values(part: Sequence[str]) -> DataFrame:
        names = [f"{s}:{m}" for m in part for s in sides]
        wide = df.select(ident, *[beyond(m, s).alias(f"{s}:{m}") for m in part for s in sides])
        return to_long(wide, [ident], names)

    far = stacked(far_values(part) for part in batches(metrics, len(sides))).select(
        F.substring_index("metric", ":", 1).alias("side"), F.regexp_replace("metric", "^[a-z]+:", "").alias("metric"),
        ident, "value",
    )
    # Ascending in both cases, with the sign turned for the high side.
    order = F.when(F.col("side") == "high", -F.col("value")).otherwise(F.col("value"))
    ranked = first_per_group(far, ["metric", "side"], [order, F.asc(ident)], k)
    return ranked.select("metric", "side", "rank", ident, "value")
