"""Quantiles and distinct counts from summaries that are stored and merged later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Size of a quantile summary and the rank error it is held to; bits of a distinct summary and its relative error.
SIZE, RANK_ERROR = 400, 0.02
BITS, DISTINCT_ERROR = 14, 0.05


def summarised(df: DataFrame, group: Sequence[str], value: str, entity: str, size: int = SIZE, bits: int = BITS) -> DataFrame:
    """``group, values, entities``: a quantile summary of ``value`` and a distinct summary of ``entity`` per group.

    Tasks summarise what they read, so only summaries of a bounded size travel. Nulls and NaN are left out; a group without values has
    an empty summary. The rows can be stored, per day for instance, and merged by ``merged`` in any order.
    """
    number = F.nanvl(F.col(f"`{value}`").cast("double"), F.lit(None).cast("double"))
    return df.groupBy(*group).agg(
        F.kll_sketch_agg_double(number, size).alias("values"),
        F.hll_sketch_agg(F.col(f"`{entity}`").cast("string"), bits).alias("entities"),
    )


def merged(sketches: DataFrame, group: Sequence[str], size: int = SIZE) -> DataFrame:
    """The summaries of coarser groups from those of finer ones."""
    return sketches.groupBy(*group).agg(
        F.kll_merge_agg_double("values", size).alias("values"), F.hll_union_agg("entities").alias("entities"))


def answers(sketches: DataFrame, group: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``group, n, quantiles, n_entities``: the quantiles at ``shares`` are null for a group without values."""
    n = F.kll_sketch_get_n_double("values")
    at = F.array(*[F.lit(float(s)) for s in shares])
    return sketches.select(
        *group, n.alias("n"), F.when(n > 0, F.kll_sketch_get_quantile_double("values", at)).alias("quantiles"),
        F.hll_sketch_estimate("entities").alias("n_entities"))


def rank_errors(df: DataFrame, found: DataFrame, group: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """``group, rank_error``: how far the true rank of the worst quantile lies from its share, as a share of the rows.

    One aggregate over the table, joined to the few rows of ``found``.
    """
    asked = found.select(*[F.col(g).alias(f"_{g}") for g in group], "quantiles")
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    number = F.nanvl(F.col(f"`{value}`").cast("double"), F.lit(None).cast("double"))
    rows = df.select(*group, number.alias("_number")).where("_number is not null").join(asked, same)
    quantile = [F.get("quantiles", F.lit(i)) for i in range(len(shares))]
    counted = rows.groupBy(*group).agg(
        F.count("*").alias("_n"), *[F.count_if(F.col("_number") < q).alias(f"_b{i}") for i, q in enumerate(quantile)],
        *[F.count_if(F.col("_number") <= q).alias(f"_t{i}") for i, q in enumerate(quantile)])
    errors = [
        F.greatest(F.col(f"_b{i}") / F.col("_n") - s, s - F.col(f"_t{i}") / F.col("_n"), F.lit(0.0)) for i, s in enumerate(shares)]
    worst = F.greatest(*errors) if len(errors) > 1 else errors[0]
    return counted.select(*group, worst.alias("rank_error"))
