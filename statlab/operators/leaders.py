"""Which group leads each metric, and how many metrics a group leads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.operators.rank import first_per_group
from statlab.operators.reshape import aggregate_long


def group_totals(df: DataFrame, group: str, metrics: Sequence[str], how: str = "sum") -> DataFrame:
    """``group, metric, total``. A sum over rates favours large groups; ``how='mean'`` does not."""
    stat, fields = {"sum": (F.sum, 1), "mean": (F.avg, 2)}[how]
    return aggregate_long(df, [group], metrics, {"total": stat}, fields)


def metric_leaders(
    df: DataFrame, group: str, metrics: Sequence[str], how: str = "sum", tie_decimals: int = 6
) -> DataFrame:
    """The group with the highest total per metric: ``metric, group, total``.

    Equal totals go to the first group by name. Totals are compared at ``tie_decimals`` so that the
    order in which doubles were added cannot decide a tie.
    """
    totals = group_totals(df, group, metrics, how).where("total is not null")
    order = [F.desc(F.round("total", tie_decimals)), F.asc(group)]
    return first_per_group(totals, ["metric"], order, 1).select("metric", group, "total")


def lead_counts(leaders: DataFrame, group: str, metrics: Sequence[str]) -> DataFrame:
    """``group, n_metrics, first_seen``: metrics led, and the place of the first of them in ``metrics``."""
    place = F.array_position(F.array(*[F.lit(m) for m in metrics]), F.col("metric"))
    return leaders.groupBy(group).agg(F.count("*").alias("n_metrics"), F.min(place).alias("first_seen"))


def best_group(counts: DataFrame, group: str) -> DataFrame:
    """The group leading most metrics; the earliest seen wins a tie."""
    return counts.orderBy(F.desc("n_metrics"), "first_seen", group).limit(1).select(group, "n_metrics")
