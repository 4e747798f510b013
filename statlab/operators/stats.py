"""Median, mean and sample standard deviation per group, with the grand total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.operators.medians import exact_medians
from statlab.operators.reshape import aggregate_long, join_null_safe

# The statistics and how a wide column is named after one.
STATS = ["median", "mean", "std"]
PREFIX = {"median": "Median", "mean": "Mean", "std": "Std"}
TOTAL = "all"


def group_moments(df: DataFrame, group: str, metrics: Sequence[str], grand_total: bool = True) -> DataFrame:
    """``is_total, grp, metric, n, mean, std``; the deviation of a single value is null."""
    moments = {"n": F.count, "mean": F.avg, "std": F.stddev_samp}
    named = df.select(F.col(group).alias("grp"), *metrics)
    long = aggregate_long(named, ["grp"], metrics, moments, 6, grand_total)
    return long if grand_total else long.withColumn("is_total", F.lit(False))


def group_stats_long(df: DataFrame, group: str, metrics: Sequence[str], total_label: str = TOTAL) -> DataFrame:
    """One row per group and metric, the total first in ``is_total``: ``n, median, mean, std``."""
    moments = group_moments(df, group, metrics)
    medians = exact_medians(df, metrics, group)
    label = F.when(F.col("is_total"), F.lit(total_label)).otherwise(F.col("grp").cast("string"))
    return join_null_safe(moments, medians, ["is_total", "grp", "metric"], "left").select(
        "is_total", label.alias("group"), "metric", "n", "median", "mean", "std"
    )


def group_stats_wide(
    df: DataFrame,
    group: str,
    metrics: Sequence[str],
    labels: dict[str, str] | None = None,
    total_label: str = TOTAL,
) -> DataFrame:
    """One row per group: ``is_total, group`` and ``Median of m, Mean of m, Std of m`` per metric in order."""
    labels = labels or {}
    long = group_stats_long(df, group, metrics, total_label)
    cells = long.groupBy("is_total", "group").pivot("metric", list(metrics)).agg(
        F.first(F.struct(*STATS), ignorenulls=True)
    )
    columns = [
        F.col(f"`{m}`.{s}").alias(f"{PREFIX[s]} of {labels.get(m, m)}") for m in metrics for s in STATS
    ]
    return cells.select("is_total", "group", *columns)
