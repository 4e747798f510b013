"""Median imputation and standardisation over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.operators.medians import exact_medians
from statlab.operators.reshape import aggregate_long, number


def median_impute(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Nulls of each metric replaced by its median over all rows; a metric without values stays null."""
    # One number per metric comes to the driver and goes into the plan as a literal.
    fill = {r["metric"]: r["median"] for r in exact_medians(df, metrics).select("metric", "median").collect()}
    return df.withColumns({
        m: F.coalesce(number(m), F.lit(fill.get(m)).cast("double")) for m in metrics
    })


def standardize(df: DataFrame, metrics: Sequence[str], suffix: str = "_z") -> DataFrame:
    """``(x - mean) / sample deviation`` of each metric in a new column; null where there is no spread."""
    stats = {"mean": F.avg, "std": F.stddev_samp}
    known = {r["metric"]: r for r in aggregate_long(df, [], metrics, stats, 5).collect()}
    return df.withColumns({
        m + suffix: F.try_divide(
            number(m) - F.lit(known[m]["mean"]).cast("double"), F.lit(known[m]["std"]).cast("double")
        )
        for m in metrics
    })
