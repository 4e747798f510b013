"""Description of groups or clusters: sizes, means, standout features, main categories, examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from statlab.operators.rank import first_per_group
from statlab.operators.reshape import aggregate_long


def sizes(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(group).agg(F.count("*").alias("size"))


def profile(df: DataFrame, group: str, metrics: Sequence[str]) -> DataFrame:
    """``group, metric, mean`` in original units."""
    return aggregate_long(df, [group], metrics, {"mean": F.avg}, 2)


def standouts(means: DataFrame, group: str, deviations: float = 1.0, scaled: bool = False) -> DataFrame:
    """Metrics whose mean lies more than ``deviations`` above the average of the group's own means.

    In raw units this favours metrics on a large scale; ``scaled`` first standardises each metric
    over the groups. The window holds one row per metric.
    """
    scored = means.withColumn("score", F.col("mean"))
    if scaled:
        spread = means.groupBy("metric").agg(F.avg("mean").alias("centre"), F.stddev_samp("mean").alias("spread"))
        # One row per metric of the catalogue.
        scored = means.join(F.broadcast(spread), "metric").withColumn(
            "score", F.try_divide(F.col("mean") - F.col("centre"), F.col("spread"))
        )
    row = Window.partitionBy(group)
    return (
        scored
        .withColumn("bar", F.avg("score").over(row) + deviations * F.stddev_samp("score").over(row))
        .where("score > bar").select(group, "metric", "mean")
    )


def top_categories(df: DataFrame, group: str, category: str, k: int = 2) -> DataFrame:
    """The ``k`` most frequent categories per group: ``group, category, n, rank``."""
    counted = df.groupBy(group, category).agg(F.count("*").alias("n"))
    return first_per_group(counted, [group], [F.desc("n"), F.asc(category)], k)


def listed(df: DataFrame, group: str, item: str, order: str, name: str) -> DataFrame:
    """The items of each group joined by ``', '`` in the given order; for lists already cut short."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(item).alias("item"))))
    return df.groupBy(group).agg(F.array_join(F.transform(entries, lambda e: e["item"]), ", ").alias(name))


def examples(df: DataFrame, group: str, ident: str, also: Sequence[str] = (), k: int = 5) -> DataFrame:
    """The first ``k`` members of each group by name."""
    return first_per_group(df.select(group, ident, *also), [group], [F.asc(ident)], k)
