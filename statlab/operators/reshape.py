"""Wide to long, long to wide, distinct values and unions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Generated code is used for operators of up to spark.sql.codegen.maxFields = 100 fields.
FIELDS = 90


def number(metric: str) -> Column:
    """A metric as a double; NaN counts as missing."""
    return F.nanvl(F.col(metric).cast("double"), F.lit(None).cast("double"))


def batches(metrics: Sequence[str], fields: int = 1) -> list[Sequence[str]]:
    """The metrics in runs that stay inside generated code, at ``fields`` per metric.

    Each run reads its own columns, so that together they scan a stored table once. A table that
    is the result of a join is better written first (``session.stage``).
    """
    size = max(1, FIELDS // fields)
    return [metrics[i:i + size] for i in range(0, len(metrics), size)]


def stacked(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def to_long(df: DataFrame, ids: Sequence[str], metrics: Sequence[str], keep_nulls: bool = False) -> DataFrame:
    """One row per id and metric: ``ids, metric, value``."""
    long = stacked(
        df.select(*ids, *[number(m).alias(m) for m in part]).unpivot(list(ids), list(part), "metric", "value")
        for part in batches(metrics)
    )
    return long if keep_nulls else long.where("value is not null")


def to_wide(df: DataFrame, ids: Sequence[str], name: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per entry of ``names``, in that order."""
    return df.groupBy(*ids).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))


def aggregate_long(
    df: DataFrame,
    group: Sequence[str],
    metrics: Sequence[str],
    stats: dict[str, Callable[[Column], Column]],
    fields: int,
    grand_total: bool = False,
) -> DataFrame:
    """Aggregate each metric over the wide rows, then turn the small result long.

    Rows are never multiplied by the number of metrics, which are taken in batches (``fields``
    buffer fields per metric). ``grand_total`` adds the row over everything, told apart from a null
    group by the ``is_total`` column.
    """
    parts = []
    for chunk in batches(metrics, fields):
        sums = [
            F.struct(F.lit(m).alias("metric"), *[f(number(m)).alias(s) for s, f in stats.items()])
            for m in chunk
        ]
        cells = F.array(*sums).alias("cells")
        if grand_total:
            grouped = df.rollup(*group)
            flag = [F.grouping(group[0]).cast("boolean").alias("is_total")]
            keep = ["is_total", *group]
        else:
            grouped, flag, keep = df.groupBy(*group), [], list(group)
        parts.append(grouped.agg(*flag, cells).select(*keep, F.inline("cells")))
    return stacked(parts)


def union_total(groups: DataFrame, total: DataFrame, key: str, label: str = "all") -> DataFrame:
    """The total row, labelled in the key column, together with the group rows."""
    return total.withColumn(key, F.lit(label)).unionByName(groups.withColumn(key, F.col(key).cast("string")))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def missing_from(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    return left.join(right, key, "left_anti")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join in which null keys meet; the left keys are kept."""
    renamed = right.withColumnsRenamed({k: f"right_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"right_{k}")) for k in keys]
    return left.join(renamed, same, how).drop(*[f"right_{k}" for k in keys])
