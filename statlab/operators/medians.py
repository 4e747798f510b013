"""Exact medians without bringing a group's values together.

``median`` keeps every distinct value of a group in one task, and the grand total is a group that
holds the whole table. Here a histogram finds the middle instead:

1. count the values of each group in logarithmic bins; the partial counts are what is shuffled;
2. find the bin, or the two neighbours, holding the two middle ranks. Between two bins, or in a bin
   of a single value, the median is known already;
3. otherwise read the table again, keep the rows within the bin, and count their values;
4. while these are many, cut the bin into equal steps and find the step in the same way; then rank
   the few values left.

A task holds at most some 67,000 bins of a group in step 2, and ``STEPS`` steps or ``FEW`` values in
step 4, whatever the number of rows; and every count is exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlab.operators.reshape import batches, join_null_safe, number, stacked, to_long
from statlab.session import stage

BINS_PER_OCTAVE = 16
STEPS = 2 ** 14
FEW = 1_000_000
TARGET = ["is_total", "grp", "metric"]


def _bin(value: Column) -> Column:
    """A whole number that never falls as the value rises; zero has its own bin."""
    octaves = F.least(F.log2(F.abs(value)), F.lit(1100.0))
    step = F.lit(20000) + F.floor(octaves * BINS_PER_OCTAVE)
    return F.when(value == 0, F.lit(0).cast("long")).when(value > 0, step).otherwise(-step)


def _step(value: Column, low: Column, high: Column) -> Column:
    return F.when(high > low, F.floor((value - low) / (high - low) * STEPS)).otherwise(F.lit(0).cast("long"))


def _covers(rank: str) -> Column:
    return (F.col("skipped") <= F.col(rank)) & (F.col(rank) < F.col("skipped") + F.col("cnt"))


def _holding_middle(counts: DataFrame, within: Sequence[str], order: str) -> DataFrame:
    """Rows whose run of ranks covers a middle rank; ``skipped`` becomes the count before the row."""
    running = Window.partitionBy(*within).orderBy(order)
    return (
        counts.withColumn("skipped", F.col("skipped") + F.sum("cnt").over(running) - F.col("cnt"))
        .where(_covers("low_rank") | _covers("high_rank"))
    )


def _narrowed(held: DataFrame) -> DataFrame:
    """One row per target from its one or two runs of values.

    ``middle`` is the median where it is known: two runs meet at the highest value of the first and
    the lowest of the second. Elsewhere it is null, and the median lies between ``low`` and ``high``.
    """
    two = F.count("*") == 2
    first_end, second_start = F.min("high"), F.max("low")
    known = F.when(two | (F.min("low") == F.max("high")), _between(first_end, second_start))
    return held.groupBy(*TARGET).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), known.alias("middle"),
        F.min("skipped").alias("skipped"), F.max("n_values").alias("n_values"),
        F.first("low_rank").alias("low_rank"), F.first("high_rank").alias("high_rank"),
    )


def _between(low: Column, high: Column) -> Column:
    return F.when(low == high, low).otherwise((low + high) / 2)


def _find_bins(rows: DataFrame, targets: list[list[str]]) -> DataFrame:
    histogram = rows.groupBy("grp", "metric", _bin(F.col("value")).alias("bin")).agg(
        F.count("value").alias("cnt"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    # The total is folded from the bins of the groups, not from the rows.
    counts = histogram.groupingSets([[*t, "metric", "bin"] for t in targets], "grp", "metric", "bin").agg(
        F.grouping("grp").cast("boolean").alias("is_total"),
        F.sum("cnt").alias("cnt"), F.min("low").alias("low"), F.max("high").alias("high"),
    )
    everything = Window.partitionBy(*TARGET)
    ranked = (
        counts.withColumn("n", F.sum("cnt").over(everything))
        .withColumn("low_rank", F.floor((F.col("n") - 1) / 2))
        .withColumn("high_rank", F.floor(F.col("n") / 2))
        .withColumns({"skipped": F.lit(0).cast("long"), "n_values": F.col("cnt")})
    )
    return _narrowed(_holding_middle(ranked, TARGET, "bin"))


def _count_values(wide: DataFrame, metrics: Sequence[str], found: DataFrame, per_group: bool) -> DataFrame | None:
    """Counts of the values that lie within a bin still open: ``grp, metric, value, cnt``.

    A row meets the ranges of its group before it is taken apart into metrics. None if every
    median is known.
    """
    open_bins = found.where("middle is null")
    # Two numbers per metric of the total come to the driver and go into the plan as literals.
    total = {r["metric"]: r for r in open_bins.where("is_total").select("metric", "low", "high").collect()}
    if per_group:
        ranges = stage(
            open_bins.where("not is_total").groupBy("grp").pivot("metric", list(metrics)).agg(
                F.min("low").alias("low"), F.max("high").alias("high")
            ),
            "median-ranges",
        )

    def kept(part: Sequence[str]) -> DataFrame:
        rows = wide.select("grp", *part)
        if per_group:
            own = ranges.select("grp", *[f"{m}_{end}" for m in part for end in ("low", "high")])
            rows = join_null_safe(rows, own, ["grp"], "left")
        inside = []
        for m in part:
            tests = [F.col(m).between(F.lit(total[m]["low"]), F.lit(total[m]["high"]))] if m in total else []
            if per_group:
                tests.append(F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")))
            inside.append(F.when(reduce(or_, tests), F.col(m)).alias(m))
        return to_long(rows.select("grp", *inside), ["grp"], part)

    searched = [m for m in metrics if per_group or m in total]
    if not searched:
        return None
    long = stacked(kept(part) for part in batches(searched, 3))
    return long.groupBy("grp", "metric", "value").agg(F.count("*").alias("cnt"))


def _inside(values: DataFrame, runs: DataFrame) -> DataFrame:
    """The counted values of each target that lie within its run; those of the total are added up."""
    within = F.col("value").between(F.col("low"), F.col("high"))
    runs = runs.drop("middle", "n_values")
    of_groups = join_null_safe(values, runs.where("not is_total"), ["grp", "metric"]).where(within)
    folded = values.groupBy("metric", "value").agg(F.sum("cnt").alias("cnt"))
    of_total = folded.join(runs.where("is_total"), "metric").where(within)
    return of_groups.unionByName(of_total)


def _find_steps(values: DataFrame, runs: DataFrame) -> DataFrame:
    step = _step(F.col("value"), F.col("low"), F.col("high")).alias("step")
    steps = _inside(values, runs).groupBy(*TARGET, step, "low_rank", "high_rank", "skipped").agg(
        F.sum("cnt").alias("cnt"), F.count("*").alias("n_values"),
        F.min("value").alias("low"), F.max("value").alias("high"),
    )
    return _narrowed(_holding_middle(steps, TARGET, "step"))


def exact_medians(
    df: DataFrame,
    metrics: Sequence[str],
    group: str | None = None,
    grand_total: bool = True,
) -> DataFrame:
    """Interpolated medians, nulls ignored: ``is_total, grp, metric, median``.

    With ``group`` one row per group and metric, and with ``grand_total`` one per metric over all
    rows. The two reads of the table run when the function is called.
    """
    per_group = group is not None
    key = F.col(group) if per_group else F.lit(None).cast("string")
    wide = df.select(key.alias("grp"), *[number(m).alias(m) for m in metrics])
    targets = ([["grp"]] if per_group else []) + ([[]] if grand_total or not per_group else [])

    # Staged, so that each read of the table happens once and the join with its result has a known size.
    found = stage(_find_bins(to_long(wide, ["grp"], metrics), targets), "median-bins")
    known = found.where("middle is not null").select(*TARGET, F.col("middle").alias("median"))
    counted = _count_values(wide, metrics, found, per_group)
    if counted is None:
        return known
    values = stage(counted, "median-values")

    runs = found.where("middle is null")
    most = values.count()
    while most > FEW:
        found = stage(_find_steps(values, runs), "median-steps")
        known = known.unionByName(found.where("middle is not null").select(*TARGET, F.col("middle").alias("median")))
        runs = found.where("middle is null")
        most = runs.agg(F.max("n_values")).first()[0] or 0
    ranked = _holding_middle(_inside(values, runs), TARGET, "value")
    ends = ranked.groupBy(*TARGET).agg(_between(F.min("value"), F.max("value")).alias("median"))
    return known.unionByName(ends)
