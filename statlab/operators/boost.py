"""Boosted regression trees for all categories at once.

A level of the trees of all categories is one aggregate: residuals summed per category, node, feature and bin. So the
number of jobs depends on rounds and depth alone, and only sums are shuffled, added up in the tasks first. Residuals are
whole numbers, so neither the order of summation nor the partitioning decides a split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlab.session import new_path, scratch, stage

#: Residuals are counted in this part of the spread of a category's actual values.
UNITS = 1 << 24
#: Cells of equal width between a feature's ends, which are put together to bins of nearly equal counts.
CELLS = 256
#: Numbers beyond are not finite here, so that differences do not overflow.
LARGEST = 1e300


@dataclass(frozen=True)
class Trees:
    """How trees are grown: shrinkage ``rate``, ``ridge`` added to every count, ``least`` rows on either side of a split."""

    rounds: int = 20
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    ridge: float = 1.0
    least: int = 1


def _finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST)


def _missing(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def _point(features: Sequence[str]) -> Column:
    return F.array(*[F.col(f"`{f}`").cast("double") for f in features])


def _rows(df: DataFrame, category: str, features: Sequence[str], actual: str) -> DataFrame:
    rows = df.select(F.col(f"`{category}`").alias("c"), _point(features).alias("x"), F.col(f"`{actual}`").cast("double").alias("y"))
    return rows.where(F.col("c").isNotNull() & _finite(F.col("y")))


def _scales(rows: DataFrame, features: int) -> DataFrame:
    """``c, low, unit, base, lows, highs``: the scale of the actual values, their mean on it, the ends of the features."""
    x = [F.col("x")[i] for i in range(features)]
    ends = rows.groupBy("c").agg(
        F.min("y").alias("low"), ((F.max("y") - F.min("y")) / UNITS).alias("unit"),
        *[F.array(*[end(F.when(_finite(v), v)) for v in x]).alias(name) for name, end in (("lows", F.min), ("highs", F.max))])
    ends = stage(ends, "ends")
    # A key of its own, so that the sums are shuffled again and a hot category's join can be split.
    whole = rows.join(ends.select("c", "low", "unit"), "c").groupBy(F.struct("c").alias("at"))
    means = whole.agg(F.floor(F.sum(_units()) / F.count("*")).alias("base"))
    return stage(means.select("at.c", "base").join(ends, "c"), "scales")


def _units() -> Column:
    """The actual value as a whole number from 0 to UNITS."""
    return F.when(F.col("unit") > 0, F.floor(F.try_divide(F.col("y") - F.col("low"), F.col("unit")))).otherwise(F.lit(0).cast("long"))


def _edges(rows: DataFrame, scales: DataFrame, bins: int) -> DataFrame:
    """``c, tops``: per feature the highest value of every bin, in ascending order."""
    each = rows.join(scales.select("c", "lows", "highs"), "c").select("c", F.posexplode(F.arrays_zip("x", "lows", "highs")).alias("f", "v"))
    each = each.select("c", "f", "v.*").where(~_missing(F.col("x")))
    part = F.try_divide(F.col("x") - F.col("lows"), F.col("highs") - F.col("lows")) * CELLS
    cell = F.when(F.col("highs") > F.col("lows"), F.floor(F.greatest(F.lit(0.0), F.least(F.lit(CELLS - 1.0), part))).cast("int")).otherwise(0)
    cells = each.groupBy(F.struct("c", "f").alias("at"), cell.alias("cell")).agg(F.count("*").alias("n"), F.max("x").alias("top"))
    of_feature = Window.partitionBy("at")
    before = F.sum("n").over(of_feature.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    number = F.floor(F.coalesce(before, F.lit(0)) * bins / F.sum("n").over(of_feature))
    tops = cells.select("at", "top", number.alias("bin")).groupBy("at", "bin").agg(F.max("top").alias("top"))
    tops = tops.groupBy("at").agg(F.sort_array(F.collect_list("top")).alias("tops"))
    return tops.groupBy("at.c").agg(F.map_from_entries(F.collect_list(F.struct("at.f", "tops"))).alias("tops"))


def _bins(x: Column, tops: Column, features: int) -> Column:
    """The bin of every feature, from 1; 0 where it is missing."""
    def place(i: int) -> Column:
        below = F.size(F.filter(F.try_element_at(tops, F.lit(i)), lambda top: top < x[i]))
        return F.when(_missing(x[i]), 0).otherwise(1 + F.coalesce(F.greatest(below, F.lit(0)), F.lit(0))).cast("short")

    return F.array(*[place(i) for i in range(features)])


def _prepared(df: DataFrame, category: str, features: Sequence[str], actual: str, bins: int) -> tuple[DataFrame, DataFrame]:
    """Scale and bins of every category, and the narrow rows ``c, bins, r`` that trees are grown from."""
    rows = stage(_rows(df, category, features, actual), "rows")
    scales = _scales(rows, len(features))
    scales = stage(scales.join(_edges(rows, scales, bins), "c", "left").drop("lows", "highs"), "scales")
    known = rows.join(scales, "c").select(
        "c", _bins(F.col("x"), F.col("tops"), len(features)).alias("bins"), (_units() - F.col("base")).alias("r"))
    return scales, stage(known, "binned")


def _node(splits: Column, bins: Column, depth: int) -> Column:
    """The node that a row reaches after ``depth`` levels. The children of n are 2n and 2n + 1; without a split it is the left one."""
    def step(node: Column, _: Column) -> Column:
        split = F.try_element_at(splits, node)
        return node * 2 + F.coalesce((F.get(bins, split["f"]) > split["b"]).cast("int"), F.lit(0))
    return F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(1), step)


def _gains(rows: DataFrame, ridge: float) -> DataFrame:
    """``at, f, b, gl, nl, g, n, gain`` of every cut of every node ``at``: bins up to ``b`` go left, with ``nl`` rows of sum ``gl``."""
    each = rows.select("at", "r", F.posexplode("bins").alias("f", "b"))
    sums = each.groupBy("at", "f", "b").agg(F.sum("r").alias("g"), F.count("*").alias("n"))
    of_feature = Window.partitionBy("at", "f")
    so_far = of_feature.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    cuts = sums.select(
        "at", "f", "b", F.sum("g").over(so_far).alias("gl"), F.sum("n").over(so_far).alias("nl"),
        F.sum("g").over(of_feature).alias("g"), F.sum("n").over(of_feature).alias("n"))

    def score(g: Column, n: Column) -> Column:
        return F.try_divide(g.cast("double") * g.cast("double"), n + F.lit(float(ridge)))

    left, both = [F.col("gl"), F.col("nl")], [F.col("g"), F.col("n")]
    return cuts.withColumn("gain", score(*left) + score(both[0] - left[0], both[1] - left[1]) - score(*both))


def _allowed(least: int) -> Column:
    return (F.col("nl") >= max(least, 1)) & (F.col("n") - F.col("nl") >= max(least, 1)) & (F.col("gain") > 0)


def _best(gains: DataFrame, least: int) -> DataFrame:
    """``c, node, g, n, best`` per node: the cut of the highest gain, of equal ones the first; null where none is allowed."""
    order = F.struct("gain", (-F.col("f")).alias("f"), (-F.col("b")).alias("b"))
    best = F.max_by(F.struct("f", "b", "gl", "nl"), F.when(_allowed(least), order))
    return gains.groupBy("at").agg(F.max("g").alias("g"), F.max("n").alias("n"), best.alias("best")).select("at.*", "g", "n", "best")


def _splits() -> Column:
    split = F.struct("node", F.struct("best.f", "best.b").alias("split"))
    return F.map_from_entries(F.collect_list(F.when(F.col("best").isNotNull(), split)))


def _values(trees: Trees) -> Column:
    """What the leaves under the last level's nodes add, by number of the leaf."""
    def leaf(number: Column, g: Column, n: Column) -> Column:
        return F.struct(number.alias("leaf"), F.floor(F.lit(float(trees.rate)) * g / (n + F.lit(float(trees.ridge)))).alias("value"))

    node, best = F.col("node"), F.col("best")
    split = F.array(leaf(node * 2, best["gl"], best["nl"]), leaf(node * 2 + 1, F.col("g") - best["gl"], F.col("n") - best["nl"]))
    return F.map_from_entries(F.flatten(F.collect_list(F.when(best.isNotNull(), split).otherwise(F.array(leaf(node * 2, F.col("g"), F.col("n")))))))


def _grown(rows: DataFrame, trees: Trees) -> DataFrame:
    """``c, splits, values``: a tree for the residuals of every category, an aggregate a level."""
    levels = []
    for level in range(trees.depth):
        at = rows.withColumn("node", F.lit(1))
        if levels:
            so_far = stage(reduce(DataFrame.unionAll, levels).groupBy("c").agg(_splits().alias("splits")), "splits")
            at = rows.join(so_far, "c").withColumn("node", _node(F.col("splits"), F.col("bins"), level))
        at = at.select(F.struct("c", "node").alias("at"), "bins", "r")
        levels.append(stage(_best(_gains(at, trees.ridge), trees.least), "level"))
    splits = reduce(DataFrame.unionAll, levels).groupBy("c").agg(_splits().alias("splits"))
    return stage(splits.join(levels[-1].groupBy("c").agg(_values(trees).alias("values")), "c"), "tree")


def _added(tree_splits: Column, values: Column, bins: Column, depth: int) -> Column:
    return F.coalesce(F.try_element_at(values, _node(tree_splits, bins, depth)), F.lit(0).cast("long"))


def root_gains(df: DataFrame, category: str, features: Sequence[str], actual: str, trees: Trees = Trees()) -> DataFrame:
    """``c, f, threshold, n_left, gain`` of every cut allowed at the first node: rows up to the threshold go left.

    The threshold is null where only rows without the feature go left. Gains are in units of the category's scale.
    """
    scales, rows = _prepared(df, category, features, actual, trees.bins)
    at = rows.select(F.struct("c", F.lit(1).alias("node")).alias("at"), "bins", "r")
    cuts = _gains(at, trees.ridge).where(_allowed(trees.least)).select("at.c", "f", "b", "nl", "gain")
    threshold = F.get(F.try_element_at("tops", F.col("f")), F.col("b") - 1)
    return cuts.join(scales.select("c", "tops"), "c").select(
        "c", "f", F.when(F.col("b") > 0, threshold).alias("threshold"), F.col("nl").alias("n_left"), "gain")


def fit(df: DataFrame, category: str, features: Sequence[str], actual: str, trees: Trees = Trees()) -> DataFrame:
    """The trees of every category: ``c, low, unit, base, tops, trees``, a row each, as written in the shared folder.

    Squared error, second-order gains; a missing feature (null or NaN) is a bin of its own, below all others. Rows of a
    null category, or whose actual value is missing or not finite, are not trained on. The empty text is a category. A
    category of one value or one row predicts that value; an empty table gives an empty model. The rows' bins and residuals are written again in
    each round, and removed when the model is there.
    """
    if min(trees.rounds, trees.depth, trees.bins) < 1 or not features:
        raise ValueError("at least one round, level, bin and feature")
    spark = df.sparkSession
    path = new_path(spark, "trees")
    with scratch(spark):
        scales, rows = _prepared(df, category, features, actual, trees.bins)
        grown = []
        for number in range(trees.rounds):
            tree = _grown(rows, trees)
            grown.append(tree.select("c", F.struct(F.lit(number).alias("number"), "splits", "values").alias("tree")))
            if number + 1 < trees.rounds:
                less = _added(F.col("splits"), F.col("values"), F.col("bins"), trees.depth)
                rows = stage(rows.join(tree, "c").select("c", "bins", (F.col("r") - less).alias("r")), "residuals")
        whole = reduce(DataFrame.unionAll, grown).groupBy("c").agg(F.collect_list("tree").alias("trees"))
        model = scales.join(whole, "c")
        model.write.parquet(path)
    return spark.read.schema(model.schema).parquet(path)


def predict(df: DataFrame, model: DataFrame, category: str, features: Sequence[str], depth: int, predicted: str = "predicted") -> DataFrame:
    """``df`` with the model's value as ``predicted``; null for rows of a null category or one without a model.

    The name ``_model`` is used in between and must not be a column of ``df``.
    """
    held = model.select(F.struct(*model.columns).alias("_model"))
    joined = df.join(held, F.col(f"`{category}`") == F.col("_model.c"), "left")
    # The bins are bound to a name once, not computed again for every tree.
    bins = F.array(_bins(_point(features), F.col("_model.tops"), len(features)))
    total = F.transform(bins, lambda b: F.aggregate(
        F.col("_model.trees"), F.col("_model.base"), lambda s, t: s + _added(t["splits"], t["values"], b, depth)))[0]
    value = F.col("_model.low") + F.col("_model.unit") * total.cast("double")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != predicted], value.alias(predicted))
