"""Joins on two inequalities: blocks of both tables, pairs of blocks pruned by their extremes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlab.operators.ranges import ticks
from statlab.session import stage

#: Rows of a smallest block on average, and the blocks one is cut into.
ROWS_PER_BLOCK = 2_000
BRANCH = 16
#: Row pairs that two blocks may have to be compared as they are, and rows that travel as one.
FEW_PAIRS = 10_000
CHUNK = 512


def _blocks(df: DataFrame, levels: int) -> DataFrame:
    """Adds ``b1`` to ``b<levels>``: blocks within blocks, cut along ``_x`` and ``_y`` in turn where each has about equally many rows."""
    rows = df.withColumn("b0", F.lit(0).cast("long"))
    for level in range(levels):
        axis, parent = ("_x", "_y")[level % 2], f"b{level}"
        probes = [i / BRANCH for i in range(1, BRANCH)]
        cuts = stage(rows.groupBy(parent).agg(F.percentile_approx(axis, probes, 1000).alias("_cuts")), "cuts")
        place = F.size(F.filter(F.array_distinct("_cuts"), lambda c: c <= F.col(axis)))
        rows = rows.join(cuts, parent).withColumn(f"b{level + 1}", F.col(parent) * BRANCH + place).drop("_cuts")
        rows = stage(rows, "blocks")
    return rows


def _extremes(rows: DataFrame, level: int, side: str) -> DataFrame:
    """Per block its parent, its number of rows, and the least and the greatest value of each axis."""
    parent = f"b{level - 1}"
    found = rows.groupBy(F.col(parent).alias(f"{side}p"), F.col(f"b{level}").alias(f"{side}b"))
    ends = [how(axis).alias(side + axis[1:] + end) for axis in ("_x", "_y") for how, end in ((F.min, "0"), (F.max, "1"))]
    return stage(found.agg(F.count("*").alias(f"{side}n"), *ends), "extremes")


def _chunks(rows: DataFrame, level: int, side: str) -> DataFrame:
    """The rows of a level's blocks, up to ``CHUNK`` of a block in one array."""
    block = f"b{level}"
    place = F.row_number().over(Window.partitionBy(block).orderBy("_x")) - 1
    held = rows.select(F.col(block).alias(f"{side}b"), F.floor(place / CHUNK).cast("long").alias(f"{side}c"), F.struct("_x", "_y", side).alias("row"))
    return held.groupBy(f"{side}b", f"{side}c").agg(F.collect_list("row").alias(f"{side}rows")).withColumn("level", F.lit(level))


def _less(strict: bool, a: str, b: str) -> Column:
    return F.col(a) < F.col(b) if strict else F.col(a) <= F.col(b)


class ThetaJoin:
    """Pairs of rows of ``left`` and ``right`` that satisfy both conditions, each ``(left column, operator, right column)``
    with one of ``< <= > >=``.

    Both tables are cut into blocks along both columns in turn, by quantiles, down to about ``rows_per_block`` rows.
    Pairs of blocks are followed from the largest to the smallest as far as their extremes leave room for a match, and
    no further where all their rows match or where they have few; the blocks' pairs are a table joined on its parents.
    So they grow with the edge of the matches, not with their number. Rows then meet by equal joins on the pairs left,
    many rows of a block at a time. Null values match nothing.
    """

    def __init__(self, left: DataFrame, right: DataFrame, first: tuple[str, str, str], second: tuple[str, str, str], rows_per_block: int = ROWS_PER_BLOCK):
        self.strict = [op in ("<", ">") for _, op, _ in (first, second)]
        if any(op not in ("<", "<=", ">", ">=") for _, op, _ in (first, second)):
            raise ValueError("conditions use < <= > >=")
        self.columns = left.columns, right.columns

        def prepared(df: DataFrame, name: str, side: int) -> DataFrame:
            # A condition with > is one with < between the negated values.
            value = [ticks(df, c[side]) * (-1 if c[1][0] == ">" else 1) for c in (first, second)]
            whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
            return stage(df.select(value[0].alias("_x"), value[1].alias("_y"), whole).where("_x IS NOT NULL AND _y IS NOT NULL"), "theta")

        sides = [prepared(left, "l", 0), prepared(right, "r", 2)]
        levels, most = 1, max(s.count() for s in sides)
        while BRANCH**levels * rows_per_block < most:
            levels += 1
        self.levels = levels
        self.left, self.right = (_blocks(s, levels) for s in sides)
        self.block_pairs = self._pairs()

    def _pairs(self) -> DataFrame:
        """``level, lb, rb``: pairs of blocks that may hold a match, none within another; ``sure`` where all rows match."""
        spark = self.left.sparkSession
        parents = spark.range(1).select(F.col("id").alias("lp"), F.col("id").alias("rp"))
        room = _less(self.strict[0], "lx0", "rx1") & _less(self.strict[1], "ly0", "ry1")
        sure = _less(self.strict[0], "lx1", "rx0") & _less(self.strict[1], "ly1", "ry0")
        found = []
        for level in range(1, self.levels + 1):
            met = parents.join(_extremes(self.left, level, "l"), "lp").join(_extremes(self.right, level, "r"), "rp").where(room)
            ends = sure | (F.col("ln") * F.col("rn") <= FEW_PAIRS) | F.lit(level == self.levels)
            pairs = stage(met.select(F.lit(level).alias("level"), "lb", "rb", "ln", "rn", sure.alias("sure"), ends.alias("ends")), "block-pairs")
            found.append(pairs.where("ends").drop("ends"))
            parents = pairs.where("NOT ends").select(F.col("lb").alias("lp"), F.col("rb").alias("rp"))
        return reduce(DataFrame.unionByName, found)

    def rows(self, prefix: str = "right_") -> DataFrame:
        """The pairs: columns of ``left``, and those of ``right`` with ``prefix`` before their names."""
        used = sorted(r[0] for r in self.block_pairs.select("level").distinct().collect()) or [self.levels]
        l, r = (reduce(DataFrame.unionByName, [_chunks(rows, v, side) for v in used]) for rows, side in ((self.left, "l"), (self.right, "r")))

        def each(n: str) -> Column:
            return F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / CHUNK).cast("long")))

        dealt = self.block_pairs.withColumn("lc", each("ln")).withColumn("rc", each("rn")).drop("ln", "rn")
        met = dealt.join(l.hint("merge"), ["level", "lb", "lc"]).join(r.hint("merge"), ["level", "rb", "rc"]).select("sure", "lrows", "rrows")
        met = met.select("sure", F.explode("lrows").alias("a"), "rrows").select("sure", "a", F.explode("rrows").alias("b"))
        met = met.where(F.col("sure") | (_less(self.strict[0], "a._x", "b._x") & _less(self.strict[1], "a._y", "b._y")))
        return met.select(*[F.col(f"a.l.`{c}`").alias(c) for c in self.columns[0]], *[F.col(f"b.r.`{c}`").alias(prefix + c) for c in self.columns[1]])


def theta_join(
    left: DataFrame, right: DataFrame, first: tuple[str, str, str], second: tuple[str, str, str], prefix: str = "right_",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    return ThetaJoin(left, right, first, second, rows_per_block).rows(prefix)
