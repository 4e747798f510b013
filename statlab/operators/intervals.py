"""Joins of points with intervals, and of intervals that overlap, without a cross join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlab.operators.ranges import quantile_bounds, range_of, ticks
from statlab.session import stage

#: Points a finest bin holds on average; bins whose bounds are sent along; bins of one level that make one of the next.
ROWS_PER_BIN = 2_000
COARSE = 1024
BRANCH = 16
#: The same for sums: times a finest bin holds, and bins that make one of the next level.
TIMES_PER_BIN = 32
SUMS_BRANCH = 4


def _bin(t: Column, bounds: Sequence, kind: str, fine: int) -> Column:
    """A number that never falls as ``t`` rises: a part between two bounds, and a step of equal width within it."""
    if not bounds:
        return F.lit(0).cast("long")
    part = range_of(t, bounds, kind)
    edges = F.lit(list(bounds)).cast(f"array<{kind}>")
    low, high = F.get(edges, part - 1), F.get(edges, part)
    step = F.least(F.floor((t - low).cast("double") / (high - low) * fine), F.lit(fine - 1))
    return part.cast("long") * fine + F.coalesce(step, F.lit(0)).cast("long")


def _covering(first: Column, last: Column, levels: int, branch: int = BRANCH) -> Column:
    """The bins that make up ``first`` to ``last``, as structs ``level, bin``: few, however many they are at the finest level."""
    a, b, out = first, last + 1, []
    going = F.lit(True)

    def run(low: Column, high: Column, level: int) -> Column:
        listed = F.when(low < high, F.sequence(low, high - 1)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(listed, lambda x: F.struct(F.lit(level).alias("level"), x.alias("bin")))

    none = F.array().cast("array<struct<level:int,bin:bigint>>")
    for level in range(levels):
        up, down = F.floor((a + branch - 1) / branch).cast("long"), F.floor(b / branch).cast("long")
        on = (up < down) & F.lit(level < levels - 1)
        ends = F.concat(run(a, up * branch, level), run(down * branch, b, level))
        out.append(F.when(going & on, ends).when(going, run(a, b, level)).otherwise(none))
        a, b, going = up, down, going & on
    return F.concat(*out)


def _held(df: DataFrame, name: str, keys: Sequence[str], **times: str) -> DataFrame:
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)
    return df.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)], *[ticks(df, c).alias(n) for n, c in times.items()], whole)


def _levels(bins: int, branch: int) -> int:
    levels = 1
    while branch**levels < bins:
        levels += 1
    return levels


def _cells(df: DataFrame, cells: Column) -> DataFrame:
    return df.withColumn("_cell", F.explode(cells)).select("*", "_cell.level", "_cell.bin").drop("_cell")


def _with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    for c in keys:
        df = df.where(F.col(c).isNotNull())
    return df


def _points_in(points: DataFrame, spans: DataFrame, keys: list[str], rows_per_bin: int, after_start: bool) -> DataFrame:
    """``points`` (keys, ``_t``, payload) joined with ``spans`` (keys, ``_from``, ``_to``, payload); both ends belong to
    a span, or with ``after_start`` only the later one. Every pair meets in one bin. Keys with no more points than a bin
    holds are a bin of their own: their rows meet by the keys alone."""
    points, spans = stage(_with_keys(points, keys).where("_t IS NOT NULL"), "points"), _with_keys(spans, keys).where("_from <= _to")
    begins = F.col("_t") > F.col("_from") if after_start else F.col("_t") >= F.col("_from")
    within = begins & (F.col("_t") <= F.col("_to"))
    if not keys:
        return _in_bins(points, spans, keys, rows_per_bin).where(within)
    large = stage(points.groupBy(*keys).count().where(F.col("count") > rows_per_bin).select(*keys), "large")
    if large.isEmpty():
        return points.join(spans.hint("merge"), keys).where(within)
    few = points.join(large, keys, "left_anti").join(spans.hint("merge"), keys).where(within)
    many = stage(points.join(large, keys, "left_semi"), "points")
    return few.unionByName(_in_bins(many, spans.join(large, keys, "left_semi"), keys, rows_per_bin).where(within).select(*few.columns))


def _in_bins(points: DataFrame, spans: DataFrame, keys: list[str], rows_per_bin: int) -> DataFrame:
    """Points and spans that share a bin."""
    n, kind = points.count(), dict(points.dtypes)["_t"]
    coarse = max(1, min(COARSE, n // rows_per_bin))
    fine = max(1, n // (coarse * rows_per_bin))
    bounds = quantile_bounds(points, "_t", coarse)
    levels = _levels((len(bounds) + 1) * fine, BRANCH)
    # The bins are columns of their own, so that each is worked out once, not once for each time a covering names it.
    placed = spans.withColumns({"_a": _bin(F.col("_from"), bounds, kind, fine), "_b": _bin(F.col("_to"), bounds, kind, fine)})
    spans = stage(_cells(placed, _covering(F.col("_a"), F.col("_b"), levels)).drop("_a", "_b"), "spans")
    # Points go to those levels only at which some span has a bin.
    used = sorted(r[0] for r in spans.select("level").distinct().collect())
    cells = F.array(*[F.struct(F.lit(v).alias("level"), F.floor(F.col("_own") / BRANCH**v).cast("long").alias("bin")) for v in used] or [F.lit(None).cast("struct<level:int,bin:bigint>")])
    placed = _cells(points.withColumn("_own", _bin(F.col("_t"), bounds, kind, fine)), cells).drop("_own")
    return placed.join(spans.hint("merge"), [*keys, "level", "bin"])


def _sums_in(points: DataFrame, spans: DataFrame, keys: list[str], sums: dict[str, tuple[str, str]], rows_per_bin: int) -> DataFrame:
    """``spans`` with the sums of the points of each bin that lies within them, and of each time in the bins at their two ends.

    Points come as their sums per time. Sums of a larger bin are those of its parts, so nothing is ever subtracted.
    """
    merged = [(F.sum if how == "count" else getattr(F, how))(f"`{c}`").alias(c) for c, (how, _) in sums.items()]
    kind = dict(points.dtypes)["_t"]
    n, least, most = points.agg(F.count("*"), F.min("_t"), F.max("_t")).first()
    coarse = max(1, min(COARSE, n // rows_per_bin))
    fine = max(1, n // (coarse * rows_per_bin))
    bounds = sorted({least, *quantile_bounds(points, "_t", coarse), most}) if n else []
    levels = _levels((len(bounds) + 1) * fine, SUMS_BRANCH)
    points = stage(points.withColumn("bin", _bin(F.col("_t"), bounds, kind, fine)), "points")
    own = stage(points.groupBy(*keys, "bin").agg(*merged), "bins")
    larger = F.array(*[F.struct(F.lit(v).alias("level"), F.floor(F.col("_own") / SUMS_BRANCH**v).cast("long").alias("bin")) for v in range(levels)])
    bins = stage(_cells(own.withColumnRenamed("bin", "_own"), larger).groupBy(*keys, "level", "bin").agg(*merged), "bins")
    spans = stage(spans.withColumns({"_a": _bin(F.col("_from"), bounds, kind, fine), "_b": _bin(F.col("_to"), bounds, kind, fine)}), "spans")
    whole = _cells(spans, _covering(F.col("_a") + 1, F.col("_b") - 1, levels, SUMS_BRANCH)).join(bins, [*keys, "level", "bin"])
    ends = spans.withColumn("bin", F.explode(F.array_distinct(F.array("_a", "_b")))).join(points.hint("merge"), [*keys, "bin"])
    ends = ends.where((F.col("_t") >= F.col("_from")) & (F.col("_t") <= F.col("_to")))
    found = ["s", *[f"`{c}`" for c in sums]]
    return whole.select(*found).unionByName(ends.select(*found))


def _flat(pairs: DataFrame, first: tuple[str, DataFrame, str], second: tuple[str, DataFrame, str]) -> DataFrame:
    return pairs.select(*[F.col(f"{s}.`{c}`").alias(prefix + c) for s, df, prefix in (first, second) for c in df.columns])


def range_join(
    points: DataFrame, spans: DataFrame, point: str, start: str, end: str, by: Sequence[tuple[str, str]] = (),
    prefix: str = "span_", rows_per_bin: int | None = None, sums: dict[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Each point with each span that holds it, ``start <= point <= end``, and equal columns ``by`` (names on both sides).

    Columns of ``points``, and those of ``spans`` with ``prefix`` before their names. Null points, bounds and keys match
    nothing, and neither does a span that ends before it starts. Bins hold about equally many points. A span is put in the
    fewest bins of several sizes that make it up, so a long one is a few rows, and each point it holds is in one of them.

    With ``sums``, new columns as ``(count, sum, min or max; column, or * to count rows)``, the points of a bin within a
    span come as one row of their sums in place of their columns. Each point a span holds is in one row of that span, so
    its rows are to be put together again, counts by adding them. The rows then grow with the spans, not with the pairs.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    p, s = _held(points, "p", [b[0] for b in by], _t=point), _held(spans, "s", [b[1] for b in by], _from=start, _to=end)
    if sums is not None:
        if any(how not in ("count", "sum", "min", "max") for how, _ in sums.values()):
            raise ValueError("sums are count, sum, min or max")
        first = [getattr(F, how)("*" if c == "*" else f"p.`{c}`").alias(name) for name, (how, c) in sums.items()]
        times = stage(_with_keys(p, keys).where("_t IS NOT NULL").groupBy(*keys, "_t").agg(*first), "times")
        met = _sums_in(times, _with_keys(s, keys).where("_from <= _to"), keys, sums, rows_per_bin or TIMES_PER_BIN)
        return met.select(*[F.col(f"`{c}`") for c in sums], *[F.col(f"s.`{c}`").alias(prefix + c) for c in spans.columns])
    met = _points_in(p, s, keys, rows_per_bin or ROWS_PER_BIN, False)
    return _flat(met, ("p", points, ""), ("s", spans, prefix))


def overlap_join(
    left: DataFrame, right: DataFrame, left_span: tuple[str, str], right_span: tuple[str, str], by: Sequence[tuple[str, str]] = (),
    prefix: str = "right_", rows_per_bin: int = ROWS_PER_BIN,
) -> DataFrame:
    """Pairs of rows whose spans, both ends included, have a point in common, and equal columns ``by``.

    Of two spans that overlap, either the right one starts within the left one, or the left one later within the
    right one; each case is a join of points with spans, so every pair comes once. Nulls and spans that end before they
    start match nothing.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    l = _held(left, "l", [b[0] for b in by], _from=left_span[0], _to=left_span[1]).where("_from <= _to")
    r = _held(right, "r", [b[1] for b in by], _from=right_span[0], _to=right_span[1]).where("_from <= _to")
    starts = [*keys, F.col("_from").alias("_t")]
    inside = _points_in(r.select(*starts, "r"), l, keys, rows_per_bin, False).select("l", "r")
    later = _points_in(l.select(*starts, "l"), r, keys, rows_per_bin, True).select("l", "r")
    return _flat(inside.unionByName(later), ("l", left, ""), ("r", right, prefix))
