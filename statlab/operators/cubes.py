"""Aggregates and distinct counts over many grouping sets, from one reduction at the finest grain."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlab.operators.reshape import stacked
from statlab.session import stage

FIRST = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
MERGED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def cube_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(dims), -1, -1) for s in combinations(dims, n)]


def rollup_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def _lattice(dims: Sequence[str], wanted: set[int]) -> list[dict[int, list[int]]]:
    """Per level the sets (as masks of the dimensions left out) made from each set of the level before.

    A set comes from the one with its lowest dimension put back, so each is made once, and from fewer rows than the finest.
    """
    needed = set()
    for mask in wanted:
        while mask:
            needed.add(mask)
            mask &= mask - 1
    levels = []
    for n in range(1, len(dims) + 1):
        made: dict[int, list[int]] = {}
        for mask in sorted(m for m in needed if m.bit_count() == n):
            made.setdefault(mask & (mask - 1), []).append(mask)
        levels.append(made)
    return [made for made in levels if made]


def _upwards(finest: DataFrame, dims: Sequence[str], levels: list[dict[int, list[int]]], merge) -> list[DataFrame]:
    """The reduced rows of every set, level by level; ``merge`` reduces what falls together."""
    found = [stage(merge(finest.withColumn("grouping_id", F.lit(0).cast("long"))), "finest")]
    for made in levels:
        children = F.create_map(*[x for p, c in made.items() for x in (F.lit(p).cast("long"), F.lit(c).cast("array<bigint>"))])
        rows = found[-1].where(F.col("grouping_id").isin(list(made))).withColumn("grouping_id", F.explode(children[F.col("grouping_id")]))
        left_out = {d: F.when(F.col("grouping_id").bitwiseAND(1 << i) == 0, F.col(f"`{d}`")) for i, d in enumerate(reversed(dims))}
        found.append(stage(merge(rows.withColumns(left_out)), "coarser"))
    return found


def grouped(
    df: DataFrame,
    dims: Sequence[str],
    distinct: dict[str, str],
    measures: dict[str, tuple[str, str | Column]],
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """``dims, grouping_id``, and a column per entry of ``distinct`` and ``measures``, for every grouping set.

    ``distinct`` names columns whose different values are counted; ``measures`` gives ``count``, ``sum``, ``min`` or
    ``max`` of a column. ``sets`` are subsets of ``dims``, by default all of them (a cube). ``grouping_id`` has a bit for
    each dimension left out, the last dimension the lowest, so a total is told apart from a null group.

    The table is read once for the measures and once, by its own columns, per distinct count, and is reduced to the finest
    grain there: rows are never multiplied by the number of sets. Each coarser set is merged from a finer one, its
    different values by the value, so that no group is gathered in one task, the total neither. Jobs: one per
    dimension and distinct count. Null values are not counted, as in SQL; an empty table gives no rows. ``dims`` may not
    be empty, and no column may be called ``grouping_id`` or ``_value``.
    """
    dims = list(dims)
    if not dims:
        raise ValueError("no dimensions")
    masks = [sum(1 << i for i, d in enumerate(reversed(dims)) if d not in s) for s in (cube_sets(dims) if sets is None else sets)]
    levels = _lattice(dims, set(masks))
    keys = ["grouping_id", *[f"`{d}`" for d in dims]]
    names = [*distinct, *measures]

    def lined_up(part: DataFrame, own: Sequence[str]) -> DataFrame:
        """The columns of the result, null where another part holds them."""
        types = dict(part.dtypes)
        return part.select(*keys, *[F.col(f"`{n}`") if n in own else F.lit(None).cast(kinds.get(n, types.get(n, "long"))).alias(n) for n in names])

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[MERGED[how](f"`{n}`").alias(n) for n, (how, _) in measures.items()])

    every = measures or {"_n": ("count", F.lit(1))}
    finest = df.groupBy(*[f"`{d}`" for d in dims]).agg(*[FIRST[how](c).alias(n) for n, (how, c) in every.items()])
    kinds = dict(finest.dtypes)
    reduce_measures = merged if measures else (lambda rows: rows.select(*keys).distinct())
    parts = [lined_up(p, list(measures)) for p in _upwards(finest, dims, levels, reduce_measures)]
    for name, column in distinct.items():
        pairs = df.select(*[f"`{d}`" for d in dims], F.col(f"`{column}`").alias("_value")).where("_value is not null")
        for part in _upwards(pairs, dims, levels, lambda rows: rows.select(*keys, "_value").distinct()):
            parts.append(lined_up(part.groupBy(*keys).agg(F.count("*").alias(name)), [name]))
    folded = stacked(parts).where(F.col("grouping_id").isin(masks)).groupBy(*keys)
    found = folded.agg(*[F.max(f"`{n}`").alias(n) for n in names])
    return found.withColumns({n: F.coalesce(F.col(f"`{n}`"), F.lit(0)) for n in distinct})
