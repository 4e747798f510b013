"""Windows over the whole table: running totals, neighbours, moving frames and ranks, without a window of one task.

Each takes the table in ranges of its order (``ranges.ordered``). What a range needs of the others is small: their
totals, the rows beside its ends, or the groups of equal rows that go across its ends.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statlab.operators.ranges import Ordered, ordered
from statlab.session import stage

__all__ = ["ordered", "running", "neighbours", "framed", "ranks"]

_RUNNING: dict[str, tuple[Callable, Callable]] = {
    "sum": (F.sum, lambda a, b: a + b), "count": (F.count, lambda a, b: a + b), "min": (F.min, min), "max": (F.max, max),
}


def _join(how: str, before: Column, own: Column) -> Column:
    if how in ("sum", "count"):
        return F.when(before.isNull(), own).when(own.isNull(), before).otherwise(before + own)
    return (F.least if how == "min" else F.greatest)(before, own)  # both skip nulls


def running(order: Ordered, totals: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Adds running aggregates from the first row to each row: name to ``(sum | count | min | max, column)``.

    As in SQL nulls are skipped, and before the first value there is null (count: 0). One number per range and
    aggregate goes to the driver.
    """
    parts = order.rows.groupBy("_part").agg(*[_RUNNING[how][0](F.col(f"`{c}`")).alias(n) for n, (how, c) in totals.items()])
    known = {r["_part"]: r for r in parts.collect()}
    whole = Window.partitionBy("_part").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = order.rows
    for name, (how, column) in totals.items():
        before, held = [], None
        for i in range(len(order.starts) - 1):
            before.append(held)
            own = known[i][name] if i in known else None
            held = own if held is None else held if own is None else _RUNNING[how][1](held, own)
        own = _RUNNING[how][0](F.col(f"`{column}`"))
        kind = parts.schema[name].dataType.simpleString()
        rows = rows.withColumn(name, _join(how, order.of_part(before, kind), own.over(whole)) if before else own.over(whole))
    return rows


def framed(order: Ordered, columns: Mapping[str, Column], preceding: int, following: int) -> DataFrame:
    """Adds aggregates over the rows from ``preceding`` before each row to ``following`` after it (negative: the other way).

    Rows near the end of a range are copied to the ranges whose frames reach them, which may be several of small ones.
    """
    reach_back, reach_on = max(preceding, 0), max(following, 0)
    starts, ends = order.starts[:-1], order.starts[1:]
    frame = Window.partitionBy("_part").orderBy("_pos").rowsBetween(-preceding, following)
    if not starts:
        return order.rows.withColumns({n: c.over(frame) for n, c in columns.items()})
    first, last = F.lit(starts).cast("array<bigint>"), F.lit(ends).cast("array<bigint>")
    pos = F.col("_pos")
    near = (pos - order.of_part(starts, "bigint") < reach_on) | (order.of_part(ends, "bigint") - pos <= reach_back)
    needed = F.filter(F.sequence(F.lit(0), F.lit(len(starts) - 1)), lambda p: (
        (p != F.col("_part")) & (F.get(first, p) < F.get(last, p)) & (F.get(first, p) - reach_back <= pos) & (pos < F.get(last, p) + reach_on)))
    copies = order.rows.where(near).withColumn("_part", F.explode(needed)).withColumn("_copy", F.lit(True))
    rows = order.rows.withColumn("_copy", F.lit(False)).unionByName(copies)
    return rows.withColumns({n: c.over(frame) for n, c in columns.items()}).where("NOT _copy").drop("_copy")


def neighbours(order: Ordered, columns: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Adds the value of another row: name to ``(column, distance)``, positive distances looking back (lag), negative ones ahead (lead)."""
    rows = order.rows
    for name, (column, distance) in columns.items():
        value = F.first(F.struct(F.col(f"`{column}`").alias("v")))
        rows = framed(Ordered(rows, order.starts), {name: value}, distance, -distance).withColumn(name, F.col(f"{name}.v"))
    return rows


def ranks(order: Ordered, keys: Sequence[str], tiles: int = 4) -> DataFrame:
    """Adds ``row_number, rank, dense_rank, percent_rank, cume_dist, ntile``; rows equal in ``keys`` are peers.

    ``keys`` are the columns of the order. Peers are looked for within each range; a group of peers that goes across
    the ends of ranges, as those of a very frequent value, is put together from two rows per range.
    """
    n = order.n
    peers = Window.partitionBy("_part", *keys)
    rows = order.rows.withColumns({"_first": F.min("_pos").over(peers), "_last": F.max("_pos").over(peers)})
    rows = stage(rows, "peers")
    ends = [s for s in order.starts[:-1]] + [s - 1 for s in order.starts[1:]]
    edges = rows.where(F.col("_pos").isin(sorted(set(ends)))).select(*keys, "_first", "_last").distinct()
    across = edges.groupBy(*keys).agg(F.min("_first").alias("_low"), F.max("_last").alias("_high"), F.count("*").alias("_n")).where("_n > 1")
    across = stage(across.select(*[F.col(k).alias(f"_e_{k}") for k in keys], "_low", "_high"), "across")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_e_{k}"))
    rows = rows.join(across, same, "left").withColumns({"_first": F.coalesce("_low", "_first"), "_last": F.coalesce("_high", "_last")})
    rows = rows.withColumn("_new", (F.col("_first") == F.col("_pos")).cast("long")).drop("_low", "_high", *[f"_e_{k}" for k in keys])
    rows = running(Ordered(stage(rows, "ranked"), order.starts), {"dense_rank": ("sum", "_new")})
    pos, rank = F.col("_pos"), F.col("_first") + 1
    size, more = n // tiles, n % tiles
    in_large = pos < more * (size + 1)
    tile = F.when(in_large, F.floor(pos / (size + 1))).otherwise(F.lit(more) + F.floor((pos - more * (size + 1)) / max(size, 1)))
    return rows.withColumns({
        "row_number": pos + 1, "rank": rank, "percent_rank": (rank - 1) / F.lit(float(max(n - 1, 1))),
        "cume_dist": (F.col("_last") + 1) / F.lit(float(max(n, 1))), "ntile": (tile + 1).cast("long"),
    }).drop("_first", "_last", "_new")
