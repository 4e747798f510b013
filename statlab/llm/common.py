"""What several operators share: numbering, word hashes, binned order."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statlab.session import stage

#: What is no space, tab, line break, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"
LOWEST = -(1 << 63)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """The quarter of the documents nothing is learned from; a null id is not part of it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def row_names() -> list[Column]:
    """``doc`` and ``row``, which tell rows apart by id and text: a null id is the lowest, and a null text is empty."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("row")]


def numbered(df: DataFrame, order: Sequence[str], name: str, parts: int = 64) -> DataFrame:
    """Adds the row's number from 0 in a global order, nulls last; ranges are numbered side by side.

    To the driver comes one count per range. Rows equal in ``order`` are numbered in any order.
    """
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in order]
    ranged = stage(df.repartitionByRange(parts, *keys).withColumn("_range", F.spark_partition_id()), "numbered")
    before, total = {}, 0
    for r in sorted(ranged.groupBy("_range").count().collect()):
        before[r["_range"]], total = total, total + r["count"]
    first = F.get(F.lit([before.get(i, 0) for i in range(max(before, default=0) + 1)]), F.col("_range"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    return ranged.withColumn(name, first.cast("long") + place - 1).drop("_range")


def first_by_hash(df: DataFrame, group: str, most: int) -> DataFrame:
    """At most ``most`` rows of each group, those with the smallest hash of ``doc_id``, with their ``place`` from 1.

    The rows per group are counted first; then only rows below a hash that about twice as many rows reach are looked
    at, and more if those were too few. So a few rows are sorted, whatever the size of a group. To the driver come
    counts per group, which are few (languages, labels); a null group is left out.
    """
    chance = F.xxhash64("doc_id").bitwiseAND((1 << 63) - 1)
    known = df.where(F.col(group).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(group).count().collect()}
    wanted = {g: min(n, most) for g, n in counts.items()}
    times = 2
    while True:
        bounds = {g: min(1 << 63, int((times * most + 64) / n * (1 << 63))) - 1 for g, n in counts.items()}
        limit = F.lit(-1)
        for g, bound in bounds.items():
            limit = F.when(F.col(group) == g, F.lit(bound)).otherwise(limit)
        near = stage(known.withColumn("_chance", chance).where(F.col("_chance") <= limit), "sampled")
        found = {r[0]: r[1] for r in near.groupBy(group).count().collect()}
        if all(found.get(g, 0) >= n for g, n in wanted.items()):
            break
        times *= 4
    first = Window.partitionBy(group).orderBy("_chance", "doc_id", *(F.xxhash64(c) for c in df.columns if c != "doc_id"))
    return near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= most).drop("_chance")


def range_bins(key: Column, bounds: list[int]) -> Column:
    """The number of ``bounds`` (ascending) at or below ``key``, found by blocks of 32."""
    if not bounds:
        return F.lit(0)
    blocks = [bounds[i:i + 32] for i in range(0, len(bounds), 32)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= key))

    block = below(F.lit([b[0] for b in blocks]).cast("array<bigint>"))
    table_of = F.array(*[F.lit(b).cast("array<bigint>") for b in blocks])
    inside = F.coalesce(below(F.get(table_of, block - 1)), F.lit(0))
    return F.when(block == 0, F.lit(0)).otherwise((block - 1) * 32 + inside)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be inverted modulo 2**64
_LETTER = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(19, n.bit_length())
    if size not in _powers:
        inverse = pow(_BASE, -1, 1 << 64)
        _powers.clear()
        _powers[size] = tuple(
            np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, dtype=np.uint64))]) for b in (_BASE, inverse)
        )
    return _powers[size]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts that lie end to end in ``data`` (bytes), text i from ``offsets[i]`` to ``offsets[i + 1]``.

    Returns a 64-bit hash per word (A-Z as a-z), each text's first word (n + 1 places), and the words' start and end.
    A word's hash is a polynomial in its bytes, taken from running sums, so no word is touched in Python.
    """
    data = _LOWER[data]
    space = _SPACE[data]
    word = ~space
    inner = np.zeros(len(data) + 1, dtype=bool)  # places where a text begins break words too
    inner[offsets[:-1]] = True
    starts = np.flatnonzero(word & np.concatenate([[True], space[:-1]]) | word & inner[:-1])
    ends = np.flatnonzero(word & (np.concatenate([space[1:], [True]]) | inner[1:])) + 1
    return byte_sums(data, starts, ends), np.searchsorted(starts, offsets), starts, ends


def byte_sums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes from each of ``starts`` to its end, a polynomial taken from running sums."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LETTER[data] * up[:len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def handing_back(made):
    """``made``, a function of record batches, after which its worker hands back the memory it no longer uses.

    Workers stay for the stages that follow, and what the allocators keep would add up on an executor.
    """
    def run(batches):
        import ctypes
        import gc

        import pyarrow as pa

        yield from made(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim is not None:
            trim(0)
    return run


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of an Arrow string column; a null text is empty."""
    import pyarrow as pa
    import pyarrow.compute as pc

    values = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    if not len(values):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    held = values.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, most_bytes: int = 1 << 20, column: str = "text", most_rows: int | None = None):
    """Record batches cut so that a piece holds about ``most_bytes`` of text, or a single row, and at most ``most_rows``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + most_bytes, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows, start + (most_rows or batch.num_rows))
            yield batch.slice(start, end - start)
            start = end
