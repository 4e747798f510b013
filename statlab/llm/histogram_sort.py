"""Sharding by histogram sort: splitters are found by counting bytes, then the rows move once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statlab.session import stage

BITS, LEVELS = 12, 5
FAN = 1 << BITS
#: A range with more than this share of the rows is cut further, so that no task numbers a hot group alone.
HOT_SHARE = 512


def _codes(text: Column, key: Column) -> list[Column]:
    """The sort key at each precision: 12 and 24 bits of the text's hash, 12 and 24 bits of the row's key, a place in a run of equal rows."""
    h, tie = F.xxhash64(text), F.xxhash64(key, F.lit("tie"))
    digits = [
        F.shiftrightunsigned(h, 64 - BITS), F.shiftrightunsigned(h, 64 - 2 * BITS) % FAN,
        F.shiftrightunsigned(tie, 64 - BITS), F.shiftrightunsigned(tie, 64 - 2 * BITS) % FAN,
        F.col("_run"),
    ]
    codes = [digits[0]]
    for d in digits[1:]:
        codes.append(codes[-1] * FAN + d)
    return codes


def _edges(bins: dict[int, tuple[int, int]], shards: int) -> tuple[list[int], list[tuple[int, int]]]:
    """The number of bins before each splitter (nearest edge), and the bins a target falls into with the miss."""
    total, cut, missed = sum(b for _, b in bins.values()), [], []
    keys, cum, at = sorted(bins), 0, 0
    for s in range(1, shards):
        target = total * s / shards
        while at < len(keys) and cum + bins[keys[at]][1] <= target:
            cum += bins[keys[at]][1]
            at += 1
        inside = bins[keys[at]][1] if at < len(keys) else 0
        low, high = target - cum, cum + inside - target
        cut.append(at if low <= high else at + 1)
        if at < len(keys):
            missed.append((keys[at], min(low, high)))
    return cut, missed


def histogram_sort(
    docs: DataFrame, shards: int = 8, tolerance: float = 0.01, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Adds ``size``, ``shard`` and ``slot`` (gapless from 0): shards of nearly equal bytes, in one global order.

    The order is by the text's hash and then the key's hash, so equal texts lie side by side and share a shard
    unless their group is heavier than the tolerance. Bytes below candidate boundaries are counted exactly; only
    the ranges where a splitter still misses its target by more than ``tolerance`` of a shard, or that hold more
    than 1/512 of the rows, are counted again at 4096 times the precision. To the driver come counts per range.
    The rows then move once, to their range; ``shard`` and the first slot of a range are looked up.
    What is still too heavy then is a run of rows equal in text and key. Its rows are written with a random place out of
    4096 and cut by these, so a run may be shared by shards; which of its rows go where follows the order of the input.
    A null text has size 1; null keys are ordered by the text alone. Columns of these names in the input are replaced,
    and those beginning with ``_run``, ``_range``, ``_first``, ``_h`` or ``_tie`` must not be there.
    """
    spark = docs.sparkSession
    own = docs.drop("size", "shard", "slot").withColumn("_run", F.lit(0).cast("long"))
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    codes = _codes(F.col(text), F.col(key))
    opened: list[list[int]] = []
    bins: dict[int, tuple[int, int]] = {}
    for level in range(LEVELS):
        if level == LEVELS - 1:
            run = codes[level - 1].isin(opened[-1])
            place = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - BITS)
            own = own.where(~run).unionByName(stage(own.where(run).withColumn("_run", place), "runs"))
        counted = own.select(size.alias("size"), *[c.alias(f"c{i}") for i, c in enumerate(codes[:level + 1])])
        if level:
            counted = counted.where(F.col(f"c{level - 1}").isin(opened[-1]))
        shift = FAN ** (LEVELS - 1 - level)
        for code in opened[-1] if level else []:
            bins.pop(code * shift * FAN)
        found = counted.groupBy(f"c{level}").agg(F.count("*").alias("n"), F.sum("size").alias("b")).collect()
        bins.update({r[0] * shift: (r["n"], r["b"]) for r in found})
        here = {r[0] * shift: r[0] for r in found}
        total, rows = sum(b for _, b in bins.values()), sum(n for n, _ in bins.values())
        missed = {k for k, miss in _edges(bins, shards)[1] if miss > tolerance * total / shards}
        hot = {k for k, (n, _) in bins.items() if n > max(rows / HOT_SHARE, 64)}
        opened.append([here[k] for k in (missed | hot) if k in here and bins[k][0] > 1])
        if not opened[-1]:
            break
    cut, _ = _edges(bins, shards)
    places, first, shard = [], 0, 0
    for i, k in enumerate(sorted(bins)):
        now = sum(c <= i for c in cut)
        first, shard = (0, now) if now != shard else (first, shard)
        places.append((k, shard, first))
        first += bins[k][0]
    ranges = spark.createDataFrame(places, "_range long, shard int, _first long")
    precise = codes[0] * FAN ** (LEVELS - 1)
    for level, codes_open in enumerate(opened):
        if codes_open and level + 1 < LEVELS:
            finer = codes[level + 1] * FAN ** (LEVELS - 2 - level)
            precise = F.when(codes[level].isin(codes_open), finer).otherwise(precise)
    keyed = own.withColumns({
        "size": size, "_range": precise, "_h": F.xxhash64(F.col(text)), "_tie": F.xxhash64(F.col(key), F.lit("tie")),
    })
    within = Window.partitionBy("_range").orderBy("_h", "_tie", "size")
    placed = keyed.join(ranges, "_range").withColumn("slot", F.col("_first") + F.row_number().over(within) - 1)
    return placed.drop("_run", "_range", "_first", "_h", "_tie")


def write_shards(sharded: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder per shard, files in slot order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.mode(mode).partitionBy(
        "shard").parquet(path)


def sharding(docs: DataFrame) -> DataFrame:
    """The digest of the eight shards: one row per document."""
    known = docs.select("doc_id", "text").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    return histogram_sort(known).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
