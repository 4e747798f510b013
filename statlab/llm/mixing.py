"""Mixing sources to target weights: block quotas split among output shards by hypergeometric draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statlab.llm.common import WORD, numbered
from statlab.session import stage

#: Blocks per source (2**8), and the bits by which the cut of a quota is narrowed before single documents are looked at.
PERM_BITS, BLOCK_BITS, STEP_BITS, STEPS = 60, 8, 12, 2
ROUNDS = 64


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """One row per source: ``source, source_size, target``, sources by code point and null last.

    All sizes are shared by weight; a target stops at ``most`` times its source's size and the excess is shared
    again by weight among the others. To the driver come three sums per round.
    """
    sums = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.pmod(F.col("_place"), F.lit(len(weights))).cast("int")
    known = stage(numbered(sums, ["source"], "_place").withColumn("weight", F.get(F.lit(list(weights)), place)), "sources")
    known = known.withColumn("cap", (F.col("source_size") * most).cast("double"))
    unit, full = 0.0, float(known.agg(F.sum("source_size")).first()[0] or 0)
    for _ in range(ROUNDS):
        above = F.col("cap") <= F.col("weight") * unit
        r = known.agg(
            F.sum(F.when(above, F.col("cap")).otherwise(0.0)).alias("capped"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        again = (full - r["capped"]) / r["open"] if r["open"] else unit
        if again <= unit:
            break
        unit = again
    return known.select("source", "source_size", F.least(F.col("cap"), F.col("weight") * unit).alias("target"))


def _perm(seed: int) -> Column:
    """A document's place in its source's permutation: 60 bits that depend on id and text alone."""
    digits = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))
    return F.conv(F.substring(digits, 1, 15), 16, 10).cast("long")


def _same(name: str) -> Column:
    """Joined on the source, nulls as a source of their own."""
    return F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))


def quotas(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source: ``source, full, cut``. Every document is taken ``full`` times, and once more if ``perm <= cut``.

    The rest of the target is cut from the permuted order: sizes are summed per range of the permutation, the range
    that holds the cut is opened at 4096 times the precision, and within the last the documents are summed one by
    one and the nearest sum wins. A hot source is never summed row by row.
    """
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-9)).otherwise(0)
    left = sources.withColumn("full", ratio.cast("int"))
    left = left.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")).withColumn("range", F.lit(0).cast("long"))
    left = left.select("source", "full", "rest", "range")
    for step in range(1, STEPS + 1):
        bits = PERM_BITS - step * STEP_BITS
        sums = docs.select("source", "size", F.shiftright("perm", bits).alias("finer")).groupBy("source", "finer").agg(F.sum("size").alias("size"))
        inside = sums.alias("l").join(left.alias("r"), _same("source") & (F.shiftright("finer", STEP_BITS) == F.col("range")))
        inside = inside.select("r.source", "full", "rest", "finer", "size")
        up_to = Window.partitionBy("source").orderBy("finer").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("size").over(up_to), F.lit(0))
        known = inside.withColumn("before", before).where(F.col("before") <= F.col("rest"))
        last = known.groupBy("source", "full").agg(F.max("finer").alias("range"), F.max_by(F.col("rest") - F.col("before"), "finer").alias("rest"))
        left = stage(last.select("source", "full", "rest", "range"), "quota")
    bits = PERM_BITS - STEPS * STEP_BITS
    near = docs.alias("l").join(left.alias("r"), _same("source") & (F.shiftright("perm", bits) == F.col("range")))
    sums = near.groupBy("r.source", "full", "rest", "range", "perm").agg(F.sum("size").alias("size"))
    running = F.sum("size").over(Window.partitionBy("source").orderBy("perm"))
    miss = F.struct(F.abs(F.col("rest") - F.col("sum")).alias("miss"), "perm")
    best = sums.withColumn("sum", running).groupBy("source", "full", "rest", "range").agg(F.min(miss).alias("best"))
    none = F.shiftleft("range", bits) - 1
    return best.select("source", "full", F.when(F.col("best.miss") < F.col("rest"), F.col("best.perm")).otherwise(none).alias("cut"))


def splitting_tree(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """Adds ``shard`` to the blocks: each node deals half of its blocks to either side.

    Which blocks go left is a random half of the node's blocks, so the counts per source are one draw of a
    multivariate hypergeometric distribution with the node's quotas. Only blocks are ordered, never documents:
    at most 256 for each copy of a source. ``shards`` is a power of two.
    """
    tree = blocks.withColumn("shard", F.lit(0))
    for level in range(shards.bit_length() - 1):
        drawn = [F.lit(str(seed)), F.lit(str(level)), F.coalesce("source", F.lit("")), F.col("block").cast("string"), F.col("copy").cast("string")]
        draw = F.md5(F.concat_ws("|", *drawn).cast("binary"))
        node = Window.partitionBy("shard")
        rank = F.row_number().over(node.orderBy(draw, "source", "block", "copy"))
        right = (rank * 2 > F.count("*").over(node)).cast("int")
        tree = tree.withColumn("shard", F.col("shard") * 2 + right)
    return tree


def mix(docs: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """Adds ``size, source_size, target, copies, taken, shards``: how often the mix takes a document, and where to.

    ``shards`` has one entry per copy. A source's blocks are disjoint ranges of its permuted documents, dealt by
    ``splitting_tree``; reruns agree. Sizes count words; a null text has none. A null source is a source of its own
    and the last one. Rows equal in id and text are taken together. Columns of these names in the input are replaced.
    """
    own = docs.drop("size", "source_size", "target", "copies", "taken", "shards", "perm", "block")
    sized = own.withColumns({"size": words(F.col("text")), "perm": _perm(seed)})
    slim = stage(sized.select("source", "size", "perm"), "mixed")
    shares = stage(targets(slim, most=3), "targets")
    cuts = stage(shares.alias("l").join(quotas(slim, shares).alias("r"), _same("source"), "left").select("l.*", "full", "cut"), "cuts")
    again = F.coalesce(F.col("full"), F.lit(0)) + F.coalesce(F.col("perm") <= F.col("cut"), F.lit(False)).cast("int")
    block = F.shiftright("perm", PERM_BITS - BLOCK_BITS).cast("int")
    kept = slim.withColumn("block", block).alias("l").join(cuts.alias("r"), _same("source")).select("l.source", "block", again.alias("copies"))
    blocks = kept.groupBy("source", "block").agg(F.max("copies").alias("copies"))
    dealt = splitting_tree(
        blocks.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies"), shards, seed)
    there = stage(dealt.groupBy("source", "block").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("copy", "shard"))), lambda x: x["shard"]).alias("_there")), "dealt")
    joined = sized.withColumn("block", block).alias("l").join(cuts.alias("r"), _same("source"))
    joined = joined.select("l.*", "source_size", "target", again.alias("copies")).alias("l")
    joined = joined.join(there.alias("r"), _same("source") & _same("block"), "left").select("l.*", "_there")
    where = F.slice(F.coalesce("_there", F.array().cast("array<int>")), F.lit(1), F.col("copies"))
    return joined.withColumns({"taken": F.col("size") * F.col("copies"), "shards": where}).drop("perm", "block", "_there")


def take(mixed: DataFrame, seed: int = 17) -> DataFrame:
    """The mixed rows themselves, a row per copy with its ``shard`` and ``copy``, each shard in a random order of its own.

    A shard is shuffled by ranges of the random order, so that no shard is one task's. Columns of these names are replaced.
    """
    rows = mixed.select(
        *[F.col(f"`{c}`") for c in mixed.columns if c not in ("shards", "shard", "copy", "_order")], F.posexplode("shards").alias("copy", "shard"))
    order = F.xxhash64(F.lit(seed), "doc_id", "text", "copy")
    return rows.withColumn("_order", order).repartitionByRange("shard", "_order").sortWithinPartitions("shard", "_order").drop("_order")


def source_mixing(docs: DataFrame) -> DataFrame:
    """The mix of all documents, a row each."""
    return mix(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken", "copies", "shards")
