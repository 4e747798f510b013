"""Connected components of links that are never gathered: alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.session import stage

ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``id, root``: the smallest id reachable from every id that is in ``links`` (long columns ``a, b``).

    Each round points the neighbours of a node at the smallest of them; the links become stars in a number of
    rounds that grows with the logarithm of the ids. Only a count and a checksum come to the driver. The smallest
    neighbours are written first, so that a join with a node of very many links is split by adaptive execution.
    """
    pairs = links.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).where("a <> b")
    edges = stage(pairs.distinct(), "links")
    mark = _mark(edges)
    for _ in range(ROUNDS):
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least")
        larger = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        large = stage(larger.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct(), "large")
        least = stage(large.groupBy("a").agg(F.min("b").alias("least")), "least")
        below = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stage(below.unionAll(least.select("a", F.col("least").alias("b"))).distinct(), "links")
        after = _mark(edges)
        if after == mark:
            break
        mark = after
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionAll(roots)
