"""Set operations on tables with repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.operators.reshape import stacked

#: Copies of a row that one task writes out.
CHUNK = 4096


def copies(inputs: Sequence[DataFrame]) -> DataFrame:
    """The different rows of all inputs with ``copies``, an array of how often each input holds them.

    All inputs go through one aggregate, so a row that is repeated very often is counted in the tasks that read it and
    travels as one. Nulls equal nulls. The inputs have to have the same columns, in any order; none may be called
    ``copies`` or begin with ``_in``.
    """
    names = inputs[0].columns
    if any(sorted(df.columns) != sorted(names) for df in inputs):
        raise ValueError("the columns differ")
    tagged = stacked(df.select(*[f"`{c}`" for c in names]).withColumn("_in", F.lit(i)) for i, df in enumerate(inputs))
    counts = [F.count_if(F.col("_in") == i).alias(f"_in{i}") for i in range(len(inputs))]
    found = tagged.groupBy(*[f"`{c}`" for c in names]).agg(*counts)
    return found.select(*[f"`{c}`" for c in names], F.array(*[f"_in{i}" for i in range(len(inputs))]).alias("copies"))


def combined(inputs: Sequence[DataFrame], how: str, distinct: bool = False) -> DataFrame:
    """The different rows of the result with ``copies``, the number of times each stands in it.

    ``how``: ``intersect`` (the least of the counts), ``except`` (the first less all others), ``union`` (the sum),
    ``widest`` (the greatest). With ``distinct`` a row counts once an input, as without ALL in SQL.
    """
    n = F.transform("copies", lambda c: F.least(c, F.lit(1).cast("long"))) if distinct else F.col("copies")
    others = F.aggregate(F.slice(n, 2, max(1, len(inputs) - 1)), F.lit(0).cast("long"), lambda a, b: a + b)
    total = {"intersect": F.array_min(n), "except": F.get(n, F.lit(0)) - others, "union": F.get(n, F.lit(0)) + others, "widest": F.array_max(n)}
    left = total[how]
    if distinct:
        left = F.least(left, F.lit(1).cast("long"))
    return copies(inputs).withColumn("copies", left).where("copies > 0")


def written_out(rows: DataFrame, parts: int | None = None) -> DataFrame:
    """Each row ``copies`` times, without that column; a row with very many is dealt to many tasks in chunks."""
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK)))
    cut = rows.withColumn("_chunk", chunk)
    cut = cut.withColumn("_n", F.least(F.lit(CHUNK).cast("long"), F.col("copies") - F.col("_chunk") * CHUNK))
    keys = [F.xxhash64("_chunk", *[f"`{c}`" for c in rows.columns])]
    dealt = cut.repartition(parts, *keys) if parts else cut.repartition(*keys)
    return dealt.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).drop("_chunk", "_n", "copies")
