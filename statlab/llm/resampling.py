"""Importance resampling towards a target's word runs: weights from an array of gains, a cutoff by bisection.

A document's weight says how much likelier its runs of words are under the target's counts than under the corpus's,
by hashed buckets. With Gumbel noise added, the highest scores are a draw without replacement by those weights.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.llm.alnum import joined_crc, lower_bytes, with_space, word_crcs, words_of
from statlab.llm.common import numbered, slices, text_bytes
from statlab.session import stage

BUCKETS = 10_000
#: Probes a counting job takes, so that it halves the interval four times.
PROBES = 15
#: Drawn rows a range is ranked with.
RANGE = 200_000
HIGHEST = (1 << 63) - 1


def _runs(batch: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Each text's first word (n + 1 places); and for runs of one, two and three words the bucket of the run that
    begins at each word, with whether it ends inside the text."""
    data, offsets = text_bytes(batch.column("text"))
    lower = lower_bytes(data)
    starts, ends, first = words_of(lower, offsets)
    n, length = len(starts), ends - starts
    word = word_crcs(lower, starts, ends)
    last = np.repeat(first[1:], np.diff(first))  # the place after the text's last word
    place, run, out = np.arange(n), word, []
    for k in range(3):
        if k:
            run = joined_crc(with_space(run[:-1]), word[k:], length[k:]) if n > k else run[:0]
        held = np.zeros(n, dtype=np.int64)
        held[:len(run)] = run % np.uint32(buckets)
        out.append((held, place + k < last))
    return first, out


def _counted(buckets: int):
    """How often each bucket is met, over all texts of a partition."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches):
            for bucket, inside in _runs(batch, buckets)[1]:
                total += np.bincount(bucket[inside], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int32()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    return made


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The number of runs of one to three words in each bucket, over whole texts; an array of that fixed length."""
    parts = docs.select("text").mapInArrow(_counted(buckets), "bucket int, n long")
    counts = np.zeros(buckets, dtype=np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier a bucket is in the target, each count taken as one more."""
    size = len(source)
    s_all, t_all = float(source.sum()) + size, float(target.sum()) + size
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(source, target)], dtype=np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A Gumbel draw in thousandths, from the seed and the id alone."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(of: np.ndarray, seed: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            first, runs = _runs(batch, len(of))
            words = np.diff(first)
            per_word = sum(np.where(inside, of[bucket], 0) for bucket, inside in runs)
            sums = np.concatenate([[0], np.cumsum(per_word)])
            weight = sums[first[1:]] - sums[first[:-1]]
            features = words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0)
            score = weight + np.array([noise(i, seed) for i in batch.column("doc_id").to_pylist()], dtype=np.int64)
            numbers = [pa.array(x.astype(np.int64)) for x in (words, features, weight, score)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *numbers], ["doc_id", "n_words", "n_features", "weight", "score"])

    return made


def nth_lowest(df: DataFrame, column: str, need: int) -> tuple[int, int]:
    """The value of the ``need``-th lowest row (from 1) of a long column, and how many rows are below that value.

    The interval is halved by exact counts over the written table; a job counts below several probes at once, and
    reads only the row groups that reach into what is left of the interval.
    """
    r = df.agg(F.min(column), F.max(column)).first()
    low, high, below = r[0], r[1], 0
    while low < high:
        step = max(1, -(-(high - low) // (PROBES + 1)))
        probes = list(range(low, high, step))
        at_most = [F.sum((F.col(column) <= p).cast("long")).alias(f"n{i}") for i, p in enumerate(probes)]
        counts = df.where(F.col(column).between(low, probes[-1])).agg(*at_most).first()
        reached = [i for i, n in enumerate(counts) if below + (n or 0) >= need]
        k = reached[0] if reached else len(probes)
        if k < len(probes):
            high = probes[k]
        if k:
            low, below = probes[k - 1] + 1, below + (counts[k - 1] or 0)
    return low, below


def _drawn(able: DataFrame, need: int):
    """The condition on ``_key, _id, _row`` that holds for exactly the first ``need`` rows in their order."""
    chosen, rest = F.lit(False), F.lit(True)
    for column in ("_key", "_id", "_row"):
        value, below = nth_lowest(able.where(rest), column, need)
        chosen = chosen | (rest & (F.col(column) < value))
        rest, need = rest & (F.col(column) == value), need - below
        if able.where(rest).count() == need:
            break
    return chosen | rest


def importance_resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, shortest: int = 20, buckets: int = BUCKETS, seed: int = 42,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words`` of every row of ``docs`` (``doc_id, text``).

    Of the rows with at least ``shortest`` words, ``percent`` of 100 (rounded down) with the highest scores are drawn and ranked
    from 1; the others have a null rank. Ties go to the smaller id, a null id coming last, and then to either row, the
    same one in all results of a run. A null text, or one without words, has no features and weight 0. Repeated rows
    are drawn one by one. An empty target counts as none in each bucket. Other columns are not looked at.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    of = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = own.mapInArrow(_scored(of, seed), "doc_id long, n_words long, n_features long, weight long, score long")
    scored = stage(scored.select(
        "*", (-F.col("score")).alias("_key"), F.coalesce("doc_id", F.lit(HIGHEST)).alias("_id"), F.monotonically_increasing_id().alias("_row")), "scored")
    able = scored.where(F.col("n_words") >= shortest)
    need = able.count() * percent // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not need:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"), "n_words")
    drawn = (F.col("n_words") >= shortest) & _drawn(able, need)
    ranked = numbered(scored.where(drawn), ["_key", "_id", "_row"], "rank", parts=need // RANGE + 8)
    rest = scored.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", F.col("rank") + 1).unionByName(rest).select(*columns, "rank", "n_words")


def target_resampling(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return importance_resample(docs, benchmark)
