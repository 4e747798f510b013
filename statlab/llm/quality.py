"""A quality classifier: a factorisation machine over hashed words, statistics of structure and metadata.

Each feature has a weight and a short vector; the interaction of two features is the product of their vectors. All
pairs are summed in linear time as half of (the square of the sum less the sum of the squares).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.llm.common import first_by_hash, held_out, slices, text_bytes, word_hashes
from statlab.session import stage

#: Places words are hashed to, length of the vectors, and texts learned from, per label at most.
WORDS, RANK, LEARNED = 1 << 15, 8, 3000
STEPS = 10
EPOCHS, BATCH, RATE, DECAY = 24, 256, 0.02, 1e-4
STATISTICS = ("length", "words", "word length", "line length", "upper", "digits", "symbols", "marks", "bars", "repeated words", "top word", "repeated lines", "n_chars")
FEATURES = WORDS + len(STATISTICS) * (STEPS + 1)


def _class_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _flag(characters: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[np.frombuffer(characters, dtype=np.uint8)] = True
    return table


_UPPER, _DIGIT = _flag(bytes(range(65, 91))), _flag(bytes(range(48, 58)))
_LETTER = _flag(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256)))
_SYMBOL, _MARK, _BAR, _LINE = _flag(b"#$%&*@^~=<>{}[]\\_"), _flag(b"!?.,;:"), _flag(b"|"), _flag(b"\n")
_CAPITAL_LEAD, _CAPITAL_REST = _flag(b"\xc3"), _flag(bytes(range(0x80, 0x9F)))


def _steps(value: np.ndarray, low: float, high: float) -> np.ndarray:
    """The step 1 to 10 of a value between two bounds; 0 is kept for what is not known."""
    known = np.clip((value - low) / (high - low), 0.0, 1.0 - 1e-9)
    return 1 + (known * STEPS).astype(np.int64)


def features(batch: pa.RecordBatch) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the places and values of its features: words by the root of their counts, statistics by steps."""
    data, offsets = text_bytes(batch.column("text"))
    hashes, first, starts, ends = word_hashes(data, offsets)
    size, count = np.diff(offsets), np.diff(first)
    letters, lines = np.maximum(_class_sums(_LETTER[data], offsets), 1), _class_sums(_LINE[data], offsets) + 1
    upper = _UPPER[data]
    if len(data):
        upper = upper | (_CAPITAL_REST[data] & np.concatenate([[False], _CAPITAL_LEAD[data[:-1]]]))
    some, length = np.maximum(count, 1), np.maximum(size, 1)
    given = batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float)
    line_end = np.flatnonzero(_LINE[data])
    repeated, top, same_lines = np.zeros(len(size)), np.zeros(len(size)), np.zeros(len(size))
    places, values = [], []
    raw = data.tobytes()
    for i in range(len(size)):
        own = hashes[first[i]:first[i + 1]]
        word, n = np.unique(own, return_counts=True)
        if len(word):
            repeated[i], top[i] = 1.0 - len(word) / len(own), n.max() / len(own)
        if lines[i] > 1:
            split = raw[offsets[i]:offsets[i + 1]].split(b"\n")
            same_lines[i] = 1.0 - len(set(split)) / len(split)
        weight = np.sqrt(n.astype(np.float64))
        places.append((word >> np.uint64(64 - 15)).astype(np.int64))
        values.append(weight / max(np.sqrt((weight * weight).sum()), 1e-9))
    steps = np.stack([
        _steps(np.log2(length), 4, 17), _steps(np.log2(some), 0, 14), _steps(size / some, 2, 14),
        _steps(np.log2(size / lines + 1), 3, 12), _steps(_class_sums(upper, offsets) / letters, 0, 0.5),
        _steps(_class_sums(_DIGIT[data], offsets) / length, 0, 0.1), _steps(_class_sums(_SYMBOL[data], offsets) / some, 0, 1),
        _steps(_class_sums(_MARK[data], offsets) / some, 0, 1), _steps(_class_sums(_BAR[data], offsets) / some, 0, 0.3),
        _steps(repeated, 0, 1), _steps(top, 0, 0.3), _steps(same_lines, 0, 0.5),
        np.where(np.isnan(given), 0, _steps(np.log2(np.maximum(np.nan_to_num(given), 0) + 1), 4, 17)),
    ], axis=1)
    statistics = WORDS + np.arange(len(STATISTICS)) * (STEPS + 1) + steps
    weight = np.full(len(STATISTICS), 1.0 / np.sqrt(len(STATISTICS)))
    return [(np.concatenate([p, s]), np.concatenate([v, weight])) for p, v, s in zip(places, values, statistics)]


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The probability of label 1."""
        raw = np.empty(len(rows))
        for i, (place, value) in enumerate(rows):
            part = self.vectors[place] * value[:, None]
            summed = part.sum(axis=0)
            raw[i] = self.bias + self.weights[place] @ value + 0.5 * (summed @ summed - (part * part).sum())
        return 1.0 / (1.0 + np.exp(-np.clip(raw, -60, 60)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 5) -> FactorisationMachine:
    """Logistic loss by Adam; the same rows in the same order give the same model."""
    rng = np.random.default_rng(seed)
    share = np.clip(labels.mean(), 0.01, 0.99)
    model = FactorisationMachine(float(np.log(share / (1 - share))), np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, RANK)))
    params = [model.weights, *[model.vectors[:, f] for f in range(RANK)]]
    first, second = [np.zeros(FEATURES) for _ in params], [np.zeros(FEATURES) for _ in params]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            chosen = order[start:start + BATCH]
            place = np.concatenate([rows[i][0] for i in chosen])
            value = np.concatenate([rows[i][1] for i in chosen])
            row = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            part = model.vectors[place] * value[:, None]
            summed = np.stack([np.bincount(row, part[:, f], len(chosen)) for f in range(RANK)], axis=1)
            raw = model.bias + np.bincount(row, model.weights[place] * value, len(chosen))
            raw += 0.5 * ((summed * summed).sum(axis=1) - np.bincount(row, (part * part).sum(axis=1), len(chosen)))
            miss = (1.0 / (1.0 + np.exp(-np.clip(raw, -60, 60))) - labels[chosen]) / len(chosen)
            pull = miss[row] * value
            slopes = [pull, *[pull * (summed[row, f] - part[:, f]) for f in range(RANK)]]
            step += 1
            for param, one, two, slope in zip(params, first, second, slopes):
                slope = np.bincount(place, slope, FEATURES) + DECAY * param
                one += 0.1 * (slope - one)
                two += 0.001 * (slope * slope - two)
                param -= RATE * (one / (1 - 0.9 ** step)) / (np.sqrt(two / (1 - 0.999 ** step)) + 1e-8)
            model.bias -= RATE * miss.sum()
    return model


def _collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1 << 20):
        rows = features(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("quality"), pa.array([p.astype(np.int32) for p, _ in rows], pa.list_(pa.int32())),
             pa.array([v.astype(np.float32) for _, v in rows], pa.list_(pa.float32()))], ["quality", "places", "found"])


def fit_quality(docs: DataFrame, labels: DataFrame, learned: int = LEARNED) -> FactorisationMachine:
    """Learns from at most ``learned`` labelled documents of each label, those with the smallest hashes.

    To the driver come their features. Only labels 0 and 1 count; of several labels of one document, the smallest.
    """
    marks = labels.where(F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    marks = stage(first_by_hash(marks, "quality", learned).drop("place"), "marks")
    sample = docs.select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars")).join(F.broadcast(marks), "doc_id")
    found = sample.mapInArrow(_collected, "quality int, places array<int>, found array<float>").collect()
    found = sorted((r["quality"], r["places"], r["found"]) for r in found)
    if not found:
        return FactorisationMachine(0.0, np.zeros(FEATURES), np.zeros((FEATURES, RANK)))
    rows = [(np.array(p, dtype=np.int64), np.array(v, dtype=np.float64)) for _, p, v in found]
    return train(rows, np.array([q for q, _, _ in found], dtype=float))


def score_quality(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """``doc_id, score`` of every whole text; a null text is scored as an empty one, by its other features."""
    slim = FactorisationMachine(model.bias, model.weights.astype(np.float32), model.vectors.astype(np.float32))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 21):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(slim.scores(features(batch)))], ["doc_id", "score"])

    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("n_chars").cast("double").alias("n_chars"))
    return known.mapInArrow(scored, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, at_least: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    found = score_quality(docs, fit_quality(docs, labels))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= at_least).cast("int").alias("predicted"))
