"""Language identification by a string kernel.

The kernel of two texts counts the byte n-grams of one to four bytes present in both (a blended spectrum), over the
geometric mean of their own counts. Nyström landmarks turn it into a short vector, and kernel ridge regression, one
language against the rest, into scores; a batch of texts is scored by two matrix products.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.llm.common import first_by_hash, handing_back, held_out, slices, text_bytes
from statlab.session import stage

#: Places n-grams are hashed to, the longest n-gram, texts learned from and landmarks, each per language at most.
PLACES, LONGEST, LEARNED, LANDMARKS = 1 << 14, 4, 600, 24
#: Texts whose n-grams are held at a time, and places looked at at a time, which bound the memory of a worker.
HELD, LOOKED_AT = 128, 1 << 18
RIDGE = 1e-4
UNKNOWN = "und"
#: The part of the learned texts that may lie farther off than its bounds say.
OUTLYING = 0.005


def presence(column) -> np.ndarray:
    """A row per text with a one at each place an n-gram of the whole lower-cased text hashes to."""
    data, offsets = text_bytes(pc.utf8_lower(column))
    found = np.zeros((len(offsets) - 1) * PLACES, dtype=np.uint8)
    for first in range(0, len(data), LOOKED_AT):
        last = min(first + LOOKED_AT, len(data))
        part = data[first:last + LONGEST - 1]
        inside = np.diff(np.clip(offsets, first, last))
        base = np.repeat(np.arange(len(inside), dtype=np.int64) * PLACES, inside)
        left = np.repeat(offsets[1:] - first, inside) - np.arange(last - first)
        code = np.zeros(len(part), dtype=np.uint32)
        for n in range(1, LONGEST + 1):
            code = code[:len(part) - n + 1] << np.uint32(8) | part[n - 1:]
            begun = code[:last - first]
            place = (begun + np.uint32(n)) * np.uint32(0x9E3779B1) >> np.uint32(32 - 14)
            found[(base[:len(begun)] + place)[left[:len(begun)] >= n]] = 1
    return found.reshape(-1, PLACES)


@dataclass
class LanguageModel:
    """Landmarks (packed bits), and per language the weights of the kernel values to them.

    ``bounds`` are the share and the margin that nearly all learned texts reach.
    """

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    bounds: tuple[float, float]

    def kernel(self, texts: np.ndarray) -> np.ndarray:
        marks = np.unpackbits(self.landmarks, axis=1).astype(np.float32)
        known = texts.astype(np.float32)
        norms = np.sqrt(np.maximum(known.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(marks.sum(axis=1), 1))[None]
        return (known @ marks.T / norms).astype(np.float64)

    def scores(self, kernel: np.ndarray) -> np.ndarray:
        """Per text and language 0 to 1; at a half, the language and the rest are as likely."""
        return np.clip((kernel @ self.weights + 1.0) / 2.0, 0.0, 1.0)

    def closeness(self, kernel: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest share of a text's n-grams that a landmark has, and by how much the best score leads."""
        marks = np.unpackbits(self.landmarks, axis=1).sum(axis=1)
        share = (kernel * np.sqrt(np.maximum(marks, 1))[None]).max(axis=1) / np.sqrt(np.maximum(sizes, 1))
        best = np.sort((kernel @ self.weights + 1.0) / 2.0, axis=1)
        return share, best[:, -1] - (best[:, -2] if len(self.languages) > 1 else 0.0)

    def near(self, kernel: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether each text is as close to the languages, by share or margin, as the learned texts are."""
        share, margin = self.closeness(kernel, sizes)
        return (share >= self.bounds[0]) | (margin >= self.bounds[1])


def _sample(docs: DataFrame, learned: int) -> DataFrame:
    """The texts to learn from: per language those with the smallest hashes, outside of the held-out quarter."""
    usable = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    return first_by_hash(usable.select("doc_id", "lang", "text"), "lang", learned).select("lang", "place", "text")


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 1 << 20, most_rows=HELD):
        packed = np.packbits(presence(batch.column("text")), axis=1)
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([p.tobytes() for p in packed], pa.binary())], ["lang", "bits"])


def fit_languages(docs: DataFrame, learned: int = LEARNED, landmarks: int = LANDMARKS) -> LanguageModel:
    """Learns from at most ``learned`` texts of each language, ``landmarks`` of which are the landmarks.

    To the driver come, for each of the languages, 2 kB per landmark and one number per learned text and landmark.
    The bounds are taken from the learned texts too, each without its own copy among the landmarks.
    """
    sample = stage(_sample(docs, learned), "learned")
    marks = sample.where(F.col("place") <= landmarks).mapInArrow(handing_back(_bits), "lang string, bits binary").collect()
    languages = sorted({r["lang"] for r in marks})
    model = LanguageModel(languages, np.zeros((0, PLACES // 8), np.uint8), np.zeros((0, len(languages))), (0.0, 0.0))
    if not languages:
        return model
    model.landmarks = np.stack([np.frombuffer(r["bits"], np.uint8) for r in sorted(marks, key=lambda r: (r["lang"], r["bits"]))])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 20, most_rows=HELD):
            texts = presence(batch.column("text"))
            values = pa.array(list(model.kernel(texts)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), values, pa.array(texts.sum(axis=1, dtype=np.int64))], ["lang", "values", "size"])

    rows = sorted((r["lang"], r["values"], r["size"]) for r in sample.mapInArrow(handing_back(near), "lang string, values array<double>, size long").collect())
    kernel = np.array([v for _, v, _ in rows])
    own = model.kernel(np.unpackbits(model.landmarks, axis=1))
    value, vector = np.linalg.eigh((own + own.T) / 2)
    whiten = vector / np.sqrt(np.maximum(value, 1e-6))
    features = np.hstack([kernel @ whiten])
    targets = np.where(np.array([lang for lang, _, _ in rows])[:, None] == np.array(languages)[None], 1.0, -1.0)
    balance = 1.0 / (targets > 0).sum(axis=0)[np.argmax(targets, axis=1)][:, None]
    ridge = features.T @ (features * balance) + RIDGE * np.eye(features.shape[1])
    model.weights = whiten @ np.linalg.solve(ridge, features.T @ (targets * balance))
    sizes = np.array([n for _, _, n in rows])
    share, _ = model.closeness(np.where(kernel < 1 - 1e-9, kernel, 0.0), sizes)
    _, margin = model.closeness(kernel, sizes)
    model.bounds = tuple(float(np.quantile(x, OUTLYING, method="lower")) for x in (share, margin))
    return model


def predict_languages(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score``, from the column ``text`` alone. Without a letter, or a learned language: ``und`` and 0.

    ``near`` says whether the text is about as close to the learned languages as their own texts are. Columns of these names
    in the input are replaced; all others are passed through.
    """
    own = [c for c in docs.columns if c not in ("lang_pred", "score", "near")]
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*[F.col(f"`{c}`") for c in own]).dtypes)
    known = docs.select(*[F.col(f"`{c}`") for c in own], F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False)).alias("_letter"))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 20, text, HELD):
            letter = batch.column("_letter").to_numpy(zero_copy_only=False)
            if model.languages:
                texts = presence(batch.column(text))
                kernel = model.kernel(texts)
                scores = model.scores(kernel)
                best = scores.argmax(axis=1)
                names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(best, letter)]
                values = np.where(letter, scores.max(axis=1), 0.0)
                near = letter & model.near(kernel, texts.sum(axis=1, dtype=np.int64))
            else:
                names, values, near = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.zeros(batch.num_rows, dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in own], pa.array(names, pa.string()), pa.array(values), pa.array(near)], [*own, "lang_pred", "score", "near"])

    return known.mapInArrow(handing_back(scored), f"{schema}, lang_pred string, score double, near boolean")


def language_id(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    model = fit_languages(docs)
    found = predict_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def keep_languages(docs: DataFrame) -> DataFrame:
    """Documents in a learned language: those without a letter, or far from all of them, go. The columns are kept."""
    model = fit_languages(docs)
    kept = predict_languages(docs.select(*[F.col(f"`{c}`").alias(f"of {c}") for c in docs.columns]), model, "of text")
    return kept.where((F.col("lang_pred") != UNKNOWN) & F.col("near")).select(*[F.col(f"`of {c}`").alias(c) for c in docs.columns])
