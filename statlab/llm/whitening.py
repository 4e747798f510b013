"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Sums and products are whole numbers as long as they fit, so they are the same in every order and on every rerun. What
the driver gets is the mean and a matrix of dimension by dimension; vectors stay in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statlab.session import stage

#: Vectors multiplied at a time; with entries below SMALL the products' sums are exact in doubles.
BLOCK = 4096
SMALL = 1 << 20
#: Blocks whose products are summed before they are handed on.
BLOCKS = 512
COMPONENTS = 16
#: What is left on the diagonal counts as nothing below this share of the largest entry.
NOTHING = 1e-13


def scaled(vector: str = "embedding", scale: int = 64, shift: int = 1_000_000):
    """Every entry as a whole number; what would exceed a long becomes the nearest that does not."""
    most = F.lit((1 << 63) - 1 - shift)
    return F.transform(vector, lambda c: F.least(F.floor(c.cast("double") * scale), most) + F.lit(shift).cast("long"))


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows whose vector is there, not empty, and has finite entries only."""
    def wrong(c):
        return c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf"))

    return df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(F.exists(vector, wrong), F.lit(True)))


def _matrix(column) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


def _apart(x: np.ndarray, center: list[int]) -> tuple[np.ndarray, bool]:
    """Differences from whole numbers, as doubles, and whether products of them add up exactly in a block."""
    near = np.abs(x.astype(np.float64) - np.array(center, dtype=np.float64)).max(initial=0) < SMALL
    if near:
        return (x - np.array(center, dtype=np.int64)).astype(np.float64), True
    return x.astype(np.float64) - np.array(center, dtype=np.float64), False


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block the number of vectors and each entry's sum, in two halves that cannot overflow."""
    for batch in _blocks(batches):
        x = _matrix(batch.column("x"))
        high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
        d = x.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d), pa.int32()), pa.array(np.full(d, len(x))), pa.array(high), pa.array(low)], ["i", "n", "high", "low"])


def _products(center: list[int]):
    d = len(center)
    i, j = (a.astype(np.int32) for a in np.triu_indices(d))

    def rows(exact: np.ndarray, rough: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(exact[i, j]), pa.array(rough[i, j])], ["i", "j", "exact", "rough"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact, rough, held = np.zeros((d, d), dtype=np.int64), np.zeros((d, d)), 0
        for batch in _blocks(batches):
            y, whole = _apart(_matrix(batch.column("x")), center)
            if whole:
                exact += (y.T @ y).astype(np.int64)
            else:
                rough += y.T @ y
            held += 1
            if held == BLOCKS:
                yield rows(exact, rough)
                exact, rough, held = np.zeros_like(exact), np.zeros_like(rough), 0
        if held:
            yield rows(exact, rough)

    return made


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``L`` (rows in the matrix's order, as many columns as its rank) with ``L @ L.T`` the matrix; the largest
    remaining diagonal entry comes first."""
    rest, d = matrix.astype(np.float64).copy(), len(matrix)
    least, columns = NOTHING * max(np.diag(matrix).max(initial=0.0), 0.0), []
    open_ = np.ones(d, dtype=bool)
    for _ in range(d):
        diagonal = np.where(open_, np.diag(rest), -np.inf)
        p = int(diagonal.argmax())
        if diagonal[p] <= least or diagonal[p] <= 0:
            break
        column = np.where(open_, rest[:, p], 0.0) / np.sqrt(diagonal[p])
        rest -= np.outer(column, column)
        open_[p] = False
        columns.append(column)
    return np.array(columns).T.reshape(d, len(columns))


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The factor with its columns rotated in pairs until all are orthogonal; the longest first."""
    a = factor.copy()
    r = a.shape[1]
    for _ in range(sweeps):
        turned = False
        for p in range(r - 1):
            for q in range(p + 1, r):
                x, y = a[:, p], a[:, q]
                alpha, beta, gamma = x @ x, y @ y, x @ y
                if abs(gamma) <= 1e-15 * np.sqrt(alpha * beta):
                    continue
                turned = True
                zeta = (beta - alpha) / (2.0 * gamma)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1.0 / np.sqrt(1.0 + t * t)
                a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if not turned:
            break
    return a[:, np.argsort(-(a * a).sum(axis=0), kind="stable")]


def fitted(fit: DataFrame, dimension: int) -> dict | None:
    """Of a table of different vectors ``x``: their number, sums, eigenvalues and components; None if it is empty."""
    # 128-bit sums of halves: exact for any number of rows that a long can count.
    parts = fit.mapInArrow(_sums, "i int, n long, high long, low long").groupBy("i").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]).collect()
    if not parts:
        return None
    n = parts[0]["n"]
    sums = [0] * dimension
    for r in parts:
        sums[r["i"]] = (int(r["high"]) << 32) + int(r["low"])
    center = [min(max(round(Fraction(s, n)), -(1 << 63)), (1 << 63) - 1) for s in sums]
    offset = np.array([float(Fraction(s - n * c, n)) for s, c in zip(sums, center)])  # at most a half
    found = fit.mapInArrow(_products(center), "i int, j int, exact long, rough double").groupBy("i", "j").agg(
        F.sum(F.col("exact").cast("decimal(38,0)")).alias("exact"), F.sum("rough").alias("rough")).collect()
    scatter = np.zeros((dimension, dimension))
    for r in found:
        scatter[r["i"], r["j"]] = scatter[r["j"], r["i"]] = (int(r["exact"]) + r["rough"]) / n
    scatter -= np.outer(offset, offset)
    rotated = one_sided_jacobi(pivoted_cholesky(scatter))
    values = (rotated * rotated).sum(axis=0)
    return {"n": n, "sums": sums, "center": center, "offset": offset, "values": values,
            "components": rotated / np.sqrt(values), "trace": float(np.trace(scatter))}


def _white(model: dict, k: int):
    turn = model["components"][:, :k] / np.sqrt(model["values"][:k])

    def of(x: np.ndarray) -> np.ndarray:
        return (_apart(x, model["center"])[0] - model["offset"]) @ turn

    return of


def _white_products(model: dict, k: int):
    of, (i, j) = _white(model, k), np.triu_indices(k)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, means = np.zeros((k, k)), np.zeros(k)
        for batch in _blocks(batches):
            w = of(_matrix(batch.column("x")))
            total, means = total + w.T @ w, means + w.sum(axis=0)
        rows = [(int(a), int(b), total[a, b]) for a, b in zip(i, j)] + [(int(a), -1, means[a]) for a in range(k)]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.float64()))], ["i", "j", "sum"])

    return made


def identity_error(fit: DataFrame, model: dict, k: int) -> float:
    """The largest entry by which the covariance of the whitened vectors differs from the identity."""
    found = fit.mapInArrow(_white_products(model, k), "i int, j int, sum double").groupBy("i", "j").agg(F.sum("sum").alias("sum")).collect()
    sums = {(r["i"], r["j"]): r["sum"] / model["n"] for r in found}
    return max(abs(sums[i, j] - sums[i, -1] * sums[j, -1] - (i == j)) for i in range(k) for j in range(i, k))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sums of (n * x - S) ** 2, exact; None beyond a long."""
    largest = max((abs(s) for s in sums), default=0)
    if n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + largest < 1 << 62:
        z = x * n - np.array(sums, dtype=np.int64)
        if int(np.abs(z).max(initial=0)) ** 2 * x.shape[1] < 1 << 62:
            return (z * z).sum(axis=1).tolist()
    found = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return [v if v < 1 << 63 else None for v in found]


def _rows(model: dict, k: int, error: float):
    of = _white(model, k)
    explained = model["values"][:k] / model["trace"]

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            x, m = _matrix(batch.column("x")), batch.num_rows
            deviation = pa.array(_deviations(x, model["n"], model["sums"]), pa.int64())
            place = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(place), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model["n"])),
                 deviation.take(place), pa.array(of(x).reshape(-1)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return made


def whitened(df: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per usable row of ``vec_id, embedding`` and component.

    The model is fitted on each different scaled vector once; every usable row is projected, repeated rows and null ids too.
    Rows whose vector is null, empty or holds null or non-finite entries are left out, and so are vectors whose length
    is not the most frequent one (of equally frequent ones the longest). Components are those with an eigenvalue: of
    vectors that lie in fewer dimensions there are fewer, of a single one none, and then there are no rows.
    ``deviation`` is null where it exceeds a long. Other columns are not looked at.
    """
    known = usable(df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding")))
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    lengths = sorted((r[1], r[0]) for r in known.groupBy(F.size("embedding")).count().collect())
    if not lengths:
        return df.sparkSession.createDataFrame([], schema)
    dimension = lengths[-1][1]
    rows = known.where(F.size("embedding") == dimension).select("vec_id", scaled().alias("x"))
    fit = stage(rows.select("x").distinct(), "fit")
    model = fitted(fit, dimension)
    k = min(components, len(model["values"]))
    if not k:
        return df.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(_rows(model, k, identity_error(fit, model, k)), schema)


def embedding_whitening(embeddings: DataFrame) -> DataFrame:
    return whitened(embeddings)
