"""Clustering and projection on MLlib."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlab.operators.impute import median_impute
from statlab.session import side_by_side, stage

#: Numbers of the centroids that are at the driver and in a task's function at a time.
HELD = 1_000_000


def scaled_features(df: DataFrame, features: Sequence[str] | str, output: str = "features") -> DataFrame:
    """Standardised feature vectors from several columns, or from one array column."""
    if isinstance(features, str):
        raw = df.withColumn("_raw", array_to_vector(F.col(features).cast("array<double>")))
    else:
        raw = VectorAssembler(inputCols=list(features), outputCol="_raw").transform(df)
    scaler = StandardScaler(inputCol="_raw", outputCol=output, withMean=True, withStd=True)
    return scaler.fit(raw).transform(raw).drop("_raw")


def imputed_features(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Median imputation, then standardised vectors; the imputed columns stay in original units."""
    return scaled_features(median_impute(df, features), features, output)


#: Rows in a partition of a fit, about.
ROWS_A_PART = 250_000


def _settled(df: DataFrame, ident: str | Sequence[str] | None, parts: int | None) -> DataFrame:
    """Each row in a partition, and at a place in it, that depend on its id alone: fits draw by partition.

    Without ``parts`` the rows are counted, and each partition gets about 250,000 of them, of eight at least.
    """
    if not ident:
        return df
    keys = [ident] if isinstance(ident, str) else list(ident)
    parts = parts or max(8, -(-df.count() // ROWS_A_PART))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys)


def kmeans_labels(
    df: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 20, features: str = "features",
    ident: str | Sequence[str] | None = None, parts: int | None = None,
) -> DataFrame:
    """Adds ``cluster`` 0..k-1, numbered by size and then by the centre's coordinates.

    With ``ident``, one or more columns that tell rows apart, the labels do not depend on the partitioning of the input;
    ``parts`` is then the number of partitions of the fit, by default taken from the number of rows.
    """
    df = _settled(df, ident, parts)
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features, predictionCol="_label").fit(df)
    centres = [tuple(c) for c in model.clusterCenters()]
    order = sorted(range(len(centres)), key=lambda i: (model.summary.clusterSizes[i], centres[i]))
    number = [order.index(i) for i in range(len(order))]
    labels = F.array(*[F.lit(n) for n in number])
    return model.transform(df).withColumn("cluster", F.get(labels, F.col("_label"))).drop("_label")


def _spread(vectors: DataFrame, features: str) -> float:
    """The inertia of a single cluster."""
    of = Summarizer.metrics("variance", "count").summary(F.col(features))
    found = vectors.agg(of.alias("s")).first()["s"]
    return float(sum(found["variance"].toArray()) * (found["count"] - 1))


def elbow(
    df: DataFrame,
    ks: Iterable[int] = range(1, 11),
    seed: int = 42,
    max_iter: int = 20,
    features: str = "features",
    threads: int = 4,
    ident: str | Sequence[str] | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``k, inertia, drop`` for each K; the vectors are kept once for all fits. ``ident`` as in ``kmeans_labels``."""
    ks = list(ks)
    vectors = _settled(df, ident, parts).select(features).persist(StorageLevel.MEMORY_AND_DISK)

    def cost(k: int) -> float:
        if k == 1:
            return _spread(vectors, features)
        fit = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol=features).fit(vectors)
        return float(fit.summary.trainingCost)

    try:
        costs = side_by_side(df.sparkSession, [partial(cost, k) for k in ks], threads)
    finally:
        vectors.unpersist()
    drops = [None, *[a - b for a, b in zip(costs, costs[1:])]]
    rows = list(zip(ks, costs, drops))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, drop double")


def project(df: DataFrame, k: int = 2, features: str = "features") -> DataFrame:
    """Adds ``pc1..pck`` and ``explained``, the share of variance the components hold together.

    Each component points so that its largest loading is positive. Features have to be centred.
    """
    model = PCA(k=k, inputCol=features, outputCol="_pc").fit(df)
    loadings = model.pc.toArray()
    sign = [1.0 if loadings[abs(loadings[:, i]).argmax(), i] >= 0 else -1.0 for i in range(k)]
    scores = vector_to_array("_pc")
    placed = model.transform(df).withColumns({f"pc{i + 1}": scores[i] * sign[i] for i in range(k)})
    return placed.withColumn("explained", F.lit(float(model.explainedVariance.toArray().sum()))).drop("_pc")


def group_centroids(df: DataFrame, group: str, array: str) -> DataFrame:
    """The mean vector of each group: ``group, centroid``; partial means are what is shuffled."""
    vector = array_to_vector(F.col(array).cast("array<double>"))
    return df.groupBy(group).agg(vector_to_array(Summarizer.mean(vector)).alias("centroid"))


def _closest(labels: list, centres: np.ndarray, result: T.StructType):
    """Label and distance of the nearest of some centroids; the smaller label on a tie."""
    squares = (centres**2).sum(axis=1)

    @F.arrow_udf(result)
    def closest(points: pa.Array) -> pa.Array:
        there = points.is_valid().to_numpy(zero_copy_only=False)
        lengths = pc.list_value_length(points.drop_null())
        if pc.any(pc.not_equal(lengths, centres.shape[1])).as_py():
            raise ValueError("a point has another number of dimensions than the centroids")
        x = points.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, centres.shape[1])
        norms = (x**2).sum(axis=1)
        rough = norms[:, None] + squares[None] - 2.0 * (x @ centres.T)
        # The product loses digits, so all centroids that may be nearest within its error are measured again.
        error = 1e-9 * (norms[:, None] + squares[None]) + 1e-30
        near = rough - error <= (rough + error).min(axis=1, initial=np.inf)[:, None]
        row, centre = np.nonzero(near)
        exact = ((x[row] - centres[centre]) ** 2).sum(axis=1)
        order = np.lexsort((centre, exact, row))
        first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
        squared, place = np.full(len(x), np.inf), np.full(len(x), -1)
        squared[row[first]], place[row[first]] = exact[first], centre[first]
        at, far = np.full(len(points), -1), np.full(len(points), np.inf)
        at[there], far[there] = place, np.sqrt(squared)
        index = pa.array(at, mask=at < 0)
        return pa.StructArray.from_arrays(
            [pa.array(labels).take(index), pa.array(far, mask=at < 0)], names=["nearest", "distance"]
        )

    return closest


def nearest_centroid(df: DataFrame, array: str, centroids: DataFrame, label: str) -> DataFrame:
    """Adds ``nearest`` and ``distance`` to the closest centroid, the smaller label on a tie.

    The centroids go to the tasks in blocks of a bounded count of numbers, in order of their labels; each block is
    one pass, and the nearest so far is kept with the row. A null label is left out.
    """
    known = stage(centroids.select(label, "centroid").where(F.col(label).isNotNull()), "centroids")
    widest = known.agg(F.max(F.size("centroid"))).first()[0] or 1
    size = max(1, HELD // widest)
    result = T.StructType([
        T.StructField("nearest", centroids.schema[label].dataType), T.StructField("distance", T.DoubleType()),
    ])
    found, block = df, known.orderBy(label).limit(size).collect()
    nothing = F.lit(None).cast(result)
    best = None
    while block:
        labels, centres = [r[0] for r in block], np.array([r[1] for r in block], dtype=float)
        here = _closest(labels, centres, result)(F.col(array))
        found = found.withColumn("_found" if best is None else "_next", here)
        if best is not None:
            nearer = F.coalesce(F.col("_next.distance") < F.col("_found.distance"), F.lit(False))
            found = found.withColumn("_found", F.when(nearer, F.col("_next")).otherwise(F.col("_found"))).drop("_next")
        best = labels[-1]
        block = known.where(F.col(label) > best).orderBy(label).limit(size).collect() if len(block) == size else []
        if block:
            found = stage(found, "nearest")
    found = found if best is not None else found.withColumn("_found", nothing)
    return found.withColumns({"nearest": F.col("_found.nearest"), "distance": F.col("_found.distance")}).drop("_found")
