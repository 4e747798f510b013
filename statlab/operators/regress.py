"""Regression estimates per category and their quality."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial, reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statlab.functions.clean import clamp_floor
from statlab.operators import boost
from statlab.session import new_path, side_by_side, stage

#: Numbers a task holds while it adds up products, before it passes them on.
HELD = 4_000_000


def in_training(key: Column, percent: int = 80) -> Column:
    """A split that depends on the key alone: the same on every run and under any partitioning."""
    digits = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return digits % 100 < percent


def line_by_group(df: DataFrame, group: Sequence[str], y: str, x: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group: ``n, slope, intercept, r2``."""
    return df.groupBy(*group).agg(
        F.regr_count(F.col(y), F.col(x)).alias("n"),
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
    )


def residual(predicted: str, actual: str) -> Column:
    return F.col(predicted) - F.col(actual)


def quality(df: DataFrame, group: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """``n, mae, rmse, r2`` per group over rows that have both values."""
    e = residual(predicted, actual)
    spread = F.var_pop(F.col(actual))
    return df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).groupBy(*group).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.try_divide(F.avg(e * e), spread)).alias("r2"),
    )


def _cross_sums(features: int):
    """Per task and category the products of ``1, x1..xk, y`` that least squares needs, as rows ``i, j, value``."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[object, np.ndarray] = {}
        i, j = (x.astype(np.int32) for x in np.triu_indices(features + 2))

        def rows() -> Iterator[pa.RecordBatch]:
            for name, total in sums.items():
                values = total[i, j]
                some = values != 0
                names = pa.array([name] * int(some.sum()), kind)
                yield pa.RecordBatch.from_arrays([names, pa.array(i[some]), pa.array(j[some]), pa.array(values[some])], ["c", "i", "j", "value"])

        kind = pa.string()
        for batch in batches:
            kind = batch.column("c").type
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, features + 1)
            whole = np.hstack([np.ones((len(x), 1)), x])
            coded = batch.column("c").dictionary_encode()
            codes = coded.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            cuts = np.flatnonzero(np.diff(codes[order])) + 1
            for rows_of in np.split(order, cuts) if len(order) else []:
                name = coded.dictionary[int(codes[rows_of[0]])].as_py()
                sums[name] = sums.get(name, 0.0) + whole[rows_of].T @ whole[rows_of]
            if len(sums) * whole.shape[1] ** 2 > HELD:
                yield from rows()
                sums.clear()
        yield from rows()

    return summed


def _solve(features: int):
    """Centred least squares from the sums of one category; of several solutions the shortest."""

    def solved(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((features + 2, features + 2))
        total[pdf["i"], pdf["j"]] = pdf["value"]
        total = total + np.triu(total, 1).T
        n, sums = total[0, 0], total[0, 1:]
        centred = total[1:, 1:] - np.outer(sums, sums) / n
        xx, xy = centred[:-1, :-1], centred[:-1, -1]
        scale = np.sqrt(np.maximum(np.diag(xx), 0.0))
        flat = scale <= 1e-7 * np.sqrt(np.maximum(np.diag(total)[1:-1], 1e-300))
        scale[flat] = 1.0
        unit = xx / np.outer(scale, scale)
        unit[flat], unit[:, flat] = 0.0, 0.0
        slopes = np.linalg.pinv(unit, rcond=1e-10, hermitian=True) @ np.where(flat, 0.0, xy / scale) / scale
        intercept = (sums[-1] - slopes @ sums[:-1]) / n
        return pd.DataFrame({"c": pdf["c"].iloc[:1], "slopes": [slopes.tolist()], "intercept": [intercept]})

    return solved


def least_squares(df: DataFrame, category: str, features: Sequence[str], actual: str) -> DataFrame:
    """``c, slopes, intercept`` per category, from one pass over the rows.

    Only sums of products are shuffled, added up in the tasks first, so neither a hot category nor a great number of
    them changes the plan.
    """
    used = [F.col(f"`{c}`").cast("double") for c in [*features, actual]]
    rows = df.where(F.col(category).isNotNull()).select(F.col(category).alias("c"), F.array(*used).alias("x"))
    rows = rows.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    kind = df.schema[category].dataType
    found = rows.mapInArrow(_cross_sums(len(features)), f"c {kind.simpleString()}, i int, j int, value double")
    sums = found.groupBy("c", "i", "j").agg(F.sum("value").alias("value"))
    return sums.groupBy("c").applyInPandas(_solve(len(features)), f"c {kind.simpleString()}, slopes array<double>, intercept double")


def estimate_by_category(
    df: DataFrame,
    category: str,
    features: Sequence[str],
    actual: str,
    key: str,
    percent: int = 80,
    floor: float = 0.1,
    regressor=None,
    predicted: str = "predicted",
    threads: int = 4,
) -> DataFrame:
    """One model per category, fitted on the training share: adds ``predicted`` and ``is_train`` to every row.

    Least squares by default: coefficients of all categories from one aggregate, joined back. With ``boost.Trees`` the
    trees of all categories grow together, and a missing feature is a value like others. With a regressor of MLlib each category is fitted for itself, and the estimates are written to the shared folder, so that the plan
    does not grow with the categories. The empty text is a category like any other. Rows of a null category, of one
    without training rows, or with a missing feature are kept with a null estimate.
    """
    marked = df.withColumn("is_train", in_training(F.col(key), percent))
    training = F.col("is_train") & F.col(actual).isNotNull()
    if regressor is None:
        fits = stage(least_squares(marked.where(training), category, features, actual).toDF("_c", "_slopes", "_intercept"), "fits")
        point = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
        raw = F.aggregate(F.zip_with(point, "_slopes", lambda x, b: x * b), F.col("_intercept"), lambda s, x: s + x)
        joined = marked.join(fits, F.col(category) == F.col("_c"), "left")
        return joined.withColumn(predicted, F.round(clamp_floor(raw, floor), 2)).select(*df.columns, "is_train", predicted)
    if isinstance(regressor, boost.Trees):
        model = boost.fit(marked.where(training), category, features, actual, regressor)
        found = boost.predict(marked, model, category, features, regressor.depth, predicted)
        return found.withColumn(predicted, F.round(clamp_floor(F.col(f"`{predicted}`"), floor), 2))
    marked = stage(marked, "by-category")
    regressor = regressor.copy({
        regressor.featuresCol: "_features", regressor.labelCol: actual, regressor.predictionCol: "_raw",
    })
    complete = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in features])
    trained = [r[0] for r in marked.where(training & complete & F.col(category).isNotNull()).select(category).distinct().toLocalIterator()]
    path = new_path(df.sparkSession, "estimates")
    columns = [*df.columns, "is_train", predicted]

    def estimate(place: int, name) -> None:
        rows = marked.where((F.col(category) == name) & complete)
        pipeline = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_features"), regressor.copy()])
        model = pipeline.fit(rows.where(training))
        value = F.round(clamp_floor(F.col("_raw"), floor), 2)
        model.transform(rows).withColumn(predicted, value).select(*columns).write.parquet(f"{path}/{place}")

    side_by_side(df.sparkSession, [partial(estimate, i, n) for i, n in enumerate(trained)], threads)
    fitted = marked.select(category).where(training & complete).distinct() if trained else marked.select(category).limit(0)
    rest = marked.join(stage(fitted.withColumnRenamed(category, "_c"), "fitted"), F.col(category) == F.col("_c"), "left")
    rest = rest.where(F.col("_c").isNull() | ~complete).withColumn(predicted, F.lit(None).cast("double")).select(*columns)
    if not trained:
        return rest
    schema = T.StructType([*marked.schema.fields, T.StructField(predicted, T.DoubleType())])
    return df.sparkSession.read.schema(schema).option("recursiveFileLookup", True).parquet(path).select(*columns).unionByName(rest)
