import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from statlab.operators import cluster, profile, regress


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0, 0], [8, 8, 0], [0, 8, 8], [8, 0, 8]], float)
    rows = [(i, *map(float, centres[c] + rng.normal(0, 0.3, 3)), int(c))
            for i, c in enumerate(np.repeat(range(4), [10, 20, 30, 40]))]
    frame = spark.createDataFrame(rows, "id int, x double, y double, z double, truth int").repartition(3)
    return cluster.scaled_features(frame, ["x", "y", "z"]).cache()


def test_kmeans_finds_separated_groups_and_numbers_them_by_size(spark, blobs):
    for seed in (1, 42):
        found = cluster.kmeans_labels(blobs, 4, seed)
        sizes = {r["cluster"]: r["size"] for r in profile.sizes(found, "cluster").collect()}
        assert sizes == {0: 10, 1: 20, 2: 30, 3: 40}
        assert found.select("cluster", "truth").distinct().count() == 4


def test_inertia_falls_with_k(spark, blobs):
    rows = cluster.elbow(blobs, range(1, 7)).collect()
    costs = [r["inertia"] for r in rows]
    assert [r["k"] for r in rows] == list(range(1, 7)) and rows[0]["drop"] is None
    assert all(a >= b - 1e-6 for a, b in zip(costs, costs[1:]))
    assert costs[0] == pytest.approx(99 * 3)
    assert costs[3] < 0.05 * costs[0]


def test_projection_agrees_with_the_eigenvectors(spark, blobs):
    got = cluster.project(blobs).orderBy("id").collect()
    x = np.array([[r["x"], r["y"], r["z"]] for r in got])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    top = vectors[:, ::-1][:, :2]
    top = top * np.sign(top[np.abs(top).argmax(0), [0, 1]])
    assert np.allclose(z @ top, [[r["pc1"], r["pc2"]] for r in got])
    assert got[0]["explained"] == pytest.approx(values[::-1][:2].sum() / values.sum())


def test_profile_rebuilds_the_overall_mean(spark, blobs):
    means = profile.profile(blobs, "truth", ["x", "y"]).collect()
    sizes = {r["truth"]: r["size"] for r in profile.sizes(blobs, "truth").collect()}
    for m in ("x", "y"):
        mixed = sum(r["mean"] * sizes[r["truth"]] for r in means if r["metric"] == m) / sum(sizes.values())
        assert mixed == pytest.approx(blobs.agg(F.avg(m)).first()[0])


def test_standouts_and_categories(spark):
    means = spark.createDataFrame([(0, "a", 1.0), (0, "b", 2.0), (0, "c", 50.0), (1, "a", 9.0), (1, "b", 1.0), (1, "c", 40.0)],
                                  "cluster int, metric string, mean double")
    assert [(r["cluster"], r["metric"]) for r in profile.standouts(means, "cluster").orderBy("cluster").collect()] == [(0, "c"), (1, "c")]
    assert (1, "a") in [(r["cluster"], r["metric"]) for r in profile.standouts(means, "cluster", 0.5, scaled=True).collect()]
    rows = [(1, p) for p in ["FW", "FW,MF", "FW", "DF", "FW,MF", "FW"]] + [(2, "GK")]
    top = profile.top_categories(spark.createDataFrame(rows, "cluster int, position string"), "cluster", "position")
    lists = profile.listed(top, "cluster", "position", "rank", "main")
    assert {r["cluster"]: r["main"] for r in lists.collect()} == {1: "FW, FW,MF", 2: "GK"}


def test_nearest_centroid_and_tie(spark):
    points = spark.createDataFrame(
        [(1, [0.0, 1.0]), (2, [5.0, 5.0]), (3, [2.5, 2.5]), (4, None), (5, [None, 1.0])], "id int, v array<float>"
    )
    centres = spark.createDataFrame([(7, [5.0, 5.0]), (3, [0.0, 0.0])], "label int, centroid array<double>")
    got = {r["id"]: (r["nearest"], r["distance"]) for r in cluster.nearest_centroid(points, "v", centres, "label").collect()}
    assert got[1] == (3, 1.0) and got[2] == (7, 0.0) and got[3][0] == 3
    assert got[4] == got[5] == (None, None)
    with pytest.raises(Exception, match="another number of dimensions"):
        cluster.nearest_centroid(spark.createDataFrame([([1.0],)], "v array<double>"), "v", centres, "label").collect()


def test_centroids_go_through_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres, points = rng.normal(size=(23, 3)), rng.normal(size=(200, 3))
    known = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)] + [(None, [0.0] * 3), (99, centres[5].tolist())], "label int, centroid array<double>")
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)] + [(900, None)], "id int, v array<double>")
    want = {i: int(((centres - p) ** 2).sum(axis=1).argmin()) for i, p in enumerate(points)} | {900: None}
    for held in (3, 12, 10**6):
        monkeypatch.setattr(cluster, "HELD", held)
        got = {r["id"]: r["nearest"] for r in cluster.nearest_centroid(frame, "v", known, "label").collect()}
        assert got == want
    assert cluster.nearest_centroid(frame, "v", known.limit(0), "label").where("nearest IS NULL").count() == 201


def test_labels_do_not_depend_on_the_partitions(spark):
    frame = spark.range(300).select("id", array_to_vector(F.array(
        (F.pmod("id", F.lit(4)) * 50).cast("double"), F.pmod(F.xxhash64("id"), F.lit(10)).cast("double"))).alias("features"))
    found = [sorted(map(tuple, cluster.kmeans_labels(frame.repartition(n), 4, ident="id").select("id", "cluster").collect())) for n in (1, 3, 7)]
    assert found[0] == found[1] == found[2] and len({c for _, c in found[0]}) == 4


def test_model_per_category(spark):
    frame = spark.range(400).select(
        "id", F.when(F.col("id") % 2 == 0, "GK").otherwise("FW, x=y").alias("position"),
        F.pmod(F.xxhash64("id"), F.lit(50)).cast("double").alias("x"),
    ).withColumn("value", F.when(F.col("position") == "GK", 3 * F.col("x") + 1).otherwise(20 - 2 * F.col("x")))
    found = regress.estimate_by_category(frame, "position", ["x"], "value", "id")
    rows = found.collect()
    assert len(rows) == 400 and {r["position"] for r in rows} == {"GK", "FW, x=y"}
    assert all(r["predicted"] == pytest.approx(max(r["value"], 0.1), abs=0.01) for r in rows)
    share = sum(r["is_train"] for r in rows) / 400
    assert 0.7 < share < 0.9
    again = {r["id"]: r["is_train"] for r in frame.repartition(7).withColumn("is_train", regress.in_training(F.col("id"))).collect()}
    assert again == {r["id"]: r["is_train"] for r in rows}


def test_any_regressor_can_be_used(spark):
    from pyspark.ml.regression import GBTRegressor

    frame = spark.range(200).select("id", F.lit("MF").alias("position"), (F.col("id") % 10).cast("double").alias("x"))
    frame = frame.withColumn("value", F.when(F.col("x") > 4, 30.0).otherwise(-5.0))
    found = regress.estimate_by_category(frame, "position", ["x"], "value", "id", regressor=GBTRegressor(maxIter=2, seed=1))
    assert {r["predicted"] for r in found.collect()} == {30.0, 0.1}


@pytest.mark.parametrize("boosted", [False, True])
def test_no_row_is_lost(spark, boosted):
    from pyspark.ml.regression import GBTRegressor

    kind = F.when(F.col("id") % 4 == 0, "").when(F.col("id") % 4 == 1, F.lit(None)).when(F.col("id") % 4 == 2, "GK").otherwise(
        F.concat(F.lit("lone "), F.col("id").cast("string")))
    frame = spark.range(120).select("id", kind.alias("c"), (F.col("id") % 10).cast("double").alias("x"), (F.col("id") % 10 * 2.0 + 1).alias("y"))
    frame = frame.withColumn("x", F.when(F.col("id") != 6, F.col("x")))
    found = regress.estimate_by_category(frame, "c", ["x"], "y", "id", regressor=GBTRegressor(maxIter=1, seed=1) if boosted else None).collect()
    assert sorted(r["id"] for r in found) == list(range(120))
    for r in found:
        lone = r["c"] is not None and r["c"].startswith("lone")
        assert (r["predicted"] is None) == (r["c"] is None or r["id"] == 6 or (lone and not r["is_train"]))
        if r["c"] in ("", "GK") and not boosted and r["id"] != 6:
            assert r["predicted"] == pytest.approx(r["y"], abs=0.01)


def test_many_categories_and_features(spark):
    frame = spark.range(3000).select(
        "id", (F.col("id") % 300).cast("string").alias("c"), *[F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)).cast("double").alias(f"x{k}") for k in range(3)])
    frame = frame.withColumn("y", 1e6 + F.col("x0") * 3 - F.col("x1") + 0.5 * F.col("x2") * 0 + F.col("c").cast("double"))
    found = regress.estimate_by_category(frame, "c", ["x0", "x1", "x2"], "y", "id")
    assert found.count() == 3000
    assert found.where(F.abs(F.col("predicted") - F.col("y")) > 0.02).count() < 60


def test_lines_are_joined_without_moving_the_rows_by_group(spark, no_broadcast):
    from statlab.plans.table_queries import residuals

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    plan = residuals(spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(l_returnflag" not in plan


def test_quality(spark):
    frame = spark.createDataFrame([("a", 1.0, 1.5), ("a", 3.0, 2.5), ("a", None, 1.0), ("b", 2.0, 2.0)], "g string, y double, p double")
    got = {r["g"]: r for r in regress.quality(frame, ["g"], "y", "p").collect()}
    assert (got["a"]["n"], got["a"]["mae"], got["a"]["rmse"], got["a"]["r2"]) == (2, 0.5, 0.5, 0.75)
    assert got["b"]["r2"] is None
