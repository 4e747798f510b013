import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from statlab.operators.impute import median_impute, standardize
from statlab.operators.leaders import best_group, lead_counts, metric_leaders
from statlab.operators.medians import exact_medians
from statlab.operators.rank import extremes
from statlab.operators.reshape import aggregate_long, to_long, to_wide
from statlab.operators.stats import group_stats_long, group_stats_wide


def medians(frame):
    return {(r["is_total"], r["grp"], r["metric"]): r["median"] for r in frame.collect()}


def spread_values(kind, n, rng):
    make = {
        "normal": lambda: rng.gauss(0, 1),
        "huge": lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300),
        "tiny": lambda: rng.uniform(0, 1) * 5e-324 * 1000,
        "ties": lambda: float(rng.choice([0, 0, 0, 1, 2])),
        "near": lambda: 1e9 + rng.random() * 1e-3,
        "signs": lambda: rng.choice([-0.0, 0.0, -1.5, 1.5, math.inf, -math.inf]),
    }[kind]
    return [make() for _ in range(n)]


@pytest.mark.parametrize("kind", ["normal", "huge", "tiny", "ties", "near", "signs"])
def test_median_is_exact(spark, kind):
    rng = random.Random(kind)
    rows = [(rng.choice(["a", "a", "a", "b", None]), v) for v in spread_values(kind, 2001, rng)]
    rows += [("one", rows[0][1]), ("two", rows[1][1]), ("two", rows[2][1]), ("none", None)]
    found = medians(exact_medians(spark.createDataFrame(rows, "g string, v double").repartition(5), ["v"], "g"))
    for g in {"a", "b", None, "one", "two"}:
        assert found[(False, g, "v")] == pytest.approx(
            statistics.median(v for k, v in rows if k == g and v is not None), rel=1e-15, nan_ok=True
        )
    want = statistics.median(v for _, v in rows if v is not None)
    assert found[(True, None, "v")] == pytest.approx(want, rel=1e-15, nan_ok=True)
    assert (False, "none", "v") not in found


def test_narrowing_goes_on_while_a_step_has_many_values(spark, monkeypatch):
    from statlab.operators import medians as module

    monkeypatch.setattr(module, "STEPS", 4)
    monkeypatch.setattr(module, "FEW", 3)
    rng = random.Random(9)
    rows = [(rng.choice("ab"), 100 + rng.random() ** 6) for _ in range(3001)]
    found = medians(exact_medians(spark.createDataFrame(rows, "g string, v double"), ["v"], "g"))
    for g in "ab":
        assert found[(False, g, "v")] == statistics.median(v for k, v in rows if k == g)
    assert found[(True, None, "v")] == statistics.median(v for _, v in rows)


def test_one_group_holds_nearly_all_rows(spark):
    frame = spark.range(100_000).select(
        F.when(F.col("id") % 1000 == 0, "rare").otherwise("hot").alias("g"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 7).alias("v"),
    )
    found = medians(exact_medians(frame, ["v"], "g"))
    want = {r["g"]: r["m"] for r in frame.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert found[(False, "hot", "v")] == want["hot"] and found[(False, "rare", "v")] == want["rare"]
    assert found[(True, None, "v")] == frame.agg(F.median("v")).first()[0]


def test_median_where_ranges_are_not_broadcast(spark, no_broadcast):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "b", None]), rng.gauss(0, 1)) for _ in range(2000)]
    found = medians(exact_medians(spark.createDataFrame(rows, "g string, v double"), ["v"], "g"))
    for g in ("a", "b", None):
        assert found[(False, g, "v")] == pytest.approx(statistics.median(v for k, v in rows if k == g), rel=1e-15)


def test_other_columns_may_have_any_name(spark):
    frame = spark.createDataFrame([("a", 1.0, "x", "y"), ("a", 2.0, "x", "y")], "g string, v double, grp string, metric string")
    row = group_stats_long(frame, "g", ["v"]).where("is_total").first()
    assert (row["median"], row["mean"]) == (1.5, 1.5)


def test_nan_is_missing(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", math.nan), ("a", 3.0)], "g string, v double")
    row = group_stats_long(frame, "g", ["v"]).where("not is_total").first()
    assert (row["n"], row["median"], row["mean"]) == (2, 2.0, 2.0)


def test_single_value_has_no_deviation_and_null_group_is_not_the_total(spark):
    frame = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 4.0), ("b", None)], "g string, v double")
    rows = {(r["is_total"], r["group"]): r for r in group_stats_long(frame, "g", ["v"]).collect()}
    assert rows[(False, "a")]["std"] is None
    assert rows[(False, None)]["median"] == 3.0
    assert rows[(True, "all")]["n"] == 3
    assert (rows[(False, "b")]["n"], rows[(False, "b")]["median"], rows[(False, "b")]["mean"]) == (0, None, None)


def test_wide_has_three_columns_per_metric_in_order(spark):
    frame = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, None)], "g string, v double, w double")
    wide = group_stats_wide(frame, "g", ["w", "v"], {"w": "W%"})
    assert wide.columns == ["is_total", "group", "Median of W%", "Mean of W%", "Std of W%",
                            "Median of v", "Mean of v", "Std of v"]
    assert {r["group"]: r["Median of W%"] for r in wide.collect()} == {"a": 2.0, "b": None, "all": 2.0}


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_group_means_and_deviations_rebuild_the_total(spark, partitions):
    rng = random.Random(1)
    rows = [(rng.choice("abcd"), rng.uniform(0, 3000)) for _ in range(500)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(partitions)
    found = group_stats_long(frame, "g", ["v"]).collect()
    total = next(r for r in found if r["is_total"])
    groups = [r for r in found if not r["is_total"]]
    n = sum(r["n"] for r in groups)
    mean = sum(r["n"] * r["mean"] for r in groups) / n
    squares = sum((r["n"] - 1) * r["std"] ** 2 + r["n"] * (r["mean"] - mean) ** 2 for r in groups)
    assert n == total["n"] == 500
    assert mean == pytest.approx(total["mean"])
    assert math.sqrt(squares / (n - 1)) == pytest.approx(total["std"])
    assert total["median"] == statistics.median(v for _, v in rows)


def test_many_metrics_in_batches(spark):
    names = [f"m{i}" for i in range(72)]
    frame = spark.range(40).select((F.col("id") % 3).alias("g"), *[(F.col("id") * i).alias(m) for i, m in enumerate(names)])
    rows = aggregate_long(frame, ["g"], names, {"total": F.sum, "mean": F.avg}, 3).collect()
    assert len(rows) == 3 * 72
    got = {(r["g"], r["metric"]): r["total"] for r in rows}
    assert all(got[(g, f"m{i}")] == i * sum(x for x in range(40) if x % 3 == g) for g in range(3) for i in range(72))


@pytest.mark.parametrize("partitions", [1, 4])
def test_extremes_break_ties_by_name_and_skip_nulls(spark, partitions):
    rng = random.Random(3)
    rows = [(f"p{i:04d}", rng.choice([None, 0.0, 1.0, float(i)]), float(i % 2)) for i in range(700)]
    frame = spark.createDataFrame(rows, "name string, a double, b double").repartition(partitions)
    got = {(r["metric"], r["side"], r["rank"]): (r["name"], r["value"]) for r in extremes(frame, "name", ["a", "b"]).collect()}
    for column, metric in [(1, "a"), (2, "b")]:
        known = [(r[column], r[0]) for r in rows if r[column] is not None]
        high = sorted(known, key=lambda x: (-x[0], x[1]))[:3]
        low = sorted(known)[:3]
        assert [got[(metric, "high", k)] for k in (1, 2, 3)] == [(n, v) for v, n in high]
        assert [got[(metric, "low", k)] for k in (1, 2, 3)] == [(n, v) for v, n in low]


def test_extremes_of_fewer_than_three(spark):
    frame = spark.createDataFrame([("x", 1.0, None), ("y", 2.0, None)], "name string, a double, b double")
    got = [(r["metric"], r["side"], r["rank"], r["name"]) for r in extremes(frame, "name", ["a", "b"]).collect()]
    assert sorted(got) == [("a", "high", 1, "y"), ("a", "high", 2, "x"), ("a", "low", 1, "x"), ("a", "low", 2, "y")]


def test_leader_tie_goes_to_first_name_and_counts_add_up(spark):
    rows = [("B", 2.0, 0.1, 5.0), ("B", 3.0, 0.2, None), ("A", 5.0, 0.3, 1.0), ("C", 1.0, 0.0, 1.0)]
    frame = spark.createDataFrame(rows, "team string, x double, y double, z double")
    metrics = ["x", "y", "z"]
    leaders = metric_leaders(frame, "team", metrics)
    assert {r["metric"]: r["team"] for r in leaders.collect()} == {"x": "A", "y": "A", "z": "B"}
    counts = lead_counts(leaders, "team", metrics)
    assert sum(r["n_metrics"] for r in counts.collect()) == len(metrics)
    assert best_group(counts, "team").first()["team"] == "A"
    by_mean = {r["metric"]: r["team"] for r in metric_leaders(frame, "team", metrics, "mean").collect()}
    assert by_mean == {"x": "A", "y": "A", "z": "B"}


def test_sum_and_mean_may_have_different_leaders(spark):
    frame = spark.createDataFrame([("big", 60.0)] * 5 + [("small", 90.0)] * 2, "team string, pct double")
    assert metric_leaders(frame, "team", ["pct"]).first()["team"] == "big"
    assert metric_leaders(frame, "team", ["pct"], "mean").first()["team"] == "small"


def test_impute_fills_the_interpolated_median(spark):
    rows = [(i, v, None) for i, v in enumerate([1.0, 1.48, 1.49, 2.0, None, math.nan])]
    got = median_impute(spark.createDataFrame(rows, "id int, v double, w double"), ["v", "w"]).collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["id"])][4:] == [pytest.approx(1.485)] * 2
    assert all(r["w"] is None for r in got)


def test_standardize(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (None, 5.0)], "v double, c double")
    got = standardize(frame, ["v", "c"]).collect()
    assert sorted(r["v_z"] for r in got if r["v_z"] is not None) == [-1.0, 0.0, 1.0]
    assert all(r["c_z"] is None for r in got)


def test_long_and_wide_are_inverse(spark):
    frame = spark.createDataFrame([("a", 1.0, None), ("b", None, 4.0)], "id string, x double, y double")
    long = to_long(frame, ["id"], ["x", "y"], keep_nulls=True)
    assert long.count() == 4 and to_long(frame, ["id"], ["x", "y"]).count() == 2
    assert sorted(to_wide(long, ["id"], "metric", "value", ["x", "y"]).collect()) == sorted(frame.collect())


def test_scratch_files_are_removed(spark, tmp_path):
    from pathlib import Path

    from statlab.session import scratch, shared_folder, stage

    with scratch(spark):
        kept = stage(spark.range(5), "gone").collect()
        folder = Path(shared_folder(spark).removeprefix("file://"))
        assert [p for p in folder.iterdir() if p.name.startswith("gone-")]
    assert len(kept) == 5 and not [p for p in folder.iterdir() if p.name.startswith("gone-")]


def test_the_shape_of_a_season_is_read_few_times(spark):
    from statlab.plans.table_queries import wide_leaders

    plan = wide_leaders(spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1
