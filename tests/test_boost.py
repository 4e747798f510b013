"""Boosted trees: one split against SQL on the tables, whole trees against brute force on odd rows."""

import math
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from statlab.operators import boost, regress
from statlab.plans.tree_queries import QUERIES, SQL
from tests.test_oracle import FOLDER, rows

NAN = float("nan")


def test_queries_are_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())
    assert set(QUERIES) - set(SQL) == {"value_trees"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{FOLDER}/lineitem.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    got = rows(frame.columns, frame.collect())
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert got == rows(columns, result.fetchall())
    assert len(got) > 100


def gone(x):
    return x is None or math.isnan(x)


def edges(values, bins):
    known = [v for v in values if not gone(v)]
    finite = [v for v in known if abs(v) <= boost.LARGEST]
    low, high = (min(finite), max(finite)) if finite else (0.0, 0.0)
    cells = defaultdict(list)
    for v in known:
        cells[math.floor(max(0.0, min(boost.CELLS - 1.0, (v - low) / (high - low) * boost.CELLS))) if high > low else 0].append(v)
    tops, before = {}, 0
    for cell in sorted(cells):
        tops[before * bins // len(known)] = max(cells[cell])
        before += len(cells[cell])
    return sorted(tops.values())


def grown(data, trees):
    """Predictions for the rows ``(x, y)`` of one category, from a plain reading of the rules."""
    features = len(data[0][0])
    tops = [edges([x[i] for x, _ in data], trees.bins) for i in range(features)]
    bins = [[0 if gone(x[i]) else 1 + sum(t < x[i] for t in tops[i]) for i in range(features)] for x, _ in data]
    low = min(y for _, y in data)
    unit = (max(y for _, y in data) - low) / boost.UNITS
    units = [math.floor((y - low) / unit) if unit > 0 else 0 for _, y in data]
    base = math.floor(sum(units) / len(units))
    total = [base] * len(data)

    def split(own, left, r):
        def score(part):
            g = float(sum(r[i] for i in part))
            return g * g / (len(part) + trees.ridge)
        if left == 0:
            value = math.floor(trees.rate * sum(r[i] for i in own) / (len(own) + trees.ridge))
            for i in own:
                total[i] += value
            return
        best = None
        for f in range(features):
            for b in sorted({bins[i][f] for i in own}):
                one, two = [i for i in own if bins[i][f] <= b], [i for i in own if bins[i][f] > b]
                if min(len(one), len(two)) < max(trees.least, 1):
                    continue
                gain = score(one) + score(two) - score(own)
                if gain > 0 and (best is None or gain > best[0]):
                    best = gain, one, two
        for part in best[1:] if best else [own]:
            split(part, left - 1, r)

    for _ in range(trees.rounds):
        split(list(range(len(data))), trees.depth, [u - t for u, t in zip(units, total)])
    return [low + unit * float(t) for t in total]


def odd_rows():
    rng = random.Random(5)
    made = [("hot", [rng.choice([None, NAN, 1.0, 2.0, 5.5]), rng.uniform(-9, 9), rng.choice([0.0, 1e9])], None) for _ in range(120)]
    made = [(c, x, (0.0 if gone(x[0]) else x[0]) * 3 + x[1] ** 2 + (x[2] > 0)) for c, x, _ in made]
    made += [("", [float(i), None, float("inf")], float(i % 3)) for i in range(9)]
    made += [("flat", [float(i), 1.0, -1.0], 7.25) for i in range(4)] + [("one", [None, None, None], -3.5)]
    made += [("ties", [float(i % 2), float(i % 2), 0.0], float(i % 2)) for i in range(8)]
    return made


@pytest.mark.parametrize("trees", [boost.Trees(rounds=3, depth=3, bins=8), boost.Trees(rounds=2, depth=1, rate=1.0, ridge=0.0, least=3)], ids=["deep", "stumps"])
def test_trees_of_odd_rows(spark, no_broadcast, trees):
    data = odd_rows()
    listed = [(i, c, *x, y) for i, (c, x, y) in enumerate(data)]
    listed += [(900, None, 1.0, 1.0, 1.0, 5.0), (901, "hot", 1.0, 0.0, 0.0, None), (902, "new", 1.0, 1.0, 1.0, None), (903, "hot", 99.0, 99.0, -1.0, NAN)]
    df = spark.createDataFrame(listed, "id int, `the kind` string, x double, `y y` double, trees double, c double").repartition(3)
    names = ["x", "y y", "trees"]
    model = boost.fit(df, "the kind", names, "c", trees)
    assert {r["c"] for r in model.collect()} == {"hot", "", "flat", "one", "ties"}
    frame = boost.predict(df, model, "the kind", names, trees.depth)
    assert frame.columns == [*df.columns, "predicted"]
    found = {r["id"]: r["predicted"] for r in frame.collect()}
    for kind in ("hot", "", "flat", "one", "ties"):
        own = [i for i, (c, _, _) in enumerate(data) if c == kind]
        assert [found[i] for i in own] == grown([data[i][1:] for i in own], trees), kind
    assert found[900] is None and found[902] is None and found[901] is not None and found[903] is not None
    assert len(found) == len(listed)


def test_trees_do_not_depend_on_the_partitioning(spark):
    df = spark.createDataFrame([(i, i % 2, random.Random(i).random(), math.sin(i)) for i in range(300)], "id int, c int, x double, y double")
    trees = boost.Trees(rounds=2, depth=2)
    runs = []
    for n in (1, 7):
        model = boost.fit(df.repartition(n), "c", ["x"], "y", trees)
        runs.append({r["id"]: r["predicted"] for r in boost.predict(df, model, "c", ["x"], 2).collect()})
    assert runs[0] == runs[1]


def test_no_rows_and_wrong_parameters(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)], "c string, x double, y double")
    assert boost.fit(df.limit(0), "c", ["x"], "y", boost.Trees(rounds=2, depth=2)).collect() == []
    with pytest.raises(ValueError):
        boost.fit(df, "c", [], "y")
    with pytest.raises(ValueError):
        boost.fit(df, "c", ["x"], "y", boost.Trees(depth=0))


def test_jobs_do_not_grow_with_the_categories(spark):
    jobs = []
    for categories in (10, 10_000):
        df = spark.range(20_000).select((F.col("id") % categories).alias("c"), (F.col("id") * 7919 % 1009).cast("double").alias("x"), (F.col("id") % 13).alias("y"))
        spark.sparkContext.setJobGroup(f"boost-{categories}", "")
        model = boost.fit(df, "c", ["x"], "y", boost.Trees(rounds=1, depth=2))
        assert model.count() == categories
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"boost-{categories}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 20 and jobs[1] < 100, jobs


def test_estimates_by_trees(spark):
    df = spark.createDataFrame(
        [(f"p{i}", "a" if i % 3 else "b", float(i % 50), 100.0 if i % 50 > 20 else 3.0) for i in range(600)] + [("q", None, 1.0, 1.0), ("r", "c", 1.0, None)],
        "key string, kind string, x double, actual double")
    found = regress.estimate_by_category(df, "kind", ["x"], "actual", "key", regressor=boost.Trees(rounds=6, depth=1, rate=0.9, bins=64))
    assert found.columns == [*df.columns, "is_train", "predicted"] and found.count() == 602
    apart = [r["predicted"] - r["actual"] for r in found.where("kind IN ('a', 'b')").collect()]
    assert max(map(abs, apart)) < 2
    assert {r["key"]: r["predicted"] for r in found.where("key IN ('q', 'r')").collect()} == {"q": None, "r": None}
    assert found.where("NOT is_train AND kind = 'a'").count() > 0
