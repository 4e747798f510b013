"""Cubes, multisets and summaries: against SQL on the tables, against brute force on odd rows."""

from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from statlab.operators import cluster, cubes, joins, multisets, sketches
from statlab.plans import season
from statlab.plans.set_queries import QUERIES
from statlab.plans.set_sql import SQL
from tests.test_oracle import FOLDER, rows


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in "orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    got = rows(frame.columns, frame.collect())
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert got == rows(columns, result.fetchall())


ODD = [(None, None, None, 1.0), ("a", None, 1, None), ("a", 1, 1, 2.0), ("a", 1, 1, 2.0), ("b", 1, None, -1.0), ("b", 2, 2, 0.5), (None, 2, 2, 4.0), ("a", 1, 3, 1.0)]


def test_cube_of_odd_rows(spark):
    df = spark.createDataFrame(ODD, "`k k` string, d int, v int, x double").repartition(3)
    found = {(r["grouping_id"], r["k k"], r["d"]): tuple(r[3:]) for r in cubes.grouped(
        df, ["k k", "d"], {"n_v": "v"}, {"n": ("count", F.lit(1)), "total": ("sum", "x"), "least": ("min", "x")}).collect()}
    want = {}
    for mask, kept in ((0, (0, 1)), (1, (0,)), (2, (1,)), (3, ())):
        groups = defaultdict(list)
        for r in ODD:
            groups[tuple(r[i] if i in kept else None for i in (0, 1))].append(r)
        for key, own in groups.items():
            values = [r[3] for r in own if r[3] is not None]
            want[(mask, *key)] = (len({r[2] for r in own} - {None}), len(own), sum(values) if values else None, min(values, default=None))
    assert found == want


def test_grouping_sets_without_measures_and_without_rows(spark):
    df = spark.createDataFrame(ODD, "k string, d int, v int, x double")
    found = {tuple(r) for r in cubes.grouped(df, ["k", "d"], {"n_v": "v"}, {}, [(), ("d",)]).collect()}
    assert {(r[0], r[1], r[2]) for r in found} == {(3, None, None), (2, None, None), (2, None, 1), (2, None, 2)}
    assert (3, None, None, 3) in found and (2, None, None, 1) in found
    assert cubes.grouped(df.limit(0), ["k"], {"n_v": "v"}, {"n": ("count", F.lit(1))}).collect() == []
    with pytest.raises(ValueError):
        cubes.grouped(df, [], {}, {})


def test_lattice_makes_each_set_once():
    dims = list("abcde")
    masks = {sum(1 << i for i in c) for n in range(6) for c in combinations(range(5), n)}
    made = [m for level in cubes._lattice(dims, masks) for children in level.values() for m in children]
    assert sorted(made) == sorted(masks - {0})


def test_multisets_of_odd_rows(spark):
    lists = [
        [(1, None)] * 5 + [(None, "x")] * 2 + [(2, "y")] + [(3, "")] * 9000,
        [(1, None)] * 3 + [(None, "x")] * 4 + [(3, "")] * 4,
        [(1, None)] * 1 + [(None, "x")] * 3 + [(4, "z")],
    ]
    frames = [spark.createDataFrame(x, "n int, s string") for x in lists]
    frames[1] = frames[1].select("s", "n")
    a, b, c = (Counter(x) for x in lists)
    want = {"intersect": a & b & c, "except": a - b - c, "union": a + b + c, "widest": a | b | c}
    for how, counts in want.items():
        found = multisets.combined(frames, how)
        assert {(r["n"], r["s"]): r["copies"] for r in found.collect()} == dict(counts), how
        assert Counter(map(tuple, multisets.written_out(found).collect())) == counts, how
    once = multisets.combined(frames, "except", distinct=True).collect()
    assert [tuple(r) for r in once] == [(2, "y", 1)]
    assert multisets.combined([frames[0].limit(0), frames[1]], "intersect").collect() == []
    assert {tuple(r)[:2] for r in multisets.combined(frames[:1], "except").collect()} == set(a)
    with pytest.raises(ValueError):
        multisets.copies([frames[0], frames[0].select("n")])


def test_summaries_merge_in_any_order(spark):
    df = spark.range(20_000).select(
        (F.col("id") % 2).alias("g"), (F.col("id") % 9).alias("part"), F.when(F.col("id") % 10 != 0, (F.col("id") * 7919 % 20_011)).cast("double").alias("v"),
        (F.col("id") % 3000).alias("who"))
    parts = sketches.summarised(df, ["g", "part"], "v", "who")
    for order in (parts.orderBy("part"), parts.orderBy(F.desc("part")).repartition(5)):
        found = sketches.answers(sketches.merged(order, ["g"]), ["g"], (0.05, 0.5, 0.95))
        assert {r["g"]: r["n"] for r in found.collect()} == {0: 8000, 1: 10_000}
        assert all(abs(r["n_entities"] - 1500) < 75 for r in found.collect())
        errors = sketches.rank_errors(df, found, ["g"], "v", (0.05, 0.5, 0.95)).collect()
        assert len(errors) == 2 and all(r["rank_error"] <= sketches.RANK_ERROR for r in errors)


def test_summary_of_a_group_without_values(spark):
    df = spark.createDataFrame([("a", None, None), ("b", 1.0, "x"), ("b", float("nan"), None)], "g string, v double, who string")
    found = {r["g"]: tuple(r)[1:] for r in sketches.answers(sketches.summarised(df, ["g"], "v", "who"), ["g"], (0.5,)).collect()}
    assert found == {"a": (0, None, 0), "b": (1, [1.0], 1)}


def test_names_with_an_unknown_word_meet_nobody(spark):
    left = spark.createDataFrame([("t", f"john a{i}") for i in range(3000)] + [("t", "john"), ("t", "mary b7")], "block string, folded string")
    right = spark.createDataFrame([("t", f"john b{i}") for i in range(3000)] + [("t", "mary ann b7")], "block string, folded string")
    found = sorted(map(tuple, joins.names_sharing_words(left, right).collect()))
    assert found == [("t", "john", "john b0", 1), ("t", "mary b7", "mary ann b7", 1)]


def test_labels_do_not_depend_on_the_partitioning(spark):
    df = spark.createDataFrame([(i, [float(i * 37 % 101), float(i * 53 % 89)]) for i in range(400)], "vec_id int, embedding array<double>")
    runs = [
        {r["vec_id"]: r["cluster"] for r in cluster.kmeans_labels(cluster.scaled_features(df.repartition(n), "embedding"), 4, ident="vec_id").collect()}
        for n in (1, 7)]
    assert runs[0] == runs[1] and season.IDENT == ("player", "team")
