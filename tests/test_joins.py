import random

import pytest
from pyspark.sql import functions as F

from statlab.operators import joins


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


@pytest.mark.parametrize("limit", [0, 1, 2, 3])
def test_similar_names_are_all_found(spark, limit):
    rng = random.Random(limit)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(0, 7)))
    left = sorted({(rng.choice("xy"), word()) for _ in range(20)})
    right = sorted({(rng.choice("xy"), word()) for _ in range(60)})
    schema = "block string, folded string"
    found = joins.similar_names(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), limit, False)
    want = {(b, n, m, distance(n, m)) for b, n in left for c, m in right if b == c and distance(n, m) <= limit}
    assert {tuple(r) for r in found.collect()} == want


PLAYERS = [("Alex Bakker", "Dunmere"), ("Cole Bakker", "Brockley"), ("Sávio Luz", "Ashford"), ("Nobody Else", "Ashford")]
VALUES = [("v1", "cole bakker", "Brockley", 115.4), ("v2", "Savio  Luz", "Ashford", 74.8), ("v3", "Savio Luz", "Ashford", 1.0)]


def match(spark, block, limit, how="inner"):
    left = spark.createDataFrame(PLAYERS, "player string, team string")
    right = spark.createDataFrame(VALUES, "id string, name string, club string, value double")
    found = joins.approx_name_join(left, right, "player", "name", "id", block, limit, how)
    return {r["player"]: (r["match_id"], r["distance"]) for r in found.collect()}


def test_team_has_to_agree_unless_loose(spark):
    assert match(spark, ("team", "club"), 3) == {"Cole Bakker": ("v1", 0), "Sávio Luz": ("v2", 0)}
    loose = match(spark, None, 4, "left")
    assert loose["Alex Bakker"] == ("v1", 3) and loose["Nobody Else"] == (None, None)


def test_rows_of_a_hot_name_all_get_their_match(spark):
    left = spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, "Jon Smyth").otherwise(
        F.concat(F.lit("Name "), F.pmod("id", F.lit(500)).cast("string"))).alias("n"))
    right = spark.createDataFrame([(1, "John Smyth"), (2, "Name 17")], "rid int, name string")
    found = joins.approx_name_join(left, right, "n", "name", "rid", None, 1).groupBy("match_name").count()
    got = {r[0]: r[1] for r in found.collect()}
    near = [i for i in range(6000) if i % 3 and distance(f"Name {i % 500}", "Name 17") <= 1]
    assert got == {"John Smyth": 2000, "Name 17": len(near)}


def test_match_where_nothing_is_broadcast(spark, no_broadcast):
    assert match(spark, ("team", "club"), 3) == {"Cole Bakker": ("v1", 0), "Sávio Luz": ("v2", 0)}


def test_aliases_and_contradictions(spark):
    frame = spark.createDataFrame([("Man T", "Manford Town"), ("Elsewhere", "Manford Town"), (None, "x")], "c string, team string")
    resolved = joins.resolve_alias(frame, "c", {"Man T": "Manford Town"}, "full")
    assert [r["full"] for r in joins.contradicting(resolved, "full", "team").collect()] == ["Elsewhere"]
    assert resolved.count() == 3
    many = spark.range(20_000).select(F.col("id").cast("string").alias("alias"), F.lit("x").alias("full_name"))
    own = spark.createDataFrame([("7", "kept", "too")], "c string, alias string, full_name string")
    assert joins.resolve_alias(own, "c", many, "full").collect()[0].asDict() == {"c": "7", "alias": "kept", "full_name": "too", "full": "x"}


def test_candidates_stay_few(spark, monkeypatch):
    measured = []
    names = [f"player number {i:05d}" for i in range(400)]
    frame = spark.createDataFrame([("", n) for n in names], "block string, folded string")
    original = joins.stage
    monkeypatch.setattr(joins, "stage", lambda df, label, *a: measured.append((label, original(df, label, *a))) or measured[-1][1])
    short = frame.select("block", F.expr("substring(folded, 1, 16) || substring(folded, 18)").alias("folded"))
    found = joins._closest_names(short, frame, 2)
    assert found.count() == short.distinct().count() == 100
    left, right = ([x for label, x in measured if label == f"keys-{side}"][0] for side in ("left", "right"))
    assert left.join(right, "key").select("folded", "match").distinct().count() < 400 * 100


def test_names_that_share_words(spark):
    left = spark.createDataFrame([("Luz Sávio",), ("Jose da Silva Santos",), ("Luz",), ("Nobody",)], "n string")
    right = spark.createDataFrame([(1, "Sávio Godinho Luz"), (2, "Santos Silva"), (3, "Luz Beta"), (4, "Luz Alfa")], "rid int, name string")
    found = joins.approx_name_join(left, right, "n", "name", "rid", None, 1, "left", shared_words=True)
    assert {r["n"]: (r["match_id"], r["distance"]) for r in found.collect()} == {
        "Luz Sávio": (1, 1), "Jose da Silva Santos": (2, 2), "Luz": (4, 1), "Nobody": (None, None)}


def test_one_to_many_keeps_every_transfer(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "player string, m int")
    right = spark.createDataFrame([("a", 2020, 5.0), ("a", 2021, 0.0), ("c", 2020, 1.0)], "player string, year int, fee double")
    got = sorted((r["player"], r["fee"], r["is_latest"]) for r in joins.one_to_many(left, right, "player", ["year"]).collect())
    assert got == [("a", 0.0, True), ("a", 5.0, False)]
    assert joins.one_to_many(left, right, "player").count() == 2
    assert joins.inner_match(left, right, ["player"]).count() == 2
