"""Joins along time, ordered windows and streams: against SQL on the tables, against brute force on odd rows."""

import bisect
import os
import random
from collections import Counter
from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from statlab.operators import intervals, ordered, theta
from statlab.operators.asof import asof_join
from statlab.operators.ranges import MOST_BOUNDS, quantile_bounds, range_of, ticks
from statlab.operators.ranges import ordered as in_ranges
from statlab.plans.time_queries import QUERIES
from statlab.plans.time_sql import SQL
from statlab.streaming import state, windows
from tests.test_oracle import FOLDER, rows


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in "supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    for word in ("CartesianProduct", "NestedLoop", "SinglePartition"):
        assert word not in plan(frame)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows(frame.columns, frame.collect()) == rows(columns, result.fetchall())


# Ranges

def test_ticks_of_all_kinds(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        at = datetime(2024, 3, 10, 2, 30, 15, 123456)  # an hour that New York does not have
        frame = spark.createDataFrame([(at, date(1969, 12, 31), 1.5, 7)], "a timestamp_ntz, b date, c double, d int")
        got = tuple(frame.select(*[ticks(frame, c) for c in frame.columns]).first())
        assert got == ((at - datetime(1970, 1, 1)) // timedelta(microseconds=1), -86_400_000_000, 1.5, 7)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_range_of_many_bounds(spark):
    bounds = [-50, -3, *range(0, 3000, 7)]
    values = list(range(-60, 3100, 3))
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    assert [r[0] for r in frame.select(range_of(F.col("v"), bounds, "bigint")).collect()] == [bisect.bisect_right(bounds, v) for v in values]
    assert frame.select(range_of(F.col("v"), [], "bigint").alias("r")).distinct().collect() == [(0,)]
    assert quantile_bounds(frame.where("false"), "v", 10) == [] and len(quantile_bounds(frame, "v", 10 * MOST_BOUNDS)) <= MOST_BOUNDS


# As-of join

def brute_asof(left, right, forward, equal, tolerance):
    out = []
    for i, k, t in left:
        best = None
        for j, rk, rt in right:
            if k is None or t is None or rk != k or rt is None or (rt == t and not equal) or (rt < t if forward else rt > t):
                continue
            if best is None or ((rt, j) < best if forward else (rt, j) > best):
                best = (rt, j)
        if best and tolerance is not None and abs(best[0] - t) > tolerance:
            best = None
        out.append((i, best[1] if best else None))
    return sorted(out)


@pytest.fixture(scope="module")
def odd_times():
    rng = random.Random(3)

    def some(n, base):
        return [(base + i, rng.choice([1, 1, 1, 2, 3, None]), rng.choice([None, 40, *range(0, 100)])) for i in range(n)]

    left, right = some(300, 0), some(120, 1000)
    left += [(5000 + i, 1, 50) for i in range(200)]  # one key and time
    right += [(3000, 9, 1), (3001, 1, 40), (3002, 1, 40)]
    return left, right


@pytest.mark.parametrize("forward, equal, tolerance", [(False, True, None), (False, False, 3), (True, True, 2), (True, False, None)])
def test_asof_by_brute_force(spark, odd_times, forward, equal, tolerance):
    left, right = odd_times
    l = spark.createDataFrame(left, "id long, k int, t long").repartition(5)
    r = spark.createDataFrame(right, "id long, k int, t long").repartition(3)
    met = asof_join(l, r, "t", "t", ["k"], tie=["id"], direction="forward" if forward else "backward", allow_equal=equal,
                    tolerance=tolerance, rows_per_range=40, hot_rows=20)
    assert met.columns == ["id", "k", "t", "right_id", "right_k", "right_t"]
    assert sorted(((x["id"], x["right_id"]) for x in met.collect())) == brute_asof(left, right, forward, equal, tolerance)


def test_asof_inner_without_key_and_of_nothing(spark, odd_times):
    left, right = ([(i, 1, t) for i, _, t in side] for side in odd_times)
    l, r = (spark.createDataFrame(side, "id long, k int, t long") for side in (left, right))
    met = asof_join(l, r, "t", "t", tie=["id"], how="inner", rows_per_range=30)
    assert sorted((x["id"], x["right_id"]) for x in met.collect()) == [x for x in brute_asof(left, right, False, True, None) if x[1] is not None]
    assert asof_join(l.where("false"), r, "t", "t").collect() == []
    assert {x["right_id"] for x in asof_join(l, r.where("false"), "t", "t").collect()} == {None}


def test_asof_of_timestamps_with_columns_that_clash(spark):
    day = datetime(2024, 1, 1)
    l = spark.createDataFrame([(1, day, "a", 5), (2, day + timedelta(hours=5), "b", 6)], "r long, when_ timestamp, l string, _t int")
    r = spark.createDataFrame([(10, day - timedelta(hours=1), "x"), (11, day + timedelta(hours=1), "y")], "l long, _span timestamp, edge string")
    met = asof_join(l, r, "when_", "_span", tolerance=2 * 3600 * 10**6)
    assert sorted((x["r"], x["l"], x["_t"], x["right_edge"]) for x in met.collect()) == [(1, "a", 5, "x"), (2, "b", 6, None)]


# Points and intervals

@pytest.fixture(scope="module")
def spans():
    rng = random.Random(9)
    made = [(i, rng.choice([1, 2, None]), a := rng.choice([None, *range(200)]), None if a is None else a + rng.choice([0, 0, 1, 5, -2, 30])) for i in range(150)]
    return made + [(900, 1, 0, 100_000), (901, 2, -10, 60), (902, 1, 77, None)] + [(1000 + i, 1, 50, 55) for i in range(60)]


def test_points_in_spans(spark, spans):
    rng = random.Random(10)
    points = [(i, rng.choice([1, 2, None]), rng.choice([None, 52, 10**6, *range(-5, 250)])) for i in range(400)]
    p = spark.createDataFrame(points, "id long, k int, t long").repartition(4)
    s = spark.createDataFrame(spans, "id long, k int, a long, b long").repartition(3)
    for by in ([("k", "k")], []):
        met = intervals.range_join(p, s, "t", "a", "b", by, rows_per_bin=7)
        want = [(i, j) for i, k, t in points for j, q, a, b in spans
                if t is not None and a is not None and b is not None and a <= t <= b and (not by or (k is not None and k == q))]
        assert sorted((x["id"], x["span_id"]) for x in met.collect()) == sorted(want)


def test_spans_that_overlap(spark, spans):
    s = spark.createDataFrame(spans, "id long, k int, a long, b long").repartition(3)
    for by in ([("k", "k")], []):
        met = intervals.overlap_join(s, s, ("a", "b"), ("a", "b"), by, rows_per_bin=5)
        good = [x for x in spans if x[2] is not None and x[3] is not None and x[2] <= x[3]]
        want = [(x[0], y[0]) for x in good for y in good if x[2] <= y[3] and y[2] <= x[3] and (not by or (x[1] is not None and x[1] == y[1]))]
        assert sorted((x["id"], x["right_id"]) for x in met.collect()) == sorted(want)
    assert intervals.overlap_join(s.where("false"), s, ("a", "b"), ("a", "b")).collect() == []


def test_sums_of_points_in_spans(spark, spans):
    """They are those of the pairs, from rows that do not grow with the points of a span."""
    rng = random.Random(11)
    points = [(i, rng.choice([1, 2, None]), rng.choice([None, 52, 10**6, *range(-5, 250)]), rng.choice([None, i / 4])) for i in range(3000)]
    p = spark.createDataFrame(points, "id long, k int, t long, v double").repartition(4)
    s = spark.createDataFrame(spans, "id long, k int, a long, b long").repartition(3)
    sums = {"n": ("count", "*"), "n_v": ("count", "v"), "v": ("sum", "v"), "most": ("max", "v")}
    for by in ([("k", "k")], []):
        met = intervals.range_join(p, s, "t", "a", "b", by, rows_per_bin=3, sums=sums)
        assert met.columns == ["n", "n_v", "v", "most", "span_id", "span_k", "span_a", "span_b"]
        found = met.groupBy("span_id").agg(F.sum("n"), F.sum("n_v"), F.sum("v"), F.max("most"), F.count("*")).collect()
        want = {}
        for j, q, a, b in spans:
            held = [v for i, k, t, v in points if None not in (t, a, b) and a <= t <= b and (not by or (k is not None and k == q))]
            known = [v for v in held if v is not None]
            if held:
                want[j] = (len(held), len(known), sum(known) if known else None, max(known, default=None))
        assert {r[0]: tuple(r)[1:5] for r in found} == want
        assert max(r[5] for r in found) <= 2 * 3 * 4 + 12 < max(n for n, *_ in want.values()) // 10
    assert intervals.range_join(p.where("false"), s, "t", "a", "b", sums=sums).collect() == []


def test_keys_with_few_rows_need_no_bins(spark, monkeypatch):
    """Only points of keys with more than a bin's rows are put in bins; the pairs are all there."""
    rng, binned = random.Random(12), []
    made = [(i, i // 4 if i < 400 else -1, a := rng.randrange(50), a + rng.choice([0, 3, 900])) for i in range(460)]
    s = spark.createDataFrame(made, "id long, k int, a long, b long").repartition(3)
    in_bins = intervals._in_bins
    monkeypatch.setattr(intervals, "_in_bins", lambda points, *more: binned.append(points.count()) or in_bins(points, *more))
    met = intervals.overlap_join(s, s, ("a", "b"), ("a", "b"), [("k", "k")], rows_per_bin=20)
    want = [(x[0], y[0]) for x in made for y in made if x[1] == y[1] and x[2] <= y[3] and y[2] <= x[3]]
    assert sorted((x["id"], x["right_id"]) for x in met.collect()) == sorted(want) and binned == [60, 60]


def test_a_long_span_is_a_few_rows(spark):
    """It is in a logarithmic number of bins, and the bins make it up without a gap."""
    frame = spark.createDataFrame([(0, 65535), (1, 65534), (17, 17), (5, 4000), (4096, 8191)], "a long, b long")
    found = frame.select("a", "b", intervals._covering(F.col("a"), F.col("b"), 4).alias("c")).collect()
    for r in found:
        held = sorted(x for c in r["c"] for x in range(c["bin"] * 16 ** c["level"], (c["bin"] + 1) * 16 ** c["level"]))
        assert held == list(range(r["a"], r["b"] + 1)) and len(r["c"]) <= 2 * 15 * 4


# Two inequalities

OPS = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}


@pytest.mark.parametrize("one, two", [("<", ">"), ("<=", "<="), (">", ">="), (">=", "<")])
def test_theta_by_brute_force(spark, one, two):
    rng = random.Random(4)

    def some(n):
        return [(i, rng.choice([None, 5, 5, rng.randrange(40)]), rng.choice([None, 1.5, rng.random() * 10])) for i in range(n)]

    left, right = some(150) + [(500, 5, 1.5)] * 30, some(90)
    l = spark.createDataFrame(left, "id long, x int, y double").repartition(3)
    r = spark.createDataFrame(right, "id long, x int, y double")
    met = theta.theta_join(l, r, ("x", one, "x"), ("y", two, "y"), rows_per_block=6)
    want = [(i, j) for i, x, y in left for j, u, v in right if None not in (x, y, u, v) and OPS[one](x, u) and OPS[two](y, v)]
    assert sorted((a["id"], a["right_id"]) for a in met.collect()) == sorted(want)
    for word in ("CartesianProduct", "NestedLoop"):
        assert word not in plan(met)
    assert theta.theta_join(l.where("false"), r, ("x", one, "x"), ("y", two, "y")).collect() == []


def test_blocks_that_cannot_match_are_not_visited(spark):
    """Rows that nearly satisfy both conditions along one line: only blocks near the line are compared."""
    n = 4000
    l = spark.range(n).select("id", F.col("id").alias("x"), (F.col("id") * 2).alias("y"))
    r = l.select("id", (F.col("x") - 3).alias("x"), (F.col("y") + 3).alias("y"))  # r.x > l.x needs a later row, r.y < l.y an earlier one
    join = theta.ThetaJoin(l, r, ("x", "<", "x"), ("y", ">", "y"), rows_per_block=20)
    blocks = join.left.select(f"b{join.levels}").distinct().count()
    assert join.rows().count() == 0
    assert blocks >= 100 and join.block_pairs.count() <= 3 * blocks


def test_blocks_that_match_as_a_whole_are_not_cut(spark):
    """Half of all pairs match; the pairs of blocks are far fewer than the pairs of smallest blocks."""
    n = 4000
    l = spark.range(n).select("id", ((F.col("id") * 7919) % n).alias("x"), ((F.col("id") * 104_729) % n).alias("y"))
    join = theta.ThetaJoin(l, l, ("x", "<", "x"), ("y", ">", "y"), rows_per_block=2)
    rows = {i: (i * 7919 % n, i * 104_729 % n) for i in range(n)}
    by_x = sorted(rows.values())
    seen, want = [], 0
    for _, y in by_x:
        want += len(seen) - bisect.bisect_right(seen, y)
        bisect.insort(seen, y)
    assert join.rows().count() == want > n * n // 8
    assert join.block_pairs.count() < 16**4
    odd = join.rows().where("NOT (x < right_x AND y > right_y)")
    assert odd.isEmpty()


# Ordered windows

@pytest.fixture(scope="module")
def listed(spark):
    rng = random.Random(12)
    made = [(i, rng.choice([3, 3, None, rng.randrange(20)]), None if rng.random() < 0.2 else rng.randrange(-50, 50)) for i in range(400)]
    return made, spark.createDataFrame(made, "id long, v int, w int").repartition(6)


def test_running_and_neighbours(listed):
    made, frame = listed
    order = in_ranges(frame, [F.desc("id")], rows_per_range=30)
    assert len([1 for a, b in zip(order.starts, order.starts[1:]) if b > a]) > 4
    got = {r["id"]: r for r in ordered.running(order, {"s": ("sum", "w"), "n": ("count", "w"), "lo": ("min", "w"), "hi": ("max", "w")}).collect()}
    around = {r["id"]: r for r in ordered.framed(order, {"m": F.sum("w"), "k": F.count("*")}, 90, 2).collect()}
    ahead = {r["id"]: r for r in ordered.framed(order, {"m": F.max("w")}, -5, 70).collect()}
    near = {r["id"]: r for r in ordered.neighbours(order, {"a": ("w", 1), "b": ("id", 130), "c": ("w", -3), "d": ("id", 0), "e": ("id", 999)}).collect()}
    by = sorted(made, reverse=True)
    for p, (i, _, w) in enumerate(by):
        seen = [x[2] for x in by[:p + 1] if x[2] is not None]
        assert tuple(got[i][c] for c in ("s", "n", "lo", "hi")) == (sum(seen) if seen else None, len(seen), min(seen, default=None), max(seen, default=None))
        part = by[max(0, p - 90):p + 3]
        held = [x[2] for x in part if x[2] is not None]
        assert (around[i]["m"], around[i]["k"]) == (sum(held) if held else None, len(part))
        assert ahead[i]["m"] == max((x[2] for x in by[p + 5:p + 71] if x[2] is not None), default=None)
        at = lambda q, c: by[q][c] if 0 <= q < len(by) else None
        assert tuple(near[i][c] for c in "abcde") == (at(p - 1, 2), at(p - 130, 0), at(p + 3, 2), i, None)


def test_ranks_with_a_value_on_a_third_of_the_rows(listed):
    made, frame = listed
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, v INTEGER, w INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", made)
    found = ordered.ranks(in_ranges(frame, [F.asc_nulls_last("v")], rows_per_range=25), ["v"], 7)
    names = ["id", "rank", "dense_rank", "percent_rank", "cume_dist"]
    want = con.execute("SELECT id, rank() OVER w, dense_rank() OVER w, percent_rank() OVER w, cume_dist() OVER w FROM t WINDOW w AS (ORDER BY v NULLS LAST)").fetchall()
    got = found.collect()
    assert sorted(tuple(round(r[c], 12) for c in names) for r in got) == sorted(tuple(round(x, 12) for x in r) for r in want)
    assert sorted(r["row_number"] for r in got) == list(range(1, 401))
    assert Counter(r["ntile"] for r in got) == Counter(r[0] for r in con.execute("SELECT ntile(7) OVER (ORDER BY v) FROM t").fetchall())
    assert "SinglePartition" not in plan(found)


def test_windows_over_nothing_and_over_one_row(spark):
    for n in (0, 1):
        order = in_ranges(spark.range(n).withColumn("v", F.lit(2.0)), ["id"])
        assert order.n == n
        assert [r["s"] for r in ordered.running(order, {"s": ("sum", "v")}).collect()] == [2.0] * n
        assert [r["a"] for r in ordered.neighbours(order, {"a": ("v", 1)}).collect()] == [None] * n
        assert [(r["rank"], r["percent_rank"], r["cume_dist"], r["ntile"]) for r in ordered.ranks(order, ["v"]).collect()] == [(1, 0.0, 1.0, 1)] * n


# Streams

START = datetime(2024, 5, 1)
SCHEMA = "event_id long, ts timestamp, user_id long, kind string, value double"


def write(spark, folder, number, minutes):
    made = [(number * 1000 + i, None if m is None else START + timedelta(minutes=m), u, "k", 1.0) for i, (m, u) in enumerate(minutes)]
    path = os.path.join(folder, f"{number}.parquet")
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.parquet(path)
    os.utime(path, (number, number))
    return made


def opened(spark, folder):
    return windows.read_stream(spark, f"{folder}/*.parquet", spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def test_late_rows(spark, tmp_path):
    """Within the watermark a late row counts, beyond it it is dropped. A batch moves the watermark of the next one,
    which hands windows on; the one after that drops rows that belong to them."""
    write(spark, tmp_path, 1, [(5, 1), (65, 1), (None, 1)])
    write(spark, tmp_path, 2, [(50, 1)])  # behind 65 by less than is allowed
    write(spark, tmp_path, 3, [(300, 1)])  # the watermark goes to 225
    write(spark, tmp_path, 4, [(301, 1)])
    write(spark, tmp_path, 5, [(55, 1), (170, 1), (230, 1)])  # 55 and 170 are in windows that were handed on
    write(spark, tmp_path, 6, [(900, 1)])
    result = windows.windowed(opened(spark, tmp_path), "ts", "75 minutes", [F.count("*").alias("n")], width="1 hour")
    found = windows.finished(result, "late").collect()
    at = {(r["start"] - START) // timedelta(minutes=60): r["n"] for r in found}
    assert at == {0: 2, 1: 1, 3: 1, 5: 2}


def test_windows_on_tables_are_those_on_streams(spark, tmp_path):
    made = write(spark, tmp_path, 1, [(m * 7 % 600, m % 3) for m in range(200)] + [(5000, 1)])
    table = spark.createDataFrame(made, SCHEMA)
    for kind in ({"width": "1 hour"}, {"width": "1 hour", "slide": "20 minutes"}, {"gap": "25 minutes"}):
        counts = [F.count("*").alias("n"), F.sum("value").alias("v")]
        batch = windows.windowed(table, "ts", "1 hour", counts, ["user_id"], **kind).where(F.col("end") < START + timedelta(minutes=4000))
        stream = windows.finished(windows.windowed(opened(spark, tmp_path), "ts", "1 hour", counts, ["user_id"], **kind), "same")
        assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect())) != []


def stopped_and_resumed(spark, tmp_path, make):
    """What a stream gives that is run three times while files come, and what another gives that finds all of them."""
    rng = random.Random(2)
    once, path, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    os.mkdir(once)
    for k in range(6):
        write(spark, once, k, [(k * 100 + rng.randrange(100), rng.randrange(4)) for _ in range(60)] + ([(None, 1), (k * 100 + 50, None)] if k == 2 else []))
        if k % 2:
            windows.run_available(make(opened(spark, once)), path, checkpoint)
    several = sorted(map(tuple, spark.read.parquet(path).collect()))
    windows.run_available(make(opened(spark, once)), path, checkpoint)  # nothing new: nothing twice
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == several
    whole = sorted(map(tuple, windows.finished(make(opened(spark, once)), "whole").collect()))
    known = [r for k in range(6) for r in spark.read.parquet(f"{once}/{k}.parquet").collect()]
    return several, whole, known


def micro(t):
    return (t - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def test_repeats_after_a_stop(spark, tmp_path):
    several, whole, known = stopped_and_resumed(
        spark, tmp_path, lambda s: state.drop_repeats(s, "user_id", "ts", "event_id", 1800, "10 minutes"))
    want, last = [], {}
    for r in sorted((r for r in known if r["ts"] and r["user_id"] is not None), key=lambda r: (r["ts"], r["event_id"])):
        if r["user_id"] not in last or r["ts"] - last[r["user_id"]] >= timedelta(seconds=1800):
            last[r["user_id"]] = r["ts"]
            want.append((r["user_id"], r["event_id"], micro(r["ts"])))
    assert several == whole == sorted(want)


def test_visits_after_a_stop(spark, tmp_path):
    several, whole, known = stopped_and_resumed(
        spark, tmp_path, lambda s: state.visits(s, "user_id", "ts", "event_id", "kind", "value", 600, "10 minutes"))
    assert several == whole
    want = []
    for user in range(4):
        times = sorted(r["ts"] for r in known if r["ts"] and r["user_id"] == user)
        cuts = [i for i in range(1, len(times)) if times[i] - times[i - 1] > timedelta(seconds=600)]
        for a, b in zip([0, *cuts], [*cuts, len(times)]):
            want.append((user, micro(times[a]), micro(times[b - 1]), b - a, float(b - a), "k", 0))
    assert set(whole) <= set(want) and len(want) - len(whole) <= 4


def test_streams_of_nothing(spark, tmp_path):
    os.mkdir(tmp_path / "none")
    assert windows.finished(windows.windowed(opened(spark, tmp_path / "none"), "ts", "1 hour", [F.count("*").alias("n")], width="1 hour"), "none").collect() == []
