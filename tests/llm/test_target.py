"""Decontamination, whitening and resampling: against SQL on the driver's tables, against brute force on odd rows."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from statlab.llm.alnum import ALNUM, joined_crc, lower_bytes, with_space, word_crcs, words_of
from statlab.llm.decontamination import contamination, phrase_matches, positional_index, proximity_matches, test_windows as windows_of
from statlab.llm.resampling import importance_resample, nth_lowest
from statlab.llm.target_oracle import SQL
from statlab.llm.target_queries import QUERIES
from statlab.llm.whitening import one_sided_jacobi, pivoted_cholesky, whitened
from statlab.session import stage
from tests.llm.test_queries import rows

FOLDER = os.environ.get("STATLAB_TEST_SF", "/root/testdata/sf0.01")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(ALNUM, (text or "").translate(LOWER))


def test_all_are_registered():
    assert [k.split("_")[0] for k in QUERIES] == ["op11", "op12", "op13"]
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows(frame.columns, map(tuple, frame.collect())) == rows(columns, result.fetchall())


def test_checksums_of_runs():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abzAZ09 é日.-\n\x7f_") for _ in range(rng.randint(0, 200))) for _ in range(100)]
    texts += ["x" * n for n in (63, 64, 65, 127, 128, 129, 5000)] + ["", "a", "q" * 70 + " " + "r" * 200 + " s"]
    data = [t.encode() for t in texts]
    lower = lower_bytes(np.frombuffer(b"".join(data), dtype=np.uint8))
    starts, ends, first = words_of(lower, np.concatenate([[0], np.cumsum([len(d) for d in data])]))
    crcs = word_crcs(lower, starts, ends)
    for i, t in enumerate(texts):
        w, a, b = tokens(t), first[i], first[i + 1]
        assert [int(x) for x in crcs[a:b]] == [zlib.crc32(x.encode()) for x in w]
        if b - a > 1:
            pairs = joined_crc(with_space(crcs[a:b - 1]), crcs[a + 1:b], (ends - starts)[a + 1:b])
            assert [int(x) for x in pairs] == [zlib.crc32(f"{x} {y}".encode()) for x, y in zip(w, w[1:])]


# Decontamination

def hits(text, items, length=10):
    w, hit, met = tokens(text), set(), set()
    for item, words in items:
        n = min(len(words), length)
        cuts = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i:i + n]) in cuts:
                hit |= set(range(i, i + n))
                met.add(item)
    listed = sorted(str(m) for m in met if m is not None)
    return len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)


ITEMS = "item_id long, text string, tid string, wid string, n int"


def made_items(odd_rows):
    long_ = [t for _, t, *_ in odd_rows if t and len(t.split()) > 30]
    items = [(3, long_[0]), (11, long_[1].upper()), (2, " ".join(long_[2].split()[3:16])), (40, "word"), (41, "two, words!"), (None, " ".join(long_[3].split()[:12])),
             (5, ""), (6, None), (7, "nowhere to be found in any of them ever"), (3, "x" * 300), (8, "日本語"), (9, "the " * 30)]
    return [(*i, "t", "w", 1) for i in items]


def test_contamination_of_odd_documents(spark, odd, odd_rows):
    items = made_items(odd_rows)
    found = contamination(odd, spark.createDataFrame(items, ITEMS)).collect()
    known = [(i[0], tokens(i[1])) for i in items]
    got = sorted((str(r["doc_id"]), *r[1:]) for r in found)
    assert got == sorted((str(r[0]), *hits(r[1], known)) for r in odd_rows)
    assert sum(r[-1] for r in got) > 5


def test_a_common_passage_in_many_copies(spark):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(25)] + ["the"] * 14
    texts = []
    for i in range(300):
        own = [rng.choice(["the", "of", "p1", "p2", f"u{i}"]) for _ in range(20)]
        cut = rng.randrange(20)
        texts.append(" ".join(own[:cut] + passage[: rng.choice([9, 10, 39])] + own[cut:]))
    texts += [texts[0]] * 100
    docs = [(i // 2, t) for i, t in enumerate(texts)]
    items = [(1, " ".join(passage)), (2, "of the"), (3, "the")]
    found = contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string")).collect()
    known = [(i, tokens(t)) for i, t in items]
    assert sorted(map(tuple, found)) == sorted((i, *hits(t, known)) for i, t in docs)


def test_phrases_and_proximity_by_brute_force(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(0, 60)))) for i in range(120)]
    items = [(i, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 4)))) for i in range(30)]
    terms, phrases, _ = windows_of(spark.createDataFrame(items, "item_id long, text string"))
    index = positional_index(spark.createDataFrame(docs, "doc_id long, text string"), terms)
    word = {r["term"]: r["word"] for r in terms.collect()}
    named = {r["wid"]: [word[t] for t in r["terms"]] for r in phrases.collect()}
    known = {tuple(r["tid"]): {} for r in index.select("tid").distinct().collect()}
    for r in index.where("term <> -1").collect():
        known[tuple(r["tid"])][r["pos"]] = word[r["term"]]

    exact = {(tuple(r["tid"]), r["start"], r["wid"]) for r in phrase_matches(index, phrases).collect()}
    assert exact == {(t, s, p) for t, held in known.items() for p, w in named.items() for s in range(60) if [held.get(s + k) for k in range(len(w))] == w}
    for slack in (0, 3):
        near = {(tuple(r["tid"]), r["wid"]) for r in proximity_matches(index, phrases, slack).collect()}
        assert near == {(t, p) for t, held in known.items() for p, w in named.items()
                        if any({held.get(s + k) for k in range(len(w) + slack)} >= set(w) for s in range(60))}


def test_contamination_of_nothing(spark, odd, odd_rows, none):
    empty = spark.createDataFrame([], ITEMS)
    assert contamination(none, spark.createDataFrame(made_items(odd_rows), ITEMS)).collect() == []
    found = contamination(odd, empty).collect()
    assert len(found) == len(odd_rows) and not any(r["contaminated"] or r["n_hit"] or r["n_items"] for r in found)


# Resampling

def features(words):
    return [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def resampled(docs, target, percent=5, shortest=20, buckets=10000, seed=42):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = Counter(bucket(f) for _, t in docs for f in features(tokens(t)))
    g = Counter(bucket(f) for _, t in target for f in features(tokens(t)))
    sn, gn = sum(s.values()) + buckets, sum(g.values()) + buckets
    out = []
    for i, t in docs:
        f = features(tokens(t))
        weight = sum(math.floor(1000 * math.log((g[bucket(x)] + 1) * sn / ((s[bucket(x)] + 1) * gn))) for x in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(tokens(t))])
    able = sorted((o for o in out if o[4] >= shortest), key=lambda o: (-o[3], o[0] is None, o[0]))
    drawn = able[: len(able) * percent // 100]
    return out, [(o[0], o[3], k + 1) for k, o in enumerate(drawn)]


@pytest.mark.parametrize("percent, buckets", [(5, 10000), (37, 16), (100, 10000), (0, 10)])
def test_resampling_of_odd_documents(spark, odd, odd_rows, percent, buckets):
    target = [(1, odd_rows[5][1], "a"), (2, None, "b"), (3, "", "c"), (4, "the of and " * 9, "d")]
    found = importance_resample(odd, spark.createDataFrame(target, "item_id long, text string, score string"), percent, buckets=buckets).collect()
    out, drawn = resampled([r[:2] for r in odd_rows], [t[:2] for t in target], percent, buckets=buckets)
    assert sorted(str((r["doc_id"], r["n_features"], r["weight"], r["score"], r["n_words"])) for r in found) == sorted(str(tuple(o)) for o in out)
    assert sorted(((r["doc_id"], r["score"], r["rank"]) for r in found if r["rank"]), key=lambda r: r[2]) == drawn


def test_ties_at_the_cutoff(spark):
    """A third of all rows are one row, and many ids share a score."""
    text = "some words that are the same in every one of these documents so that only noise tells them apart here now"
    docs = [(7, text)] * 200 + [(None, text)] * 60 + [(i % 50, text) for i in range(340)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    for percent in (3, 20, 33, 60, 97):
        found = importance_resample(frame, spark.createDataFrame([(1, "some words")], "item_id long, text string"), percent).collect()
        _, drawn = resampled(docs, [(1, "some words")], percent)
        assert len(found) == len(docs)
        assert sorted(((r["doc_id"], r["score"], r["rank"]) for r in found if r["rank"]), key=lambda r: r[2]) == drawn


def test_the_nth_lowest(spark):
    rng = random.Random(8)
    values = [rng.choice([5, -(1 << 63), (1 << 63) - 1, rng.randrange(-10**6, 10**6)]) for _ in range(500)]
    frame = stage(spark.createDataFrame([(v,) for v in values], "v long"), "values")
    for need in (1, 2, 120, 250, 499, 500):
        v = sorted(values)[need - 1]
        assert nth_lowest(frame, "v", need) == (v, sum(x < v for x in values))


def test_resampling_of_nothing(spark, odd, odd_rows, none):
    target = spark.createDataFrame([], "item_id long, text string")
    assert importance_resample(none, target).collect() == []
    assert len(importance_resample(odd, target).collect()) == len(odd_rows)


# Whitening

VECTORS = "vec_id long, embedding array<float>, label int, x string, n int, component string"


def brute(vectors, k=16):
    known = [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in known}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array([[float(v * n - s) / n for v, s in zip(row, sums)] for row in fit])
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    order = [o for o in np.argsort(-values) if values[o] > 1e-9 * values.max()][:k]
    out = {}
    for i, x in known:
        c = np.array([float(v * n - s) / n for v, s in zip(x, sums)])
        out.setdefault(i, (sum((v * n - s) ** 2 for v, s in zip(x, sums)), c @ vectors_[:, order] / np.sqrt(values[order])))
    return n, values[order] / values.sum(), out, known


def check_whitened(found, vectors):
    n, explained, want, known = brute(vectors)
    k = len(explained)
    assert len(found) == k * len(known)
    by = {}
    for r in found:
        assert r["n"] == n and r["deviation"] == want[r["vec_id"]][0] and r["identity_error"] < 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
        by.setdefault(r["vec_id"], {})[r["component"]] = r["whitened"]
    ids = sorted(by, key=str)
    got = np.array([[by[i][c + 1] for c in range(k)] for i in ids])
    expected = np.array([want[i][1] for i in ids])
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max(initial=0) < 1e-6


def test_whitening_of_the_table(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = QUERIES["op12_embedding_whitening"](spark, FOLDER).collect()
    check_whitened(found, vectors)


def test_whitening_of_odd_vectors(spark):
    rng = random.Random(6)
    vectors = [(i, [rng.gauss(0, 1 + d) for d in range(6)]) for i in range(60)]
    vectors += [(100 + i, vectors[3][1]) for i in range(50)] + [(None, vectors[4][1]), (3, vectors[3][1])]
    wrong = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (203, [math.nan] * 6), (204, [math.inf] + [0.0] * 5), (205, [-math.inf] + [0.0] * 5)]
    frame = spark.createDataFrame([(*v, 1, "x", 1, "c") for v in vectors + wrong + [(206, [1.0, 2.0])]], VECTORS).repartition(4)
    check_whitened(whitened(frame).collect(), vectors + wrong)


def test_vectors_in_fewer_dimensions(spark):
    rng = random.Random(7)
    vectors = [(i, [a := rng.randrange(-40, 40) / 4, rng.randrange(-9, 9) / 4, a, 0.5]) for i in range(50)]
    found = whitened(spark.createDataFrame([(*v, 1, "x", 1, "c") for v in vectors], VECTORS)).collect()
    assert {r["component"] for r in found} == {1, 2}
    check_whitened(found, vectors)


def test_huge_entries_do_not_crash(spark):
    vectors = [(i, [1e30 * (i % 3), float(i), 3e37 * (-1) ** i]) for i in range(9)]
    found = whitened(spark.createDataFrame([(*v, 1, "x", 1, "c") for v in vectors], VECTORS)).collect()
    assert {r["vec_id"] for r in found} == set(range(9)) and all(math.isfinite(r["whitened"]) for r in found)


def test_whitening_of_nothing(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert whitened(frame).collect() == []
    assert whitened(spark.createDataFrame([(1, [1.0, 2.0], 1, "x", 1, "c")] * 3, VECTORS)).collect() == []


def test_factors():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(20, 9)) @ rng.normal(size=(9, 12)) + 1000
    c = np.cov(a, rowvar=False)
    factor = pivoted_cholesky(c)
    assert factor.shape == (12, 9) and np.abs(factor @ factor.T - c).max() < 1e-9
    turned = one_sided_jacobi(factor)
    values = np.linalg.eigvalsh(c)[::-1]
    assert np.abs((turned**2).sum(axis=0) - values[:9]).max() < 1e-9 * values[0]
