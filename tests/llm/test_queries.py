"""The registered queries on the driver's tables: against SQL, against the tokenizers library, on held-out rows."""

import os
from collections import defaultdict

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from statlab.llm.bpe import tokenizer_file
from statlab.llm.oracle import SQL
from statlab.llm.queries import QUERIES

FOLDER = os.environ.get("STATLAB_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in data)


def test_all_are_registered():
    known = contract.queries()
    assert [k.split("_")[0] for k in QUERIES] == [f"op{n}" for n in range(1, 11)]
    assert set(QUERIES) <= set(known) and known["pipeline"] is corpus_pipeline.run and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    result = db.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows(frame.columns, map(tuple, frame.collect())) == rows(columns, result.fetchall())


def test_held_out_languages_and_quality(spark, db):
    lang = {r["doc_id"]: r for r in QUERIES["op5_language_id"](spark, FOLDER).collect()}
    right = [lang[i]["lang_pred"] == known for i, known in db.execute("SELECT doc_id, lang FROM documents").fetchall() if lang[i]["held_out"]]
    assert sum(right) / len(right) > 0.98
    good = {r["doc_id"]: r for r in QUERIES["op9_quality"](spark, FOLDER).collect()}
    right = [good[i]["predicted"] == q for i, q in db.execute("SELECT doc_id, quality FROM labels").fetchall() if good[i]["held_out"]]
    assert sum(right) / len(right) > 0.93


def test_pipeline_stage_by_stage(spark, db):
    """Each stage against brute force on its own input."""
    import hashlib

    from tokenizers import Tokenizer

    from statlab.session import stage
    from tests.llm.test_ngram_join import shingles
    from tests.llm.test_texts import distance

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id < 150")
    columns, seen = docs.columns, []
    for name, function in corpus_pipeline.STAGES:
        before = sorted(map(tuple, docs.collect()))
        docs = stage(function(spark, docs, FOLDER), name)
        seen.append((name, before, sorted(map(tuple, docs.collect()))))
        assert docs.columns == columns or name == "bpe"
    steps = {name: (before, after) for name, before, after in seen}

    before, after = steps["language_id"]
    assert len(after) > 0.98 * len(before) and set(after) <= set(before)

    before, after = steps["line_dedup"]
    first = {}
    for r in before:
        for n, line in enumerate(r[1].split("\n")):
            if len(line) >= 80:
                first.setdefault(line, (r[0], n))
    lines = sorted(first, key=first.get)
    later = {b for k, b in enumerate(lines) for a in lines[:k] if abs(len(a) - len(b)) <= 2 and near(a, b, distance)}
    want = {}
    for r in before:
        kept = [x for n, x in enumerate(r[1].split("\n")) if len(x) < 80 or (first[x] == (r[0], n) and x not in later)]
        if len(kept) == len(r[1].split("\n")) or "\n".join(kept).strip():
            want[r[0]] = "\n".join(kept)
    assert {r[0]: r[1] for r in after} == want

    before, after = steps["ngram_jaccard"]
    sets = {r[0]: shingles(r[1]) for r in before}
    parent = dict.fromkeys(sets)
    for i in sorted(sets):
        linked = [j for j in sorted(sets) if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
        parent[i] = min([i, *(parent[j] for j in linked)])
    assert {r[0] for r in after} == {i for i, p in parent.items() if p == i}

    before, after = steps["source_mixing"]
    assert set(after) <= set(before) and max(after.count(r) for r in set(after)) <= 3
    size, taken = defaultdict(int), defaultdict(int)
    for r in before:
        size[r[3]] += len(r[1].split())
    for r in after:
        taken[r[3]] += len(r[1].split())
    assert 0.9 < sum(taken.values()) / sum(size.values()) < 1.1

    before, after = steps["bpe"]
    known = Tokenizer.from_str(tokenizer_file())
    ids = [(r[0], known.encode(r[1], add_special_tokens=False).ids) for r in before]
    assert sorted((i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()) for i, x in ids) == sorted(r[:3] for r in after)


def near(a, b, distance):
    """Within two edits; the common beginning and end are cut off first."""
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    return min(len(a), len(b)) < 30 and distance(a, b) <= 2
