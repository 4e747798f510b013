import hashlib

from pyspark.sql import functions as F

from statlab.llm import merkle


def in_order(rows):
    return sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0))


def test_edits_and_likeness(odd, odd_rows):
    found = merkle.document_fingerprints(odd).collect()
    assert len(found) == len(odd_rows)
    order = in_order(odd_rows)
    ids = [i for i, _ in order]
    roots = {}
    for r in found:
        if r["doc_id"] is None or ids.count(r["doc_id"]) > 1:
            continue
        k = ids.index(r["doc_id"])
        following = (k + 1) % len(order)
        if ids.count(ids[following]) > 1 or ids[following] is None:
            continue
        text, other = order[k][1], order[following][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (text == edited)
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if text == edited:
            assert r["near_edited"] == 1.0
        roots.setdefault(text, set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in roots.values()) and len({next(iter(x)) for x in roots.values()}) == len(roots)


def test_neighbours_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BINS", 7)
    docs = spark.createDataFrame([(i * i, f"text {i}") for i in range(200)], "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r["next"]["text"] for r in merkle.with_next(docs, ["text"]).collect()}
    assert found == {i * i: f"text {(i + 1) % 200}" for i in range(200)}


def test_differing_branches_locate_edits(spark):
    a = "one, two.\nthree.\n\nfour.\nfive."
    df = spark.createDataFrame([(a, a), (a, a.replace("three", "3")), (a, a + "\nsix."), ("", a)], "a string, b string")
    edits = merkle.differing(merkle.sections(F.col("a")), merkle.sections(F.col("b")))
    found = [[tuple(x) for x in r[0]] for r in df.select(edits).collect()]
    assert found == [[], [(0, 1)], [(1, 2)], [(0, 0), (0, 1), (1, 0), (1, 1)]]


def test_empty_and_single(spark, none):
    assert merkle.document_fingerprints(none).collect() == []
    one = spark.createDataFrame([(5, "ab, cd")], "doc_id long, text string")
    row = merkle.document_fingerprints(one).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"ab,ab,").hexdigest()
