import re

import pytest

from statlab.llm.components import components
from statlab.llm.ngram_join import jaccard_components, keep_one, ngram_jaccard

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)}


def brute(rows, percent=90):
    """(id, size, component) per row; rows with one id are one node."""
    sets = [(r[0], shingles(r[1])) for r in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return sorted((str(i), len(s), None if i is None else root(i) if s else i) for i, s in sets)


def family(rng, words, n):
    """A text and ``n`` edits of it, some of them edits of edits, so that links form chains."""
    made = [words]
    for _ in range(n):
        copy = list(rng.choice(made))
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
        made.append(copy)
    return made


@pytest.fixture(scope="module")
def families():
    import random

    rng, texts = random.Random(2), []
    passage = [f"shared{i}" for i in range(60)]
    for f in range(14):
        own = [f"w{rng.randrange(60)}" for _ in range(rng.choice([12, 40, 90, 150]))]
        texts += family(rng, own + passage * (f % 2), 7)
    texts += family(rng, passage + ["tail"], 40)
    return [(i * 2 + 3, " ".join(t), "x", 1) for i, t in enumerate(texts)]


def test_odd_documents(odd, odd_rows):
    single = [r for r in odd_rows if [x[0] for x in odd_rows].count(r[0]) == 1 or r[0] is None or r[1] == odd_rows[0][1]]
    found = ngram_jaccard(odd).collect()
    assert len(found) == len(odd_rows)
    got = sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in found)
    assert len(single) and got == brute(odd_rows)


@pytest.mark.parametrize("percent", [90, 70])
def test_chains_and_shared_passages(spark, families, percent):
    docs = spark.createDataFrame(families, "doc_id long, text string, token string, n int").repartition(4)
    found = jaccard_components(docs, percent).collect()
    want = brute(families, percent)
    assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in found) == want
    assert len({c for _, _, c in want}) < len(families) * 0.9


def test_one_of_each_group_stays(spark, families):
    docs = spark.createDataFrame(families, "doc_id long, text string, token string, n int")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in brute(families)}


def test_stage_links_four_fifths_of_five_words(spark):
    """Copies with edits of which three words and 90 % miss many."""
    import random

    import corpus_pipeline

    rng, rows = random.Random(6), []
    for f in range(12):
        own = [f"w{rng.randrange(400)}" for _ in range(rng.choice([30, 80, 150]))]
        for k in range(6):
            copy = list(own)
            for _ in range(k):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
            rows.append((f * 10 + k, " ".join(copy)))
    sets = {i: shingles(t, 5) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    kept = corpus_pipeline.ngram_jaccard(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert {r["doc_id"] for r in kept.collect()} == {i for i in sets if root(i) == i} != {c for _, _, c in brute(rows)}


def test_rows_that_share_an_id_are_kept_apart(spark):
    text = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(6)]
    rows = [(1, text[0]), (5, text[0]), (5, text[1]), (7, text[1] + " end"), (None, text[2]), (None, text[2] + " end"), (None, text[3]), (8, text[3]),
            (9, text[4]), (9, text[4]), (None, ""), (None, None), (None, text[5])]
    kept = [tuple(r) for r in keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    first = [r for r in kept if r[1] and r[1].startswith(text[2])]
    assert len(first) == 1 and first[0] in rows[4:6]
    want = [rows[i] for i in (0, 2, 6, 8, 9, 10, 11, 12)] + first
    assert sorted(map(repr, kept)) == sorted(map(repr, want))


def test_empty_table(none):
    assert ngram_jaccard(none).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5000), (70, 60)]
    found = {r["id"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in [*range(61), 70]}, **{1000 + i: 1000 for i in range(50)}}


def test_many_copies_ask_few_questions(spark, monkeypatch):
    """Copies that link with one text and seldom with each other; the pairs compared grow as the copies do. Without
    that text the result is as right, but nothing tells apart copies that nearly link, so all pairs are compared."""
    import random

    from statlab.llm import ngram_join

    asked = []
    compare = ngram_join._jaccard
    monkeypatch.setattr(ngram_join, "_jaccard", lambda pairs, *a: (asked.append(pairs.count()), compare(pairs, *a))[1])
    for n, with_original in ((60, False), (100, True), (200, True), (400, True)):
        rng, asked[:] = random.Random(n), []
        base = [f"w{k}" for k in range(300)]
        rows = [(0, " ".join(base))] if with_original else []
        for i in range(1, n + 1):
            copy = list(base)
            for k in rng.sample(range(10, 290), 4):
                copy[k] = f"edit{i}x{k}"
            rows.append((i, " ".join(copy)))
        found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted((str(r["doc_id"]), r["n_shingles"], r["component_id"]) for r in found) == brute(rows)
        assert not with_original or sum(asked) <= 4 * n
