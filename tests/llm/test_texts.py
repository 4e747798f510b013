"""Language, quality, tokens, lines and private data."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statlab.llm import bpe as B
from statlab.llm import langid, line_dedup, pii, quality
from statlab.llm.common import handing_back
from tests.llm.conftest import made_texts

ALPHABETS = {"aa": "abcde", "bb": "fghij", "cc": "klmnö"}


def in_language(rng, lang, n):
    return " ".join("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 6))) for _ in range(n))


# --- language


@pytest.fixture(scope="module")
def spoken(spark):
    rng, rows = random.Random(4), []
    for i in range(240):
        lang = ["aa", "bb", "cc"][i % 3]
        rows.append((i, in_language(rng, lang, rng.randint(3, 60)), None if i % 10 == 7 else lang, f"s{i % 4}", 5))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")


def test_languages_are_told_apart(spark, spoken):
    found = {r["doc_id"]: r for r in langid.language_id(spoken).collect()}
    assert all(found[i]["lang_pred"] == ["aa", "bb", "cc"][i % 3] for i in range(240))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) and 0.5 < r["score"] <= 1 for i, r in found.items())


def test_language_of_odd_documents(odd, odd_rows, none):
    found = langid.language_id(odd).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        text = next(x[1] for x in odd_rows if x[0] == r["doc_id"]) if r["doc_id"] is not None else "a"
        if not any(c.isalpha() for c in text or ""):
            assert r["lang_pred"] == "und" and r["score"] == 0.0
        assert r["lang_pred"] in ("en", "fr", "und")
    assert langid.language_id(none).collect() == []
    assert {r["lang_pred"] for r in langid.language_id(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_filter_keeps_learned_languages(spoken):
    more = spoken.unionAll(spoken.limit(1).selectExpr("999L", "'12 345'", "'aa'", "'s'", "1"))
    kept = langid.keep_languages(more)
    assert kept.columns == spoken.columns and kept.count() == 240


def test_filter_rejects_unlearned_languages_and_scripts(spark, spoken):
    rng = random.Random(9)
    far = ["".join(rng.choice(letters) for _ in range(n)) for n in (40, 90, 300) for letters in ("pqrst ", "жзийк ", "日本語文 ")]
    rows = [(1000 + i, t, None, "s", 1) for i, t in enumerate(far)]
    kept = langid.keep_languages(spoken.unionAll(spark.createDataFrame(rows, spoken.schema)))
    assert {r["doc_id"] for r in kept.collect()} == set(range(240))


def test_presence_is_of_whole_texts():
    texts = ["ab", "xab" * 1000, ""]
    rows = langid.presence(pa.array(texts))
    assert rows[0].sum() == 3 and rows[2].sum() == 0 and (rows[1] >= rows[0]).all()


# --- quality


def test_quality_on_held_out_documents(spark):
    rng, rows, labels = random.Random(8), [], []
    for i in range(400):
        good = i % 3 > 0
        text = in_language(rng, "aa", rng.randint(20, 60)) if good else " ".join(["SPAM!!", in_language(rng, "aa", 1).upper()] * rng.randint(5, 30))
        rows.append((i, text, None if i % 5 else len(text), "x"))
        labels.append((i, int(good) if i % 7 else None, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, quality string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality.quality(docs, known).collect()
    out = [r for r in found if r["held_out"]]
    assert len(found) == 400 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 > 0) for r in out]) > 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found)


def test_quality_of_odd_documents(spark, odd, odd_rows, none):
    known = spark.createDataFrame([(r[0], i % 2, 0) for i, r in enumerate(odd_rows[:60])] * 2, "doc_id long, quality int, toxic int")
    assert len(quality.quality(odd, known).collect()) == len(odd_rows)
    assert {r["score"] for r in quality.quality(odd, known.limit(0)).collect()} == {0.5}
    assert quality.quality(none, known).collect() == []


def test_interactions_are_the_sum_over_all_pairs():
    rng = np.random.default_rng(0)
    model = quality.FactorisationMachine(0.3, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, 4)))
    place, value = np.array([3, 50, 700]), np.array([0.5, 1.0, 2.0])
    raw = 0.3 + model.weights[place] @ value
    raw += sum(model.vectors[place[i]] @ model.vectors[place[j]] * value[i] * value[j] for i in range(3) for j in range(i))
    assert model.scores([(place, value)])[0] == pytest.approx(1 / (1 + np.exp(-raw)))


# --- tokens


def test_tokens_are_the_librarys(odd, odd_rows, none):
    from tokenizers import Tokenizer

    known = Tokenizer.from_str(B.tokenizer_file())
    want = []
    for r in odd_rows:
        ids = known.encode(r[1] or "", add_special_tokens=False).ids
        digests = [" ".join(map(str, ids)), known.decode(ids, skip_special_tokens=False)]
        want.append((str(r[0]), len(ids), *(hashlib.sha256(d.encode()).hexdigest() for d in digests)))
    found = B.bpe_round_trip(odd).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found) == sorted(want)
    assert B.bpe_round_trip(none).collect() == []


def test_joins_are_repaired_wherever_chunks_are_known():
    words = B.Words(B.tokenizer_file())
    text = "\n".join(made_texts(n=40)) + " é" + "x" * 3000 + " end"
    chunks = B._text_chunks(text.encode())
    assert "".join(chunks) == text and len(chunks) > 5
    want = words.tokenizer.encode(text, add_special_tokens=False).ids
    for step in (1, 2, 3):
        inner = {i: words.encode([c[slice(*B.inner_part(c))]])[0] for i, c in enumerate(chunks) if i % step == 0}
        assert B.encode_pieces([B.pieces(chunks, inner)], words)[0].tolist() == want


def test_shared_passages_fall_into_shared_chunks():
    passage = " ".join(made_texts(n=60))[:20000]
    one, two = (set(B._text_chunks((head + passage).encode())) for head in ("a beginning ", "another one, longer "))
    assert len(one & two) > 0.8 * len(one)


def test_a_full_memory_forgets(monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 50)
    words = B.Words(B.tokenizer_file())
    for text in made_texts(n=12):
        assert words.encode([text, "", text])[2].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids


# --- lines


def distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


def edited(rng, text, most, letters="abcé😀"):
    made = list(text)
    for _ in range(rng.randint(0, most)):
        at, how = rng.randrange(len(made) + 1), rng.randrange(3)
        if how == 0:
            made.insert(at, rng.choice(letters))
        elif made and how == 1:
            made.pop(min(at, len(made) - 1))
        elif made:
            made[min(at, len(made) - 1)] = rng.choice(letters)
    return "".join(made)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_banded_distance(edits):
    rng, pairs = random.Random(edits), []
    for _ in range(1500):
        text = "".join(rng.choice("abcé😀") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 40])))
        pairs.append((text, edited(rng, text, edits + 2)))
    found = line_dedup.within([a for a, _ in pairs], [b for _, b in pairs], edits)
    assert found.tolist() == [distance(a, b) <= edits for a, b in pairs]


def brute_lines(rows, edits=2, shortest=80):
    first, places = {}, []
    for i, text in sorted(((r[0], r[1]) for r in rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        for n, line in enumerate((text or "").split("\n")):
            if len(line) >= shortest:
                at = (i is not None, i or 0, n)
                first[line] = min(first.get(line, at), at)
                places.append((i, n, line))
    lines, later = list(first), set()
    for k, a in enumerate(lines):
        for b in lines[:k]:
            if abs(len(a) - len(b)) <= edits and distance(a, b) <= edits:
                later.add(max(a, b, key=first.get))
    dropped = defaultdict(set)
    for i, n, line in places:
        if line in later or first[line] != (i is not None, i or 0, n):
            dropped[i].add(n)
    return dropped


def test_lines_of_odd_documents(odd, odd_rows, none):
    want = brute_lines(odd_rows)
    found = line_dedup.line_dedup(odd).collect()
    assert len(found) == len(odd_rows) and sum(map(len, want.values())) > 20
    for r in found:
        assert r["dropped"] == sorted(want.get(r["doc_id"], ())) and r["n_dropped"] == len(r["dropped"])
    assert line_dedup.line_dedup(none).collect() == []


def test_near_lines_and_what_is_left(spark):
    rng, rows = random.Random(3), []
    base = ["".join(rng.choice("abc ") for _ in range(rng.randint(60, 100))) for _ in range(12)]
    for i in range(60):
        rows.append((i, "\n".join(edited(rng, rng.choice(base), 3, "abc ") for _ in range(3))))
    rows.append((100, rows[0][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_lines(rows)
    assert {r["doc_id"]: set(r["dropped"]) for r in line_dedup.repeated_lines(docs).collect()} == want
    left = {r["doc_id"]: r["text"] for r in line_dedup.without_repeats(docs).collect()}
    for i, text in rows:
        kept = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in want.get(i, ()))
        assert left.get(i, "") == kept if kept.strip() or i not in want else i not in left


def test_lines_of_rows_that_share_an_id(spark):
    rng = random.Random(12)
    line = ["".join(rng.choice("abcdefgh ") for _ in range(100)) for _ in range(7)]
    rows = [(None, f"{line[0]}\n{line[1]}"), (None, f"{line[2]}\n{line[0]}"), (None, f"{line[3]}\n{line[4]}"), (None, f"{line[5]}\n{line[1]}"),
            (3, f"{line[6]}\nx"), (3, f"{line[6]}\ny"), (3, f"{line[6]}\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = line_dedup.without_repeats(docs).collect()
    once = [x for r in left if r["doc_id"] is None for x in r["text"].split("\n")]
    assert sorted(once) == sorted(line[:6])
    assert sorted(x for r in left if r["doc_id"] == 3 for x in r["text"].split("\n") if len(x) < 80) == ["x", "y", "y"]
    assert len({r["text"] for r in left if line[6] in r["text"]}) == 1
    found = line_dedup.line_dedup(docs)
    assert found.count() == 7 and found.where("doc_id IS NULL").agg(F.sum("n_dropped")).first()[0] == 2


# --- private data

PRIVATE = ("Dear Mrs. Anna Schmidt, write to Anna.Schmidt@mail.example.com or call +1 (017) 555-7713 190.137.223.204. "
           "Frau Schmidt (SCHMIDT) pays with 4111 1111 1111 1111 from DE89 3704 0044 0532 0130 00 on 2024-01-02, v 1.2.")


def test_surrogates_keep_type_gender_script_and_format():
    kinds = [f[2] for f in pii.detect(PRIVATE)]
    assert sorted(kinds) == sorted(["given f LATIN", "email", "phone", "address", "number", "iban"] + ["surname LATIN"] * 3)
    for _, _, kind, norm in pii.detect(PRIVATE):
        made = pii.surrogate(b"k", kind, norm, 0)
        assert made != norm and made == pii.surrogate(b"k", kind, norm, 0) != pii.surrogate(b"other", kind, norm, 0)
        if kind == "iban":
            assert pii._iban_rest(made) == 1 and len(made) == len(norm)
        if kind == "number":
            assert pii._luhn(made) == 0 and len(made) == 16
    assert pii.surrogate(b"k", "given f LATIN", "anna", 0)[-1] == "a"
    assert pii.script(pii.surrogate(b"k", "given m CYRILLIC", "иван", 0)) == "CYRILLIC"
    assert re.fullmatch(r"\+\d \(\d{3}\) \d{3}-\d{4}", pii.fitted("+1 (017) 555-7713", "phone", "12345678901"))


def test_mentions_agree_across_documents(spark, none):
    rows = [(1, PRIVATE), (2, "Frau Schmidt called from +1 (017) 555-7713."), (3, "nothing private, 2024-01-02"), (4, None), (5, ""), (2, "twice"), (None, PRIVATE)]
    docs = spark.createDataFrame([(*r, "k", 3) for r in rows], "doc_id long, text string, kind string, n_entities int")
    out = pii.replace_private(docs).collect()
    assert len(out) == len(rows) and out[0].__fields__ == ["doc_id", "text", "kind", "n_entities"]
    by = {(r["doc_id"], r["n_entities"]): r["text"] for r in out}
    assert by[3, 0] == rows[2][1] and by[4, 0] is None and by[5, 0] == "" and by[2, 0] == "twice"
    first, second = by[1, 9], by[2, 2]
    assert by[None, 9] == first
    for secret in ("Schmidt", "Anna", "mail.example", "555-7713", "4111", "0532", "190.137"):
        assert secret.lower() not in (first + second).lower()
    name = re.match(r"Frau (\w+) called from (.*)\.$", second)
    assert name[1] in first and name[1].upper() in first and name[2] in first and "2024-01-02, v 1.2." in first
    assert pii.pii_surrogates(none).collect() == []


def test_collisions_are_drawn_again(spark):
    def spread(batches):
        for batch in batches:
            norms, attempts = batch.column("norm").to_pylist(), batch.column("attempt").to_pylist()
            made = [str(zlib.crc32(f"{n} {a}".encode()) % 60) for n, a in zip(norms, attempts)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "norm", "attempt")), pa.array(made)], ["kind", "norm", "attempt", "made"])

    names = [str(n) for n in range(25)]
    entities = spark.createDataFrame([("k", n) for n in names] * 3, "kind string, norm string")
    found = {r["norm"]: r["made"] for r in pii.assign_surrogates(entities, "x", spread).collect()}
    assert sorted(found) == sorted(names) and len(set(found.values())) == 25 and not set(found.values()) & set(names)


def test_surrogates_of_a_full_space(spark):
    import string

    short = [f"{a}@{b}.de" for a in string.ascii_lowercase for b in string.ascii_lowercase]
    entities = spark.createDataFrame([("email", x) for x in short], "kind string, norm string")
    found = {r["norm"]: r["made"] for r in pii.assign_surrogates(entities, "x").collect()}
    assert set(found) == set(short) and len(set(found.values())) == len(short) and not set(found.values()) & set(short)
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.de", x) for x in found.values())


def test_grown_surrogates_keep_the_format():
    assert re.fullmatch(r"[A-Z][a-z]{2}@[a-z]\.de", pii.fitted("A@b.de", "email", pii.surrogate(b"k", "email", "a@b.de", 8)))
    assert re.fullmatch(r"\d{3}-\d{6}", pii.fitted("555-1234", "phone", pii.surrogate(b"k", "phone", "5551234", 8)))
    assert pii._iban_rest(pii.surrogate(b"k", "iban", "DE89370400440532013000", 8)) == 1
    assert pii._luhn(pii.surrogate(b"k", "number", "4111111111111111", 8)) == 0


def test_long_runs_of_letters_are_read_once():
    import time

    begin = time.monotonic()
    assert pii.detect("1" + "a" * 1_000_000) == [(0, 1_000_001, "secret", "1" + "a" * 1_000_000)]
    many = " ".join(f"user{i}@example.org" for i in range(20_000))
    assert len(pii.detect(many)) == 20_000
    assert time.monotonic() - begin < 20
    assert [x[3] for x in pii.detect("x@y.de_z@w.com a@b@c.de")] == ["x@y.de", "_z@w.com", "b@c.de"]


def test_digits_of_other_scripts_are_a_hint():
    assert [x[2:] for x in pii.detect("\u0660\u0661\u0662 \u0663\u0664\u0665 \u0666\u0667\u0668\u0669")] == [("phone", "0123456789")]


def test_slices_are_bounded_by_rows():
    import pyarrow as pa

    from statlab.llm.common import slices

    batch = pa.record_batch({"text": ["short"] * 1500 + [None, ""]})
    sizes = [b.num_rows for b in slices([batch], most_rows=langid.HELD)]
    assert sum(sizes) == 1502 and max(sizes) == langid.HELD


def test_presence_takes_memory_by_the_place_not_by_the_text(monkeypatch):
    import tracemalloc

    rng = random.Random(33)
    texts = [None, "", "ab", "".join(rng.choice("abcäß中 ") for _ in range(900)), "a", "xyz" * 40]
    whole = langid.presence(pa.array(texts))
    for places in (1, 2, 3, 7, 64):
        monkeypatch.setattr(langid, "LOOKED_AT", places)
        assert (langid.presence(pa.array(texts)) == whole).all()
    monkeypatch.undo()
    long = pa.array(["some words " * 400_000])
    tracemalloc.start()
    langid.presence(long)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20
    tracemalloc.start()
    langid.presence(pa.array(["short"] * 512).slice(0, langid.HELD)).astype("float32")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20


def test_code_points_are_mixed_once_a_task(monkeypatch):
    """Sums from tables are those of the formula; a task works out a common code point once, not once a line or batch."""
    rng = random.Random(34)
    running, base = line_dedup.Sums(), 0x9E3779B97F4A7C15
    for text in ("", "abc", "".join(rng.choice("abäß中\uffff\U00010000\U0001f600") for _ in range(300)), "later, shorter"):
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        sums, down = running.hashes(points)
        letters, want, wanted = running.letters(points), 0, 0
        for i, p in enumerate(points.tolist()):
            want = (want + int(line_dedup.mix64(np.uint64(p + 1))) * pow(base, i, 1 << 64)) % (1 << 64)
            wanted = (wanted + (1 << int(line_dedup.mix64(np.uint64(p)) % np.uint64(15)) * 4)) % (1 << 64)
            assert int(sums[i + 1]) == want and int(letters[i + 1]) == wanted
            assert int(down[i]) * pow(base, i, 1 << 64) % (1 << 64) == 1
    batch = pa.record_batch({"doc": [0, 1, 2], "row": [0, 0, 0], "text": ["line of words " * 60_000] * 3})
    mixed = []
    monkeypatch.setattr(line_dedup, "mix64", lambda x, of=line_dedup.mix64: mixed.append(np.size(x)) or of(x))
    assert sum(b.num_rows for b in line_dedup._occurrences(80, 2)([batch])) == 3
    assert sum(mixed) < 1 << 18


def test_filter_with_clashing_columns(spoken):
    docs = spoken
    plain = {r["doc_id"] for r in langid.keep_languages(docs).collect()}
    names = ["letter", "_letter", "_text", "near", "score", "lang_pred"]
    wide = docs
    for i, name in enumerate(names):
        wide = wide.withColumn(name, F.lit(i))
    kept = langid.keep_languages(wide)
    assert kept.columns == wide.columns
    found = kept.collect()
    assert {r["doc_id"] for r in found} == plain and plain
    assert all([r[n] for n in names] == list(range(6)) for r in found)


def test_words_with_a_mark_between_them():
    """Their tokens are those of each word alone, also where a word holds the mark or something that becomes it."""
    rng = random.Random(31)
    letters = "abcXYZäñß中\u0308\ufb01\t\u00a0.,#'0129§×÷~^\u00b7|"
    made = sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) for _ in range(900)} | {"×", "a×", "\t", "the", "Don't"})
    for mark in ("found", None, "a"):
        words = B.Words(B.tokenizer_file())
        assert words.mark in B.MARKS
        if mark != "found":
            words.mark, words.mark_id = mark, words.tokenizer.encode(mark or "", add_special_tokens=False).ids[0] if mark else -1
        texts = [" ".join(made[i:i + 30]) for i in range(0, len(made), 30)]
        want = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [t.tolist() for t in words.encode(texts)] == want
    words = B.Words(B.tokenizer_file())
    plain = [w for w in made if words.mark not in w]
    tokens, counts = words._of_marked(plain)
    alone = words._of_words(plain)
    assert tokens.tolist() == alone[0].tolist() and counts.tolist() == alone[1].tolist()
    assert words._of_marked([*plain, words.mark]) is None


def test_plain_words_need_no_marks(monkeypatch):
    """Words are parted by their tokens' bytes; other words, and tokens that are no bytes, go the longer ways."""
    rng = random.Random(32)
    made = sorted({"".join(rng.choice("abXYZäñßÿ.,#'0129§×<>|") for _ in range(rng.randrange(1, 9))) for _ in range(900)} | {"<|endoftext|>", "a<|endoftext|>b"})
    words = B.Words(B.tokenizer_file())
    tokens, counts = words._of_joined(made)
    alone = words._of_words(made)
    assert tokens.tolist() == alone[0].tolist() and counts.tolist() == alone[1].tolist()
    assert words._of_joined(["a\tb", "c"]) is None and words._of_joined(["\u0130x", "y"]) is None
    want = [words.tokenizer.encode(w, add_special_tokens=False).ids for w in [*made, "\u0130x", "中"]]
    longer = []
    monkeypatch.setattr(B.Words, "_of_marked", lambda self, some, of=B.Words._of_marked: longer.extend(some) or of(self, some))
    assert [t.tolist() for t in words.encode([*made, "\u0130x", "中"])] == want and sorted(longer) == ["\u0130x", "中"]
    words = B.Words(B.tokenizer_file())
    words.bytes[:] = 1
    assert [t.tolist() for t in words.encode([*made, "\u0130x", "中"])] == want


def test_words_are_parted_by_kind_only_where_the_tokenizer_does():
    """Parts are learned once, whatever stands around them; the tokens are the library's, also of other tokenizers."""
    import json

    from tokenizers import Tokenizer

    words, learned = B.Words(B.tokenizer_file()), []
    words._learn = lambda some, keys, of=words._learn: learned.extend(some) or of(some, keys)
    text = "There there, THERE&&& (there) it's 'there' x1there\nthere\u0308! \u00c9there.?"
    assert words.encode([text])[0].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(learned) == sorted(["there", ",", "&&&", "(", ")", "it", "'s", "'there", "'", "x", "1", "there\u0308!", "\u00c9there", ".?"])
    spec, rng = json.loads(B.tokenizer_file()), random.Random(33)
    split, signs = spec["pre_tokenizer"]["pretokenizers"]
    by_gaps = {"type": "Sequence", "pretokenizers": [split | {"pattern": {"Regex": "[^\\s]+"}}, signs]}
    other = [spec | {"normalizer": {"type": "NFC"}}, spec | {"normalizer": None}, spec | {"pre_tokenizer": by_gaps}]
    other.append(spec | {"added_tokens": [spec["added_tokens"][0] | {"content": "abc"}, spec["added_tokens"][1] | {"content": "Se"}]})
    signs = "abcXYZ jJsStTrReEvVlLmMdD' '01239&$%.-<|>_\t\x1c\x00\x7f\u00a0\u0308\u030c\u0307\u0130\u03a3\u4e2d\ufb01äß×½²"
    for made in (spec, *other):
        words = B.Words(json.dumps(made))
        assert (words.parted, words.folded) == (made["pre_tokenizer"] == spec["pre_tokenizer"], made["normalizer"] == spec["normalizer"] and made["pre_tokenizer"] == spec["pre_tokenizer"])
        for _ in range(6):
            some = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 2, 9, 40]))) for _ in range(30)]
            some += [" a<|endoftext|>b ", "Abc abc se Se"] * (rng.random() < 0.4)
            alone = [[w for w in t.split(" ") if w] for t in some]
            want = [[i for w in t for i in words.tokenizer.encode(w, add_special_tokens=False).ids] for t in alone]
            assert [t.tolist() for t in words.encode(some)] == want


def test_what_a_task_remembers_is_small():
    """Words are kept as their hashes and tokens, and texts are opened some bytes at a time."""
    import tracemalloc

    import pyarrow as pa
    import zstandard

    rng = random.Random(34)
    words = B.Words(B.tokenizer_file())
    made = [" ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(2000)) for _ in range(40)]
    tracemalloc.start()
    tokens = [words.encode([t])[0] for t in made[:1]]
    before = tracemalloc.get_traced_memory()[0]
    for t in made:
        words.encode([t])
    grown = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert len(words.keys) > 75_000 and grown < 60 * len(words.keys)
    assert tokens[0].tolist() == words.encode(made[:1])[0].tolist()
    press = zstandard.ZstdCompressor()
    batch = pa.RecordBatch.from_arrays([pa.array([press.compress(b"x" * B.TEXT_BYTES)] * 5 + [press.compress(b"")] * 600)], ["packed"])
    sizes = [len(rows) for rows in B._opened(iter([batch]), zstandard.ZstdDecompressor())]
    assert sizes == [1] * 5 + [256, 256, 88]


def test_words_beyond_a_block(monkeypatch):
    """Long words, and blocks that one word fills, have the same tokens."""
    monkeypatch.setattr(B, "BLOCK", 400)
    words = B.Words(B.tokenizer_file())
    texts = ["a&" * 700 + " b", "", "x" * 300 + " y " + "x" * 300 + "z\n", "é1" * 500, "one two " * 300]
    assert [t.tolist() for t in words.encode(texts)] == [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_workers_hand_memory_back():
    """The batches are the same, and what was freed inside is not kept by the worker."""
    def made(batches):
        held = [bytes(1000) for _ in range(200_000)]
        yield from batches
        del held

    def size():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    list(handing_back(lambda batches: batches)(iter([])))
    before = size()
    assert list(handing_back(made)(iter([1, 2]))) == [1, 2]
    assert size() - before < 60_000_000
