import random

import pytest
from pyspark.sql import functions as F

WORDS = "the of and to in is that for as with was on be by at from are this it or an were which not but".split()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size string, shard string, cid string, "
          "token string, n int, score string, key string")


def sentence(rng, n=14):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "er", "ing", "ly", "ment", "ous"]) + rng.choice("aeiou") for _ in range(n))


def made_texts(seed=11, n=60):
    """Texts of a few paragraphs; every third is a copy or a slight edit of the one before."""
    rng, texts = random.Random(seed), []
    for i in range(n):
        if i % 3 == 2:
            words = texts[-1].split(" ")
            for _ in range(i % 4):
                words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        else:
            texts.append("\n".join(sentence(rng, rng.randint(8, 40)) + "." for _ in range(rng.randint(1, 6))))
    return texts


@pytest.fixture(scope="session")
def odd_rows():
    """Ordinary documents, and all that may go wrong: nulls, empty, long and odd texts, ties and repeated rows."""
    rng = random.Random(5)
    texts = made_texts()
    texts += ["", " \t\n ", "word", "two words", None, None, "İstanbul ſ É É <|endoftext|> \x1c日本語 😀", "12 34 !!", "\n\n", "x" * 300]
    texts += ["\n".join(sentence(rng, 25) for _ in range(300)), " ".join(sentence(rng, 30) for _ in range(200))]
    rows = [(i * 3 + 1, t, ["en", "fr", None][i % 3], [None, "a", "b", "é", "c"][i % 5]) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], rows[7], (None, texts[3], None, None), (None, None, "en", "a"), (10**15, texts[0], "fr", "b")]
    return [(*r, None if r[1] is None else len(r[1]), "s", "h", "c", "t", 7, "x", "k") for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vectors_none(spark):
    return spark.createDataFrame([], "vec_id long, embedding array<float>, label int")


def crc_mod(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4


@pytest.fixture
def held_out_column():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
