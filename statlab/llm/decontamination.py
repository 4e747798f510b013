"""Benchmark decontamination by a positional inverted index of the training texts.

The index is a table of postings ``tid, pos, term, run``: text, place and term, for the terms of the benchmark, and
the length of the run of such terms around it. Phrases are found by intersecting lists shifted by the terms' offsets,
the rarest terms first. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statlab.llm.alnum import ALNUM
from statlab.session import stage

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 10
#: So many of the rarest terms' lists are intersected one by one; the other terms of what is left, all at once.
RAREST = 3
#: More terms than any phrase has.
MOST = 1 << 20
#: The term of the posting that ends each text and carries its number of words.
END = -1


def words(text: str = "text") -> Column:
    """Words of letters, digits and all that is not ASCII, A-Z as a-z; none in a null text."""
    return F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), CAPITALS, CAPITALS.lower()), F.lit(ALNUM), F.lit(0))


def text_id(text: str = "text") -> Column:
    """128 bits of a text; two different texts share them with a chance of 2^-128 a pair. A null text is empty."""
    known = F.coalesce(F.col(text), F.lit(""))
    return F.struct(F.xxhash64(known).alias("a"), F.xxhash64(F.lit(1), known, F.length(known)).alias("b")).alias("tid")


def test_windows(items: DataFrame, length: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three tables from ``item_id, text``: ``term, word``; ``wid, terms``, the different windows; ``wid, item``, the items they stand in.

    A window is ``length`` words in a row, or all words of a shorter item; an item without words has none.
    """
    known = items.select(F.col("item_id").cast("string").alias("item"), words().alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(length))
    cut = F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))
    held = stage(known.select("item", F.explode(cut).alias("phrase")).distinct().withColumn("wid", F.md5(F.array_join("phrase", " "))), "windows")
    # A term's number is its hash, so that no single task has to number them.
    terms = stage(held.select(F.explode("phrase").alias("word")).distinct().withColumn("term", F.xxhash64("word")), "terms")
    numbered = held.select("wid", "phrase").distinct().select("wid", F.posexplode("phrase").alias("off", "word")).join(terms, "word")
    phrases = numbered.groupBy("wid").agg(F.array_sort(F.collect_list(F.struct("off", "term"))).alias("t"))
    return terms, stage(phrases.select("wid", F.col("t.term").alias("terms")), "phrases"), held.select("wid", "item").where("item IS NOT NULL")


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The postings ``tid, pos, term, run`` of the given terms in all different texts of ``docs``, written once.

    Equal texts are indexed once. A posting with the term END stands behind each text's last word. ``run`` is the
    number of postings that follow each other without a gap around it, the end of the text included.
    """
    texts = docs.groupBy(text_id()).agg(F.first(F.coalesce("text", F.lit(""))).alias("text"))
    flat = texts.select("tid", F.posexplode(F.concat(words(), F.array(F.lit("")))).alias("pos", "word"))
    ended = terms.unionAll(terms.sparkSession.range(1).select(F.lit(""), F.lit(END).cast("long")))
    met = flat.join(ended, "word").select("tid", "pos", "term")
    island = F.col("pos") - F.row_number().over(Window.partitionBy("tid").orderBy("pos"))
    run = F.count("*").over(Window.partitionBy("tid", "island"))
    return stage(met.withColumn("island", island).withColumn("run", run.cast("int")).select("tid", "pos", "term", "run"), "index")


def _by_rarity(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """``wid, n, by``: each window's terms with their offsets, those with the fewest postings first.

    Windows with a term that has no posting are left out: they stand nowhere.
    """
    df = index.where(F.col("term") != END).groupBy("term").agg(F.count("*").alias("df"))
    each = phrases.select("wid", F.size("terms").alias("n"), F.posexplode("terms").alias("off", "term")).join(df, "term")
    by = each.groupBy("wid", "n").agg(F.array_sort(F.collect_list(F.struct("df", "off", "term"))).alias("by"))
    return stage(by.where("size(by) = n"), "by-rarity")


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``tid, start, n, wid``: every place at which a phrase ``wid, terms`` stands word by word.

    Each phrase begins with the list of its rarest term, shifted by the term's offset. What is left is intersected with the
    shifted lists of the next rarest; then all other terms are looked up for the few places that remain. Postings in
    runs shorter than the shortest phrase are not read.
    """
    shortest = phrases.agg(F.min(F.size("terms"))).first()[0]
    if shortest is None:
        shortest = 1
    lists = index.where(F.col("run") >= shortest).select("tid", "pos", "term", "run")
    by = _by_rarity(phrases, lists)
    first = by.select("wid", "n", F.col("by")[0]["term"].alias("term"), F.col("by")[0]["off"].alias("off"))
    found = lists.join(first, "term").where("run >= n AND pos >= off").select("tid", (F.col("pos") - F.col("off")).alias("start"), "n", "wid")
    found = stage(found, "candidates")
    for level in range(1, RAREST):
        asked = by.where(F.size("by") > level).select("wid", F.col("by")[level]["term"].alias("term"), F.col("by")[level]["off"].alias("off"))
        wanted = found.join(asked, "wid", "left").withColumn("pos", F.col("start") + F.coalesce("off", F.lit(0)))
        short, rest = wanted.where("term IS NULL"), wanted.where("term IS NOT NULL")
        some = lists.join(asked.select("term").distinct(), "term", "left_semi").select("tid", "pos", "term")
        met = rest.join(some, ["tid", "pos", "term"], "left_semi")
        found = stage(met.unionByName(short).select("tid", "start", "n", "wid"), "candidates")
    others = by.select("wid", F.explode(F.slice("by", RAREST + 1, MOST)).alias("t")).select("wid", F.col("t.term").alias("term"), F.col("t.off").alias("off"))
    asked = found.join(others, "wid").select("tid", "start", "n", "wid", (F.col("start") + F.col("off")).alias("pos"), "term")
    there = asked.join(lists.select("tid", "pos", "term"), ["tid", "pos", "term"]).groupBy("tid", "start", "n", "wid").agg(F.count("*").alias("met"))
    exact = there.where(F.col("met") == F.col("n") - RAREST).drop("met").unionByName(found.where(F.col("n") <= RAREST))
    return stage(exact, "matches")


def proximity_matches(index: DataFrame, phrases: DataFrame, slack: int = 5) -> DataFrame:
    """``tid, wid``: texts with all different terms of a phrase, in any order, within ``slack`` words more than it has.

    From every posting of the rarest term its surroundings are looked up in the other terms' lists; a surrounding holds
    at most twice the span, so no group grows with the table.
    """
    lists = index.where(F.col("term") != END).select("tid", "pos", "term")
    once = phrases.select("wid", F.array_distinct("terms").alias("terms"), (F.size("terms") + slack).alias("span"))
    by = _by_rarity(once.select("wid", "terms"), lists).join(once.select("wid", "span"), "wid")
    first = by.select("wid", "n", "span", F.col("by")[0]["term"].alias("term"))
    around = lists.join(first, "term").select("tid", F.col("pos").alias("at"), "wid", "n", "span")
    # A list is cut in stretches as long as the span, so that a place meets its own stretch and the two beside it.
    around = around.withColumn("cell", F.explode(F.array(*[F.floor(F.col("at") / F.col("span")) + k for k in (-1, 0, 1)])))
    needed = by.select("wid", "span", F.explode("by.term").alias("term"))
    placed = lists.join(needed, "term").select("tid", "wid", "pos", "term", F.floor(F.col("pos") / F.col("span")).alias("cell"))
    met = around.join(placed, ["tid", "wid", "cell"]).where("abs(pos - at) < span")
    seen = met.groupBy("tid", "wid", "at", "n", "span").agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("m"))

    def complete(row):
        within = F.filter("m", lambda o: (o["pos"] >= row["pos"]) & (o["pos"] < row["pos"] + F.col("span")))
        return F.size(F.array_distinct(F.transform(within, lambda o: o["term"]))) == F.col("n")

    return seen.where(F.exists("m", complete)).select("tid", "wid").distinct()


def _covered(starts: Column) -> Column:
    """How many places are inside any of the stretches ``start, end`` (sorted, end exclusive)."""
    zero = F.struct(F.lit(0).alias("until"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        new = F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["until"]))
        return F.struct(F.greatest(acc["until"], s["end"]).alias("until"), (acc["n"] + new).alias("n"))

    return F.aggregate(starts, zero, add)["n"]


def contamination(docs: DataFrame, items: DataFrame, length: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every row of ``docs`` (``doc_id, text``).

    A word is hit if it stands in an occurrence of any window of ``items`` (``item_id, text``). A null or empty text has
    no words and is hit nowhere; then ``items_sha256`` is that of an empty text. Null ids are kept as they are, and
    repeated rows each get their row. Items with one id count once; an item without an id hits words, but is not listed.
    With an empty table of items nothing is hit. Other columns are not looked at.
    """
    terms, phrases, owners = test_windows(items, length)
    index = positional_index(docs, terms)
    matches = phrase_matches(index, phrases)
    stretches = matches.select("tid", F.struct("start", (F.col("start") + F.col("n")).alias("end")).alias("s")).distinct()
    hit = stretches.groupBy("tid").agg(_covered(F.array_sort(F.collect_list("s"))).alias("n_hit"))
    listed = matches.select("tid", "wid").distinct().join(owners, "wid").select("tid", "item").distinct()
    listed = listed.groupBy("tid").agg(F.array_sort(F.collect_list("item")).alias("items"))
    sizes = index.where(F.col("term") == END).select("tid", F.col("pos").cast("long").alias("n_words"))
    found = hit.join(listed, "tid", "left").select(
        "tid", "n_hit", F.size(F.coalesce("items", F.array().cast("array<string>"))).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", F.array().cast("array<string>")), ",").cast("binary"), 256).alias("items_sha256"))
    per_text = stage(sizes.join(found, "tid", "left"), "per-text")
    none = F.sha2(F.lit("").cast("binary"), 256)
    return docs.select("doc_id", text_id()).join(per_text, "tid").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def benchmark_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contamination(docs, benchmark)
