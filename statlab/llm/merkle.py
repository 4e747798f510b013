"""Document fingerprints: a Merkle tree over clauses, paragraphs and sections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from statlab.llm.common import LOWEST, range_bins

#: Ranges of doc_id in which neighbours are looked up, at most.
BINS = 1024
#: A clause ends where space follows a character that is no letter, digit or space.
CLAUSE_END = r"([^\p{L}\p{N} \t\n\f\r])[ \t\n\f\r]+"


def _paragraphs(section: Column) -> Column:
    return F.split(section, "\n")


def sections(text: Column) -> Column:
    """Per section (parted by an empty line) the digests of its paragraphs (parted by a line break)."""
    return F.transform(F.split(text, "\n\n"), lambda s: F.transform(_paragraphs(s), lambda p: F.md5(p.cast("binary"))))


def root(tree: Column) -> Column:
    """The root over the sections' digests; texts are equal if and only if their roots are."""
    nodes = F.transform(tree, lambda s: F.md5(F.array_join(s, ",").cast("binary")))
    return F.md5(F.array_join(nodes, ";").cast("binary"))


def leaves(text: Column) -> Column:
    """Digests of the different clauses; a paragraph is cut where space follows punctuation."""
    clauses = F.split(F.regexp_replace(text, CLAUSE_END, "$1\n"), "\n")
    return F.array_distinct(F.transform(clauses, lambda x: F.substring(F.md5(x.cast("binary")), 1, 16)))


def fingerprint(tree: Column, clauses: Column) -> Column:
    """Root, section roots, and 24 bits of each clause, as one string; equal texts have equal ones."""
    nodes = F.array_join(F.transform(tree, lambda s: F.substring(F.md5(F.array_join(s, ",").cast("binary")), 1, 8)), ".")
    codes = F.array_join(F.transform(clauses, lambda x: F.substring(x, 1, 6)), "")
    return F.concat_ws("/", root(tree), nodes, codes)


def likeness(a: Column, b: Column) -> Column:
    """The share of common clauses, 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def differing(a: Column, b: Column) -> Column:
    """The edited paragraphs, as section and paragraph numbers: only branches whose digests differ are entered."""
    def within(i: Column) -> Column:
        left, right = F.get(a, i), F.get(b, i)
        n = F.greatest(F.coalesce(F.size(left), F.lit(0)), F.coalesce(F.size(right), F.lit(0)))
        numbers = F.filter(F.sequence(F.lit(0), n - 1), lambda j: ~F.get(left, j).eqNullSafe(F.get(right, j)))
        return F.when(left.eqNullSafe(right), F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(
            F.transform(numbers, lambda j: F.struct(i.cast("int").alias("section"), j.cast("int").alias("paragraph"))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1), within))


def with_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """Adds ``next``, a struct of the ``carried`` columns of the next document by ``doc_id``; after the last, the first.

    Rows are dealt to ranges of doc_id that hold about equally many; each range also gets the first row of the range
    after it. Nulls come first; rows of one id are ordered by their text's hash. Only range bounds, and the first
    row of each range, come from elsewhere.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST))
    keyed = docs.withColumns({"_key": key, "_h": F.xxhash64("text")})
    cuts = [i / BINS for i in range(1, BINS)]
    bounds = keyed.agg(F.percentile_approx("_key", cuts, 100_000)).first()[0] or []
    keyed = keyed.withColumn("_bin", range_bins(F.col("_key"), sorted(set(bounds))))
    lowest = keyed.groupBy("_bin").agg(F.min("_key").alias("_key"))
    firsts = [(r["_bin"], r["_key"]) for r in lowest.orderBy("_bin").collect()]
    before = {firsts[i][1]: firsts[i - 1][0] for i in range(len(firsts))}
    order = ["_key", "_h", "text"]
    heads = keyed.where(F.col("_key").isin(list(before)))
    heads = heads.withColumn("_n", F.row_number().over(Window.partitionBy("_bin").orderBy(*order))).where("_n = 1").drop("_n")
    to = docs.sparkSession.createDataFrame(list(before.items()), "_key long, _to int")
    heads = heads.join(to, "_key").withColumn("_bin", F.col("_to")).withColumn("_copy", F.lit(1)).drop("_to")
    both = keyed.withColumn("_copy", F.lit(0)).unionByName(heads)
    following = F.lead(F.struct(*carried)).over(Window.partitionBy("_bin").orderBy("_copy", *order))
    return both.withColumn("next", following).where("_copy = 0").drop("_key", "_h", "_bin", "_copy")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each whole text and of its edit, a row per document; a null text is empty.

    The edit replaces the last half by the beginning of the next document (``with_next``); an empty table gives none.
    Only texts travel: clauses, the next document's too, are digested after the rows have moved.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    paired = with_next(docs.select("doc_id", text.alias("text")), ["text"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    made = paired.select("doc_id", "text", F.col("next.text").alias("other"), n.cast("long").alias("n_chars"), edited.alias("edited"))
    made = made.select(
        "doc_id", "n_chars", "edited", leaves(F.col("text")).alias("clauses"), leaves(F.col("other")).alias("others"),
        leaves(F.col("edited")).alias("edited_clauses"), sections(F.col("text")).alias("tree"), sections(F.col("edited")).alias("edited_tree"))
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("tree"), F.col("clauses")).alias("fingerprint"),
        fingerprint(F.col("edited_tree"), F.col("edited_clauses")).alias("edited_fingerprint"),
        likeness(F.col("clauses"), F.col("edited_clauses")).alias("near_edited"),
        likeness(F.col("clauses"), F.col("others")).alias("near_next"),
        F.size(differing(F.col("tree"), F.col("edited_tree"))).alias("n_edited_paragraphs"),
    )
