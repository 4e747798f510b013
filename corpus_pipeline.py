"""A corpus from raw documents to tokens: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statlab.llm.bpe import bpe_round_trip
from statlab.llm.langid import keep_languages
from statlab.llm.line_dedup import without_repeats
from statlab.llm.mixing import mix, take
from statlab.llm.ngram_join import keep_one
from statlab.session import stage


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language."""
    return keep_languages(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat earlier ones; documents that consisted of nothing else go."""
    return without_repeats(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id: five words, 80 of 100 in common."""
    return keep_one(docs, percent=80, width=5)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix: a document stands in it as often as the mix takes it, up to three times or not at all."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document")
    return take(mix(docs.select("doc_id", "source", "text", whole))).select("document.*")


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens' number and digests of every row that is left."""
    return bpe_round_trip(docs)


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard),
    ("source_mixing", source_mixing), ("bpe", bpe),
]

#: SQL cannot say the classifier, the edit join or the tokenizer; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
