"""The operators of this folder as queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statlab.llm.bpe import bpe_round_trip
from statlab.llm.common import table
from statlab.llm.cover_tree import embedding_near_dedup
from statlab.llm.histogram_sort import sharding
from statlab.llm.langid import language_id
from statlab.llm.line_dedup import line_dedup
from statlab.llm.merkle import document_fingerprints
from statlab.llm.mixing import source_mixing
from statlab.llm.ngram_join import ngram_jaccard
from statlab.llm.pii import pii_surrogates
from statlab.llm.quality import quality


def op1_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_near_dedup(table(spark, sf, "embeddings"))


def op2_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding(table(spark, sf, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return document_fingerprints(table(spark, sf, "documents"))


def op4_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return source_mixing(table(spark, sf, "documents"))


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language_id(table(spark, sf, "documents"))


def op6_pii_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    return pii_surrogates(table(spark, sf, "documents"))


def op7_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf, "documents"))


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup(table(spark, sf, "documents"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op10_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_jaccard(table(spark, sf, "documents"))


QUERIES = {
    f.__name__: f for f in (
        op1_embedding_near_dedup, op2_sharding, op3_document_fingerprints, op4_source_mixing, op5_language_id,
        op6_pii_surrogates, op7_bpe_round_trip, op8_line_dedup, op9_quality, op10_ngram_jaccard,
    )
}
