"""Decontamination, whitening and resampling as queries over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from statlab.llm.common import table
from statlab.llm.decontamination import benchmark_decontamination
from statlab.llm.resampling import target_resampling
from statlab.llm.whitening import embedding_whitening


def op11_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return benchmark_decontamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op12_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_whitening(table(spark, sf, "embeddings"))


def op13_target_resampling(spark: SparkSession, sf: str) -> DataFrame:
    return target_resampling(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES = {f.__name__: f for f in (op11_benchmark_decontamination, op12_embedding_whitening, op13_target_resampling)}
