"""The training-data pipeline: documents to packed sequences in five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import jaccard, lines, packing, quality, queries, substrings
from quillon.session import scratch_path, ship_package


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the log-likelihood ratio reject."""
    ship_package(spark)
    return quality.quality_stage(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs; documents without words left go."""
    ship_package(spark)
    return lines.line_stage(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near copies (five-word shingles, similarity 0.8)."""
    ship_package(spark)
    return jaccard.jaccard_stage(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes words in 20-word windows that occur earlier; documents without words left go."""
    ship_package(spark)
    return substrings.substring_stage(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every piece of every document in a sequence of at most 4,096 ids."""
    ship_package(spark)
    return packing.pack_documents(docs, queries.vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

ORACLE_SQL = None  # n-gram models, shingle components and token ids are beyond SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
