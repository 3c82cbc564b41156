"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread


TEXTS = {"documents", "conversations", "pages", "benchmark"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return spread(df) if name in TEXTS else df


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


def r6(c: Column | str, name: str) -> Column:
    """Double rounded for the comparison with SQL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6).alias(name)


# SQL fragments for the oracle side.
SQL_HASH = "md5('{seed}:' || {x}::VARCHAR)"
SQL_HASH_INT = "('0x' || substr(md5('{seed}:' || {x}::VARCHAR), 1, 8))::BIGINT"


def sql_hash(x: str, seed: int = 0) -> str:
    return SQL_HASH.format(x=x, seed=seed)


def sql_hash_int(x: str, seed: int = 0) -> str:
    return SQL_HASH_INT.format(x=x, seed=seed)


# Every vector as (vec_id, label, v DOUBLE[]).
SQL_EMB = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"
