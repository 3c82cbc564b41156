"""Sinks and caches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_metrics(metrics: DataFrame, path: str, epoch: int = -1, steps: int = -1) -> None:
    """Appends metric rows with their epoch and step; every part file carries the header."""
    rows = metrics.select(F.lit(epoch).alias("epoch"), F.lit(steps).alias("steps"), "*")
    rows.write.mode("append").option("header", True).csv(path)


def write_tsv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str | None = "gzip") -> None:
    """Tab-separated text without quoting; tabs and line breaks inside a cell become blanks."""
    cells = [F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"[\t\r\n]", " ") for c in df.columns]
    writer = df.select(F.concat_ws("\t", *cells).alias("value")).write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)


def cached_embeddings(df: DataFrame, path: str, id: str, encode: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of ``df`` with their vectors, computed once: only ids missing in the table at ``path`` are encoded."""
    spark = df.sparkSession
    try:
        known = spark.read.parquet(path).select(id)
        missing = df.join(known, id, "left_anti")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        missing = df
    encode(missing).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(df.select(id), id, "left_semi")


def keep(df: DataFrame) -> DataFrame:
    """Marks a table that is read several times; spills to disk, recomputed if an executor is lost."""
    return df.persist()
