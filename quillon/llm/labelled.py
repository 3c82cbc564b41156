"""Joining label rows to documents without a hot key and without an unchecked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_LABELS = 1_000_000  # rows of (bigint, int): about 32 MB in an executor


def with_label(docs: DataFrame, labels: DataFrame, label: str, limit: int = BROADCAST_LABELS) -> DataFrame:
    """``docs`` with the column ``__label`` (int, null where there is none).

    Repeated label rows count once; an id with contradicting labels has none. At most ``limit`` counted rows are
    broadcast; a larger table is joined by a shuffle on the id, with the same result.
    """
    one = (labels.select(F.col("doc_id").alias("__id"), F.col(label).cast("int").alias("__label"))
           .where("__id is not null and __label is not null").groupBy("__id")
           .agg(F.min("__label").alias("__label"), F.max("__label").alias("__most")).where("__label = __most").drop("__most"))
    if labels.count() <= limit:
        one = F.broadcast(one)
    return docs.join(one, F.col("doc_id") == F.col("__id"), "left").drop("__id")
