"""One unique, ordered bigint for every row of a document table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import global_row_number


def numbered(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``__id``: unique, and ordered as the ids are.

    Where ids are unique whole numbers they are used as they are. If any is null or repeats, the rows are numbered in the
    order of id (null last) and a hash of the text, so that rows of one id stay apart.
    """
    ids = docs.select(F.col(id).cast("bigint").alias("i"))
    if ids.groupBy("i").count().where("i is null or count > 1").limit(1).count() == 0:
        return docs.withColumn("__id", F.col(id).cast("bigint"))
    return global_row_number(docs, [F.col(id).asc_nulls_last(), F.xxhash64(text).asc()], "__id")


def set_aside(docs: DataFrame, *own: str) -> DataFrame:
    """``docs`` with all columns but ``own`` named ``c0, c1, ...``, so that they clash with nothing an operator adds."""
    return docs.toDF(*[c if c in own else f"c{i}" for i, c in enumerate(docs.columns)])
