"""Exact duplicates: grouping by a 128-bit content hash, with the bytes compared inside every group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

SPACES = r"[\x20\x09-\x0D]+"


def normalized(text: str = "text"):
    """The text with every run of white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACES, " ")


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they agree after white space is normalised. Rows are grouped by the MD5 of the text *and* the text
    itself: the hash decides where a row goes, the key comparison inside the aggregation compares the bytes, and equal
    texts are merged before the shuffle, so a text that a third of all rows repeat arrives once per task. The groups (one
    row per distinct text, without the text) are then joined to the rows' hashes; a hot group is split by the adaptive
    join because both sides of it are plain shuffles.

    Null and empty texts are equal. Rows that repeat an id with an equal text each come out, and ``group_size`` counts all
    rows. A null id never wins against another id. Further columns are ignored.
    """
    staged = docs.select(F.col(id).alias("doc_id"), normalized(text).alias("norm"))
    hashed = staged.withColumn("h", F.md5("norm"))
    groups = hashed.groupBy("h", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = cut_lineage(groups.select("h", F.sha2("norm", 256).alias("sha"), "keep_id", "group_size"))
    rows = hashed.select("doc_id", "h", F.sha2("norm", 256).alias("sha"))
    return rows.join(groups, ["h", "sha"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"))


SQL = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm)
"""
