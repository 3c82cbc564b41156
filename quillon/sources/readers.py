"""Readers (A01-A15). Line numbers are kept where a rule depends on file order."""

from __future__ import annotations

import io
import lzma
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..operators.prefix import first_n, global_row_number
from ..session import cut_lineage


def read_json(spark: SparkSession, path, schema: T.StructType | str | None = None, drop: Sequence[str] = ()) -> DataFrame:
    """JSON lines. Without a schema one pass infers it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path).drop(*drop)


def read_csv(
    spark: SparkSession, path, header: bool = False, infer: bool = False, sep: str = ",",
    schema: T.StructType | str | None = None, quote: str | None = '"',
) -> DataFrame:
    reader = spark.read.option("header", header).option("sep", sep).option("quote", quote or "")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path)


def read_positional_tsv(spark: SparkSession, path, columns: dict[int, str], sep: str = "\t") -> DataFrame:
    """File without header: the listed positions under new names."""
    raw = spark.read.option("sep", sep).option("quote", "").csv(path)
    return raw.select(*[F.col(f"_c{i}").alias(name) for i, name in columns.items()])


def read_libsvm(spark: SparkSession, path, features: int | None = None) -> DataFrame:
    """``(label, features)``; give the number of features to spare a pass over the data."""
    reader = spark.read.format("libsvm")
    if features is not None:
        reader = reader.option("numFeatures", features)
    return reader.load(path)


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def id_range(spark: SparkSession, n: int, name: str = "id", kind: str = "bigint") -> DataFrame:
    return spark.range(n).select(F.col("id").cast(kind).alias(name))


#: The most bytes of block rows that are broadcast to number lines; beyond it the blocks are joined by a shuffle.
BLOCK_TABLE_BYTES = 64 << 20


def _blocks(raw: DataFrame) -> DataFrame:
    """One row per block of a file (a byte range that Spark planned): its lines, the number its rows start at in this plan,
    and the lines before it in its file. The text is not decoded into rows that travel: only counts are shuffled."""
    counted = raw.groupBy("file", "start").agg(F.count(F.lit(1)).alias("lines"), F.min("mid").alias("first"))
    before = F.sum("lines").over(W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, W.currentRow))
    return cut_lineage(counted.withColumn("offset", before - F.col("lines")))


def _numbered(spark: SparkSession, paths: Sequence[str], over_files: bool) -> DataFrame:
    """``(file, line, value)``: two scans of the files, the first counts the lines of every block, the second numbers them.

    Both scans have the same byte ranges in the same order, so a line is its block's offset plus its distance to the
    block's first row; a row outside its block's counted range is an error. With ``over_files`` the numbers run on over
    the files in name order.
    """
    raw = spark.read.text(list(paths)).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("mid"))
    blocks = _blocks(raw.select("file", "start", "mid"))
    if over_files:
        files = blocks.groupBy("file").agg(F.sum("lines").alias("own"))  # one row per file
        ahead = F.sum("own").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("own")
        blocks = cut_lineage(blocks.join(files.select("file", ahead.alias("ahead")), "file").withColumn("offset", F.col("offset") + F.col("ahead")).drop("ahead"))
    size = blocks.agg(F.sum(F.length("file") + 32)).head()[0] or 0
    met = raw.join(F.broadcast(blocks) if size <= BLOCK_TABLE_BYTES else blocks, ["file", "start"])
    at = F.col("mid") - F.col("first")
    line = F.when((at >= 0) & (at < F.col("lines")), F.col("offset") + at).otherwise(F.raise_error(F.lit("the files changed between two reads")).cast("bigint"))
    return met.select("file", line.cast("bigint").alias("line"), "value")


def read_lines(spark: SparkSession, path) -> DataFrame:
    """``(file, line, value)``: text lines numbered from 0 within each file, in parallel over the blocks of a file.

    A line's number is its place in its block plus the lines of the blocks before; texts are numbered where they are
    read. ``.gz`` and ``.bz2`` files are read by Spark (``.bz2`` in blocks); ``.xz`` files, for which Hadoop has no
    codec, are each read whole by a task and decompressed in parts. A list may mix them.
    """
    paths = [path] if isinstance(path, str) else list(path)
    packed = [p for p in paths if p.endswith(".xz")]
    if packed:
        rest = [p for p in paths if not p.endswith(".xz")]
        unpacked = _read_xz(spark, packed)
        return unpacked.unionByName(read_lines(spark, rest)) if rest else unpacked
    return _numbered(spark, paths, False)


def _read_xz(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file, content in zip(pdf["path"], pdf["content"]):
                held, n = [], 0
                with lzma.open(io.BytesIO(content), "rt", encoding="utf-8", newline="\n") as lines:
                    for text in lines:
                        held.append(text.rstrip("\r\n"))
                        if len(held) == 10_000:
                            yield pd.DataFrame({"file": file, "line": range(n, n + len(held)), "value": held})
                            n, held = n + len(held), []
                if held:
                    yield pd.DataFrame({"file": file, "line": range(n, n + len(held)), "value": held})

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(unpack, "file string, line bigint, value string")


def ordered_lines(spark: SparkSession, path) -> DataFrame:
    """``(line, value)`` over one file, or over the part files of a folder in name order."""
    if not (isinstance(path, str) and path.endswith(".xz")):
        return _numbered(spark, [path] if isinstance(path, str) else path, True).select("line", "value")
    lines = read_lines(spark, path)
    counts = lines.groupBy("file").agg(F.count(F.lit(1)).alias("lines"))  # one row per file
    before = F.sum("lines").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("lines")
    return lines.join(counts.select("file", before.alias("offset")), "file").select(
        (F.col("offset") + F.col("line")).alias("line"), "value")


def _cells(sep: str) -> Column:
    return F.split("value", "\\Q" + sep + "\\E", -1)


def read_sts_pairs(
    spark: SparkSession, path: str, s1: int = 5, s2: int = 6, score: int = 4, low: float = 0.0, high: float = 5.0,
    normalize: bool = True, name: str | None = None, max_rows: int | None = None,
) -> DataFrame:
    """``(guid, texts, label)`` from tab-separated lines without quoting; guid is the file name and the row number."""
    lines = ordered_lines(spark, path).withColumn("c", _cells("\t"))
    value = F.get("c", F.lit(score)).cast("double")
    label = (value - F.lit(low)) / F.lit(high - low) if normalize else value
    if max_rows:
        lines = lines.where(F.col("line") < max_rows)
    stem = name if name is not None else path.rstrip("/").rsplit("/", 1)[-1]
    return lines.select(
        F.concat(F.lit(stem), F.col("line").cast("string")).alias("guid"),
        F.array(F.get("c", F.lit(s1)), F.get("c", F.lit(s2))).alias("texts"), label.alias("label"))


def read_triplets(
    spark: SparkSession, path: str, c1: int = 0, c2: int = 1, c3: int = 2, has_header: bool = False, sep: str = "\t",
    max_rows: int | None = None,
) -> DataFrame:
    """``(line, texts)`` with three texts per row."""
    lines = ordered_lines(spark, path)
    if has_header:
        lines = lines.where("line > 0").withColumn("line", F.col("line") - 1)
    if max_rows:
        lines = lines.where(F.col("line") < max_rows)
    lines = lines.withColumn("c", _cells(sep))
    return lines.select("line", F.array(*[F.get("c", F.lit(i)) for i in (c1, c2, c3)]).alias("texts"))


def label_ids(df: DataFrame, label: str, order: str) -> DataFrame:
    """``(label, label_id)``: labels numbered from 0 in the order of their first row."""
    first = df.groupBy(label).agg(F.min(order).alias("__first"))
    numbered = global_row_number(first, [F.col("__first").asc()], "__n")
    return numbered.select(label, (F.col("__n") - 1).alias("label_id"))


def read_labelled_sentences(
    spark: SparkSession, path: str, label: int = 0, text: int = 1, sep: str = "\t", max_rows: int | None = None,
) -> DataFrame:
    """``(line, text, label, label_id)``; label ids in first-seen order."""
    lines = ordered_lines(spark, path)
    if max_rows:
        lines = lines.where(F.col("line") < max_rows)
    rows = lines.withColumn("c", F.split(X.strip("value"), "\\Q" + sep + "\\E", -1)).select(
        "line", F.get("c", F.lit(text)).alias("text"), F.get("c", F.lit(label)).alias("label"))
    return rows.join(label_ids(rows, "label", "line"), "label").select("line", "text", "label", "label_id")


def read_paired_files(spark: SparkSession, paths: Sequence[str], max_rows: int | None = None) -> DataFrame:
    """``(guid, texts, label)``: line ``i`` of every file; stops at the shortest file; label 1."""
    out = None
    for i, p in enumerate(paths):
        side = ordered_lines(spark, p).withColumnRenamed("value", f"t{i}")
        out = side if out is None else out.join(side, "line")
    if max_rows:
        out = out.where(F.col("line") < max_rows)
    return out.select(F.col("line").cast("string").alias("guid"), F.array(*[f"t{i}" for i in range(len(paths))]).alias("texts"), F.lit(1).alias("label"))


# Class numbers of the three inference labels.
NLI_LABELS = {"contradiction": 0, "entailment": 1, "neutral": 2}


def read_nli(spark: SparkSession, s1: str, s2: str, labels: str, max_rows: int | None = None) -> DataFrame:
    """``(guid, texts, label)`` from three files zipped by line. An unknown label gives null."""
    rows = read_paired_files(spark, [s1, s2, labels], max_rows)
    key = F.lower(X.strip(F.get("texts", F.lit(2))))
    number = F.coalesce(*[F.when(key == k, F.lit(v)) for k, v in NLI_LABELS.items()])
    return rows.select("guid", F.slice("texts", 1, 2).alias("texts"), number.cast("bigint").alias("label"))


def read_parallel_tsv(spark: SparkSession, path: str, max_len: int | None = 128, max_rows: int | None = None) -> DataFrame:
    """``(line, texts)``: translations per line, the source first; a row with any cell over ``max_len`` is left out."""
    rows = ordered_lines(spark, path).select("line", F.split(X.strip("value"), "\t", -1).alias("texts"))
    if max_len:
        rows = rows.where(F.array_max(F.transform("texts", lambda t: F.length(t))) <= max_len)
    return first_n(rows, [F.col("line").asc()], max_rows) if max_rows else rows


PADDING = "PADDING_TOKEN"


def read_word_vectors(spark: SparkSession, path: str, sep: str = " ", max_vocab: int | None = None) -> DataFrame:
    """``(idx, word, vector)``. Line 1 fixes the dimension, other lengths are skipped; index 0 is a zero padding row."""
    rows = ordered_lines(spark, path).withColumn("c", F.split(F.rtrim("value", F.lit(X.WHITE)), "\\Q" + sep + "\\E", -1))
    first = rows.where("line = 0").select(F.size("c").alias("width")).head()
    if first is None:
        raise ValueError("empty word vector file")
    width = first[0]
    good = rows.where(F.size("c") == width).select(
        "line", F.get("c", F.lit(0)).alias("word"), F.slice("c", 2, width - 1).cast("array<float>").alias("vector"))
    numbers = global_row_number(good.select("line"), [F.col("line").asc()], "idx")
    out = good.join(numbers, "line").select("idx", "word", "vector")
    if max_vocab:
        out = out.where(F.col("idx") <= max_vocab)
    pad = spark.createDataFrame([(0, PADDING, [0.0] * (width - 1))], "idx bigint, word string, vector array<float>")
    return out.unionByName(pad)


def read_doc_frequencies(spark: SparkSession, path: str, stop: Sequence[str] = (), max_vocab: int | None = None) -> DataFrame:
    """``(token, df, weight)`` with ``weight = ln(N / df)``; ``N`` is line 1. The first ``max_vocab`` words are kept."""
    rows = ordered_lines(spark, path)
    n = int(rows.where("line = 0").head()["value"])
    cells = rows.where("line > 0").withColumn("c", F.split(X.strip(F.lower("value")), "\t"))
    out = cells.select("line", F.get("c", F.lit(0)).alias("token"), F.get("c", F.lit(1)).cast("bigint").alias("df"))
    if stop:
        out = out.where(~F.col("token").isin(list(stop)))
    if max_vocab:
        out = first_n(out, [F.col("line").asc()], max_vocab)
    return out.select("token", "df", F.log(F.lit(float(n)) / F.col("df")).alias("weight"))


def read_qrels(spark: SparkSession, path, sep: str = "\t") -> DataFrame:
    """``(query_id, corpus_id, relevance)`` of the four-column format, relevant rows only."""
    raw = spark.read.option("sep", sep).option("quote", "").schema("query_id string, run string, corpus_id string, relevance int").csv(path)
    return raw.where("relevance > 0").select("query_id", "corpus_id", "relevance")
