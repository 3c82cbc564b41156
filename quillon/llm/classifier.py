"""Quality classifier: n-gram indicators scaled by class log-count ratios, then a linear hinge-loss model.

The model is fitted by dual coordinate descent on shards of the training rows at once, and the shards' weights are averaged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .labelled import with_label

BUCKETS = 1 << 18
FIT_ROWS = 32_768  # the classifier is fitted on about this many labelled rows at most, chosen by a hash of their id
SHARD_ROWS = 2_048
EPOCHS = 12


class Model(NamedTuple):
    """Hinge-loss weight and class ratio per bucket, and the intercept."""

    weights: np.ndarray
    scale: np.ndarray
    intercept: float


def fold(id: str | Column = "doc_id", folds: int = 3) -> Column:
    """``crc32(id as text) mod folds``."""
    c = F.col(id) if isinstance(id, str) else id
    return F.crc32(c.cast("string").cast("binary")) % folds


def _features(batch: pa.RecordBatch, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of every document's words and word pairs, as (bucket, start of each document).

    A word followed by itself is the same pair whatever the word.
    """
    data, offsets = W.column_bytes(batch.column("text"))
    spans = W.word_spans(data, offsets)
    h = W.hash_spans(data, spans, 11)
    at = W.windows_inside(spans, 2)
    owners = spans.owners()
    two = W.pair_hash(h[at], h[at + 1], 13) if len(at) else h[:0]
    if len(at):
        two[h[at] == h[at + 1]] = 1
    gram = np.concatenate([h, two]) % W.U(buckets)
    owner = np.concatenate([owners, owners[at]])
    key = np.unique(owner * buckets + gram.astype(np.int64))
    return key % buckets, np.searchsorted(key, np.arange(batch.num_rows + 1) * buckets)


def indicator_counts(train: DataFrame, buckets: int) -> DataFrame:
    """``bucket, ones, zeros``: in how many documents of each class a bucket occurs. Bucket -1 counts the documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, buckets + 1), dtype=np.int64)
        for batch in W.slices(batches):
            y = batch.column("__label").to_numpy(zero_copy_only=False).astype(np.int64)
            bucket, first = _features(batch, buckets)
            cls = np.repeat(y, np.diff(first))
            for c in (0, 1):
                total[c, 1:] += np.bincount(bucket[cls == c], minlength=buckets)
                total[c, 0] += int((y == c).sum())
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some - 1), pa.array(total[1][some]), pa.array(total[0][some])], ["bucket", "ones", "zeros"])

    counts = train.select("text", "__label").mapInArrow(count, "bucket bigint, ones bigint, zeros bigint")
    return counts.groupBy("bucket").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))


def _ratios(counts: DataFrame, buckets: int) -> tuple[np.ndarray, int, int]:
    """Log-count ratio per bucket (at most ``buckets`` rows reach the driver) and the class sizes."""
    total = np.zeros((2, buckets + 1))
    for bucket, ones, zeros in counts.collect():
        total[1, bucket + 1], total[0, bucket + 1] = ones, zeros
    p, q = total[1, 1:] + 1, total[0, 1:] + 1
    return np.log((p / p.sum()) / (q / q.sum())), int(total[1, 0]), int(total[0, 0])


def dual_coordinate_descent(bucket: np.ndarray, first: np.ndarray, y: np.ndarray, scale: np.ndarray, cost: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Weights (last: intercept) of the L2-regularised hinge loss over rows of unit length.

    The values of row ``i`` are ``scale[bucket]`` over its length, and 1 for the intercept; ``cost`` bounds each dual
    variable.
    """
    values = scale[bucket]
    norms = np.sqrt(np.maximum(np.add.reduceat(np.append(values * values, 0.0), first[:-1]) * (np.diff(first) > 0), 1e-12))
    w, alpha = np.zeros(len(scale) + 1), np.zeros(len(y))
    rows = [(bucket[a:b], values[a:b] / n) for a, b, n in zip(first[:-1], first[1:], norms)]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            at, x = rows[i]
            gradient = y[i] * (w[at] @ x + w[-1]) - 1.0
            new = min(max(alpha[i] - gradient / (2.0 if len(at) else 1.0), 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                moved = max(moved, abs(step))
                alpha[i] = new
                w[at] += step * x
                w[-1] += step
        if moved < 1e-3:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", buckets: int = BUCKETS, fit_rows: int = FIT_ROWS) -> Model:
    """Learns from the labelled rows outside fold 1.

    The class ratios count all of those rows. The hinge-loss weights come from about ``fit_rows`` of them, dealt by a hash
    of the id to shards of about ``SHARD_ROWS``; each shard is one task and the mean of the weights is the model.
    """
    train = with_label(docs.select("doc_id", "text"), labels, label).where("__label is not null").where(fold() != 1)
    ratio, ones, zeros = _ratios(indicator_counts(train, buckets), buckets)
    if not ones or not zeros:
        return Model(np.zeros(buckets), ratio, 1.0 if ones >= zeros else -1.0)
    n = ones + zeros
    cost = {1: n / (2.0 * ones), -1: n / (2.0 * zeros)}
    shards = max(1, round(min(n, fit_rows) / SHARD_ROWS))
    key = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    sample = train.select("doc_id", "text", "__label", key.alias("u")).where(F.col("u") < min(1.0, fit_rows / n))
    sample = sample.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(shards)).cast("int")).drop("u")
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            bucket, first = _features(batch, buckets)
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(bucket, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("doc_id"), batch.column("__label"), lists], ["shard", "doc_id", "label", "buckets"])

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "label"])
        first = np.concatenate([[0], np.cumsum([len(x) for x in pdf["buckets"]])]).astype(np.int64)
        bucket = np.concatenate([*pdf["buckets"], np.zeros(0, np.int32)]).astype(np.int64)
        y = np.where(pdf["label"] == 1, 1, -1)
        limit = np.array([cost[int(c)] for c in y])
        w = dual_coordinate_descent(bucket, first, y, shared.value, limit, EPOCHS, int(pdf["shard"].iloc[0]))
        some = np.flatnonzero(w)
        return pd.DataFrame({"bucket": some, "w": w[some], "n": len(pdf)})

    made = sample.mapInArrow(features, "shard int, doc_id bigint, label int, buckets array<int>")
    parts = made.groupBy("shard").applyInPandas(shard, "bucket bigint, w double, n bigint")
    mean = parts.groupBy("bucket").agg((F.sum("w") / F.lit(shards)).alias("w")).collect()  # at most buckets + 1 rows
    w = np.zeros(buckets + 1)
    for bucket, value in mean:
        w[bucket] = value
    return Model(w[:-1], ratio, float(w[-1]))


def quality_scores(docs: DataFrame, labels: DataFrame, label: str = "quality", buckets: int = BUCKETS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Only the text is an input of the score: the margin over the distinct n-grams of the whole text, scaled as in training
    and divided by the row's length, put through a logistic curve. ``held_out`` marks fold 1, whose labels are not learned
    from. A null or empty text is scored by the intercept alone; a null id is in no fold (``held_out`` false) and is not
    learned from. Ids with contradicting labels are not learned from; without rows of both classes every row gets the
    class there is. Repeated rows come out repeated, further columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    model = fit(docs, labels, label, buckets, fit_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, scale, intercept = shared.value
        for batch in W.slices(batches):
            bucket, first = _features(batch, buckets)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
            x = scale[bucket]
            norm = np.sqrt(np.maximum(np.bincount(owner, x * x, minlength=batch.num_rows), 1e-12))
            margin = np.bincount(owner, x * weights[bucket], minlength=batch.num_rows) / norm + intercept
            p = 1.0 / (1.0 + np.exp(-2.0 * margin))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    scored = docs.mapInArrow(score, "doc_id bigint, score double, predicted int")
    return scored.select("doc_id", F.coalesce(fold() == 1, F.lit(False)).alias("held_out"), "score", "predicted")
