"""Quality rules: counted base rules, and a log-likelihood ratio of hashed n-grams between trusted texts and the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from . import words as W
from .labelled import with_label

BUCKETS = 1 << 16
#: The cut where no labelled document says what is bad; else the labels decide (``label_cut``).
THRESHOLD = -0.08
#: Scores of labelled documents are counted in steps of this width.
STEP = 1 / 2048
#: A pseudo-count of this many n-grams per bucket, dealt out as the corpus is.
PRIOR = 5.0
SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"


def _grams(h: np.ndarray, spans: W.Spans, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and the document of each."""
    pairs = W.windows_inside(spans, 2)
    owners = spans.owners()
    two = W.pair_hash(h[pairs], h[pairs + 1], 7) if len(pairs) else h[:0]
    return (np.concatenate([h, two]) % W.U(buckets)).astype(np.int64), np.concatenate([owners, owners[pairs]])


def measures(data: np.ndarray, offsets: np.ndarray, spans: W.Spans, h: np.ndarray) -> list[np.ndarray]:
    """The columns of ``MEASURES``."""
    space = W.IS_SPACE[data]
    chars = W.per_document(~space & ((data & 0xC0) != 0x80), offsets)
    symbols = W.per_document(SYMBOLS[data], offsets)
    lines = W.line_spans(data, offsets)
    filled = np.searchsorted(spans.starts, lines.ends) > np.searchsorted(spans.starts, lines.starts)
    owners = lines.owners()[filled]
    keys = W.mix(W.hash_spans(data, lines, 3)[filled] ^ W.mix(owners.astype(W.U)))
    distinct = np.unique(keys, return_index=True)[1]
    n = len(offsets) - 1
    dup = np.bincount(owners, minlength=n) - np.bincount(owners[distinct], minlength=n)
    at = W.windows_inside(spans, 3)
    keys = W.window_hash(h, 3, 5)[at] if len(at) else h[:0]
    at = at[W.repeated(W.mix(keys ^ W.mix(spans.owners()[at].astype(W.U))))]
    covered = np.zeros(len(h), dtype=bool)
    for i in range(3):
        covered[at + i] = True
    return [spans.counts, chars, symbols, dup, W.per_document(covered, spans.first)]


def gram_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, raw, trusted``: n-gram counts of all documents and of those with ``__label`` = 1.

    Every task sums its own documents first, so what is shuffled is at most ``buckets`` rows a task.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, trusted = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        for batch in W.slices(batches):
            data, offsets = W.column_bytes(batch.column("text"))
            spans = W.word_spans(data, offsets)
            gram, owner = _grams(W.hash_spans(data, spans), spans, buckets)
            good = batch.column("__label").fill_null(0).to_numpy(zero_copy_only=False) == 1
            raw += np.bincount(gram, minlength=buckets)
            trusted += np.bincount(gram[good[owner]], minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(trusted[some])], ["bucket", "raw", "trusted"])

    counts = docs.select("text", "__label").mapInArrow(count, "bucket bigint, raw bigint, trusted bigint")
    return counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))


class Ratios:
    """Per bucket the trusted count and the corpus share, and the log of the trusted share over the corpus share."""

    def __init__(self, share: np.ndarray, trusted: np.ndarray, prior: float):
        self.share, self.trusted, self.total, self.prior = share, trusted, trusted.sum(), prior * len(share)
        self.log = self.of(np.arange(len(share)), 0, 0)

    def of(self, gram: np.ndarray, own: np.ndarray | int, size: np.ndarray | int) -> np.ndarray:
        """The log ratios of ``gram`` after ``own`` of its trusted counts and ``size`` of all of them are taken away."""
        share = self.share[gram]
        return np.log((self.trusted[gram] - own + self.prior * share) / (self.total - size + self.prior) / share)

    def scores(self, gram: np.ndarray, owner: np.ndarray, good: np.ndarray) -> np.ndarray:
        """The mean log ratio of every document; those that are ``good`` are measured without their own counts."""
        n = len(good)
        size = np.bincount(owner, minlength=n)
        value = self.log[gram]
        mine = np.flatnonzero(good[owner])
        _, at, own = np.unique(owner[mine] * len(self.share) + gram[mine], return_inverse=True, return_counts=True)
        value[mine] = self.of(gram[mine], own[at], size[owner[mine]])
        return np.bincount(owner, value, minlength=n) / np.maximum(size, 1)


def log_ratios(counts: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> Ratios:
    """The ratios of the counted n-grams; at most ``buckets`` rows reach the driver."""
    raw, trusted = np.zeros(buckets), np.zeros(buckets)
    at, *both = (c.to_numpy() for c in counts.toArrow().columns)
    raw[at], trusted[at] = both
    share = (raw + 1) / (raw.sum() + buckets)
    return Ratios(share, trusted, prior)


def label_cut(scored: DataFrame) -> float:
    """The cut that the labelled documents which pass the base rules ask for.

    It makes the share of good documents under it plus the share of bad documents from it up least (the lowest of equal
    ones), and lies halfway to the next lower score of a labelled document. Without a bad document it is ``THRESHOLD``, or
    the least score of a good one if that is lower; without a good one it is ``THRESHOLD``. What reaches the driver is one
    row per occupied step of ``STEP``.
    """
    steps = scored.where("not base_failed and __label in (0, 1)").groupBy(F.floor(F.col("llr") / STEP).alias("step"))
    rows = sorted(steps.agg(F.sum("__label"), F.sum(1 - F.col("__label"))).collect())
    step, good, bad = np.array(rows, dtype=np.int64).reshape(-1, 3).T
    if not good.any():
        return THRESHOLD
    if not bad.any():
        return min(THRESHOLD, float(step[0] * STEP))
    below = (np.cumsum(good) - good) / good.sum()
    above = (bad.sum() - np.cumsum(bad) + bad) / bad.sum()
    at = int(np.argmin(np.round(below + above, 12)))
    low = step[at - 1] + 1 if at else step[at]
    return float((low + step[at]) / 2 * STEP)


def quality_rules(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): the base counts, ``base_failed``, ``llr`` and ``kept``.

    Words and word pairs are hashed to ``buckets``; their counts over all documents (the corpus) and over the documents
    labelled ``quality = 1`` (the trusted target) are two multinomials. ``llr`` is the mean over a document's n-grams of the
    log ratio of the two, so long and short texts are measured alike. A trusted document is measured without its own counts
    in the target, so that its score says what an unlabelled document like it would get. A document is kept unless
    ``base_failed`` or ``llr`` is under ``threshold``, by default the cut of ``label_cut``, as the scale of ``llr`` follows
    the size and the coverage of the target. ``base_failed`` is ``n_words < 50 or 100 * n_repeat_words > 50 * n_words``.

    A null or empty text has no words, ``llr`` 0 and fails the base rules. Without a trusted document every ``llr`` is 0. A
    null id counts in the corpus and comes out as it is; repeated rows come out repeated. Further columns are ignored.
    """
    marked = with_label(docs.select("doc_id", "text"), labels, "quality")
    shared = docs.sparkSession.sparkContext.broadcast(log_ratios(gram_counts(marked, buckets), buckets))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratios = shared.value
        for batch in W.slices(batches):
            data, offsets = W.column_bytes(batch.column("text"))
            spans = W.word_spans(data, offsets)
            h = W.hash_spans(data, spans)
            base = measures(data, offsets, spans, h)
            gram, owner = _grams(h, spans, buckets)
            label = batch.column("__label")
            llr = ratios.scores(gram, owner, label.fill_null(0).to_numpy(zero_copy_only=False) == 1)
            failed = (base[0] < 50) | (100 * base[4] > 50 * base[0])
            columns = [*(pa.array(x.astype(np.int64)) for x in base), pa.array(failed), pa.array(llr), label]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    schema = f"doc_id {marked.schema['doc_id'].dataType.simpleString()}, {MEASURES}, base_failed boolean, llr double, __label int"
    names = [x.split()[0] for x in schema.split(", ")]
    path = scratch_path(docs.sparkSession, "quality")
    marked.mapInArrow(score, schema).write.parquet(path)  # without the texts
    scored = docs.sparkSession.read.parquet(path)
    cut = label_cut(scored) if threshold is None else threshold
    return scored.drop("__label").withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(cut)))


def quality_stage(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose document is kept, with all their columns as they were.

    Ids that are null are dropped with the documents that fail. An id that repeats with different texts is kept if any of
    them is.
    """
    kept = quality_rules(docs, labels).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"] == kept["__kept"], "left_semi")
