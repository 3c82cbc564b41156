"""Fill-in-the-middle: a compressed set of unit boundaries gives the byte offsets of both cuts of every text."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .ids import set_aside

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts of 100 that are rewritten, and of those the ones that give the suffix first.
REWRITTEN, SUFFIX_FIRST = 90, 20
SPAN = 1 << 16
ARRAY_LIMIT = 4096
PLACED = "n bigint, form string, prefix_units bigint, middle_units bigint, output string"


class Array(NamedTuple):
    """Few members of a span: their low 16 bits."""

    low: np.ndarray

    def select(self, k: np.ndarray) -> np.ndarray:
        return self.low[k].astype(np.int64)


class Bitmap(NamedTuple):
    """Many members: one bit each, with the number of bits before every byte."""

    bits: np.ndarray
    before: np.ndarray

    def select(self, k: np.ndarray) -> np.ndarray:
        byte = np.searchsorted(self.before, k, side="right") - 1
        left = k - self.before[byte]
        ones = np.cumsum(np.unpackbits(self.bits[byte][:, None], axis=1, bitorder="little"), axis=1)
        return byte * 8 + np.argmax(ones > left[:, None], axis=1)


class Runs(NamedTuple):
    """Consecutive members: first member of every run, with the number of members before it."""

    first: np.ndarray
    before: np.ndarray

    def select(self, k: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, k, side="right") - 1
        return self.first[run].astype(np.int64) + k - self.before[run]


def container(low: np.ndarray):
    """The smallest of the three forms for the sorted members ``low`` (0 to 65,535) of one span."""
    starts = np.flatnonzero(np.diff(low, prepend=-2) != 1)
    if 4 * len(starts) <= min(2 * len(low), SPAN // 8):
        return Runs(low[starts].astype(np.uint16), starts.astype(np.int64))
    if len(low) <= ARRAY_LIMIT:
        return Array(low.astype(np.uint16))
    flags = np.zeros(SPAN, dtype=np.uint8)
    flags[low] = 1
    bits = np.packbits(flags, bitorder="little")
    return Bitmap(bits, np.cumsum(np.bitwise_count(bits), dtype=np.int64) - np.bitwise_count(bits))


class BoundarySet:
    """Sorted positions, cut by their upper bits into containers; ``total`` counts the members up to each container."""

    def __init__(self, positions: np.ndarray):
        edges = np.flatnonzero(np.diff(positions >> 16, prepend=-1))
        self.high = positions[edges] >> 16
        self.parts = [container(p & (SPAN - 1)) for p in np.split(positions, edges[1:])] if len(positions) else []
        self.total = np.append(edges[1:], len(positions))

    def select(self, k: np.ndarray) -> np.ndarray:
        """The members of rank ``k`` (from 0): the container by the cumulative counts, then a select inside it."""
        out = np.empty(len(k), dtype=np.int64)
        part = np.searchsorted(self.total, k, side="right")
        order = np.argsort(part, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(k) else []:
            c = int(part[rows[0]])
            out[rows] = (int(self.high[c]) << 16) + self.parts[c].select(k[rows] - (int(self.total[c - 1]) if c else 0))
        return out


def boundaries(data: np.ndarray, offsets: np.ndarray, unit: str) -> np.ndarray:
    """Where a unit begins in the bytes of all texts, and their end.

    ``char`` units are code points. A ``word`` unit is a word with the white space after it; white space before the first
    word belongs to the first unit.
    """
    if unit == "char":
        first = (data & 0xC0) != 0x80
    elif unit == "word":
        spans = W.word_spans(data, offsets)
        first = np.zeros(len(data), dtype=bool)
        first[spans.starts] = True
        first[spans.starts[spans.first[:-1][spans.counts > 0]]] = False
        first[offsets[:-1][np.diff(offsets) > 0]] = True
    else:
        raise ValueError(f"unit {unit!r}")
    return np.append(np.flatnonzero(first), len(data))


def _rewrite(batches: Iterator[pa.RecordBatch], unit: str, rewritten: int, suffix_first: int) -> Iterator[pa.RecordBatch]:
    for batch in W.slices(batches):
        texts = pc.fill_null(batch.column("text"), "")
        data, offsets = W.column_bytes(texts)
        places = boundaries(data, offsets, unit)
        base = np.searchsorted(places, offsets)
        n = np.diff(base)
        h1, h2, h3, h4 = (batch.column(f"__h{i}").to_numpy() for i in range(1, 5))
        marked = np.zeros(len(n), dtype=bool)
        for mark in (PREFIX, SUFFIX, MIDDLE):
            marked |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
        plain = (n == 0) | marked | (h3 % 100 >= rewritten)
        form = np.where(plain, "plain", np.where(h4 % 100 < suffix_first, "spm", "psm"))
        a, b = h1 % (n + 1), h2 % (n + 1)
        one, two = np.minimum(a, b), np.maximum(a, b)
        known = BoundarySet(places)
        left, right = known.select(base[:-1] + one), known.select(base[:-1] + two)
        raw, out = data.tobytes(), []
        for i, kind in enumerate(form):
            start, x, y, end = int(offsets[i]), int(left[i]), int(right[i]), int(offsets[i + 1])
            p, m, s = raw[start:x], raw[x:y], raw[y:end]
            if kind == "plain":
                out.append(raw[start:end])
            elif kind == "psm":
                out.append(b"".join([PREFIX.encode(), p, SUFFIX.encode(), s, MIDDLE.encode(), m]))
            else:
                out.append(b"".join([SUFFIX.encode(), s, PREFIX.encode(), p, MIDDLE.encode(), m]))
        kept = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] not in ("text", "__h1", "__h2", "__h3", "__h4")]
        names = [c for c in batch.schema.names if c not in ("text", "__h1", "__h2", "__h3", "__h4")]
        made = [pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), pa.array(one, pa.int64(), mask=plain),
                pa.array(two - one, pa.int64(), mask=plain), pa.array(out, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays(kept + made, names + [x.split()[0] for x in PLACED.split(", ")])


def fill_in_middle(
    docs: DataFrame, id: str = "doc_id", text: str = "text", unit: str = "char", seed: int = 1,
    rewritten: int = REWRITTEN, suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n, form, prefix_units, middle_units, output``.

    A text of ``n`` units is cut at two of its ``n + 1`` boundaries, which the SHA-256 of ``seed:id`` draws. ``form`` is
    ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or ``plain`` (the text itself, counts null): empty
    texts, texts that hold a marker, and the share that the hash leaves alone. The cuts depend on the id alone, so a
    repeated row gives the same output, and a recomputed task the same rows.

    A null text counts as empty; a null id draws as an empty id. Texts are handled whole, however long, a few megabytes
    of texts at a time. Further columns are ignored, whatever their names. No rows meet, so nothing is shuffled.
    """
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring("__d", 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"__h{i + 1}") for i in range(4)]
    rows = rows.withColumn("__d", digest).select("doc_id", "text", *draws)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _rewrite(batches, unit, rewritten, suffix_first), f"doc_id {kind}, {PLACED}")


def restored(form: str = "form", output: str = "output") -> Column:
    """The original text, from ``form`` and ``output`` alone."""
    f, o = F.col(form), F.col(output)
    body = F.substr(o, F.lit(len(PREFIX) + 1))
    one = F.when(f == "psm", F.substring_index(body, SUFFIX, 1)).otherwise(F.substring_index(body, PREFIX, 1))
    tail = F.substr(body, F.length(one) + len(PREFIX) + 1)
    two = F.substring_index(tail, MIDDLE, 1)
    three = F.substr(tail, F.length(two) + len(MIDDLE) + 1)
    return F.when(f == "plain", o).when(f == "psm", F.concat(one, three, two)).otherwise(F.concat(two, three, one))


def fill_query(docs: DataFrame) -> DataFrame:
    """The digest of ``fill_in_middle`` over code points, with the texts rebuilt from the outputs."""
    made = fill_in_middle(set_aside(docs, "doc_id", "text"))
    return made.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored(), 256).alias("restored_sha256"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN t ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""
