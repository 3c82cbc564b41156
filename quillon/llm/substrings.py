"""Substring dedup by recompression: repeated windows of words are found through symbols that equal texts share.

The words of a text are its first symbols. A round names maximal runs of one symbol, then every pair of a "left" and a "right"
symbol, the side being a hash bit of the symbol; names are hashes of their parts, so all tasks and all rounds agree on them
without a shuffle. Each symbol carries its *context*: the words that settle that it stands there, whatever surrounds them.
Equal windows therefore hold the same symbols wherever the context lies inside the window.

Every window is filed under one such symbol, the one with the least hash among the highest level that has any. Windows in a
row filed under one occurrence travel as one row, keyed by the hash of the occurrence's context words (about nine words at the
second level), so only texts that share those words meet; there the windows are compared by 64 further bits of hash. A task
first settles the copies among its own texts, so that a passage that a third of the corpus repeats sends one row from each slice
of texts. Keys are counted before: the windows of a key that a large part of the corpus shares travel one by one, keyed by the
window itself, so that no task holds such a key whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import words as W
from .ids import numbered, set_aside

WIDTH = 20
ROUNDS = 2
HASH_BYTES = 8  # of a window, beside the 64 bits of its key
COUNTERS = 1 << 16  # keys are counted by their low bits, so a count is never too low
HOT_WINDOWS = 1 << 14  # a key is hot from so many windows, and from HOT_SHARE times the mean of the counters
HOT_SHARE = 8
MARK_BITS = 1 << 26  # of the bitmap of documents with repeated windows; others may be taken for one, never the reverse
_BASE = 0x9E3779B97F4A7C15 | 1


class Symbols:
    """The symbols of one level, in text order: name, first word, document, and context ``[low, high)`` in words."""

    def __init__(self, name, start, doc, low, high, first):
        self.name, self.start, self.doc, self.low, self.high, self.first = name, start, doc, low, high, first

    def _neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """Context start of the symbol before and context end of the symbol after; outside the document at its ends."""
        low, high, first, doc = self.low, self.high, self.first, self.doc
        same = doc[1:] == doc[:-1]
        before, after = first[doc] - 1, first[doc + 1] + 1
        before[1:][same] = low[:-1][same]
        after[:-1][same] = high[1:][same]
        return before, after

    def runs(self, salt: int) -> "Symbols":
        """Maximal runs of one symbol become one symbol; single ones stay. Both neighbours settle where a run ends."""
        n = len(self.name)
        head = np.ones(n, dtype=bool)
        head[1:] = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        at = np.flatnonzero(head)
        last = np.append(at[1:], n) - 1
        length = (last - at + 1).astype(W.U)
        before, after = self._neighbours()
        name = np.where(length > 1, W.pair_hash(self.name[at], length, salt), self.name[at])
        return Symbols(name, self.start[at], self.doc[at], before[at], after[last], self.first)

    def pairs(self, salt: int) -> "Symbols":
        """A left symbol followed by a right one becomes one symbol; the others stay, settled by the neighbour they lack."""
        left = W.mix(self.name ^ W.U(salt * 0x51ED270B + 1)) >> W.U(63) == 0
        pair = np.zeros(len(left), dtype=bool)
        pair[:-1] = left[:-1] & ~left[1:] & (self.doc[1:] == self.doc[:-1])
        before, after = self._neighbours()
        name = self.name.copy()
        at = np.flatnonzero(pair)
        name[at] = W.pair_hash(self.name[at], self.name[at + 1], salt)
        low, high = np.where(left, self.low, before), np.where(left, after, self.high)
        keep = np.ones(len(left), dtype=bool)
        keep[at + 1] = False
        return Symbols(name[keep], self.start[keep], self.doc[keep], low[keep], high[keep], self.first)


class Prefix:
    """Hashes of any stretch of words from one pass: a polynomial with an odd base, whose powers can be divided out."""

    def __init__(self, h: np.ndarray):
        n = len(h)
        self.inverse = np.ones(n + 1, dtype=W.U)
        self.inverse[1:] = pow(_BASE, -1, 1 << 64)
        np.multiply.accumulate(self.inverse, out=self.inverse)
        powers = np.ones(n + 1, dtype=W.U)
        powers[1:] = _BASE
        np.multiply.accumulate(powers, out=powers)
        self.total = np.zeros(n + 1, dtype=W.U)
        np.cumsum(h * powers[:n], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return W.mix((self.total[end] - self.total[start]) * self.inverse[start])


def _least(keys: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The place of the least key in ``first .. last`` (the leftmost of equals), by a table of power-of-two ranges."""
    out = np.zeros(len(first), dtype=np.int64)
    span = last - first + 1
    best, width = np.arange(len(keys)), 1
    top = int(span.max(initial=0))
    while width <= top:
        mine = np.flatnonzero((span >= width) & (span < 2 * width))
        a, b = best[first[mine]], best[last[mine] - width + 1]
        out[mine] = np.where(keys[a] <= keys[b], a, b)
        if 2 * width <= top:
            a, b = best[:-width], best[width:]
            best = np.where(keys[a] <= keys[b], a, b)
        width *= 2
    return out


def anchors(h: np.ndarray, first: np.ndarray, width: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Prefix]:
    """For every window of ``width`` words inside a document: its start, the key it is filed under and the word of its anchor."""
    prefix = Prefix(h)
    n = len(h)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    words = np.arange(n)
    level = Symbols(h, words, doc, words, words + 1, first)
    levels = [level]
    for r in range(rounds):
        level = level.runs(2 * r + 1).pairs(2 * r + 2)
        levels.append(level)
    ok = np.zeros(n, dtype=bool)
    size = np.diff(first)[doc]
    ok[words - first[doc] <= size - width] = True
    windows = np.flatnonzero(ok)
    key, place = np.zeros(len(windows), dtype=W.U), np.zeros(len(windows), dtype=np.int64)
    todo = np.arange(len(windows))
    for depth in range(rounds, -1, -1):
        level = levels[depth]
        if not len(todo):
            break
        low, high = np.clip(level.low, 0, n), np.clip(level.high, 0, n)
        keys = W.pair_hash(prefix.of(low, high), (level.start - level.low).astype(W.U) * W.U(64) + W.U(depth), 31)
        begins = np.concatenate([[0], np.cumsum(np.bincount(np.clip(level.low, -1, n) + 1, minlength=n + 2))])
        ends = np.cumsum(np.bincount(np.clip(level.high, 0, n + 1), minlength=n + 2))
        w = windows[todo]
        a, b = begins[w + 1], ends[w + width] - 1  # contexts that begin at w or later, and end at w + width or before
        has = a <= b
        at = _least(keys, a[has], b[has])
        key[todo[has]], place[todo[has]] = keys[at], level.start[at]
        todo = todo[~has]
    return windows, key, place, prefix


def _counter(key: np.ndarray) -> np.ndarray:
    return (key & W.U(COUNTERS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], width: int, rounds: int) -> Iterator[pa.RecordBatch]:
    """``counter, n``: the windows of a task by the low bits of their key."""
    total = np.zeros(COUNTERS, dtype=np.int64)
    for batch in W.slices(batches):
        data, offsets = W.column_bytes(batch.column("text"))
        spans = W.word_spans(data, offsets)
        total += np.bincount(_counter(anchors(W.hash_spans(data, spans, 23), spans.first, width, rounds)[1]), minlength=COUNTERS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["counter", "n"])


def hot_counters(docs: DataFrame, width: int, rounds: int, least: int = HOT_WINDOWS) -> np.ndarray:
    """True for the counters of keys that must be dealt out; at most ``COUNTERS`` rows reach the driver."""
    counts = docs.select("text").mapInArrow(lambda b: _count(b, width, rounds), "counter bigint, n bigint")
    total = np.zeros(COUNTERS, dtype=np.int64)
    counter, n = (c.to_numpy() for c in counts.groupBy("counter").agg(F.sum("n")).toArrow().columns)
    total[counter] = n
    return total >= max(least, HOT_SHARE * total.mean())


def _file(batches: Iterator[pa.RecordBatch], width: int, rounds: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows ``key, id, at, n, hashes``: ``n`` windows from word ``at`` on, filed under one anchor, or a single window under
    its own hash where the anchor is ``hot``. Rows without hashes are windows with an earlier copy in the same slice of
    texts."""
    for batch in W.slices(batches):
        data, offsets = W.column_bytes(batch.column("text"))
        spans = W.word_spans(data, offsets)
        windows, key, place, prefix = anchors(W.hash_spans(data, spans, 23), spans.first, width, rounds)
        if not len(windows):
            continue
        hashes = prefix.of(windows, windows + width).astype("<u8")
        alone = hot[_counter(key)]
        key[alone] = W.pair_hash(key[alone], hashes[alone], 41)
        head = np.ones(len(windows), dtype=bool)
        head[1:] = (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1) | (key[1:] != key[:-1])
        begin = np.flatnonzero(head)
        n = np.diff(np.append(begin, len(windows)))
        at = windows[begin]
        doc = np.searchsorted(spans.first, at, side="right") - 1
        ids = batch.column("__id").to_numpy()[doc]
        content = W.pair_hash(prefix.of(at, at + n + width - 1), key[begin], 37)
        order = np.lexsort((at, ids, content))
        copy = np.zeros(len(at), dtype=bool)
        copy[order[1:]] = content[order[1:]] == content[order[:-1]]
        packed = hashes[np.repeat(~copy, n)].tobytes()
        sizes = np.where(copy, 0, n) * HASH_BYTES
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        valid = pa.py_buffer(np.packbits(~copy, bitorder="little").tobytes())
        binary = pa.Array.from_buffers(pa.binary(), len(at), [valid, pa.py_buffer(bounds.tobytes()), pa.py_buffer(packed)])
        keys = np.where(copy, W.mix(ids.astype(W.U) + at.astype(W.U)), key[begin]).view(np.int64)
        columns = [pa.array(keys), pa.array(ids), pa.array((at - spans.first[doc]).astype(np.int32)), pa.array(n.astype(np.int32)), binary]
        yield pa.RecordBatch.from_arrays(columns, ["key", "id", "at", "n", "hashes"])


def _settle(table: pa.Table) -> pa.RecordBatch:
    """Of whole keys: the windows with an earlier equal window, as ``id, at, n``."""
    table = table.combine_chunks()
    key, ids, at, n = (table.column(c).to_numpy() for c in ("key", "id", "at", "n"))
    settled = table.column("hashes").combine_chunks().is_null().to_numpy(zero_copy_only=False)
    out = [(ids[settled], at[settled], n[settled])]
    open_rows = np.flatnonzero(~settled)
    k = key[open_rows]
    group = np.cumsum(np.concatenate([[0], k[1:] != k[:-1]])) if len(k) else k
    shared = np.bincount(group)[group] > 1 if len(k) else np.zeros(0, dtype=bool)
    rows, group = open_rows[shared], group[shared] if len(k) else group
    if len(rows):
        raw = b"".join(table.column("hashes").take(pa.array(rows)).to_pylist())
        hashes = np.frombuffer(raw, dtype="<u8")
        owner = np.repeat(np.arange(len(rows)), n[rows])
        first = np.cumsum(n[rows]) - n[rows]
        start = at[rows][owner] + (np.arange(len(owner)) - first[owner])
        order = np.lexsort((start, ids[rows][owner], hashes, group[owner]))
        later = np.zeros(len(owner), dtype=bool)
        later[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (group[owner[order[1:]]] == group[owner[order[:-1]]])
        head = later.copy()
        head[1:] &= ~later[:-1] | (owner[1:] != owner[:-1])
        begin = np.flatnonzero(head)
        stretch = np.cumsum(head) - 1
        count = np.bincount(stretch[later], minlength=len(begin)) if len(begin) else begin
        out.append((ids[rows][owner[begin]], start[begin], count))
    columns = [np.concatenate(x) for x in zip(*out)]
    return pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1].astype(np.int32)), pa.array(columns[2].astype(np.int32))], ["id", "at", "n"])


GROUPS = 1 << 22  # rows settled together at most


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; the rows of the last key wait for the next batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        for start in range(0, batch.num_rows, GROUPS):
            part = batch.slice(start, GROUPS)
            keys = part.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut or (held and held[-1].column("key")[-1].as_py() != keys[0]):
                yield _settle(pa.Table.from_batches([*held, part.slice(0, cut)]))
                held = []
            held.append(part.slice(cut))
    if held:
        yield _settle(pa.Table.from_batches(held))


def repeated_windows(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS, hot_windows: int = HOT_WINDOWS) -> DataFrame:
    """``id, at, n`` over ``docs`` (``__id, text``): the ``n`` windows of ``width`` words from word ``at`` on start earlier too,
    in a document of smaller id or before in the same one."""
    hot = hot_counters(docs, width, rounds, hot_windows)
    filed = docs.select("__id", "text").mapInArrow(lambda b: _file(b, width, rounds, hot), "key bigint, id bigint, at int, n int, hashes binary")
    met = filed.repartition("key").sortWithinPartitions("key")
    return met.mapInArrow(_settled, "id bigint, at int, n int")


def _cut(batches: Iterator[pa.RecordBatch], width: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Removes the covered words of each text."""
    for batch in W.slices(batches):
        texts = batch.column("text")
        data, offsets = W.column_bytes(texts)
        spans = W.word_spans(data, offsets)
        lists = batch.column("__spans")
        sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        at, n = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "n"))
        begin = np.repeat(spans.first[:-1], sizes) + at
        edge = np.zeros(len(spans.starts) + 1, dtype=np.int64)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + n + width - 1, -1)
        gone = np.cumsum(edge[:-1]) > 0
        removed = W.per_document(gone, spans.first)
        kept = np.flatnonzero(~gone)
        length = spans.ends[kept] - spans.starts[kept] + 1  # with the space after it
        stops = np.cumsum(length)
        index = np.repeat(spans.starts[kept] - (stops - length), length) + np.arange(stops[-1] if len(stops) else 0)
        joined = np.append(data, np.uint8(32))[index]
        joined[stops - 1] = 32
        bounds = np.concatenate([[0], stops])[np.searchsorted(kept, spans.first)]
        whole = memoryview(joined.tobytes())
        shas = [hashlib.sha256(whole[a : max(a, b - 1)]).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        values = texts.to_pylist()
        after = np.append(spans.starts[1:], len(data))
        after[spans.first[1:][spans.counts > 0] - 1] = offsets[1:][spans.counts > 0]
        for d in np.flatnonzero(removed):
            a, b = spans.first[d], spans.first[d + 1]
            keep = np.ones(offsets[d + 1] - offsets[d], dtype=bool)
            for i in np.flatnonzero(gone[a:b]) + a:
                keep[spans.starts[i] - offsets[d] : after[i] - offsets[d]] = False
            values[d] = data[offsets[d] : offsets[d + 1]][keep].tobytes().decode()
        made = {"text": pa.array(values, pa.string()), "n_words": pa.array(spans.counts.astype(np.int64)), "n_removed": pa.array(removed), "kept_sha256": pa.array(shas, pa.string())}
        yield pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in names], names)


ADDED = {"n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"}


def _bit(id: str, bits: int) -> tuple[Column, Column]:
    """The word and the bit of a bitmap that an id's hash has."""
    place = F.pmod(F.xxhash64(id), F.lit(bits))
    return F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")


def substring_dedup(docs: DataFrame, width: int = WIDTH, rounds: int = ROUNDS, mark_bits: int = MARK_BITS) -> DataFrame:
    """``docs`` without the words that lie in a window of ``width`` words that starts earlier too; ``ADDED`` columns appended.

    Words are runs of characters outside space and 0x09-0x0D. A window's copy is earlier if its document has a smaller
    ``doc_id`` or it starts before in the same document; all windows are judged on the input. ``text`` loses every such word
    and the white space after it and is untouched elsewhere; ``kept_sha256`` is over the kept words joined by one space.

    A null text has no words and stays null. Repeated ids are told apart by their text, null ids come last, and of wholly
    repeated rows all but one lose their windows. Other columns pass through, whatever their names; columns named like the
    added ones are replaced. An empty table gives an empty table.
    """
    docs = docs.drop(*ADDED)
    given, docs = docs.columns, set_aside(docs, "doc_id", "text")
    rows = numbered(docs)
    found = repeated_windows(rows, width, rounds)
    spans = cut_lineage(found.groupBy(F.col("id").alias("__key")).agg(F.collect_list(F.struct("at", "n")).alias("__spans")))
    # Most documents have no repeated window; a bitmap of those that have, of a fixed size, keeps the other texts out of
    # the shuffle. It is broadcast as rows of 64 bits, at most mark_bits / 64 of them.
    word, bit = _bit("__key", mark_bits)
    marks = cut_lineage(spans.select(word.alias("__w"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("b")).groupBy("__w").agg(F.bit_or("b").alias("__b")))
    word, bit = _bit("__id", mark_bits)
    placed = rows.withColumn("__at", word).join(F.broadcast(marks), F.col("__at") == F.col("__w"), "left").drop("__at", "__w")
    marked = F.call_function("shiftrightunsigned", F.coalesce("__b", F.lit(0).cast("bigint")), bit).bitwiseAND(F.lit(1)) == 1
    some, rest = placed.where(marked).drop("__b"), placed.where(~marked).drop("__b")
    joined = some.join(spans, F.col("__id") == F.col("__key"), "left").drop("__id", "__key")
    joined = joined.unionByName(rest.drop("__id").withColumn("__spans", F.lit(None).cast(spans.schema["__spans"].dataType)))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"{k} {v}" for k, v in ADDED.items()]
    names = [*docs.columns, *ADDED]
    return joined.mapInArrow(lambda b: _cut(b, width, names), ", ".join(fields)).toDF(*given, *ADDED)


def substring_stage(docs: DataFrame) -> DataFrame:
    """The documents without repeated windows; those that lose all their words go. Columns as they were."""
    out = substring_dedup(set_aside(docs, "doc_id", "text"))
    return out.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words"))).drop(*ADDED).toDF(*docs.columns)


def substring_query(docs: DataFrame) -> DataFrame:
    return substring_dedup(docs.select("doc_id", "text")).select("doc_id", *ADDED)
