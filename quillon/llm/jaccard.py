"""N-gram Jaccard join: documents whose sets of word shingles overlap by a given share, by a grouped prefix join.

* Texts with one and the same set are one *class*, named by its smallest id.
* Two sets that overlap enough share one of the first ``n - ceil(t n) + 1`` elements (the prefix) in any common order. Here the
  order is by frequency level, then hash, so shingles that many texts repeat come last and rarely enter a prefix.
* Classes with the same size and the same prefix are one *group*; only groups are posted under the elements of their prefix.
* Groups that meet under an element are expanded to their members, which are compared in blocks of bounded size by a bound: the
  bits in which two parity bitmaps differ are at most the elements in which the sets differ, so no linked pair is lost. Bitmaps
  grow with the sets, and the longer of two is folded to the shorter.
* What is left is verified on the sets themselves, in two rounds: first every member's nearest partner, then all pairs that these
  links have not connected already. Components are unaffected, and a cluster of near copies is not listed pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from . import words as W
from .ids import numbered
from .stars import star_components

SHINGLE = 3
PERCENT = 90
BITS = 512  # of the shortest bitmap; a set of n elements has between n and 2 n bits,
MOST_BITS = 4096  # but no more than these
SKETCH = 1 << 21  # buckets of the frequency sketch; it only orders elements, so collisions cost time and not results
BLOCK = 4096  # members of one element compared in a task at once
BROADCAST_IDS = 1_000_000  # candidate ids (8 MB) that may be sent to all executors; more are joined by a shuffle


def _shingles(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, and where each text's begin; a text with fewer words has one, the whole."""
    data, offsets = W.column_bytes(batch.column("text"))
    data = W.LOWER[data]
    spans = W.word_spans(data, offsets)
    h = W.hash_spans(data, spans, 41)
    counts = spans.counts
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(first[-1], dtype=W.U)
    at = np.repeat(spans.first[:-1] - first[:-1], sizes) + np.arange(first[-1])
    whole = np.repeat(counts >= width, sizes)
    if whole.any():
        out[whole] = W.window_hash(h, width, 43)[at[whole]]
    for d in np.flatnonzero((counts > 0) & (counts < width)):
        value = np.full(1, counts[d], dtype=W.U)
        for i in range(spans.first[d], spans.first[d + 1]):
            value = W.pair_hash(value, h[i : i + 1], 47)
        out[first[d]] = value[0]
    return out, first


def frequency_levels(docs: DataFrame, width: int, buckets: int) -> np.ndarray:
    """Per bucket of shingle hashes the binary order of its count where it stands out in some task, else 0.

    A task reports only buckets far above its mean, so few rows are shuffled and at most ``buckets`` reach the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int32)
        for batch in W.slices(batches):
            tokens, _ = _shingles(batch, width)
            total += np.bincount((tokens % W.U(buckets)).astype(np.int64), minlength=buckets).astype(np.int32)
        some = np.flatnonzero(total >= 4 + 3 * total.mean())
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some].astype(np.int64))], ["bucket", "n"])

    levels = np.zeros(buckets, dtype=np.uint8)
    rows = docs.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    if table.num_rows:
        levels[table.column("bucket").to_numpy()] = np.minimum(np.log2(table.column("n").to_numpy()), 63).astype(np.uint8)
    return levels


def features(docs: DataFrame, width: int, percent: int, buckets: int = SKETCH) -> DataFrame:
    """``id, n, f1, f2, g1, g2, prefix, bitmap`` of every text: set size, fingerprint, group, prefix elements, parity bits."""
    shared = docs.sparkSession.sparkContext.broadcast(frequency_levels(docs, width, buckets))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in W.slices(batches):
            tokens, first = _shingles(batch, width)
            order = levels[(tokens % W.U(buckets)).astype(np.int64)].astype(W.U) << W.U(58) | tokens >> W.U(6)
            one, two = W.mix(tokens ^ W.U(0x5BD1E995)), W.mix(tokens + W.U(0x27D4EB2F165667C5))
            rows = []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                own, at = np.unique(tokens[a:b], return_index=True)
                n = len(own)
                if not n:
                    rows.append((0, 0, 0, 0, 0, [], b""))
                    continue
                at += a
                p = n + (-percent * n // 100) + 1
                prefix = np.sort(order[at])[:p]
                bits = min(max(BITS, 1 << (n - 1).bit_length()), MOST_BITS)
                bitmap = np.packbits(np.bincount((own >> W.U(20)).astype(np.int64) % bits, minlength=bits) & 1)
                mixed = W.mix(prefix)
                rows.append((n, _signed(one[at].sum()), _signed(two[at].sum()), _signed(mixed.sum()), _signed(W.mix(mixed + W.U(n)).sum()), prefix.view(np.int64), bitmap.tobytes()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), *columns], names)

    types = [pa.int64()] * 5 + [pa.list_(pa.int64()), pa.binary()]
    names = ["id", "n", "f1", "f2", "g1", "g2", "prefix", "bitmap"]
    return docs.select("__id", "text").mapInArrow(run, "id bigint, n bigint, f1 bigint, f2 bigint, g1 bigint, g2 bigint, prefix array<bigint>, bitmap binary")


def _signed(x: np.uint64) -> int:
    x = int(x)
    return x - (1 << 64) if x >> 63 else x


def _whole_keys(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Batches sorted by ``keys`` as tables that end where a key ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy() for k in keys]
        change = np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0))
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut or (held and any(held[-1].column(k)[-1].as_py() != v[0] for k, v in zip(keys, values))):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).combine_chunks()
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


class _Bitmaps:
    """Bitmaps of several lengths, compared at the shorter length: the halves of a longer one are added bit by bit."""

    def __init__(self, raw: list[bytes]):
        self.length = np.array([len(x) for x in raw])
        self.place = np.zeros((len(raw), 2), dtype=np.int64)  # in the table of the own length, and of half of it
        self.tables = {}
        for length in np.unique(self.length):
            own, twice = np.flatnonzero(self.length == length), np.flatnonzero(self.length == 2 * length)
            table = np.frombuffer(b"".join([raw[i] for i in own]), dtype="<u8").reshape(len(own), length // 8)
            folded = np.frombuffer(b"".join([raw[i] for i in twice]), dtype="<u8").reshape(len(twice), length // 4)
            half = length // 8
            self.tables[int(length)] = np.concatenate([table, folded[:, :half] ^ folded[:, half:]]) if len(twice) else table
            self.place[own, 0] = np.arange(len(own))
            self.place[twice, 1] = len(own) + np.arange(len(twice))

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Differing bits of rows ``i`` and ``j``, where ``j`` has as many bits as ``i`` or twice as many (else 0)."""
        out = np.zeros(len(i), dtype=np.int64)
        for length, table in self.tables.items():
            for fold in (0, 1):
                at = np.flatnonzero((self.length[i] == length) & (self.length[j] == length << fold))
                if len(at):
                    out[at] = np.bitwise_count(table[self.place[i[at], 0]] ^ table[self.place[j[at], fold]]).sum(axis=1, dtype=np.int64)
        return out


def _compare(batches: Iterator[pa.RecordBatch], percent: int, nearest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of members of one block pair that the sizes and bitmaps don't exclude, as ``a < b``.

    ``nearest``: for each member only the pair with the fewest differing bits among those of smaller id, and a row
    ``(null, token)`` for every element that has more pairs than those. Otherwise all pairs whose components differ.
    """
    keys = ["token", "lo", "hi"]
    for table in _whole_keys(batches, keys):
        n, ids, block, component = (table.column(c).to_numpy() for c in ("n", "id", "block", "component"))
        lo, hi = table.column("lo").to_numpy(), table.column("hi").to_numpy()
        bits = _Bitmaps(table.column("bitmap").to_pylist())
        change = np.any([table.column(k).to_numpy()[1:] != table.column(k).to_numpy()[:-1] for k in keys], axis=0)
        group = np.concatenate([[0], np.cumsum(change)])
        best = np.full(len(n), 1 << 62, dtype=np.int64)  # per row: differing bits, then the partner's row
        found = [np.zeros((2, 0), dtype=np.int64)]
        met = np.zeros(len(n), dtype=np.int64)  # pairs of each row, as the one of larger id
        # Rows are sorted by size in a group: row i meets the rows after it while these are small enough.
        end = np.searchsorted(group, group, side="right")
        rows, step = np.arange(len(n)), 1
        while len(rows):
            rows = rows[rows + step < end[rows]]
            rows = rows[100 * n[rows] >= percent * n[rows + step]]
            for a in range(0, len(rows), 1 << 14):
                i = rows[a : a + (1 << 14)]
                j = i + step
                ok = (component[i] != component[j]) & ((lo[i] == hi[i]) | (block[i] != block[j]))
                i, j = i[ok], j[ok]
                differ = bits.differ(i, j)
                ok = (100 + percent) * differ <= (100 - percent) * (n[i] + n[j])
                i, j, differ = i[ok], j[ok], differ[ok]
                swap = ids[i] > ids[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                if nearest:
                    np.minimum.at(best, j, differ << 32 | i)
                    met += np.bincount(j, minlength=len(n))
                else:
                    found.append(np.unique(np.stack([ids[i], ids[j]]), axis=1))
            step += 1
        if nearest:
            j = np.flatnonzero(best < 1 << 62)
            found.append(np.stack([ids[best[j] & 0xFFFFFFFF], ids[j]]))
        pair = np.unique(np.concatenate(found, axis=1), axis=1)
        more = np.unique(table.column("token").to_numpy()[met > 1])
        first = pa.chunked_array([pa.array(pair[0]), pa.nulls(len(more), pa.int64())]).combine_chunks()
        yield pa.RecordBatch.from_arrays([first, pa.array(np.concatenate([pair[1], more]))], ["a", "b"])


def meetings(leads: DataFrame, percent: int) -> DataFrame:
    """``token, lead, m``: the groups that share an element of their prefixes, and under a token of its own every group of
    several members. ``leads``: ``lead, m, n, prefix`` of the groups, ``m`` being their members.

    The first common element of a linked pair lies in a shorter prefix of the smaller set, about half of the other's, so an
    element that is in no shorter prefix is left away.
    """
    short = F.expr(f"n + floor(-{2 * percent} * n / {100 + percent}) + 1")
    posts = leads.select("lead", "m", short.alias("short"), F.posexplode("prefix").alias("at", "token"))
    posts = posts.select("token", "lead", "m", (F.col("at") < F.col("short")).alias("first"))
    shared = posts.groupBy("token").agg(F.count(F.lit(1)).alias("k"), F.max("first").alias("first")).where("k > 1 and first").select("token")
    own = leads.where("m > 1").select(F.xxhash64("lead", F.lit("own")).alias("token"), "lead", "m")
    return cut_lineage(posts.drop("first").join(cut_lineage(shared), "token").select("token", "lead", "m").unionByName(own))


def candidates(met: DataFrame, members: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Distinct pairs of classes that may be linked. ``members``: ``lead, id, n, bitmap, component`` of the classes.

    An element with more than ``BLOCK`` members is dealt to pairs of blocks, so that no task holds more than two blocks of it.
    """
    sizes = cut_lineage(met.groupBy("token").agg(F.sum("m").alias("c")).where(F.col("c") > BLOCK))
    rows = met.drop("m").join(members, "lead").join(sizes, "token", "left")
    blocks = F.ceil(F.coalesce("c", F.lit(1)) / BLOCK).cast("bigint")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    rows = rows.select("token", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "id", "n", "bitmap", "component")
    dealt = rows.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi", "n")
    return dealt.mapInArrow(lambda b: _compare(b, percent, nearest), "a bigint, b bigint").distinct()


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets overlap by ``percent`` of their union, counted exactly."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), dtype="<u8") for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return joined.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """``id, shingles`` (sorted 64-bit hashes as bytes) of the given ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.slices(batches):
            tokens, first = _shingles(batch, width)
            packed = [np.unique(tokens[a:b]).astype("<u8").tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("__id"), pa.array(packed, pa.binary())], ["id", "shingles"])

    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    chosen = docs.select("__id", "text").join(ids, F.col("__id") == F.col("id"), "left_semi")
    return chosen.mapInArrow(run, "id bigint, shingles binary")


def linked(docs: DataFrame, classes: DataFrame, made: DataFrame, width: int, percent: int) -> DataFrame:
    """``node, component`` of the classes that links connect to a smaller one. ``classes``: ``rep, n, g1, g2``; ``made``: features.

    The second round's links are few; they join components of the first round, so only their ends are contracted and merged.
    """
    groups = cut_lineage(classes.groupBy("g1", "g2").agg(F.min("rep").alias("lead"), F.count(F.lit(1)).alias("m")))
    leads = made.select("id", "n", "prefix").join(groups.select("lead", "m"), F.col("id") == F.col("lead")).drop("id")
    members = classes.join(groups, ["g1", "g2"]).select(F.col("rep").alias("id"), "lead")
    members = cut_lineage(made.select("id", "n", "bitmap").join(members, "id"))
    met = meetings(leads, percent)
    first = cut_lineage(candidates(met, members.withColumn("component", F.col("id")), percent, True))
    near = _verified(docs, first.where(F.col("a").isNotNull()), width, percent)
    # Only elements with pairs beyond the nearest ones are met again.
    met = cut_lineage(met.join(first.where(F.col("a").isNull()).select(F.col("b").alias("token")), "token", "left_semi"))
    found = star_components(near)
    if met.isEmpty():
        return found
    known = found.withColumnRenamed("node", "id")
    labelled = members.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rest = cut_lineage(candidates(met, labelled, percent, False))
    more = rest if rest.isEmpty() else _verified(docs, rest, width, percent)
    if more.isEmpty():
        return found
    for end in ("a", "b"):
        more = more.join(known, F.col(end) == F.col("id"), "left").withColumn(end, F.coalesce("component", end)).drop("id", "component")
    merged = star_components(more).select(F.col("node").alias("old"), F.col("component").alias("new"))
    # A merged component's own smallest class was a node of no star and becomes one.
    every = found.unionByName(merged.select(F.col("old").alias("node"), F.col("old").alias("component")))
    return every.join(merged, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))


def _verified(docs: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    path = scratch_path(docs.sparkSession, "shingles")
    _sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), width).write.parquet(path)
    return cut_lineage(_verify(pairs, docs.sparkSession.read.parquet(path), percent))


def jaccard_components(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id``.

    A text's set holds its distinct shingles of ``width`` words (runs outside space and 0x09-0x0D, A-Z lower-cased); with
    fewer words the whole sequence is one shingle. Two texts link when ``100 * |both| >= percent * |either|``.
    ``component_id`` is the smallest ``doc_id`` reachable by links, its own included.

    A null or empty text has an empty set and links with nothing, not even another empty one. Rows of one id are told apart
    (wholly repeated rows link as equal texts do); null ids come last, so a component is named null only if it has no other
    id. Further columns are ignored; an empty table gives no row.
    """
    rows = numbered(docs.select("doc_id", "text"))
    path = scratch_path(docs.sparkSession, "features")
    features(rows, width, percent).write.parquet(path)
    made = docs.sparkSession.read.parquet(path)
    equal = ["n", "f1", "f2"]
    classes = made.where("n > 0").groupBy(*equal, "g1", "g2").agg(F.min("id").alias("rep"))  # equal sets, equal prefix
    classes = cut_lineage(classes)
    found = linked(rows, classes, made, width, percent)
    known = cut_lineage(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(*equal, F.coalesce("component", "rep").alias("component")))
    out = made.select("id", *equal).join(known, equal, "left").select("id", "n", F.coalesce("component", "id").alias("component"))
    names = rows.select("__id", "doc_id")
    out = out.join(names, F.col("id") == F.col("__id")).select("doc_id", F.col("n").alias("n_shingles"), "component")
    return out.join(names.select("__id", F.col("doc_id").alias("component_id")), F.col("component") == F.col("__id")).select("doc_id", "n_shingles", "component_id")


def jaccard_stage(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Of each component the document with the smallest id, with its columns as they were; null ids stay."""
    found = jaccard_components(docs, width, percent)
    copies = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("__copy")).distinct()
    return docs.join(copies, docs["doc_id"] == copies["__copy"], "left_anti")
