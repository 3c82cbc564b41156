"""Phrase collocations: counts of all frequent phrases by multikey three-way quicksort of suffix pointers, then scores.

A pointer stands for the words that follow one place of a piece, up to the longest phrase. Pointers are routed by their
leading words, so that all pointers of a phrase meet in one task; there the sort's equal partitions are the phrases, their
sizes the counts, and partitions below the least count are abandoned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import words as W

LEAST, LONGEST, TOP = 100, 5, 2000
#: A phrase goes when this share (in percent) of its occurrences lies in one longer candidate.
ABSORBED = 100
#: Frequent words are broadcast up to this many (16 bytes each); beyond it pointers carry the words' hashes.
MOST_WORDS = 1 << 20
#: Pointers that a counting task gets on average, and counters of leading words that show which ones are hot.
TASK_ROWS, COUNTERS = 1 << 18, 1 << 16
#: Pointers that are merged at once before the shuffle.
MERGE_ROWS = 1 << 20
U = np.uint64

IS_BREAK = np.zeros(256, dtype=bool)
IS_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
IS_WORD = ~IS_BREAK
IS_WORD[[0x20, 0x09]] = False


def _words(batch: pa.RecordBatch, seed: int) -> tuple[np.ndarray, W.Spans, np.ndarray, np.ndarray]:
    """Lower-case bytes, words, 64-bit hashes of (language, word), and the end of each word's piece (a word number)."""
    data, offsets = W.column_bytes(batch.column("text"))
    data = W.LOWER[data]
    spans = W._spans(IS_WORD[data], offsets)
    langs, at = W.column_bytes(batch.column("lang"))
    own = W.hash_spans(langs, W.Spans(at[:-1], at[1:], np.arange(len(at))), seed + 1)
    owners = spans.owners()
    h = np.maximum(W.pair_hash(own[owners], W.hash_spans(data, spans, seed), seed), U(1))
    broken = np.cumsum(IS_BREAK[data])
    piece = np.flatnonzero((np.diff(broken[spans.starts]) > 0) | (np.diff(owners) > 0)) + 1 if len(h) > 1 else np.zeros(0, np.int64)
    ends = np.append(piece, len(h))
    return data, spans, h, np.repeat(ends, np.diff(ends, prepend=0))


def _counts(batches: Iterator[pa.RecordBatch], seed: int, longest: int, counters: int, merge_rows: int) -> Iterator[pa.RecordBatch]:
    """One row per word of a language and run of slices; at the end the counters of leading words (``word`` null)."""
    names = ["counter", "lang", "word", "f"]
    table = np.zeros(counters, dtype=np.int64)
    held, size = [], 0

    def flush():
        parts = pa.Table.from_batches(held).combine_chunks()
        h, first, at = np.unique(parts.column("h").to_numpy(), return_index=True, return_inverse=True)
        f = np.bincount(at, weights=parts.column("f").to_numpy()).astype(np.int64)
        one = parts.take(pa.array(first)).combine_chunks()
        none = pa.nulls(len(f), pa.int32())
        return pa.RecordBatch.from_arrays([none, one.column("lang").combine_chunks(), one.column("word").combine_chunks(), pa.array(f)], names)

    for batch in W.slices(batches):
        data, spans, h, ends = _words(batch, seed)
        if not len(h):
            continue
        for length, key in _leading(h, ends, longest):
            if length > 1:
                table += np.bincount((key % U(counters)).astype(np.int64), minlength=counters)
        kinds, first, f = np.unique(h, return_index=True, return_counts=True)
        width = (spans.ends - spans.starts)[first]
        at = np.concatenate([[0], np.cumsum(width)])
        raw = data[np.repeat(spans.starts[first] - at[:-1], width) + np.arange(at[-1])]
        word = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw)])
        lang = batch.column("lang").take(pa.array(spans.owners()[first]))
        held.append(pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), lang, word.cast(pa.binary()).cast(pa.string()), pa.array(f, pa.int64())], ["h", *names[1:]]))
        size += len(kinds)
        if size >= merge_rows // 4:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()
    some = np.flatnonzero(table)
    none = pa.nulls(len(some), pa.string())
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), none, none, pa.array(table[some])], names)


def _leading(h: np.ndarray, ends: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """For every length the hashes of the leading words of all pointers that are that long."""
    at, key = np.arange(len(h)), h
    for length in range(1, longest + 1):
        if length > 1:
            some = at + length <= ends[at]
            at = at[some]
            key = W.pair_hash(key[some], h[at + length - 1], length)
        yield length, key


class Coder:
    """Numbers of frequent words: their rank (from 1), or their hash where the words are too many to be broadcast."""

    def __init__(self, hashes: np.ndarray | None):
        self.hashes = hashes
        if hashes is not None:
            self.order = np.argsort(hashes)
            self.sorted = hashes[self.order]

    @property
    def bits(self) -> int:
        return 64 if self.hashes is None else max(1, len(self.hashes).bit_length())

    def code(self, h: np.ndarray) -> np.ndarray:
        """Zero for words that are not frequent."""
        if self.hashes is None:
            return h.view(np.int64)
        if not len(self.sorted):
            return np.zeros(len(h), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.order[at] + 1, 0)


def merged(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows once, with the sum of their weights."""
    if not len(rows):
        return rows, weight
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[first], np.add.reduceat(weight[order], first)


def _packing(bits: int, longest: int) -> int:
    """How many word numbers share one bigint."""
    return max(1, min(longest, 63 // bits))


def pack(rows: np.ndarray, bits: int) -> np.ndarray:
    """Rows of ``longest`` word numbers as rows of fewer bigints, which sort as the words do."""
    each = _packing(bits, rows.shape[1])
    if each == 1:
        return rows
    out = np.zeros((len(rows), -(-rows.shape[1] // each)), dtype=np.int64)
    for i in range(rows.shape[1]):
        out[:, i // each] |= rows[:, i] << _shift(i, bits, each)
    return out


def unpack(packed: np.ndarray, bits: int, longest: int) -> np.ndarray:
    each = _packing(bits, longest)
    if each == 1:
        return packed
    mask = (1 << bits) - 1
    return np.stack([packed[:, i // each] >> _shift(i, bits, each) & mask for i in range(longest)], axis=1)


def _shift(i: int, bits: int, each: int) -> int:
    return bits * (each - 1 - i % each) if each > 1 else 0


def _route(bits: int, longest: int) -> list[Column]:
    """The leading words of a pointer that say where it goes: as many as its depth."""
    each = _packing(bits, longest)
    word = [F.shiftright(f"k{i // each}", _shift(i, bits, each)).bitwiseAND(F.lit((1 << bits) - 1)) if each > 1 else F.col(f"k{i}") for i in range(longest)]
    return [word[0], word[1], *[F.when(F.col("depth") > i, word[i]) for i in range(2, longest)]]


def pointers(h: np.ndarray, ends: np.ndarray, coder: Coder, hot: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of every pointer of two words or more, up to the first word that is not frequent, and its depth.

    ``depth`` is how many leading words the pointer is routed by: the fewest, from two on, whose counter is not hot, or
    one more than ``longest`` if none is.
    """
    code = coder.code(h)
    padded = np.concatenate([code, np.zeros(longest, dtype=code.dtype)])
    at = np.arange(len(h))
    rows = np.zeros((len(h), longest), dtype=np.int64)
    live = code != 0
    for i in range(longest):
        if i:
            live = live & (at + i < ends) & (padded[at + i] != 0)
        rows[live, i] = padded[(at + i)[live]]
    depth = np.full(len(h), longest + 1, dtype=np.int64)
    if hot.any():
        at, key, open = np.arange(len(h)), h, np.ones(len(h), dtype=bool)
        for length in range(2, longest + 1):
            some = at + length <= ends[at]
            at, open = at[some], open[some]
            key = W.pair_hash(key[some], h[at + length - 1], length)
            cool = open & ~hot[(key % U(len(hot))).astype(np.int64)]
            depth[at[cool]] = length
            open = open & ~cool
    else:
        depth[:] = 2
    two = rows[:, 1] != 0
    return rows[two], depth[two]


def _routed(batches: Iterator[pa.RecordBatch], seed: int, coder: Coder, hot: np.ndarray, longest: int, merge_rows: int) -> Iterator[pa.RecordBatch]:
    """Merged pointers with their depth and weight."""
    held, size = [], 0
    width = -(-longest // _packing(coder.bits, longest))

    def flush():
        rows = np.concatenate([x[0] for x in held])
        depth = np.concatenate([x[1] for x in held])
        both, weight = merged(np.column_stack([rows, depth]), np.concatenate([x[2] for x in held]))
        rows, depth = both[:, :-1], both[:, -1]
        columns = [pa.array(depth, pa.int8()), pa.array(weight, pa.int64())] + [pa.array(np.ascontiguousarray(c)) for c in rows.T[::-1]]
        return pa.RecordBatch.from_arrays(columns, ["depth", "weight"] + [f"k{i}" for i in reversed(range(width))])

    for batch in W.slices(batches):
        _, _, h, ends = _words(batch, seed)
        if not len(h):
            continue
        rows, depth = pointers(h, ends, coder, hot, longest)
        both, weight = merged(np.column_stack([pack(rows, coder.bits), depth]), np.ones(len(rows), dtype=np.int64))
        held.append((both[:, :-1], both[:, -1], weight))
        size += len(both)
        if size >= merge_rows:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def equal_partitions(rows: np.ndarray, weight: np.ndarray, least: list[int]) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort of the pointers; yields ``(pointer, length, count)`` of every equal partition of two
    words or more whose weight reaches ``least[length - 1]`` (which must not fall with the length).

    A partition that cannot hold an equal partition of that weight is abandoned.
    """
    columns = [np.ascontiguousarray(c) for c in rows.T]
    work = [(np.arange(len(rows)), 0)] if len(rows) else []
    while work:
        at, d = work.pop()
        keys = columns[d][at]
        pivot = keys[len(keys) // 2]
        low, high = keys < pivot, keys > pivot
        for side in (at[low], at[high]):
            if len(side) and int(weight[side].sum()) >= least[d]:
                work.append((side, d))
        if pivot == 0:
            continue
        same = at[~(low | high)]
        count = int(weight[same].sum())
        if count >= least[d]:
            if d:
                yield int(same[0]), d + 1, count
            if d + 1 < len(columns):
                work.append((same, d + 1))


def _phrases(batches: Iterator[pa.RecordBatch], bits: int, longest: int, least: int) -> Iterator[pa.RecordBatch]:
    """Frequent phrases of one task's pointers: ``ids, f, whole``; not whole are counts that other tasks add to."""
    parts = list(batches)
    if not parts:
        return
    table = pa.Table.from_batches(parts)
    packed = np.column_stack([c.to_numpy() for c in table.columns[:1:-1]]) if len(table) else np.zeros((0, 1), dtype=np.int64)
    weight, depth = table.column("weight").to_numpy(), table.column("depth").to_numpy().astype(np.int64)
    del table, parts
    words = unpack(packed, bits, longest) if len(packed) else np.zeros((0, longest), dtype=np.int64)
    order = np.argsort(depth, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1) if len(order) else []:
        cut = int(depth[own[0]])
        rows, w = words[own], weight[own]
        ids, f, whole = [], [], []
        # Prefixes shorter than the route meet in several tasks: their sizes here are parts, and none is abandoned.
        floors = [1 if max(length, 2) < cut else least for length in range(1, longest + 1)]
        for i, length, count in equal_partitions(rows, w, floors):
            ids.append(rows[i, :length])
            f.append(count)
            whole.append(length >= cut)
        if ids:
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids), pa.int64())), pa.array(f, pa.int64()), pa.array(whole)],
                ["ids", "f", "whole"])


def _hashed(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """The hash that :func:`_words` gives each word; a counter keeps its number."""
    for batch in batches:
        data, offsets = W.column_bytes(batch.column("word"))
        langs, at = W.column_bytes(batch.column("lang"))
        own = [W.hash_spans(d, W.Spans(o[:-1], o[1:], np.arange(len(o))), s) for d, o, s in ((langs, at, seed + 1), (data, offsets, seed))]
        h = pa.array(np.maximum(W.pair_hash(*own, seed), U(1)).view(np.int64))
        counter = batch.column("counter").cast(pa.int64())
        yield pa.RecordBatch.from_arrays([pc.coalesce(counter, h), *batch.columns[1:]], ["h", "lang", "word", "f"])


def _vocabulary(rows: DataFrame, longest: int, counters: int, merge_rows: int) -> tuple[DataFrame, int]:
    """Counts of all words (``h, lang, word, f``) and of leading words (``word`` null), and the hash seed under which no
    two words of the table share a hash."""
    for seed in range(0, 64, 2):
        made = rows.mapInArrow(lambda batches: _counts(batches, seed, longest, counters, merge_rows), "counter int, lang string, word string, f bigint")
        counted = made.groupBy("counter", "lang", "word").agg(F.sum("f").alias("f"))
        counted = cut_lineage(counted.mapInArrow(lambda batches: _hashed(batches, seed), "h bigint, lang string, word string, f bigint"))
        if not counted.where(F.col("word").isNotNull()).groupBy("h").count().where("count > 1").limit(1).count():
            return counted, seed
    raise ValueError("no seed keeps the words apart")


def phrase_counts(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST,
    most_words: int = MOST_WORDS, task_rows: int = TASK_ROWS, counters: int = COUNTERS, merge_rows: int = MERGE_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(phrases, words, totals)``: every phrase of 2 to ``longest`` words that occurs ``least`` times in its language
    (``ids, f``), the frequent words (``id, lang, word, f``), and the number of words of each language (``lang, n``)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    table, seed = _vocabulary(rows, longest, counters, merge_rows)
    words = table.where(F.col("word").isNotNull())
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = words.where(F.col("f") >= least)
    total = int(totals.agg(F.sum("n")).head()[0] or 0)
    tasks = max(1, math.ceil(total / task_rows))
    # A counter is hot beyond two tasks' share (and, once all counters are that full, beyond four times their mean).
    limit = max(2 * min(task_rows, total // spark.sparkContext.defaultParallelism + 1), 4 * (longest - 1) * total // counters)
    hot = np.zeros(counters, dtype=bool)
    hot[table.where(F.col("word").isNull() & (F.col("f") > limit)).select("h").toArrow().column("h").to_numpy()] = True
    if frequent.select("h").limit(most_words + 1).count() <= most_words:
        h = frequent.select("h", "f").toArrow()
        hashes = h.column("h").to_numpy().view(U)[np.lexsort((h.column("h").to_numpy(), -h.column("f").to_numpy()))]
        coder = Coder(hashes)
        ranks = spark.createDataFrame(pa.table({"h": hashes.view(np.int64), "id": np.arange(1, len(hashes) + 1)})) if len(hashes) else spark.createDataFrame([], "h bigint, id bigint")
        words = frequent.join(F.broadcast(ranks), "h").select("id", "lang", "word", "f")
    else:
        coder = Coder(None)
        words = frequent.select(F.col("h").alias("id"), "lang", "word", "f")
    shared = spark.sparkContext.broadcast((coder, hot))
    bits = coder.bits
    width = -(-longest // _packing(bits, longest))
    # Last words first: sorted rows then differ in one stretch of bytes, which the shuffle's compression needs.
    schema = "depth tinyint, weight bigint, " + ", ".join(f"k{i} bigint" for i in reversed(range(width)))
    routed = rows.mapInArrow(lambda batches: _routed(batches, seed, *shared.value, longest, merge_rows), schema)
    counted = routed.repartition(max(tasks, spark.sparkContext.defaultParallelism), *_route(bits, longest)).mapInArrow(
        lambda batches: _phrases(batches, bits, longest, least), "ids array<bigint>, f bigint, whole boolean")
    counted = cut_lineage(counted)
    parts = counted.where(~F.col("whole")).groupBy("ids").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return cut_lineage(counted.where("whole").select("ids", "f").unionByName(parts)), cut_lineage(words), totals


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
    absorbed: int = ABSORBED, most_words: int = MOST_WORDS, task_rows: int = TASK_ROWS, counters: int = COUNTERS,
    merge_rows: int = MERGE_ROWS,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at space and tab. A
    phrase of 2 to ``longest`` words with ``a >= least`` occurrences (overlaps count) is a candidate. Cut after its first
    ``k`` words, ``l`` and ``r`` count both parts and the score is ``floor(1000 * a * n / (l * r))``; the lowest cut
    counts, ties to the smallest ``k``. Candidates inside a longer candidate that has ``absorbed`` percent of their
    occurrences are dropped. Order: score and ``a`` descending, phrase ascending by bytes.

    A null language is ``und``, an empty one a language of its own; null and empty texts have no words. Texts are read
    whole, however long. Repeated rows count each time; ids and further columns are not used. Counts and products are
    exact (products as decimals of 38 digits).
    """
    phrases, words, totals = phrase_counts(docs, lang, text, least, longest, most_words, task_rows, counters, merge_rows)
    known = phrases.unionByName(words.select(F.array("id").alias("ids"), "f"))
    size = F.size("ids")
    inner = phrases.where(size > 2).select("f", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("ids", i, n))))).alias("ids"))
    outer = inner.groupBy("ids").agg(F.max("f").alias("over"))
    kept = phrases.join(outer, "ids", "left").where(F.col("over").isNull() | (F.col("over") * 100 < F.col("f") * absorbed)).select("ids", F.col("f").alias("a"))
    first = F.col("ids")[0].alias("id")
    kept = kept.withColumn("id", first).join(words.select("id", "lang").join(totals, "lang"), "id").drop("id")
    cuts = kept.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "*", F.expr("slice(ids, 1, k)").alias("head"), F.expr("slice(ids, k + 1, size(ids) - k)").alias("tail"))
    parts = cuts.join(known.select(F.col("ids").alias("head"), F.col("f").alias("l")), "head").join(
        known.select(F.col("ids").alias("tail"), F.col("f").alias("r")), "tail")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    parts = parts.withColumn("top", (big("a") * big("n") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)")).withColumn(
        "under", (big("l") * big("r")).cast("decimal(38,0)")).withColumn("score", F.expr("top div under"))
    best = parts.groupBy("lang", "ids", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "ids", "a", "n", "cut.score", "cut.l", "cut.r")
    # Each language is trimmed in parts first, equal rows kept, so that no task ranks all phrases of a language.
    order = [F.desc("score"), F.desc("a")]
    best = best.withColumn("part", F.pmod(F.xxhash64("ids"), F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        best = best.withColumn("place", F.rank().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= top)
    spelled = best.select("*", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id").groupBy(
        "lang", "ids", "a", "l", "r", "n", "score").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    last = Window.partitionBy("lang").orderBy(*order, "phrase")
    return spelled.withColumn("rank", F.row_number().over(last).cast("bigint")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = """
WITH t AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
p AS (SELECT lang, row_number() OVER () AS d, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM t),
e AS (SELECT lang, d, unnest(w) AS w, unnest(range(len(w))) AS i FROM p),
c AS (SELECT lang, count(*) AS n FROM e GROUP BY lang),
s AS (SELECT lang, w AS g1, g1 || ' ' || lead(w, 1) OVER x AS g2, g2 || ' ' || lead(w, 2) OVER x AS g3,
             g3 || ' ' || lead(w, 3) OVER x AS g4, g4 || ' ' || lead(w, 4) OVER x AS g5 FROM e WINDOW x AS (PARTITION BY d ORDER BY i)),
g AS (SELECT lang, g1 AS phrase FROM s UNION ALL SELECT lang, g2 FROM s UNION ALL SELECT lang, g3 FROM s UNION ALL SELECT lang, g4 FROM s UNION ALL SELECT lang, g5 FROM s),
f AS MATERIALIZED (SELECT lang, phrase, string_split(phrase, ' ') AS g, len(string_split(phrase, ' ')) AS k, count(*) AS f FROM g WHERE phrase IS NOT NULL
                   GROUP BY lang, phrase HAVING count(*) >= 100),
o AS (SELECT x.lang, x.g[i.i : i.i + j.j - 1] AS g, max(x.f) AS f FROM f x, (SELECT unnest(range(1, 5)) AS i) i, (SELECT unnest(range(2, 5)) AS j) j
      WHERE j.j < x.k AND i.i + j.j - 1 <= x.k GROUP BY ALL),
q AS MATERIALIZED (SELECT f.* FROM f LEFT JOIN o ON f.lang = o.lang AND f.g = o.g WHERE f.k >= 2 AND (o.f IS NULL OR 100 * o.f < 100 * f.f)),
u AS (SELECT q.lang, q.phrase, q.f AS a, h.f AS l, e.f AS r, c.n, x.x, CAST((1000 * CAST(q.f AS HUGEINT) * c.n) // (CAST(h.f AS HUGEINT) * e.f) AS BIGINT) AS score
      FROM q JOIN c ON q.lang = c.lang, (SELECT unnest(range(1, 5)) AS x) x
      JOIN f h ON h.lang = q.lang AND h.g = q.g[1 : x.x] JOIN f e ON e.lang = q.lang AND e.g = q.g[x.x + 1 : q.k] WHERE x.x < q.k),
b AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, x) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM b QUALIFY rank <= 2000
"""
