"""Top-k sums of word weights over an inverted index with score bounds (J10 where the query words cannot be broadcast).

Texts are hashed into slices of a bounded number of texts. A slice holds, for every query word, its postings in blocks of
falling impact; the greatest impact of a word in a slice is the bound of its block list. Three bounds keep texts out that
cannot be among a query's ``k`` best:

* The floor: the ``k``-th best partial score over the words' best postings. No text below it is a hit.
* A query visits a slice only if the slice's greatest impacts of its words add up to the floor.
* Inside a slice, words whose bounds together stay below the floor name no candidates, and of the other words only the
  blocks count whose bound and the other words' bounds reach the floor.

What leaves a slice are at most ``k`` texts of a query, none below its floor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import blocks as B

SLICE_TEXTS = 16_384
BLOCK = 128
#: Best postings of a word that give the floors (at least ``k``).
HEAD = 256
#: Below the floor by this much a score may still be the same after rounding.
NEAR = 2 * 10.0**-B.SCORE_DECIMALS
ROWS = "slice int, asks boolean, query_id bigint, token string, id bigint, weight double, floor double"


class Postings:
    """One word in one slice: text numbers ascending with their impacts, and the blocks of falling impact."""

    def __init__(self, at: np.ndarray, impact: np.ndarray):
        order = np.argsort(at, kind="stable")
        self.at, self.impact = at[order], impact[order]
        fall = np.argsort(-self.impact, kind="stable")
        self.falling = self.at[fall]
        self.bounds = self.impact[fall][::BLOCK]

    @property
    def top(self) -> float:
        return float(self.bounds[0])

    def from_blocks(self, least: float) -> np.ndarray:
        """The texts of the blocks whose bound reaches ``least``."""
        return self.falling[: BLOCK * int(np.searchsorted(-self.bounds, -least, side="right"))]

    def of(self, at: np.ndarray) -> np.ndarray:
        """The impacts of the texts ``at``, zero for those without the word."""
        if not len(self.at):
            return np.zeros(len(at))
        i = np.minimum(np.searchsorted(self.at, at), len(self.at) - 1)
        return np.where(self.at[i] == at, self.impact[i], 0.0)


class Slice:
    """The index of one slice of texts."""

    def __init__(self, tokens: pa.Array, ids: np.ndarray, impacts: np.ndarray):
        self.ids, at = np.unique(ids, return_inverse=True)
        coded = tokens.dictionary_encode()
        code = coded.indices.to_numpy()
        order = np.argsort(code, kind="stable")
        edges = np.searchsorted(code[order], np.arange(len(coded.dictionary) + 1))
        self.words = {w: Postings(at[order[a:b]], impacts[order[a:b]]) for w, a, b in zip(coded.dictionary.to_pylist(), edges[:-1], edges[1:])}
        self.scored = 0

    def search(self, tokens: list[str], weights: list[float], k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and rounded scores of the slice's ``k`` best texts for one query, none below ``floor``."""
        lists = [(w * self.words[t].top, w, self.words[t]) for t, w in zip(tokens, weights) if t in self.words]
        lists.sort(key=lambda x: -x[0])
        total, rest, chosen = sum(x[0] for x in lists), sum(x[0] for x in lists), []
        for top, weight, postings in lists:
            if rest < floor:  # this word and those after it cannot lift a text over the floor by themselves
                break
            chosen.append(postings.from_blocks((floor - (total - top)) / weight))
            rest -= top
        if not chosen:
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.unique(np.concatenate(chosen))
        self.scored += len(at)
        score, left = np.zeros(len(at)), total
        for top, weight, postings in lists:
            score += weight * postings.of(at)
            left -= top
            open = score + left >= floor
            if not open.all():
                at, score = at[open], score[open]
        score = np.round(score, B.SCORE_DECIMALS)
        best = np.lexsort((self.ids[at], -score))[:k]
        return self.ids[at[best]], score[best]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by slice, postings before queries: a slice is built from its postings, then answers its queries."""
    now, index, tokens, ids, impacts = None, None, [], [], []
    asked, words, weights, floor = None, [], [], 0.0

    def answer():
        nonlocal index, tokens, ids, impacts
        if index is None:
            index = Slice(pa.concat_arrays(tokens), np.concatenate(ids), np.concatenate(impacts))
            tokens, ids, impacts = [], [], []
        found, score = index.search(words, weights, k, floor)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), asked, dtype=np.int64)), pa.array(found, pa.int64()), pa.array(score)], [f.name for f in B.HITS.fields])

    for batch in batches:
        if not batch.num_rows:
            continue
        cut = batch.column("slice").to_numpy()
        asks = batch.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        edges = np.flatnonzero((np.diff(cut) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
        for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(cut)]):
            some = batch.slice(lo, hi - lo)
            if cut[lo] != now:
                if asked is not None:
                    yield answer()
                now, index, asked = int(cut[lo]), None, None
                tokens, ids, impacts = [], [], []
            if not asks[lo]:
                tokens.append(some.column("token"))
                ids.append(some.column("id").to_numpy().copy())
                impacts.append(some.column("weight").to_numpy().copy())
                continue
            for query, token, weight, least in zip(*(some.column(c).to_pylist() for c in ("query_id", "token", "weight", "floor"))):
                if query != asked:
                    if asked is not None:
                        yield answer()
                    asked, words, weights, floor = query, [], [], least
                words.append(token)
                weights.append(weight)
    if asked is not None:
        yield answer()


def query_floors(terms: DataFrame, impacts: DataFrame, k: int, head: int = HEAD) -> DataFrame:
    """``query_id, floor``: the ``k``-th best sum over the ``head`` best postings of each word, zero where fewer texts have one.

    ``head`` rows per query word are joined, however frequent the word is.
    """
    # A word's postings are trimmed per slice first, so that no task ranks all of them.
    best = impacts
    for keys in (["token", "slice"], ["token"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("impact"), "corpus_id")
        best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= max(head, k))
    sums = terms.join(best, "token").groupBy("query_id", "corpus_id").agg(F.sum(F.col("qtf") * F.col("impact")).alias("part"))
    place = Window.partitionBy("query_id").orderBy(F.desc("part"), "corpus_id")
    kth = sums.withColumn("place", F.row_number().over(place)).where(F.col("place") == k).select("query_id", F.col("part").alias("floor"))
    every = terms.select("query_id").distinct().join(kth, "query_id", "left")
    return every.select("query_id", (F.coalesce("floor", F.lit(0.0)) - NEAR).alias("floor"))


def block_max_search(terms: DataFrame, impacts: DataFrame, texts: int, k: int, slice_texts: int = SLICE_TEXTS, head: int = HEAD) -> DataFrame:
    """``query_id, corpus_id, score``: of every slice of texts each query's ``k`` best, none below the query's floor.

    ``terms`` has one row ``(query_id, token, qtf)`` per word of a query, ``impacts`` one ``(corpus_id, token, impact)`` with a
    positive impact per word of a text; a score is the sum of ``qtf * impact``. ``texts`` is about the number of texts.
    A slice's postings are held by one task (``slice_texts`` bounds them), its queries stream past.
    """
    slices = max(1, math.ceil(texts / slice_texts))
    impacts = cut_lineage(impacts.withColumn("slice", F.pmod(F.xxhash64("corpus_id"), F.lit(slices)).cast("int")))
    floors = cut_lineage(query_floors(terms, impacts, k, head))
    # The greatest impact of every word in every slice: which slices can hold a hit of a query.
    tops = impacts.groupBy("token", "slice").agg(F.max("impact").alias("top"))
    bounds = terms.join(tops, "token").groupBy("query_id", "slice").agg(F.sum(F.col("qtf") * F.col("top")).alias("bound"))
    visits = bounds.join(floors, "query_id").where(F.col("bound") >= F.col("floor")).select("query_id", "slice", "floor")
    asks = visits.join(terms, "query_id").select(
        "slice", F.lit(True).alias("asks"), "query_id", "token", F.lit(None).cast("bigint").alias("id"), F.col("qtf").cast("double").alias("weight"), "floor")
    held = impacts.select(
        "slice", F.lit(False).alias("asks"), F.lit(None).cast("bigint").alias("query_id"), "token", F.col("corpus_id").alias("id"),
        F.col("impact").alias("weight"), F.lit(None).cast("double").alias("floor"))
    parts = max(slices, impacts.sparkSession.sparkContext.defaultParallelism)
    met = held.unionByName(asks).repartition(parts, "slice").sortWithinPartitions("slice", "asks", "query_id")
    return met.mapInArrow(lambda batches: _search(batches, k), B.HITS)
