"""Multi-probe search over sign hashes (J08): few tables, buckets visited in the order of their distance from the query.

A table hashes a unit vector to the signs of its products with orthonormal directions. The rows of a bucket that differs from
the query's own in the signs ``F`` lie beyond those hyperplanes, so with ``y`` the query's products their squared distance is
at least ``sum(y[i] ** 2 for i in F)`` and their cosine at most one minus half of that. This orders the buckets, and it ends the
search: once a query's ``k``-th score beats the bound of the next bucket, no unvisited bucket can hold a better row. With
enough probes the search is exact; a cap on probes makes it approximate.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..session import cut_lineage
from . import blocks as B
from .search import top_k

#: Rows that a bucket holds on average, the most signs of a table, and the probes after which a round ends.
BUCKET_ROWS, MOST_BITS = 64, 16
ROUNDS = (1, 4, 16, 64, 256, 1024, 4096, 16384, 65536)


def probe_order(costs: np.ndarray, count: int) -> tuple[list[int], list[float]]:
    """The ``count`` subsets of bits of least total cost as masks, in order, with their costs; the empty one is first.

    From a subset whose greatest (by rank of cost) bit is ``m`` follow two dearer ones: ``m`` moved to ``m + 1``, and
    ``m + 1`` added. So every subset is reached once, and a heap as long as the output yields them in order.
    """
    rank = np.argsort(costs, kind="stable")
    cost, bit = costs[rank].tolist(), [1 << int(i) for i in rank]
    masks, totals = [0], [0.0]
    heap = [(cost[0], 0, bit[0])] if cost else []
    while heap and len(masks) < count:
        total, m, mask = heapq.heappop(heap)
        masks.append(mask)
        totals.append(total)
        if m + 1 < len(cost):
            heapq.heappush(heap, (total - cost[m] + cost[m + 1], m + 1, mask ^ bit[m] | bit[m + 1]))
            heapq.heappush(heap, (total + cost[m + 1], m + 1, mask | bit[m + 1]))
    return masks, totals


class Tables(NamedTuple):
    """``planes[t]`` has orthonormal rows; bucket ids carry the table in their upper bits."""

    planes: np.ndarray

    @property
    def bits(self) -> int:
        return self.planes.shape[1]

    def buckets(self, mat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of every row in every table, and the products behind it."""
        y = np.einsum("tbd,nd->ntb", self.planes, mat)
        return (y >= 0) @ (1 << np.arange(self.bits)) + (np.arange(len(self.planes)) << self.bits), y


def make_tables(rows: int, dim: int, tables: int, bits: int | None, bucket_rows: int, seed: int) -> Tables:
    """Tables whose number of signs follows from the counted rows (or is given), never more than the dimension."""
    wanted = bits if bits is not None else max(1, math.ceil(math.log2(max(2.0, rows / bucket_rows))))
    b = max(1, min(wanted, MOST_BITS, dim))
    rng = np.random.default_rng(seed)
    return Tables(np.stack([np.linalg.qr(rng.standard_normal((dim, b)))[0].T for _ in range(tables)]))


def _unit(df: DataFrame, id: str, vector: str) -> DataFrame:
    rows = df.where(F.col(id).isNotNull() & F.col(vector).isNotNull())
    return rows.select(F.col(id).cast("bigint").alias("id"), V.l2_normalize(vector).alias("embedding"))


def _hash(batches: Iterator[pa.RecordBatch], tables: Tables) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            bucket, _ = tables.buckets(B.list_matrix(batch.column("embedding")))
            at = np.repeat(np.arange(batch.num_rows), bucket.shape[1])
            some = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([some.column("id"), some.column("embedding"), pa.array(bucket.ravel(), pa.int64())], ["id", "embedding", "bucket"])


def _ask(batches: Iterator[pa.RecordBatch], tables: Tables, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """``id, embedding, bucket``: probes ``low .. high - 1`` of every table for each query that they can still improve.

    A query is done when its ``floor`` (the ``k``-th score) is above what the next bucket of any table allows: a row in no
    visited bucket is beyond the bound of every table.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        home, y = tables.buckets(B.list_matrix(batch.column("embedding")))
        floor = batch.column("floor").to_numpy(zero_copy_only=False)
        at, bucket = [], []
        for i in range(batch.num_rows):
            orders = [probe_order(y[i, t] ** 2, high) for t in range(home.shape[1])]
            bound = min((1 - total[low] / 2 if low < len(total) else -np.inf) for _, total in orders)
            if bound == -np.inf or floor[i] > bound + 1e-9:
                continue
            for t, (masks, total) in enumerate(orders):
                useful = [m for m, c in zip(masks[low:high], total[low:high]) if floor[i] <= 1 - c / 2 + 1e-9]
                bucket += [int(home[i, t]) ^ m for m in useful]
                at += [i] * len(useful)
        some = batch.take(pa.array(at, pa.int64()))
        yield pa.RecordBatch.from_arrays([some.column("id"), some.column("embedding"), pa.array(bucket, pa.int64())], ["id", "embedding", "bucket"])


def multiprobe_search(
    queries: DataFrame, corpus: DataFrame, k: int = 10, tables: int = 2, bits: int | None = None, probes: int = 16, seed: int = 0,
    id: str = "id", vector: str = "embedding", bucket_rows: int = BUCKET_ROWS, chunk_rows: int = 2048,
) -> tuple[DataFrame, int]:
    """``(hits, compared)``: ``query_id, corpus_id, score, rank`` by cosine, and the number of pairs of rows compared.

    Every query visits at most ``probes`` buckets of each table, nearest first, in rounds that grow by four; between rounds
    the queries whose ``k``-th score beats the bound of their next bucket are done. ``bits`` follows from the number of rows
    (about ``bucket_rows`` to a bucket, 16 signs at most) unless given. With one table and ``2 ** bits`` probes the hits are
    those of the exact search. Null vectors and null ids drop out; a zero vector scores 0 with all (it lies on every
    plane's positive side, so zero rows are found only in that bucket). A bucket is cut into chunks, so one that holds a
    third of the rows is spread over many tasks.
    """
    spark = corpus.sparkSession
    none = top_k(spark.createDataFrame([], B.HITS), "query_id", "score", "corpus_id", k)
    rows = _unit(corpus, id, vector)
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).head()
    if not n or not dim:
        return none, 0
    made = make_tables(n, dim, tables, bits, bucket_rows, seed)
    hashed = cut_lineage(rows.mapInArrow(lambda b: _hash(b, made), "id bigint, embedding array<double>, bucket bigint"))
    # At most tables * 2 ** bits rows.
    sizes = cut_lineage(hashed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), B.chunk_count(F.count(F.lit(1)), chunk_rows, dim).alias("chunks")))
    held = hashed.join(F.broadcast(sizes.drop("size")), "bucket").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    asked = cut_lineage(_unit(queries, id, vector))
    best, compared, low = None, 0, 0
    for high in [h for h in ROUNDS if h < probes] + [probes]:
        if best is None:
            waiting = asked.withColumn("floor", F.lit(-2.0))
        else:
            kth = best.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
            waiting = asked.join(kth, "id", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)))
        probed = waiting.mapInArrow(lambda b, lo=low, hi=high: _ask(b, made, lo, hi), "id bigint, embedding array<double>, bucket bigint")
        # The queries of one bucket are dealt to slices as its rows are to chunks.
        probed = cut_lineage(probed.join(F.broadcast(sizes), "bucket"))
        work = probed.agg(F.sum("size")).head()[0]
        if work:
            compared += int(work)
            slices = probed.groupBy("bucket").agg(B.chunk_count(F.count(F.lit(1)), chunk_rows, dim).alias("slices"))  # a row per bucket
            q = probed.join(F.broadcast(slices), "bucket").withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int"))
            q = q.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
            c = held.join(F.broadcast(slices), "bucket").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
            keys = ["bucket", "chunk", "slice"]
            q, c = q.select(*keys, "id", "embedding"), c.select(*keys, "id", "embedding")
            hits = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(lambda a, b: B.best_pairs(a, b, k), B.HITS)
            hits = hits if best is None else hits.unionByName(best.drop("rank"))
            hits = hits.groupBy("query_id", "corpus_id").agg(F.max("score").alias("score"))
            best = cut_lineage(top_k(hits, "query_id", "score", "corpus_id", k))
        low = high
    return (none if best is None else best), compared


def compared_share(queries: DataFrame, corpus: DataFrame, compared: int, id: str = "id", vector: str = "embedding") -> float:
    """Pairs compared as a share of all pairs of a query and a row."""
    return compared / max(1, _unit(queries, id, vector).count() * _unit(corpus, id, vector).count())
