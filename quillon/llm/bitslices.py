"""Exact top-k inner products over a bit-sliced index of quantised vectors.

The rows of a block become bitmaps: slice ``(d, b)`` has bit ``b`` of attribute ``d`` of every row. An inner product with a
query is a sum of slices at weights that are powers of two, done by carry-save additions of whole bitmaps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

BLOCK_ROWS = 1 << 16
LEAST_ROWS = 1 << 13
QUERIES_A_ROW = 256
#: Low bits of every attribute that the first sum leaves out; rows that they could lift over the boundary are scored exactly.
LOW_BITS = 1
INDEX = "block int, ids binary, base binary, bits binary, slices binary"
HITS = "query_id bigint, vec_id bigint, score bigint"
U = np.uint64


class Slices(NamedTuple):
    """The index of one block: row ids, least value and number of slices of each attribute, and the bitmaps.

    ``maps[first[d] + b]`` is slice ``b`` of attribute ``d``; the second half of ``maps`` holds the complements.
    """

    ids: np.ndarray
    base: np.ndarray
    bits: np.ndarray
    first: np.ndarray
    maps: np.ndarray

    @property
    def half(self) -> int:
        return len(self.maps) // 2


def _packed(flags: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    bits = np.packbits(flags, axis=-1, bitorder="little")
    pad = -bits.shape[-1] % 8
    return np.ascontiguousarray(np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, pad)])).view("<u8")


def build(ids: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, bits, slices`` of the integer matrix ``values`` (one row per id)."""
    base = values.min(axis=0)
    over = (values - base).astype(U)
    bits = np.array([int(x).bit_length() for x in over.max(axis=0)], dtype=np.int64)
    rows = [_packed((over[:, d] >> U(b) & U(1)).astype(bool)) for d in range(len(base)) for b in range(bits[d])]
    width = -(-len(ids) // 64)
    return base, bits, np.array(rows, dtype=U).reshape(-1, width)


def load(ids: bytes, base: bytes, bits: bytes, slices: bytes) -> Slices:
    ids, base, bits = (np.frombuffer(x, dtype=np.int64) for x in (ids, base, bits))
    maps = np.frombuffer(slices, dtype=U).reshape(int(bits.sum()), -(-len(ids) // 64))
    return Slices(ids, base, bits, np.concatenate([[0], np.cumsum(bits)[:-1]]).astype(np.int64), np.concatenate([maps, ~maps]))


def add_up(columns: dict[int, np.ndarray]) -> np.ndarray:
    """The slices of the sum, least significant first; ``columns[p]`` are the bitmaps that count ``2 ** p`` each."""
    out, carried, p = [], [], 0
    width = next(iter(columns.values())).shape[1]
    while p <= max(columns) or carried:
        rows = [columns[p]] if p in columns else []
        x, carried = np.concatenate(rows + carried) if rows or carried else np.zeros((0, width), dtype=U), []
        while len(x) > 2:
            t = len(x) // 3
            a, b, c = x[:t], x[t : 2 * t], x[2 * t : 3 * t]
            ab = a ^ b
            carried.append((a & b) | (ab & c))
            x = np.concatenate([ab ^ c, x[3 * t :]])
        if len(x) == 2:
            carried.append(x[:1] & x[1:])
            x = x[:1] ^ x[1:]
        out.append(x[0] if len(x) else np.zeros(width, dtype=U))
        p += 1
    return np.array(out)


def kth_largest(total: np.ndarray, live: np.ndarray, k: int) -> int:
    """The k-th largest sum of the live rows, from the most significant slice downward (there are ``k`` of them)."""
    value = 0
    for b in range(len(total) - 1, -1, -1):
        high = live & total[b]
        n = int(np.bitwise_count(high).sum())
        if n >= k:
            live, value = high, value | 1 << b
        else:
            k -= n
            live = live & ~total[b]
    return value


def not_below(total: np.ndarray, live: np.ndarray, value: int) -> np.ndarray:
    """The live rows whose sum is ``value`` or more."""
    above, equal = np.zeros_like(live), live
    for b in range(max(len(total), value.bit_length()) - 1, -1, -1):
        s = total[b] if b < len(total) else np.zeros_like(live)
        if value >> b & 1:
            equal = equal & s
        else:
            above, equal = above | (equal & s), equal & ~s
    return above | equal


def _bit_of(maps: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Bits of the chosen rows, one line per bitmap."""
    return (maps[:, rows >> 6] >> (rows & 63).astype(U) & U(1)).astype(np.int64)


def search_block(index: Slices, query_id: int, query: np.ndarray, k: int, low_bits: int = LOW_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the block's ``k`` best rows for one query (ties to the smaller id), the query's own row left out."""
    n, width = len(index.ids), len(index.base)
    q = np.zeros(width, dtype=np.int64)
    q[: min(width, len(query))] = query[:width]
    weight = np.abs(q)
    if math.log2(max(int(weight.max(initial=0)), 1)) + int(index.bits.max(initial=0)) + math.log2(width + 1) > 61:
        raise OverflowError("inner products beyond 64 bits")
    live = _packed(index.ids != query_id)
    # Query bit j of attribute d takes every slice b of d to position b + j; negative weights take the complement.
    of = np.repeat(np.arange(width), index.bits)
    place = np.arange(len(of)) - index.first[of]
    rows = np.arange(len(of)) + np.where(q[of] < 0, index.half, 0)
    columns: dict[int, list] = {}
    for j in range(int(weight.max(initial=0)).bit_length()):
        wanted = (weight[of] >> j & 1 == 1) & (place >= low_bits)
        for p in np.unique(place[wanted] + j):
            columns.setdefault(int(p), []).append(rows[wanted & (place + j == p)])
    # A negative weight times u is |weight| times (all ones - u), less |weight| times all ones.
    const = int(np.dot(q, index.base) - np.dot(weight, np.where(q < 0, (1 << index.bits) - 1, 0)))
    alive = int(np.bitwise_count(live).sum())
    k = min(k, alive)
    if not k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if columns:
        total = add_up({p: index.maps[np.concatenate(r)] for p, r in columns.items()})
        slack = int(np.dot(weight, (1 << np.minimum(index.bits, low_bits)) - 1))
        near = not_below(total, live, max(kth_largest(total, live, k) - slack, 0))
    else:
        total, near = np.zeros((0, live.shape[0]), dtype=U), live
    found = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little")[:n])
    score = (_bit_of(total, found) << np.arange(len(total))[:, None]).sum(axis=0) + const
    rest = np.flatnonzero((place < low_bits) & (weight[of] > 0))
    if len(rest):
        score = score + ((weight[of[rest]] << place[rest])[:, None] * _bit_of(index.maps[rows[rest]], found)).sum(axis=0)
    best = np.lexsort((index.ids[found], -score))[:k]
    return index.ids[found][best], score[best]


def quantised(df: DataFrame, id: str, vector: str, scale: int) -> DataFrame:
    """``id, v``: ``floor(scale * x)`` of every component, for rows whose components are all finite numbers.

    Rows are known by their id: of rows that repeat one, the least vector stands for it. A null id takes no part.
    """
    usable = df.select(F.col(id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    whole = usable.select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint")).alias("v"))
    if not usable.groupBy("id").count().where("count > 1").limit(1).count():
        return whole
    return whole.groupBy("id").agg(F.min("v").alias("v"))


def _narrow(values: np.ndarray) -> tuple[str, bytes]:
    """The matrix in the smallest whole number type that holds it."""
    for kind in ("i1", "i2", "i4"):
        if len(values) == 0 or (np.iinfo(kind).min <= values.min(initial=0) and values.max(initial=0) <= np.iinfo(kind).max):
            return kind, values.astype(kind).tobytes()
    return "i8", values.tobytes()


def _vectors(column: pa.Array, width: int | None = None) -> np.ndarray:
    """A list column as a matrix; shorter vectors end in zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), int(lengths.max(initial=0)) if width is None else width), dtype=np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def build_index(df: DataFrame, id: str = "vec_id", vector: str = "embedding", scale: int = 64, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The bit-sliced index of ``df``: one row of ``INDEX`` per block of about ``block_rows`` hashed rows.

    Every row is in it. It can be written and searched again; a block of 65,536 rows of 64 attributes with 7 slices each
    takes 4 MB.
    """
    rows = quantised(df, id, vector, scale)
    blocks = max(1, math.ceil(rows.count() / block_rows))
    names = [x.split()[0] for x in INDEX.split(", ")]

    def make(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("id")
        ids = table.column("id").to_numpy()
        base, bits, slices = build(ids, _vectors(table.column("v").combine_chunks()))
        row = [pa.array([int(table.column("block")[0].as_py())], pa.int32())]
        return pa.Table.from_arrays(row + [pa.array([x.tobytes()], pa.binary()) for x in (ids, base, bits, slices)], names)

    placed = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return placed.groupBy("block").applyInArrow(make, INDEX)


def search(index: DataFrame, queries: DataFrame, k: int, scale: int = 64, low_bits: int = LOW_BITS) -> DataFrame:
    """``query_id, vec_id, score``: the ``k`` best rows of every block for every row of ``queries`` (``id, v``, quantised).

    Packed runs of queries go to every block, and the queries are dealt to groups where there are fewer blocks than cores.
    A task holds one block and streams the queries past it, so its memory follows neither side.
    """
    spark = index.sparkSession
    blocks, asked = (index.agg(F.max("block")).head()[0] or 0) + 1, queries.count()
    wide = max(1, math.ceil(4 * spark.sparkContext.defaultParallelism / blocks))
    groups = max(1, min(wide, math.ceil(asked / 32)))
    runs = max(groups, math.ceil(asked / QUERIES_A_ROW))

    def pack(table: pa.Table) -> pa.Table:
        kind, vectors = _narrow(_vectors(table.column("v").combine_chunks()))
        ids = table.column("id").to_numpy()
        return pa.Table.from_arrays([pa.array([int(table.column("run")[0].as_py())], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                                     pa.array([kind.encode()], pa.binary()), pa.array([vectors], pa.binary())], ["run", "ids", "kind", "vectors"])

    placed = queries.withColumn("run", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(runs)).cast("int"))
    packed = placed.groupBy("run").applyInArrow(pack, "run int, ids binary, kind binary, vectors binary")
    none = F.lit(None).cast("binary")
    every = index.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part"), "block", F.lit(False).alias("asks"), "ids", "base", "bits", "slices")
    asks = packed.select(F.pmod("run", F.lit(groups)).cast("int").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                         F.lit(True).alias("asks"), "ids", none.alias("base"), F.col("kind").alias("bits"), F.col("vectors").alias("slices"))
    # Spare partitions, so that few of them get two of the keys.
    met = every.unionByName(asks).repartition(min(4 * groups * blocks, groups * blocks + 1024), "part", "block").sortWithinPartitions("part", "block", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                if not row["asks"].as_py():
                    held, at = load(*(row[c].as_py() for c in ("ids", "base", "bits", "slices"))), row["block"].as_py()
                    continue
                if row["block"].as_py() != at:  # no row was hashed to that block
                    continue
                ids = np.frombuffer(row["ids"].as_py(), dtype=np.int64)
                flat = np.frombuffer(row["slices"].as_py(), dtype=row["bits"].as_py().decode())
                vectors = flat.astype(np.int64).reshape(len(ids), len(flat) // len(ids))
                found = [search_block(held, int(q), v, k, low_bits) for q, v in zip(ids, vectors)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(ids, [len(f[0]) for f in found]), pa.int64()), pa.array(np.concatenate([f[0] for f in found]), pa.int64()),
                    pa.array(np.concatenate([f[1] for f in found]), pa.int64())], ["query_id", "vec_id", "score"])

    return met.mapInArrow(run, HITS)


def topk_search(
    df: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = 20, every: int = 20, scale: int = 64,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id ``every`` divides, the ``k`` best other rows.

    The score is the inner product of the vectors' ``floor(scale * x)``, exact; ties go to the smaller id, and a query
    gets fewer rows only where there are fewer. Vectors that are null or hold null or non-finite components, and null
    ids, take no part. A row is known by its id (of rows that repeat one, the least vector counts). Missing components of
    shorter vectors count as zero, so an empty vector scores 0 with all. Scores beyond 64 bits are an error. Further
    columns are ignored.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    index = cut_lineage(build_index(df, id, vector, scale, block_rows))
    queries = quantised(df.where(F.col(id) % every == 0), id, vector, scale)
    hits = search(index, cut_lineage(queries.repartition(cores, "id")), k, scale)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
