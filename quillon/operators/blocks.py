"""All-pairs vector work as products of packed blocks.

Rows are hashed into blocks of at most a few thousand vectors, each packed as one binary matrix. Blocks are put into
groups; a block travels once to every group it has to meet, and the blocks of a group are multiplied where they meet.
No row-wise product is planned, a task holds a few blocks whatever the table size, and kernels emit only reduced rows
(a top-k, a count, a spanning forest), never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

MAX_BLOCK_ROWS = 4096
BLOCK_BYTES = 4 << 20
BLOCKS_PER_GROUP = 16
BROADCAST_BYTES = 64 << 20  # the most a query side may weigh to be broadcast
BROADCAST_HITS = 200_000  # the most hits a task of a broadcast search may emit
SLICE_SCORES = 1 << 20  # scores in double that are held at once
CHUNK_BYTES = 16 << 20  # the most the vectors of a chunk of a bucket may weigh
CHUNKS = 4  # chunks of a bucket, as long as they are neither too small nor too heavy
SCORE_DECIMALS = 9  # scores are rounded before ranking, so that ties do not depend on summation order


@dataclass
class Block:
    """Rows of one piece: ids, double matrix, numeric extras, and a single-precision copy made on first use."""

    piece: int
    ids: np.ndarray
    mat: np.ndarray
    extra: dict[str, np.ndarray] = field(default_factory=dict)
    _single: tuple[np.ndarray, float] | None = None

    @property
    def single(self) -> tuple[np.ndarray, float]:
        if self._single is None:
            longest = float(np.sqrt(np.einsum("ij,ij->i", self.mat, self.mat)).max(initial=0.0))
            self._single = self.mat.astype(np.float32), longest
        return self._single


def prepare(mat: np.ndarray, score: str) -> np.ndarray:
    """Double matrix, with unit rows when the score is cosine (zero rows stay zero)."""
    mat = mat.astype(np.float64)
    if score == "cos":
        mat /= np.maximum(np.sqrt(np.einsum("ij,ij->i", mat, mat)), 1e-12)[:, None]
    return mat


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.round(a @ b.T, SCORE_DECIMALS)


def rough_scores(a: Block, b: Block) -> tuple[np.ndarray, float]:
    """Single-precision dot products and a bound on their error."""
    x, nx = a.single
    y, ny = b.single
    return x @ y.T, 4.0 * (x.shape[1] + 2) * 2.0**-24 * nx * ny + 1e-9


def pair_scores(a: Block, b: Block, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact scores of chosen pairs, in slices of bounded memory."""
    out = np.empty(len(i))
    step = max(1, (8 << 20) // max(a.mat.shape[1], 1))
    for lo in range(0, len(i), step):
        out[lo : lo + step] = np.einsum("ij,ij->i", a.mat[i[lo : lo + step]], b.mat[j[lo : lo + step]])
    return np.round(out, SCORE_DECIMALS)


def at_least(a: Block, b: Block, threshold: float) -> np.ndarray:
    """``score >= threshold`` for all pairs: single precision decides, the unclear pairs are recomputed in double."""
    rough, tol = rough_scores(a, b)
    near = rough >= threshold - tol
    unclear = near ^ (rough >= threshold + tol)
    n = np.count_nonzero(unclear)
    if n > unclear.size // 8:
        return scores(a.mat, b.mat) >= threshold
    if n:
        i, j = np.nonzero(unclear)
        near[i, j] = pair_scores(a, b, i, j) >= threshold
    return near


def list_matrix(column: pa.Array) -> np.ndarray:
    """Arrow list column to a 2-D array; all rows must have the same length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(column) == 0:
        return np.zeros((0, 0))
    if flat.size % len(column):
        raise ValueError("vectors of different length")
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != lengths[0]).any():
        raise ValueError("vectors of different length")
    return flat.reshape(len(column), -1)


@dataclass
class Packed:
    """Packed table: ``data`` has one row per piece (block, piece, grp, ids, mat, dim, extras)."""

    data: DataFrame
    blocks: int
    groups: int
    extras: list[str]
    rows: int
    double: bool


def _parallelism(df: DataFrame) -> int:
    return max(1, df.sparkSession.sparkContext.defaultParallelism)


def pack(
    df: DataFrame,
    id: str = "id",
    vector: str = "embedding",
    extras: dict[str, str] | None = None,
    rows_per_block: int | None = None,
) -> Packed:
    """Packs ``(id bigint, vector array)`` and numeric ``extras`` (name -> column) into blocks; null vectors drop out."""
    extras = extras or {}
    wide = df.where(F.col(vector).isNotNull() & F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("id"),
        F.col(vector).alias("vec"),
        *[F.col(c).cast("double").alias(n) for n, c in extras.items()],
    )
    n, width = wide.agg(F.count(F.lit(1)), F.max(F.size("vec"))).head()
    par = _parallelism(df)
    most = min(MAX_BLOCK_ROWS, max(64, BLOCK_BYTES // (4 * max(width or 1, 1))))
    per = rows_per_block or max(64, min(most, math.ceil(n / (2 * par))))
    blocks = max(1, math.ceil(n / per))
    groups = max(1, min(blocks, max(math.ceil(blocks / BLOCKS_PER_GROUP), 2 * par)))
    names = list(extras)
    double = isinstance(wide.schema["vec"].dataType.elementType, T.DoubleType)
    np_type = np.float64 if double else np.float32
    schema = T.StructType(
        [
            T.StructField("block", T.IntegerType()),
            T.StructField("piece", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("mat", T.BinaryType()),
            *[T.StructField(n_, T.BinaryType()) for n_ in names],
        ]
    )
    arrow = pa.schema(
        [("block", pa.int32()), ("piece", pa.int64()), ("ids", pa.binary()), ("mat", pa.binary())]
        + [(n_, pa.binary()) for n_ in names]
    )

    def emit(block: int, seq: int, ids, mat, ext) -> pa.RecordBatch:
        o = np.argsort(ids, kind="stable")
        cols = [[block], [block * (1 << 24) + seq], [ids[o].tobytes()], [mat[o].astype(np_type).tobytes()]]
        cols += [[e[o].tobytes()] for e in ext]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, arrow.types)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows arrive sorted by block; a block that outgrows the limit is cut into several pieces.
        current, seq, held = None, 0, []

        def flush():
            ids = np.concatenate([h[0] for h in held])
            mat = np.concatenate([h[1] for h in held])
            ext = [np.concatenate([h[2][i] for h in held]) for i in range(len(names))]
            return emit(current, seq, ids, mat, ext)

        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("block").to_numpy()
            ids = batch.column("id").to_numpy()
            mat = list_matrix(batch.column("vec"))
            ext = [batch.column(n_).to_numpy(zero_copy_only=False) for n_ in names]
            edges = np.flatnonzero(np.diff(block)) + 1
            for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(block)]):
                if held and (block[lo] != current or sum(len(h[0]) for h in held) + hi - lo > 2 * per):
                    yield flush()
                    seq = seq + 1 if block[lo] == current else 0
                    held = []
                if block[lo] != current:
                    seq = 0
                current = int(block[lo])
                # Copies: Arrow memory of a batch must not be kept.
                held.append((ids[lo:hi].copy(), mat[lo:hi].copy(), [e[lo:hi].copy() for e in ext]))
        if held:
            yield flush()

    parts = max(1, min(blocks, 4 * par if n < 1_000_000 else blocks // 8 + 1))
    placed = wide.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    packed = placed.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(run, schema)
    packed = packed.withColumn("grp", F.pmod(F.col("block"), F.lit(groups)).cast("int"))
    # Written once: both sides of a product must see the same pieces.
    return Packed(cut_lineage(packed), blocks, groups, names, n, double)


def _decode(row: dict, names: list[str], np_type) -> Block:
    ids = np.frombuffer(row["ids"].as_buffer(), dtype=np.int64)
    mat = np.frombuffer(row["mat"].as_buffer(), dtype=np_type)
    mat = mat.reshape(len(ids), -1) if len(ids) else mat.reshape(0, 0)
    return Block(row["piece"].as_py(), ids, mat, {n: np.frombuffer(row[n].as_buffer(), dtype=np.float64) for n in names})


def _grid(left: int, right: int, par: int) -> tuple[int, int]:
    """Groups of the right blocks and slices of the left ones: as few groups as a task can hold, slices to occupy all cores."""
    groups = min(right, max(math.ceil(right / BLOCKS_PER_GROUP), math.ceil(2 * par / min(left, 2 * par))))
    return groups, min(left, math.ceil(2 * par / groups))


def product(left: Packed, right: Packed | None, kernel: Callable[[], "Kernel"], schema: T.StructType) -> DataFrame:
    """Runs ``kernel`` over every pair of pieces; with ``right=None`` over every unordered pair of ``left``.

    One shuffle brings to each group its own pieces (held, a few blocks) and the pieces it has to meet (streamed past). Of
    two tables a group meets the left pieces in slices, each with a copy of the group.
    """
    par = _parallelism(left.data)
    own = right is None
    other = left if own else right
    if own:
        g = left.groups
        # Group i meets groups i .. i + g/2 (modulo g): every unordered pair of groups exactly once.
        half = g // 2
        reach = F.sequence(F.lit(0), F.lit(half)) if half else F.array(F.lit(0))
        steps = F.filter(reach, lambda s: ~((s == half) & F.lit(g % 2 == 0 and half > 0) & (F.col("grp") >= half)))
        key = F.explode(F.transform(steps, lambda s: F.pmod(F.col("grp") + s, F.lit(g)).cast("int")))
        place, keys = F.col("grp"), g
    else:
        # Every left row leaves a list behind in each group that it meets: few groups, met by slices of the left side.
        groups, slices = _grid(left.blocks, other.blocks, par)
        each = lambda n, at: F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda x: at(x).cast("int")))
        key = each(groups, lambda x: x * slices + F.pmod(F.col("block"), F.lit(slices)))
        place = each(slices, lambda x: x + F.pmod(F.col("block"), F.lit(groups)) * slices)
        keys = groups * slices
    # Few keys get spare partitions, so that no two of them share one by hash.
    parts = keys if keys > 8 * par else 4 * keys
    names = sorted({*left.extras, *other.extras})

    def side(p: Packed, where, streamed: bool) -> DataFrame:
        extra = [(F.col(n) if n in p.extras else F.lit(None).cast("binary")).alias(n) for n in names]
        return p.data.select(where.alias("key"), F.lit(streamed).alias("streamed"), "grp", "piece", "ids", "mat", *extra)

    both = side(other, place, False).unionByName(side(left, key, True))
    both = both.repartition(parts, "key").sortWithinPartitions("key", "streamed", "piece")
    l_names, r_names = left.extras, other.extras
    lt = np.float64 if left.double else np.float32
    rt = np.float64 if other.double else np.float32
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = kernel()
        held: list[tuple[int, Block]] = []
        at = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i] for n in batch.schema.names}
                group = row["grp"].as_py()
                if row["key"].as_py() != at:
                    for out in k.finish():
                        yield to_batch(out, arrow)
                    held, at = [], row["key"].as_py()
                if not row["streamed"].as_py():
                    held.append((group, k.load(_decode(row, r_names, rt))))
                    continue
                mine = None
                for g, block in held:
                    if own and g == group and row["piece"].as_py() == block.piece:
                        mine = block
                if mine is None:
                    mine = k.load(_decode(row, l_names, lt))
                for g, block in held:
                    if own and g == group and mine.piece > block.piece:
                        continue
                    for out in k.pair(mine, block, block is mine):
                        yield to_batch(out, arrow)
                for out in k.leave(mine):
                    yield to_batch(out, arrow)
        for out in k.finish():
            yield to_batch(out, arrow)

    return both.mapInArrow(run, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {T.LongType: pa.int64(), T.DoubleType: pa.float64(), T.IntegerType: pa.int32(), T.BooleanType: pa.bool_()}
    return pa.schema([(f.name, kinds[type(f.dataType)]) for f in schema.fields])


def to_batch(columns: list[np.ndarray], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], schema=arrow)


class Kernel:
    """Work on one pair of blocks. Methods yield lists of output columns."""

    def load(self, block: Block) -> Block:
        return block

    def pair(self, left: Block, right: Block, same: bool):
        return ()

    def leave(self, block: Block):
        return ()

    def finish(self):
        return ()


HITS = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("corpus_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def best_columns(s: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ``k`` best scores with their ids; equal scores go to the lower id. ``ids`` must ascend."""
    m = s.shape[1]
    if k >= m:
        return s, np.broadcast_to(ids, s.shape)
    finite = np.where(np.isfinite(s), s, 0.0)
    if np.abs(finite).max(initial=0.0) * 10**SCORE_DECIMALS * m < 2**61:
        exact = np.rint(finite * 10**SCORE_DECIMALS).astype(np.int64) * m - np.arange(m)
        exact[~np.isfinite(s)] = -(2**62)
        cols = np.argpartition(-exact, k - 1, axis=1)[:, :k]
    else:
        cols = np.argsort(-s, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(s, cols, 1), ids[cols]


def chunk_count(rows: Column, least: int, dim: int) -> Column:
    """Chunks into which the ``rows`` of a bucket are dealt.

    Every row of the other side is copied to each of them, so their number stays at ``CHUNKS`` from ``least`` rows a chunk
    until a chunk weighs ``CHUNK_BYTES``, and grows beyond.
    """
    most = max(least, CHUNK_BYTES // (8 * max(dim, 1)))
    size = F.least(F.greatest(F.ceil(rows / CHUNKS), F.lit(least)), F.lit(most))
    return F.ceil(rows / size).cast("int")


def best_pairs(q: pd.DataFrame, c: pd.DataFrame, k: int) -> pd.DataFrame:
    """Top ``k`` rows of ``c`` for every row of ``q`` (unit vectors), a slice of ``q`` at a time."""
    if not len(q) or not len(c):
        return pd.DataFrame({"query_id": [], "corpus_id": [], "score": []})
    c = c.sort_values("id")
    ids, mat, asked = c["id"].to_numpy(), np.vstack(c["embedding"]), q["id"].to_numpy()
    step, out = max(1, SLICE_SCORES // len(ids)), []
    for lo in range(0, len(asked), step):
        top, who = best_columns(scores(np.vstack(q["embedding"].iloc[lo : lo + step]), mat), ids, k)
        out.append((np.repeat(asked[lo : lo + step], top.shape[1]), who.ravel(), top.ravel()))
    return pd.DataFrame(dict(zip(("query_id", "corpus_id", "score"), (np.concatenate(x) for x in zip(*out)))))


class Best:
    """Flat top-k lists of the rows of one block: sorted by row, score descending, id ascending.

    What is added waits until it weighs half of the lists: sorting them for the few entries of every block would take most of the time.
    """

    def __init__(self, rows: int, k: int):
        self.k = k
        self.row, self.score, self.id = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.floor = np.full(rows, -np.inf)  # score of the k-th entry, where there is one, as of the last sorting
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, row, score, id) -> None:
        self.waiting.append((row, score, id))
        if 2 * sum(len(w[0]) for w in self.waiting) >= self.k * len(self.floor):
            self.settle()

    def settle(self) -> None:
        """Sorts what waits into the lists."""
        row, score, id = (np.concatenate(x) for x in zip((self.row, self.score, self.id), *self.waiting))
        self.waiting = []
        order = np.lexsort((id, -score, row))
        row, score, id = row[order], score[order], id[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, "left")
        keep = place < self.k
        last = place == self.k - 1
        self.floor[row[last]] = score[last]
        self.row, self.score, self.id = row[keep], score[keep], id[keep]


class TopK(Kernel):
    """Running top-k of each row; a block's list is emitted once, when the block leaves the task.

    Single-precision scores pick the candidates that can still enter a list; these are scored in double.
    """

    def __init__(self, k: int, score: str, both: bool):
        self.k, self.score, self.both = k, score, both
        self.held: dict[tuple[str, int], tuple[Block, Best]] = {}

    def load(self, block):
        return Block(block.piece, block.ids, prepare(block.mat, self.score), block.extra)

    def best(self, side: str, rows: Block) -> Best:
        if (side, rows.piece) not in self.held:
            self.held[side, rows.piece] = (rows, Best(len(rows.ids), self.k))
        return self.held[side, rows.piece][1]

    def merge(self, side: str, rows: Block, cols: Block, rough: np.ndarray, tol: float) -> None:
        best = self.best(side, rows)
        found = []
        # A slice of rows at a time: the double scores of two whole blocks would weigh many times their rough ones.
        step = max(1, SLICE_SCORES // max(rough.shape[1], 1))
        for lo in range(0, len(rows.ids), step):
            i, id, score = self.candidates(rows.mat[lo : lo + step], cols, rough[lo : lo + step], best.floor[lo : lo + step], tol)
            found.append((i + lo, score, id))
        if found:
            best.add(*(np.concatenate(x) for x in zip(*found)))

    def candidates(self, mat: np.ndarray, cols: Block, rough: np.ndarray, floor: np.ndarray, tol: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, id and score of the pairs that can still enter a list."""
        floor = floor - tol
        fresh = ~np.isfinite(floor)
        if fresh.any() and rough.shape[1] > self.k:
            part = np.partition(rough[fresh], rough.shape[1] - self.k, axis=1)[:, rough.shape[1] - self.k]
            floor[fresh] = part - 2 * tol
        wanted = (rough >= floor[:, None]) & (rough > -np.inf)
        if np.count_nonzero(wanted) > max(8 * self.k * len(mat), wanted.size // 16):
            # Many equal scores (copies): rank the columns in double, keep k per row.
            order = np.argsort(cols.ids, kind="stable")
            exact = np.where(rough > -np.inf, scores(mat, cols.mat), -np.inf)[:, order]
            top, who = best_columns(exact, cols.ids[order], self.k)
            i, at = np.nonzero(top > -np.inf)
            return i, who[i, at], top[i, at]
        i, j = np.nonzero(wanted)
        return i, cols.ids[j], pair_scores(Block(0, np.zeros(0, np.int64), mat), cols, i, j)

    def pair(self, left, right, same):
        rough, tol = rough_scores(left, right)
        if same and self.both:
            rough[left.ids[:, None] == right.ids[None, :]] = -np.inf
        self.merge("l", left, right, rough, tol)
        if self.both and not same:
            self.merge("r", right, left, rough.T, tol)
        return ()

    def _emit(self, key):
        rows, best = self.held.pop(key)
        best.settle()
        return [rows.ids[best.row], best.id, best.score]

    def leave(self, block):
        return [self._emit(("l", block.piece))] if ("l", block.piece) in self.held else []

    def finish(self):
        return [self._emit(key) for key in list(self.held)]


def small_matrix(df: DataFrame, id: str, vector: str, k: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The side as ``(ids, matrix)`` if its size, checked first, allows a broadcast; otherwise None."""
    usable = df.where(F.col(vector).isNotNull() & F.col(id).isNotNull())
    head = usable.select(F.size(vector)).head()
    if head is None:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 0))
    # Each task emits up to k hits per query, so their number is bounded as well as the bytes.
    limit = max(1, min(BROADCAST_BYTES // (8 * max(head[0], 1)), BROADCAST_HITS // max(k, 1)))
    if usable.select(id).limit(limit + 1).count() > limit:
        return None
    table = usable.select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("vec")).toArrow()
    ids = table.column("id").to_numpy()
    mat = list_matrix(table.column("vec"))
    order = np.argsort(ids, kind="stable")
    return ids[order], mat[order].astype(np.float64)


def broadcast_topk(
    queries: tuple[np.ndarray, np.ndarray], corpus: DataFrame, id: str, vector: str, k: int, score: str,
    exclude_self: bool,
) -> DataFrame:
    """Scans the corpus once; each task emits at most ``k`` hits per query."""
    shared = corpus.sparkSession.sparkContext.broadcast(queries)
    arrow = arrow_schema(HITS)
    chunk = 512

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, qmat = shared.value
        qmat = prepare(qmat, score)
        top = TopK(k, score, both=False)
        parts = [Block(i, qids[i : i + chunk], qmat[i : i + chunk]) for i in range(0, len(qids), chunk)]
        for batch in batches:
            if not batch.num_rows or not parts:
                continue
            ids = batch.column("id").to_numpy()
            mat = prepare(list_matrix(batch.column("vec")), score)
            cols = Block(0, ids, mat)
            for part in parts:
                rough, tol = rough_scores(part, cols)
                if exclude_self:
                    rough[part.ids[:, None] == ids[None, :]] = -np.inf
                top.merge("l", part, cols, rough, tol)
        for out in top.finish():
            yield to_batch(out, arrow)

    rows = corpus.where(F.col(vector).isNotNull() & F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("id"), F.col(vector).alias("vec")
    )
    return rows.mapInArrow(run, HITS)
