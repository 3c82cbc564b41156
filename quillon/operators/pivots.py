"""Exact similarity join by pivots on the sphere (C07, J02 at scale): rows meet only where the triangle inequality lets them.

Vectors are compared by their angle, which is a metric. A row lives in the cell of its nearest pivot ``p``, ordered by its
angle to ``p`` and cut into leaves of a bounded number of rows. It is copied as a guest to every other leaf that may hold a
partner within ``alpha``, the angle of the threshold:

* Any ``y`` of cell ``q`` lies on ``q``'s side of the plane between ``p`` and ``q``. A row ``x`` of cell ``p`` is
  ``asin((x.p - x.q) / |p - q|)`` away from that side, so cell ``q`` is out where this passes ``alpha``.
* ``|angle(x, q) - angle(y, q)| <= angle(x, y)``: of the leaves of ``q`` only those count whose angles to ``q`` come within
  ``alpha`` of ``x``'s.

Both rules are necessary conditions of a pair, so no pair is lost whatever the pivots are. Leaves are put into bundles that a
task can hold. A row travels once to every bundle with a leaf that it has to meet, and carries a bit for each of these. A pair of
rows of different leaves would meet in both; it is sought in one of them, which a fixed rule on the two bundles names (on the two
leaves where they share a bundle), so that a row visits half of the bundles at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from . import blocks as B

#: Rows of a leaf, rows from which the pivots are picked, and the most pivots.
LEAF_ROWS, SAMPLE_ROWS, MOST_PIVOTS = 4096, 4096, 512
BINS = 1024
#: Rows of the table for which a bundle gets another slice of guests, each met by a copy of the bundle.
GUEST_ROWS = 262144
#: The most the vectors of a bundle of leaves may weigh in double precision.
HELD_BYTES = 32 << 20
#: Rows times leaves that are routed at once.
ROUTED = 1 << 21
#: Guests that are multiplied with a leaf at once, after sorting by their angle.
STEP = 256
#: Added to the angle of the threshold, far above the rounding of angles in double precision.
SLACK = 1e-6
MET = "id1 bigint, id2 bigint, score double"


class Leaves(NamedTuple):
    """The pivots and all leaves, sorted by cell and angle: cell, range of angles, and slice of a hot range."""

    pivots: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    part: np.ndarray
    parts: np.ndarray
    bundle: np.ndarray  # ascending
    edges: np.ndarray  # leaves of bundle b: edges[b] .. edges[b + 1] - 1


def some_rows(emb: DataFrame, id: str, vector: str) -> DataFrame:
    """``id, v``: the vectors as they are, floats or doubles; null and zero vectors and null ids drop out (they have no angle)."""
    kind = emb.schema[vector].dataType
    v = F.col(vector) if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else V.as_double(vector)
    rows = emb.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).select(F.col(id).cast("bigint").alias("id"), v.alias("v"))
    return rows.where(F.exists("v", lambda x: x != 0))


def pick_pivots(rows: DataFrame, count: int, sample_rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Farthest-first pivots from the ``sample_rows`` rows of smallest id hash. They decide the work, not the result."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow()
    mat = B.prepare(B.list_matrix(sample.column("v")), "cos") if len(sample) else np.zeros((0, 0))
    if not len(mat):
        return mat
    chosen, nearest = [0], mat @ mat[0]
    while len(chosen) < min(count, len(mat)):
        far = int(np.argmin(nearest))
        if nearest[far] > 1 - 1e-12:  # only copies of pivots are left
            break
        chosen.append(far)
        nearest = np.maximum(nearest, mat @ mat[far])
    return mat[chosen]


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def _bin(angle: np.ndarray) -> np.ndarray:
    return np.minimum((angle * (BINS / math.pi)).astype(np.int64), BINS - 1)


def _homes(mat: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cosines to all pivots, the nearest pivot, and the angle to it."""
    cos = mat @ pivots.T
    cell = np.argmax(cos, axis=1)
    return cos, cell, _angles(cos[np.arange(len(mat)), cell])


def _histogram(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(pivots) * BINS, dtype=np.int64)
    for batch in batches:
        if batch.num_rows:
            _, cell, angle = _homes(B.prepare(B.list_matrix(batch.column("v")), "cos"), pivots)
            counts += np.bincount(cell * BINS + _bin(angle), minlength=len(counts))
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some // BINS, pa.int32()), pa.array(some % BINS, pa.int32()), pa.array(counts[some])], ["cell", "bin", "n"])


def cut_leaves(pivots: np.ndarray, counted: pa.Table, leaf_rows: int, bundle_rows: int = 0) -> Leaves:
    """Leaves of at most ``leaf_rows`` rows: runs of angle bins; a bin above that is dealt to slices by a hash of the id.

    Leaves that follow each other share a bundle up to ``bundle_rows`` rows.
    """
    table = counted.sort_by([("cell", "ascending"), ("bin", "ascending")])
    out, width = [], math.pi / BINS
    open_, size = None, 0
    for cell, at, n in zip(*(table.column(c).to_pylist() for c in ("cell", "bin", "n"))):
        if open_ and (open_[0] != cell or size + n > leaf_rows):
            out.append((*open_, 0, 1, size))
            open_ = None
        if n > leaf_rows:
            parts = math.ceil(n / leaf_rows)
            out += [(cell, at, at, i, parts, math.ceil(n / parts)) for i in range(parts)]
        elif open_:
            open_, size = (cell, open_[1], at), size + n
        else:
            open_, size = (cell, at, at), n
    if open_:
        out.append((*open_, 0, 1, size))
    cell, low, high, part, parts, sizes = (np.array([x[i] for x in out], dtype=np.int64) for i in range(6))
    bundle, held = np.zeros(len(out), dtype=np.int64), 0
    for i, n in enumerate(sizes):
        begins = i > 0 and held + n > bundle_rows
        bundle[i] = bundle[i - 1] + begins if i else 0
        held = n if begins else held + n
    edges = np.searchsorted(bundle, np.arange(bundle[-1] + 2 if len(out) else 1))
    return Leaves(pivots, cell, low * width, (high + 1) * width, part, parts, bundle, edges)


def _slice_of(ids: np.ndarray, parts: np.ndarray) -> np.ndarray:
    h = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((h ^ (h >> np.uint64(29))) % parts.astype(np.uint64)).astype(np.int64)


def _visits(leaves: Leaves, ids: np.ndarray, mat: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """The home leaf of every row, and whether the row has to meet a leaf as its guest (rows x leaves)."""
    cos, _, _ = _homes(mat, leaves.pivots)
    used = np.zeros(cos.shape[1], dtype=bool)
    used[leaves.cell] = True
    cell = np.argmax(np.where(used, cos, -np.inf), axis=1)  # a tie in the last digit must not lead to a cell without leaves
    n = np.arange(len(cos))
    angle = _angles(cos[n, cell])
    # The last leaf of the cell that begins at or before the row's bin; slices of a hot bin follow each other.
    start = _bin(angle) * (math.pi / BINS)
    key = leaves.cell * 8.0 + leaves.low
    last = np.maximum(np.searchsorted(key, cell * 8.0 + start + 1e-9, side="right") - 1, np.searchsorted(leaves.cell, cell))
    parts = leaves.parts[last]
    home = last - leaves.part[last] + _slice_of(ids, parts)
    gap = np.sqrt(np.maximum(2.0 - 2.0 * leaves.pivots @ leaves.pivots.T, 1e-30))
    apart = np.arcsin(np.clip((cos[n, cell][:, None] - cos) / gap[cell], -1.0, 1.0))
    meets = (apart <= alpha) | (np.arange(cos.shape[1])[None, :] == cell[:, None])
    far = _angles(cos)[:, leaves.cell]
    near = meets[:, leaves.cell] & (far >= leaves.low - alpha) & (far <= leaves.high + alpha)
    mine, other = leaves.bundle[home][:, None], leaves.bundle[None, :]
    sought = np.where((mine + other) % 2 == 0, other < mine, other > mine)
    near &= np.where(mine == other, np.arange(len(leaves.cell))[None, :] < home[:, None], sought)
    return home, near


def routes(leaves: Leaves, ids: np.ndarray, mat: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, leaf, guest)`` of every meeting of a row with a leaf."""
    home, near = _visits(leaves, ids, mat, alpha)
    i, j = np.nonzero(near)
    return np.r_[np.arange(len(home)), i], np.r_[home, j], np.r_[np.zeros(len(home), dtype=bool), np.ones(len(i), dtype=bool)]


def _route(batches: Iterator[pa.RecordBatch], leaves: Leaves, alpha: float) -> Iterator[pa.RecordBatch]:
    """One row per copy: the row itself with its leaf in the bundle of that, a guest in every other bundle that it visits.

    ``met`` has a bit for each leaf of the bundle that the copy meets.
    """
    names = ["bundle", "guest", "id", "home", "met", "vec"]
    step = max(1, min(1024, ROUTED // len(leaves.cell)))
    for batch in batches:
        for lo in range(0, batch.num_rows, step):
            some = batch.slice(lo, step)
            ids, raw = some.column("id").to_numpy(), B.list_matrix(some.column("v"))
            home, near = _visits(leaves, ids, B.prepare(raw, "cos"), alpha)
            mine, packed = leaves.bundle[home], np.array([x.tobytes() for x in raw], dtype=object)
            row, bundle, met = [], [], []
            for b, (x, y) in enumerate(zip(leaves.edges, leaves.edges[1:])):
                rows = np.flatnonzero(near[:, x:y].any(axis=1) | (mine == b))
                row.append(rows)
                bundle.append(np.full(len(rows), b))
                met += [m.tobytes() for m in np.packbits(near[rows, x:y], axis=1)]
            row, bundle = np.concatenate(row), np.concatenate(bundle)
            yield pa.RecordBatch.from_arrays([pa.array(bundle, pa.int32()), pa.array(mine[row] != bundle), pa.array(ids[row]), pa.array(home[row], pa.int32()),
                                              pa.array(met, pa.binary()), pa.array(packed[row], pa.binary())], names)


def _matrix(batch: pa.RecordBatch, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(column).to_pylist()), dtype=kind).reshape(batch.num_rows, -1)


class _Leaf:
    """The home rows of one leaf, sorted by their angle to the pivot of its cell."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        ids, angle, mat = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((ids, angle))
        self.ids, self.angle, self.mat = ids[order], angle[order], mat[order]
        self.compared = 0

    def meet(self, ids, angle, mat, threshold: float, alpha: float, same: bool) -> Iterator[list[np.ndarray]]:
        """Pairs of the given rows with the leaf's; ``same`` rows are the leaf itself, each pair of it once."""
        order = np.lexsort((ids, angle))
        ids, angle, mat = ids[order], angle[order], mat[order]
        for lo in range(0, len(ids), STEP):
            mine = slice(lo, min(lo + STEP, len(ids)))
            a = lo if same else int(np.searchsorted(self.angle, angle[lo] - alpha, "left"))
            b = int(np.searchsorted(self.angle, angle[mine.stop - 1] + alpha, "right"))
            if a >= b:
                continue
            left, right = B.Block(0, ids[mine], mat[mine]), B.Block(1, self.ids[a:b], self.mat[a:b])
            self.compared += (mine.stop - lo) * (b - a)
            near = B.at_least(left, right, threshold)
            if same:
                near &= np.arange(lo, mine.stop)[:, None] < np.arange(a, b)[None, :]
            i, j = np.nonzero(near)
            if len(i):
                x, y = left.ids[i], right.ids[j]
                yield [np.minimum(x, y), np.maximum(x, y), B.pair_scores(left, right, i, j)]


class _Bundle:
    """The leaves of one bundle that have rows."""

    def __init__(self, leaves: Leaves, number: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]):
        self.first, end = int(leaves.edges[number]), int(leaves.edges[number + 1])
        self.ids, home, self.met, self.mat = (np.concatenate([p[i] for p in parts]) for i in range(4))
        cells, self.column = np.unique(leaves.cell[self.first : end], return_inverse=True)
        self.pivots = leaves.pivots[cells]
        self.leaves: dict[int, _Leaf] = {}
        order = np.argsort(home, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
            at = int(home[rows[0]])
            angle = _angles(self.mat[rows] @ self.pivots[self.column[at - self.first]])
            self.leaves[at] = _Leaf([(self.ids[rows], angle, self.mat[rows])])

    def own(self, threshold: float, alpha: float, part: int, slices: int) -> Iterator[list[np.ndarray]]:
        """The share of one slice in the pairs of the bundle's own rows."""
        for at, leaf in self.leaves.items():
            if at % slices == part:
                yield from leaf.meet(leaf.ids, leaf.angle, leaf.mat, threshold, alpha, True)
        mine = np.flatnonzero(_slice_of(self.ids, np.array(slices)) == part)
        for lo in range(0, len(mine), LEAF_ROWS):
            some = mine[lo : lo + LEAF_ROWS]
            yield from self.meet(self.ids[some], self.met[some], self.mat[some], threshold, alpha)

    def meet(self, ids: np.ndarray, met: np.ndarray, mat: np.ndarray, threshold: float, alpha: float) -> Iterator[list[np.ndarray]]:
        angle, wanted = _angles(mat @ self.pivots.T), np.unpackbits(met, axis=1).astype(bool)
        for at, leaf in self.leaves.items():
            rows = np.flatnonzero(wanted[:, at - self.first])
            if len(rows):
                yield from leaf.meet(ids[rows], angle[rows, self.column[at - self.first]], mat[rows], threshold, alpha, False)


def _join(batches: Iterator[pa.RecordBatch], leaves: Leaves, kind, threshold: float, alpha: float, slices: int = 1) -> Iterator[pa.RecordBatch]:
    """Pairs of every bundle; the rows after them have a null ``id2``, a leaf as ``id1`` and the pairs compared as ``score``.

    ``leaf`` is the bundle's number times ``slices`` plus the slice of its guests; its own pairs are shared out as well.
    """
    names = ["id1", "id2", "score"]
    at, bundle, parts = None, None, []

    def pairs(found):
        return pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()), pa.array(found[2])], names)

    def close():
        done = [(i, leaf.compared) for i, leaf in sorted(bundle.leaves.items())]
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in done], pa.int64()), pa.nulls(len(done), pa.int64()), pa.array([float(n) for _, n in done])], names)

    def settle():
        made = _Bundle(leaves, at // slices, parts)
        return made, made.own(threshold, alpha, at % slices, slices)

    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("leaf").to_numpy().astype(np.int64) * 2 + batch.column("guest").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.diff(key)) + 1
        for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(key)]):
            some = batch.slice(lo, hi - lo)
            if at != key[lo] // 2:
                if parts and bundle is None:
                    bundle, found = settle()
                    yield from map(pairs, found)
                if bundle is not None:
                    yield close()
                at, bundle, parts = int(key[lo] // 2), None, []
            ids, met, mat = some.column("id").to_numpy(), _matrix(some, "met", np.uint8), B.prepare(_matrix(some, "vec", kind), "cos")
            if not key[lo] % 2:
                parts.append((ids.copy(), some.column("home").to_numpy().astype(np.int64), met.copy(), mat))
                continue
            if bundle is None:
                if not parts:  # a bundle none of whose rows are there; guests come to leaves with rows
                    continue
                bundle, found = settle()
                parts = []
                yield from map(pairs, found)
            for found in bundle.meet(ids, met, mat, threshold, alpha):
                yield pairs(found)
    if parts and bundle is None:
        bundle, found = settle()
        yield from map(pairs, found)
    if bundle is not None:
        yield close()


def pivot_join(
    emb: DataFrame, threshold: float, id: str = "id", vector: str = "embedding", pivots: int | None = None,
    leaf_rows: int = LEAF_ROWS, sample_rows: int = SAMPLE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(pairs, work)``: unordered pairs ``(id1, id2, score)`` with a cosine at or above ``threshold``, and the pairs of rows
    that each leaf compared for them (``leaf, compared``).

    Exact for every ``threshold`` above zero (below, zero vectors would pair and angles no longer bound anything): the
    pairs are those of :func:`search.similarity_join`. Rows with a null or zero vector or a null id have no pairs. Ids
    must be unique. The number of pivots grows with the root of the rows, up to ``MOST_PIVOTS``. A task holds the rows of
    one bundle of leaves and streams their guests past them; a range of angles with more rows than a leaf holds, such as copies of one
    vector, is dealt to slices that meet one another as guests. How much is saved depends on the data: rows in clusters
    narrower than the threshold's angle meet their own cluster, rows spread evenly over many dimensions meet most others.
    """
    if threshold <= 0:
        raise ValueError("a threshold above 0")
    spark = emb.sparkSession
    rows = some_rows(emb, id, vector)
    count, width = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).head()
    chosen = pick_pivots(rows, pivots or min(MOST_PIVOTS, max(8, 4 * math.isqrt(count))), sample_rows)
    if not len(chosen):
        return spark.createDataFrame([], MET), spark.createDataFrame([], "leaf bigint, compared bigint")
    alpha = math.acos(min(1.0, threshold - 10.0**-B.SCORE_DECIMALS)) + SLACK
    counted = rows.mapInArrow(lambda batches: _histogram(batches, chosen), "cell int, bin int, n bigint").groupBy("cell", "bin").agg(F.sum("n").alias("n"))
    # A row is copied to half of the bundles at most, and to the slices of its own: few copies for four tasks a core.
    par = spark.sparkContext.defaultParallelism
    slices = max(math.ceil(count / GUEST_ROWS), math.ceil(math.sqrt(2 * par)))
    bundles = max(math.ceil(8 * width * count / HELD_BYTES), math.ceil(4 * par / slices))
    leaves = cut_leaves(chosen, counted.toArrow(), leaf_rows, math.ceil(count / bundles))
    shared = spark.sparkContext.broadcast(leaves)
    routed = rows.mapInArrow(lambda batches: _route(batches, shared.value, alpha), "bundle int, guest boolean, id bigint, home int, met binary, vec binary")
    # A bundle may have half of the table as guests: they are dealt to slices, so that no task reads them all.
    mine = F.when(F.col("guest"), F.array(F.pmod(F.xxhash64("id"), F.lit(slices)).cast("int"))).otherwise(F.sequence(F.lit(0), F.lit(slices - 1)))
    routed = routed.withColumn("slice", F.explode(mine)).withColumn("leaf", F.col("bundle").cast("bigint") * slices + F.col("slice")).drop("slice", "bundle")
    keys = (len(leaves.edges) - 1) * slices
    tasks = keys if keys > 8 * par else 4 * keys  # spare ones, so that no two of few keys share one by hash
    kind = np.float32 if isinstance(rows.schema["v"].dataType.elementType, T.FloatType) else np.float64
    met = routed.repartition(tasks, "leaf").sortWithinPartitions("leaf", "guest").mapInArrow(lambda batches: _join(batches, shared.value, kind, threshold, alpha, slices), MET)
    work = met.where(F.col("id2").isNull()).groupBy(F.col("id1").alias("leaf")).agg(F.sum(F.col("score").cast("bigint")).alias("compared"))
    return met.where(F.col("id2").isNotNull()), work


def compared_share(emb: DataFrame, threshold: float, id: str = "id", vector: str = "embedding", **options) -> DataFrame:
    """One row ``n_rows, n_pairs, compared, share``: how many pairs of rows the join compared, as a share of all pairs."""
    pairs, work = pivot_join(emb, threshold, id, vector, **options)
    n = some_rows(emb, id, vector).agg(F.count(F.lit(1)).alias("n_rows"))
    done = work.agg(F.coalesce(F.sum("compared"), F.lit(0)).alias("compared"))
    found = pairs.agg(F.count(F.lit(1)).alias("n_pairs"))
    one = n.crossJoin(found).crossJoin(done)  # one row each
    return one.withColumn("share", F.col("compared") / F.greatest(F.col("n_rows") * (F.col("n_rows") - 1) / 2, F.lit(1.0)))
