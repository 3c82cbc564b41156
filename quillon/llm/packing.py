"""Best-fit packing of documents into sequences of bounded length.

Documents are taken from the longest to the shortest; each goes to the smallest gap that holds it, the order in which equals
are served being their rank. Since lengths are whole numbers up to the capacity, all documents of a length (and all sequences
with a gap) are alike up to their rank, so a superstep works on *classes*: it takes the documents of one length and sweeps the
gap classes upwards from that length (the successors), gives each class as many documents as it holds, and moves the classes
to their new gaps. The state is the number of documents per length and a few runs of sequences per gap, at most some tens of
thousands of entries for a capacity of 4,096, whatever the number of documents. The rows themselves are range-sorted and
ranked, and matched to their place by (length, rank), all distributed.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import global_row_number
from ..session import cut_lineage
from . import words as W
from .tokens import encoder

CAPACITY = 4096
END = 1  # the id after every document


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document's ids, cut every ``capacity`` ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = encoder(path)
        for batch in W.slices(batches):
            ids, first = machine.texts(batch.column("text"))
            ids = np.insert(ids, first[1:], END).astype("<u4")
            first = first + np.arange(len(first))
            counts = -(-np.diff(first) // capacity)
            row = np.repeat(np.arange(len(counts)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = piece * capacity
            length = np.minimum(np.diff(first)[row] - start, capacity)
            begins = (first[row] + start).tolist()
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(begins, length.tolist())]
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """The plan for ``counts`` documents per length, as rows ``(length, first rank, first sequence, per sequence, offset)``.

    The document of rank ``r`` (from 0) goes to sequence ``first + (r - first rank) // per`` at ``offset + ((r - first rank) %
    per) * length``.
    """
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # gap -> runs of (first sequence, how many)
    opened, plan = 0, []
    for length in range(capacity, 0, -1):
        left, rank = counts.get(length, 0), 0
        gap = length
        while left:
            while gap <= capacity and not gaps[gap]:
                gap += 1
            if gap > capacity:  # no successor: new sequences
                first, many = opened, -(-left // (capacity // length))
                opened += many
                gap = capacity
            else:
                first, many = gaps[gap].pop()
            per = gap // length
            full, rest = min(many, left // per), 0
            if full < many:
                rest = left - full * per if left < (full + 1) * per else 0
                gaps[gap] += [(first + full + (rest > 0), many - full - (rest > 0))] if many > full + (rest > 0) else []
            taken = full * per + rest
            plan.append((length, rank, first, per, capacity - gap))
            if full:
                gaps[gap - per * length].append((first, full))
            if rest:
                gaps[gap - rest * length].append((first + full, 1))
            rank += taken
            left -= taken
    return np.array(plan, dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``."""
    rows = cut_lineage(pieces)
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = best_fit(counts, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    shared = rows.sparkSession.sparkContext.broadcast(plan)
    order = [F.col(c).asc() for c in rows.columns if c != "length"]
    ranked = global_row_number(rows, order, "__rank", by=["length"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first_rank, first, per, offset = shared.value.T
        key = length << 40 | first_rank
        for batch in batches:
            own = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy() - 1
            at = np.searchsorted(key, own << 40 | rank, side="right") - 1
            step = rank - first_rank[at]
            columns = [c for n, c in zip(batch.schema.names, batch.columns) if n != "__rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(first[at] + step // per[at]), pa.array(offset[at] + step % per[at] * own)], names)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields]
    names = [*rows.columns, "sequence_id", "offset"]
    return ranked.mapInArrow(place, ", ".join([*fields, "sequence_id bigint", "offset bigint"]))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Every row of ``docs`` is a document: its ids and then id 1, cut into pieces of ``capacity`` only where it is longer. No
    piece is dropped, and no sequence holds more than ``capacity`` ids. A null or empty text is the single id 1. Null ids and
    repeated rows are packed like others; further columns are ignored; an empty table gives no row.
    """
    return pack(pieces(docs, path, capacity), capacity)
