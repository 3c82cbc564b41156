"""Training-order materialisation: token ids in fixed-stride binary shards, in an order given by a keyed permutation.

The texts' ids, each text ended by a separator, form one stream, cut into sequences of ``seq_len`` ids. A keyed Feistel network
with cycle-walking maps sequence ``i`` of ``n`` to its slot in ``0 .. n - 1``; slots are cut into ranges of ``per_shard``, and
one task writes the file of one range. Slot ``s`` lies in file ``s // per_shard`` at byte ``s % per_shard * stride``, so a
reader can go on from any slot with one seek.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import words as W
from .tokens import encoder

SEQ_LEN = 2048
SHARD_BYTES = 16 << 20
KEY = 0x5EED
SEPARATOR = 49407
_LEVEL = 6  # of the compression of the scratch table,
_TEXTS = 4 << 20  # and bytes of text in a row of it


class Layout(NamedTuple):
    path: str
    sequences: int
    seq_len: int
    per_shard: int
    id_bytes: int
    key: int

    @property
    def stride(self) -> int:
        return self.seq_len * self.id_bytes


def feistel(index: np.ndarray, n: int, key: int, rounds: int = 6) -> np.ndarray:
    """The keyed permutation of ``0 .. n - 1`` at ``index``.

    A balanced network permutes ``0 .. 4^h - 1`` with ``4^h >= n``; an image outside ``0 .. n - 1`` is sent through it again
    until it falls inside, which keeps the map one to one.
    """
    half = np.uint64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    low = np.uint64((1 << int(half)) - 1)
    out = np.asarray(index).astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & low
        for r in range(rounds):
            left, right = right, left ^ (W.pair_hash(right, np.full(1, key, np.uint64), r + 1) & low)
        out[todo] = left << half | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _slot_places(first: np.ndarray, length: np.ndarray, seq_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of the stream cut at sequence ends: for each part its stretch, its start in the stream and its length."""
    some = np.flatnonzero(length > 0)
    counts = (first[some] + length[some] - 1) // seq_len - first[some] // seq_len + 1
    row = np.repeat(some, counts)
    step = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.maximum(first[row], (first[row] // seq_len + step) * seq_len)
    end = np.minimum(first[row] + length[row], (first[row] // seq_len + step + 1) * seq_len)
    return row, begin, end - begin


def token_table(docs: DataFrame, path: str, out: str, separator: int, id_bytes: int) -> DataFrame:
    """Writes and rereads the stream: a row per slice of texts, with its place in its task's part of the stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, squeeze = encoder(path), zstandard.ZstdCompressor(level=_LEVEL)
        task, begin = TaskContext.get().partitionId(), 0
        for batch in W.slices(batches, size=_TEXTS):
            ids, first = machine.texts(batch.column("text"))
            blob = np.insert(ids, first[1:], separator).astype(f"<u{id_bytes}")
            lengths = np.diff(first) + 1
            columns = [[task], [begin], [len(blob)], [batch.column("doc_id").to_pylist()], [lengths.tolist()], [squeeze.compress(blob.tobytes())]]
            begin += len(blob)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("task", pa.int32()), ("begin", pa.int64()), ("n", pa.int64()), ("doc_ids", pa.list_({"int": pa.int32(), "bigint": pa.int64()}.get(kind, pa.string()))),
                        ("lengths", pa.list_(pa.int64())), ("blob", pa.binary())])
    made = docs.select("doc_id", "text").mapInArrow(run, f"task int, begin bigint, n bigint, doc_ids array<{kind}>, lengths array<bigint>, blob binary")
    made.write.option("compression", "uncompressed").parquet(out)
    return docs.sparkSession.read.parquet(out)


def materialise(docs: DataFrame, path: str, out: str, seq_len: int = SEQ_LEN, key: int = KEY, shard_bytes: int = SHARD_BYTES,
                separator: int = SEPARATOR, id_bytes: int = 2) -> tuple[Layout, DataFrame]:
    """Writes the shards, ``manifest`` (a table) and ``layout.json`` under ``out``; returns the layout and the index.

    ``out`` must be a folder that every executor reaches. The index has one row for each part of a document in a sequence:
    ``doc_id, start, length, sequence_id, offset, slot, shard, byte_offset``; its lengths add up to every document's ids and
    one separator. A null or empty text is a separator alone. The order of the stream is that of the table read; null ids
    and repeated rows keep their texts. The last sequence is filled up with separators. An empty table writes no shard.

    A shard is written under a temporary name and then renamed, so a task that is run again replaces it by the same bytes.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    table = token_table(docs, path, scratch_path(spark, "tokens"), separator, id_bytes)
    totals = sorted(table.groupBy("task").agg(F.sum("n").alias("n")).collect())  # one row per task
    base = dict(zip([t for t, _ in totals], np.cumsum([0, *[n for _, n in totals]]).tolist()))
    ids = sum(n for _, n in totals)
    n = -(-ids // seq_len)
    layout = Layout(out, n, seq_len, max(1, shard_bytes // (seq_len * id_bytes)), id_bytes, key)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze, expand = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()
        for batch in batches:
            for i in range(batch.num_rows):
                raw = expand.decompress(batch.column("blob")[i].as_py())
                first = base[batch.column("task")[i].as_py()] + batch.column("begin")[i].as_py()
                _, begin, length = _slot_places(np.array([first]), np.array([len(raw) // id_bytes]), seq_len)
                slot = feistel(begin // seq_len, n, key)
                parts = [squeeze.compress(raw[(b - first) * id_bytes : (b - first + k) * id_bytes]) for b, k in zip(begin.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(slot // layout.per_shard), pa.array(slot), pa.array(begin % seq_len), pa.array(parts, pa.binary())], ["shard", "slot", "at", "part"])

    def write(group: pa.Table) -> pa.Table:
        expand = zstandard.ZstdDecompressor()
        shard = group.column("shard")[0].as_py()
        rows = min(layout.per_shard, n - shard * layout.per_shard)
        filled = np.full((rows, seq_len), separator, dtype=f"<u{id_bytes}")
        for slot, at, part in zip(*(group.column(c).to_pylist() for c in ("slot", "at", "part"))):
            values = np.frombuffer(expand.decompress(part), dtype=filled.dtype)
            filled[slot - shard * layout.per_shard, at : at + len(values)] = values
        raw = filled.tobytes()
        fs, folder = _filesystem(out)
        name = f"{folder}/{shard_name(shard)}"
        with fs.open_output_stream(temporary := f"{folder}/.{shard_name(shard)}-{uuid.uuid4().hex}") as f:
            f.write(raw)
        fs.move(temporary, name)
        return pa.table({"shard": [shard], "first_slot": [shard * layout.per_shard], "sequences": [rows], "crc32": [zlib.crc32(raw)]})

    fs, folder = _filesystem(out)
    fs.create_dir(folder, recursive=True)
    parts = table.select("task", "begin", "blob").mapInArrow(cut, "shard bigint, slot bigint, at bigint, part binary")
    parts.groupBy("shard").applyInArrow(write, "shard bigint, first_slot bigint, sequences bigint, crc32 bigint").write.parquet(f"{out}/manifest")
    with fs.open_output_stream(f"{folder}/layout.json") as f:
        f.write(json.dumps(layout._asdict()).encode())

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[i].as_py(), dtype=np.int64)
                first = base[batch.column("task")[i].as_py()] + batch.column("begin")[i].as_py() + np.cumsum(lengths) - lengths
                row, begin, length = _slot_places(first, lengths, seq_len)
                sequence = begin // seq_len
                slot = feistel(sequence, n, key)
                numbers = [begin - first[row], length, sequence, begin % seq_len, slot, slot // layout.per_shard,
                           slot % layout.per_shard * layout.stride + begin % seq_len * id_bytes]
                yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[i].values.take(pa.array(row)), *map(pa.array, numbers)], names)

    schema = f"doc_id {kind}, start bigint, length bigint, sequence_id bigint, offset bigint, slot bigint, shard bigint, byte_offset bigint"
    names = [x.split()[0] for x in schema.split(", ")]
    return layout, table.select("task", "begin", "doc_ids", "lengths").mapInArrow(index, schema)


def shard_name(shard: int) -> str:
    return f"shard-{shard:08d}.bin"


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """A path with a scheme is opened by that file system; without one it is a local or mounted folder."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path.removeprefix("file:"))


def read_slots(out: str, first: int = 0) -> Iterator[np.ndarray]:
    """The sequences from slot ``first`` on, one at a time: what a trainer reads, and goes on with after a stop."""
    fs, folder = _filesystem(out)
    with fs.open_input_stream(f"{folder}/layout.json") as f:
        layout = Layout(**json.loads(f.read()))
    for shard in range(first // layout.per_shard, -(-layout.sequences // layout.per_shard)):
        with fs.open_input_file(f"{folder}/{shard_name(shard)}") as f:
            f.seek(max(0, first - shard * layout.per_shard) * layout.stride)
            while raw := f.read(layout.stride):
                yield np.frombuffer(raw, dtype=f"<u{layout.id_bytes}")


def training_order(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """The index of shards written to a fresh folder under the shared scratch folder."""
    return materialise(docs, path, scratch_path(spark, "shards"))[1]
