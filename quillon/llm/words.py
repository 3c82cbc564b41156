"""Words, lines and hashes of Arrow text batches as numpy arrays.

A word is a run of bytes outside space and 0x09-0x0D; in UTF-8 that equals the same rule on characters. A null text has no
words. Batches are cut into slices of a few megabytes, so that a task's memory does not follow the size of a batch; a
single text longer than a slice is one slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
U = np.uint64
_K = [U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)]
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], dtype=U)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


class Spans(NamedTuple):
    """``starts`` and ``ends`` in bytes; document ``d`` owns the spans ``first[d] .. first[d + 1] - 1``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of at most ``size`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start, base = np.cumsum(lengths), 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array, and the offsets of the texts in it."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _spans(inside: np.ndarray, offsets: np.ndarray) -> Spans:
    """Maximal runs of ``inside`` that do not cross the given offsets."""
    n = len(inside)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    if n:
        starts[1:] &= ~inside[:-1] | cut[1:n]
        ends[:-1] &= ~inside[1:] | cut[1:n]
    starts = np.flatnonzero(starts)
    return Spans(starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    return _spans(~IS_SPACE[data], offsets)


def line_spans(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """The non-empty pieces between line ends."""
    return _spans(data != 0x0A, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (every input bit reaches every output bit)."""
    h = (h ^ (h >> U(30))) * _K[1]
    h = (h ^ (h >> U(27))) * _K[2]
    return h ^ (h >> U(31))


def hash_spans(data: np.ndarray, spans: Spans, seed: int = 0) -> np.ndarray:
    """64-bit hash of the bytes of every span, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    at, left = spans.starts.copy(), spans.ends - spans.starts
    h = mix(left.astype(U) * _K[0] + U(seed * 2 + 1))
    live = np.arange(len(at))
    while len(live):
        part = words[at] & _MASK[np.minimum(left, 8)]
        h[live] = mix(h[live] * _K[0] ^ part)
        more = left > 8
        if not more.any():
            break
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


def pair_hash(a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
    """Order-dependent hash of two hashes."""
    salt = U((seed * 2 + 1) * int(_K[0]) & 0xFFFFFFFFFFFFFFFF)
    return mix(mix(a + salt) * _K[0] ^ b)


def window_hash(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``width`` consecutive hashes (runs may cross documents; the caller masks those)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    out = h[:n]
    for i in range(1, width):
        out = pair_hash(out, h[i : i + n], seed)
    return out if width > 1 else out.copy()


def windows_inside(spans: Spans, width: int) -> np.ndarray:
    """The starts of windows of ``width`` spans that lie in one document."""
    n = len(spans.starts)
    ok = np.zeros(n + 1, dtype=np.int32)
    last = np.maximum(spans.first[1:] - width + 1, spans.first[:-1])
    np.add.at(ok, spans.first[:-1], 1)
    np.add.at(ok, last, -1)
    return np.flatnonzero(np.cumsum(ok[:-1]) > 0)


def per_document(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """True where a key occurs more than once."""
    out = np.zeros(len(keys), dtype=bool)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        same = keys[order[1:]] == keys[order[:-1]]
        out[order[1:]] = same
        out[order[:-1]] |= same
    return out
