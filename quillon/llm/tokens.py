"""Token ids of whole texts under a ``tokenizers`` file with a lower-casing word BPE, in numpy over the distinct words.

The ids are those of the library's ``encode(text, add_special_tokens=False)``. Words of ASCII and Latin-1 letters are
split, lower-cased and merged for all distinct words of a batch at once; every other word (apostrophes, possible special
tokens, other scripts, over-long pieces) is encoded by the library itself.
"""

from __future__ import annotations

import functools
import json
import os

import numpy as np
import pyarrow as pa

from .bpe import byte_symbols
from .pretokens import coded_words, ragged

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20  # log2 of the slots of the merge table
_LAST = np.int32(2**31 - 1)
LONGEST = 64  # longer pieces go to the library

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LETTER, _DIGIT, _MARK, _ODD = 1, 2, 3, 4
_KIND = np.full(256, _ODD, dtype=np.uint8)
_KIND[0x21:0x7F] = _MARK
_KIND[ord("a") : ord("z") + 1] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[[ord("'"), ord("<")]] = _ODD


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)["model"]
        vocab, suffix = spec["vocab"], spec["end_of_word_suffix"] or ""
        self.size = max(vocab.values()) + 1
        symbols = byte_symbols()
        self.inner = np.array([vocab[c] for c in symbols], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in symbols], dtype=np.int64)
        self._table([m.split(" ") if isinstance(m, str) else m for m in spec["merges"]], vocab)

    def _table(self, merges: list, vocab: dict[str, int]) -> None:
        """Open addressing: pair -> rank and merged id."""
        slots = (1 << _SLOTS) + 64
        self.keys = np.full(slots, _NONE)
        self.ranks = np.full(slots, _LAST, dtype=np.int32)
        self.merged = np.zeros(slots, dtype=np.int64)
        self.probes = 1
        keys = np.array([vocab[u] * self.size + vocab[v] for u, v in merges], dtype=np.uint64)
        for rank, (key, at) in enumerate(zip(keys, (keys * _MULTIPLIER >> np.uint64(64 - _SLOTS)).tolist())):
            step = 0
            while self.keys[at + step] != _NONE:
                step += 1
            self.probes = max(self.probes, step + 1)
            self.keys[at + step], self.ranks[at + step] = key, rank
            self.merged[at + step] = vocab["".join(merges[rank])]

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of pairs (``_LAST`` where there is no merge)."""
        key = (a * self.size + b).astype(np.uint64)
        at = (key * _MULTIPLIER >> np.uint64(64 - _SLOTS)).astype(np.int64)
        for _ in range(self.probes - 1):
            at += (self.keys[at] != key) & (self.keys[at] != _NONE)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], _LAST), self.merged[at]

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pieces at once: in every round each piece merges its first pair of lowest rank. Ids and lengths by piece."""
        n = len(lengths)
        done_piece, done_length, done_ids = [], [], []
        piece = np.arange(n)
        ends = np.cumsum(lengths)
        rank = np.full(len(symbols), _LAST, dtype=np.int32)
        new = np.zeros(len(symbols), dtype=np.int64)
        inside = np.ones(len(symbols), dtype=bool)
        inside[ends - 1] = False
        at = np.flatnonzero(inside)
        rank[at], new[at] = self._pairs(symbols[at], symbols[at + 1])
        while len(piece):
            starts = ends - lengths
            least = np.minimum.reduceat(rank, starts)
            live = least < _LAST
            if not live.all():
                stays = np.repeat(live, lengths)
                done_piece.append(piece[~live])
                done_length.append(lengths[~live])
                done_ids.append(symbols[~stays])
                piece, lengths, least = piece[live], lengths[live], least[live]
                symbols, rank, new = symbols[stays], rank[stays], new[stays]
                ends = np.cumsum(lengths)
                if not len(piece):
                    break
            owner = np.repeat(np.arange(len(piece)), lengths)
            at = np.flatnonzero(rank == least[owner])
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]  # one for each piece
            symbols[at] = new[at]
            stays = np.ones(len(symbols), dtype=bool)
            stays[at + 1] = False
            symbols, rank, new = symbols[stays], rank[stays], new[stays]
            lengths = lengths - 1
            ends = np.cumsum(lengths)
            at = at - np.arange(len(at))
            rank[at] = _LAST
            right = at[at < ends - 1]
            left = at[at > ends - lengths] - 1
            for where in (right, left):
                rank[where], new[where] = self._pairs(symbols[where], symbols[where + 1])
        order = np.argsort(np.concatenate([np.zeros(0, np.int64), *done_piece]), kind="stable")
        sizes = np.concatenate([np.zeros(0, np.int64), *done_length])
        first = np.concatenate([[0], np.cumsum(sizes)])
        ids, begins = ragged(np.concatenate([np.zeros(0, np.int64), *done_ids]), first, order)
        return ids, begins

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words: flat, and where each word's ids begin."""
        words = words.cast(pa.large_string())
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
        raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        offsets = offsets - offsets[0]
        lower = _LOWER[raw]
        kind = _KIND[lower]
        second = np.zeros(len(raw), dtype=bool)  # of a Latin-1 letter: 0xC3 and 0x80-0xBF without the two signs
        second[1:] = (raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        kind[second] = _LETTER
        kind[:-1][second[1:]] = _LETTER
        lower[second & (raw <= 0x9E)] += 0x20
        lengths = np.diff(offsets)
        odd = np.zeros(len(words), dtype=bool)
        total = np.concatenate([[0], np.cumsum(kind == _ODD)])
        odd = total[offsets[1:]] > total[offsets[:-1]]
        # Pieces: words cut where the kind changes; a digit is a piece of its own.
        begin = np.ones(len(raw), dtype=bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        begin[offsets[:-1][lengths > 0]] = True
        starts = np.flatnonzero(begin)
        sizes = np.diff(np.append(starts, len(raw)))
        of_word = np.searchsorted(offsets, starts, side="right") - 1
        odd[of_word[sizes > LONGEST]] = True
        keep = ~odd[of_word]
        plain = np.repeat(keep, sizes)
        sizes, of_word, flat = sizes[keep], of_word[keep], lower[plain]
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(flat.tobytes())])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary
        ids, begins = np.zeros(0, np.int64), np.zeros(1, np.int64)
        if len(distinct):
            _, at, text = distinct.buffers()
            at = np.frombuffer(at, dtype=np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
            symbols = self.inner[np.frombuffer(text, dtype=np.uint8)[at[0] : at[-1]]]
            stops = at[1:] - at[0] - 1
            symbols[stops] = self.final[np.frombuffer(text, dtype=np.uint8)[at[1:] - 1]]
            ids, begins = self._merge(symbols, np.diff(at))
        codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        counts = np.bincount(of_word, np.diff(begins)[codes], minlength=len(words)).astype(np.int64) if len(codes) else np.zeros(len(words), np.int64)
        values, _ = ragged(ids, begins, codes)
        if odd.any():
            where = np.flatnonzero(odd)
            more = [e.ids for e in self.library.encode_batch_fast(words.take(pa.array(where)).to_pylist(), add_special_tokens=False)]
            counts[where] = [len(x) for x in more]
            first = np.concatenate([[0], np.cumsum(counts)])
            whole = np.zeros(first[-1], dtype=np.int64)
            from_library = np.repeat(odd, counts)
            whole[~from_library] = values
            whole[from_library] = np.concatenate([np.array(x, dtype=np.int64) for x in more]) if more else values[:0]
            return whole, first
        return values, np.concatenate([[0], np.cumsum(counts)])

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts (null: none): flat, and where each text's ids begin."""
        codes, distinct, first = coded_words(texts)
        if not len(distinct):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        ids, begins = ragged(*self.words(distinct), codes)
        return ids, begins[first]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    return Encoder(path)
