"""Byte-pair encoding by a tokenization automaton, and decoding by the labels of its arcs.

The automaton reads tokens. It starts with one state that has an arc for every base symbol, and every merge ``(u, v)`` in
order applies one gadget: wherever an arc ``u`` is followed by an arc ``v``, an arc ``uv`` is added past both, and ``u`` from
now on leads to a copy of its target without ``v``. What is left after the last gadget accepts exactly the token sequences
that the merges produce, so each string has one accepted path.

A state is known by the last token read, and the gadget of merge number ``k`` removes arcs from a *rectangle* of the
transition table: the rows are the tokens that end in a ``u`` still open after merge ``k``, the columns the tokens that begin
with a ``v`` still open then. In a preorder of the tokens by right (left) part, children with later merges first, both sets
are intervals. The rows of the table are those intervals, laid out when a state is first entered.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import words as W
from .pretokens import coded_words

# What a worker remembers between words: bounds its memory (about 300 MB), not the words it can encode.
MEMO = 800_000
ARCS = 500_000


@functools.cache
def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable Latin-1, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def _preorder(part: list[int], rank: list[int]) -> tuple[list[int], list[list[int]], list[list[int]]]:
    """For the forest in which ``part[t]`` is the parent of ``t`` (-1: none): each token's place, its children from the latest
    merge to the earliest as merge numbers, and the place after each child's subtree."""
    children: list[list[int]] = [[] for _ in part]
    for t, p in enumerate(part):
        if p >= 0:
            children[p].append(t)
    for c in children:
        c.sort(key=lambda t: -rank[t])
    place, ends = [0] * len(part), [[] for _ in part]
    next_place = 0
    for root in (t for t, p in enumerate(part) if p < 0):
        place[root] = next_place
        next_place += 1
        stack = [(root, iter(children[root]))]
        while stack:
            t, left = stack[-1]
            c = next(left, None)
            if c is not None:
                place[c] = next_place
                next_place += 1
                stack.append((c, iter(children[c])))
            else:
                stack.pop()
                if stack:
                    ends[stack[-1][0]].append(next_place)
    return place, [[-rank[t] for t in c] for c in children], ends


class Automaton:
    """Compiled from a ``tokenizers`` file with a BPE model, an end-of-word suffix and lower-cased text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.labels = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        cut = len(self.suffix)
        self.inner = self.vocab
        self.final = {t[: len(t) - cut]: i for t, i in self.vocab.items() if t.endswith(self.suffix)}
        self.longest = max(map(len, self.vocab))
        self._compile(model["merges"])
        self.rows: dict[int, tuple[list[int], list[int]]] = {}
        self.arcs: dict[int, bool] = {}
        self.pieces_known: dict[str, tuple[int, bytes, bytes]] = {}

    def _compile(self, merges: list) -> None:
        size = max(self.vocab.values()) + 1
        left, right, rank = [-1] * size, [-1] * size, [-1] * size
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        for k, (u, v) in enumerate(pairs):
            token = self.vocab[u + v]
            if rank[token] < 0:
                left[token], right[token], rank[token] = self.vocab[u], self.vocab[v], k
        self.right, self.rank = right, rank
        self.column, later, ends = _preorder(left, rank)
        #: Per token u its gadgets by merge number, and the columns each one removes after u.
        self.gadgets: list[tuple[list[int], list[tuple[int, int]]]] = [([], []) for _ in range(size)]
        for k, (u, v) in enumerate(pairs):
            # After the gadget of (u, u) the arc uu is not there either, because u no longer follows u.
            among = bisect.bisect_right if u == v else bisect.bisect_left
            v = self.vocab[v]
            open_children = among(later[v], -k)
            stop = ends[v][open_children - 1] if open_children else self.column[v] + 1
            ks, cut = self.gadgets[self.vocab[u]]
            ks.append(k)
            cut.append((self.column[v], stop))

    def _row(self, state: int) -> tuple[list[int], list[int]]:
        """The removed columns of a state as disjoint intervals: the starts and the ends."""
        cut, token, before = [], state, 1 << 60
        while token >= 0:
            ks, intervals = self.gadgets[token]
            cut += intervals[: bisect.bisect_left(ks, before)]
            before, token = self.rank[token], self.right[token]
        starts, ends = [], []
        for a, b in sorted(cut):
            if ends and a <= ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                starts.append(a)
                ends.append(b)
        self.rows[state] = starts, ends
        return starts, ends

    def allows(self, state: int, token: int) -> bool:
        """Whether the state after ``state`` has an arc ``token``."""
        starts, ends = self.rows.get(state) or self._row(state)
        column = self.column[token]
        i = bisect.bisect_right(starts, column)
        return not i or ends[i - 1] <= column

    def path(self, symbols: str) -> list[int]:
        """The accepted path over a pre-token (byte symbols, without the suffix).

        Arcs are tried from the longest on. Every prefix has one accepted path, so a position from which the end was not
        reached once is never entered again.
        """
        n, inner, final, known = len(symbols), self.inner, self.final, self.arcs
        tokens, places, dead = [], [0], set()
        at, length = 0, min(n, self.longest)
        while at < n:
            while length:
                stop = at + length
                token = (final if stop == n else inner).get(symbols[at:stop])
                if token is not None and stop not in dead:
                    if not tokens:
                        break
                    arc = tokens[-1] << 20 | token
                    allowed = known.get(arc)
                    if allowed is None:
                        if len(known) >= ARCS:
                            known.clear()
                        allowed = known[arc] = self.allows(tokens[-1], token)
                    if allowed:
                        break
                length -= 1
            if length:
                tokens.append(token)
                places.append(stop)
                at = stop
                length = min(n - at, self.longest)
            else:
                dead.add(places.pop())
                tokens.pop()
                length, at = at - places[-1] - 1, places[-1]
        return tokens

    def pretokens(self, text: str) -> list[str]:
        """Normalised and split text without special tokens, as byte symbols."""
        if text.isascii():
            text = text.lower()
            if text.isalpha():
                return [text]
            if text.isprintable():  # stands for itself as byte symbols
                return self.pieces.findall(text)
        else:
            text = "".join(c.lower() for c in unicodedata.normalize("NFC", text))
        table = byte_symbols()
        return ["".join(table[b] for b in p.encode()) for p in self.pieces.findall(text)]

    def _pack(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        return len(ids), struct.pack(f"<{len(ids)}I", *ids), "".join(self.labels[i] + " " for i in ids).encode()

    def piece(self, piece: str) -> tuple[int, bytes, bytes]:
        found = self.pieces_known.get(piece)
        if found is None:
            if len(self.pieces_known) >= MEMO:
                self.pieces_known.clear()
            found = self.pieces_known[piece] = self._pack(self.path(piece))
        return found

    def packed(self, text: str) -> tuple[int, bytes, bytes]:
        """The number of ids of a text, the ids as little-endian 32-bit numbers, and the arcs' labels, a space after each."""
        out = []
        for part in self.specials.split(text) if self.specials and "<" in text else (text,):
            if part in self.special:
                out.append(self._pack([self.special[part]]))
            elif part:
                out += map(self.piece, self.pretokens(part))
        if len(out) == 1:
            return out[0]
        return sum(x[0] for x in out), b"".join([x[1] for x in out]), b"".join([x[2] for x in out])

    def encode(self, text: str) -> list[int]:
        n, ids, _ = self.packed(text)
        return list(struct.unpack(f"<{n}I", ids))

    def decode(self, ids: list[int]) -> str:
        """The labels of the arcs, one space between two."""
        return " ".join(self.labels[i] for i in ids)


@functools.lru_cache(maxsize=2)
def automaton(path: str) -> Automaton:
    """One compiled automaton per worker process and file."""
    return Automaton(path)


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    Texts are encoded whole, without added special tokens (special tokens written in a text are recognised), and decoded
    again from the ids. A null text counts as empty: no ids, and the hashes of nothing. Every row stands for itself, so
    null ids, repeated rows and further columns change nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in W.slices(batches):
            codes, distinct, first = coded_words(batch.column("text"))
            codes, first = codes.tolist(), first.tolist()
            packed = list(map(machine.packed, distinct.to_pylist()))
            sizes, ids, labels = zip(*packed) if packed else ((), (), ())
            rows = []
            for a, b in zip(first[:-1], first[1:]):
                own = codes[a:b]
                rows.append((sum(map(sizes.__getitem__, own)), hashlib.sha256(b"".join(map(ids.__getitem__, own))).hexdigest(),
                             hashlib.sha256(b"".join(map(labels.__getitem__, own))[:-1]).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
