"""Fill-in-the-middle, collocations and bit-sliced search against brute force, with odd rows."""

import hashlib
import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from quillon.llm import bitslices, collocations, infill  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, n string, form string, __h1 string, id string, output string, f string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "n", "form", "h", "id", "o", "f") for i, t, lang in rows], SCHEMA).repartition(3)


# Fill-in-the-middle


@pytest.mark.parametrize("kind", ["run", "array", "bitmap"])
def test_containers(kind):
    rng = np.random.default_rng(4)
    low = {"run": np.r_[0:4000, 5000:65536], "array": np.sort(rng.choice(65536, 900, replace=False)),
           "bitmap": np.sort(rng.choice(65536, 30000, replace=False))}[kind]
    made = infill.container(low)
    assert type(made) is {"run": infill.Runs, "array": infill.Array, "bitmap": infill.Bitmap}[kind]
    k = np.r_[0, len(low) - 1, rng.integers(0, len(low), 500)]
    assert (made.select(k) == low[k]).all()


def test_boundary_set():
    rng = np.random.default_rng(5)
    parts = [np.arange(70_000), 200_000 + np.sort(rng.choice(60_000, 25_000, replace=False)), 900_000 + 997 * np.arange(300), [5_000_000]]
    positions = np.concatenate(parts)
    made = infill.BoundarySet(positions)
    assert {type(p) for p in made.parts} == {infill.Runs, infill.Bitmap, infill.Array}
    k = rng.permutation(len(positions))
    assert (made.select(k) == positions[k]).all()
    assert len(infill.BoundarySet(np.zeros(0, dtype=np.int64)).select(np.zeros(0, dtype=np.int64))) == 0


def brute_fill(i, t):
    t = t or ""
    n = len(t)
    d = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * j : 8 * j + 8], 16) for j in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, out, a, b = "plain", t, None, None
    elif h[3] % 100 < 20:
        form, out = "spm", f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    else:
        form, out = "psm", f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (i, n, form, a, None if a is None else b - a, sha(out), sha(t))


def test_fill_in_middle(spark):
    rng = random.Random(6)
    letters = "ab c\n<PSM>é€𝄞̈ｱ"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(40))), "en") for i in range(300)]
    rows += [(300, None, None), (301, "", "en"), (302, "x<S>y", "en"), (303, "é" * 200_000 + "a" * 70_000 + "€x" * 90_000, "en"), (304, "𝄞", "en"),
             (None, "no id", "en"), (5, "second text of an id", "en"), rows[7], (305, "plain ascii " * 9000, "en"), (306, "\x00\x01<", "en")]
    got = infill.fill_query(docs(spark, rows)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted((brute_fill(i, t) for i, t, _ in rows), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_by_words(spark):
    rows = [(i, f"  w{i} two\tthree \n four{i} ", "en") for i in range(50)] + [(50, " \n ", "en"), (51, None, "en")]
    made = infill.fill_in_middle(docs(spark, rows), unit="word", rewritten=100).withColumn("back", infill.restored()).collect()
    text = {i: t or "" for i, t, _ in rows}
    assert all(r.back == text[r.doc_id] for r in made)
    assert {r.n for r in made if r.doc_id < 50} == {4} and {r.doc_id: r.n for r in made}[50] == 1
    for r in made:
        if r.form != "plain":
            units = re.findall(r"^\s*\S*\s*|\S+\s*", text[r.doc_id])
            cut = "".join(units[: r.prefix_units]), "".join(units[r.prefix_units : r.prefix_units + r.middle_units])
            assert f"<P>{cut[0]}<" in r.output and r.output.endswith(f"<M>{cut[1]}")


# Collocations


def brute_phrases(rows, least, longest):
    f, n = defaultdict(Counter), Counter()
    for _, t, lang in rows:
        lang = "und" if lang is None else lang
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", t):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return {x: {g: c for g, c in f[x].items() if c >= least} for x in f}, n


def brute_collocations(rows, least, longest, top, absorbed=100):
    counts, n = brute_phrases(rows, least, longest)
    out = []
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if len(g) > 1}
        gone = set()
        for g, a in found.items():
            for i in range(len(g)):
                for j in range(i + 2, len(g) + 1):
                    if j - i < len(g) and 100 * a >= absorbed * found[g[i:j]]:
                        gone.add(g[i:j])
        ranked = []
        for g, a in found.items():
            if g not in gone:
                score, k = min((1000 * a * n[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows(rng):
    fixed = ["new york city hall", "of the", "Of The Rings", "über alles", "a a a a a a"]
    rows = []
    for i in range(240):
        words = []
        for _ in range(rng.randrange(5, 40)):
            words.append(rng.choice(fixed) if rng.random() < 0.4 else f"w{min(rng.randrange(1, 30), rng.randrange(1, 30))}")
            words.append(rng.choice([" ", " ", "  ", "\t", ", ", ".\n", ";", "\x0b"]))
        rows.append((i, "".join(words), rng.choice(["en", "en", "de", None, ""])))
    return rows + [(None, None, "en"), (900, "", "fr"), (901, " ,;\n", None), rows[0], rows[0], (902, "of the " * 3000, "en"), (903, "z\xa0z z z", "de")]


def test_phrase_counts_and_scores(spark):
    rows = phrase_rows(random.Random(7))
    want = brute_collocations(rows, 12, 5, 40)
    assert len(want) > 40 and len({r[0] for r in want}) >= 3
    got = collocations.collocations(docs(spark, rows), least=12, top=40)
    assert sorted(map(tuple, got.collect())) == want
    # Without a broadcast, with hot leading words at every depth and with small merges the result is the same.
    for options in ({"most_words": 3}, {"task_rows": 40, "counters": 1 << 12, "merge_rows": 50}, {"task_rows": 40, "counters": 1 << 12, "most_words": 0}):
        assert sorted(map(tuple, collocations.collocations(docs(spark, rows), least=12, top=40, **options).collect())) == want
    loose = collocations.collocations(docs(spark, rows), least=12, longest=3, top=1000, absorbed=50)
    assert sorted(map(tuple, loose.collect())) == brute_collocations(rows, 12, 3, 1000, 50)


def test_hot_pointers_are_split():
    """A pointer of hot leading words is routed by more of them."""
    rng = np.random.default_rng(8)
    h = np.tile(np.array([11, 12, 0], dtype=np.uint64), 400)
    h[2::3] = rng.integers(100, 10**6, 400).astype(np.uint64)
    ends = np.full(len(h), len(h))
    coder = collocations.Coder(np.unique(h))
    counters = np.zeros(1 << 12, dtype=np.int64)
    for length, key in collocations._leading(h, ends, 5):
        if length > 1:
            counters += np.bincount((key % np.uint64(1 << 12)).astype(np.int64), minlength=1 << 12)
    rows, depth = collocations.pointers(h, ends, coder, counters > 200, 5)
    starts = rows[:, 0] == coder.code(np.array([11], dtype=np.uint64))[0]
    assert (depth[starts][:-2] >= 3).all() and (depth[~starts] < 6).all()


def test_equal_partitions():
    rng = np.random.default_rng(9)
    for least in (1, 3, 20):
        rows = rng.integers(0, 4, (400, 4))
        rows[np.cumsum(rows == 0, axis=1) > 0] = 0
        weight = rng.integers(1, 5, 400)
        count = Counter()
        for r, w in zip(rows.tolist(), weight.tolist()):
            for k in range(2, 5):
                if all(r[:k]):
                    count[tuple(r[:k])] += w
        got = {tuple(rows[i, :k].tolist()): c for i, k, c in collocations.equal_partitions(rows, weight, [least] * 4)}
        assert got == {g: c for g, c in count.items() if c >= least}


def test_packing():
    rng = np.random.default_rng(10)
    for bits in (1, 13, 21, 40, 64):
        rows = rng.integers(0, 1 << min(bits, 62), (50, 5))
        assert (collocations.unpack(collocations.pack(rows, bits), bits, 5) == rows).all()


# Bit-sliced search


def brute_topk(rows, k=20, every=20, scale=64):
    known = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(scale * float(x)) for x in v]
            known[i] = min(known[i], q) if i in known else q
    out = []
    for i, q in known.items():
        if i % every == 0:
            score = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, w in known.items() if j != i)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(score[:k], 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "r", 1, "s", "b") for i, v in rows], "vec_id bigint, embedding array<double>, rank string, id bigint, score string, block string").repartition(3)


def vector_rows(rng, n=700, width=9):
    mat = rng.normal(size=(n, width)) / 3
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(mat)]
    rows += [(1000 + i, rows[20][1]) for i in range(60)]  # many equal scores
    rows += [(2000, None), (2001, [None] * width), (2020, [float("nan")] * width), (2040, [float("inf")] * width), (None, rows[3][1]),
             (2060, []), (2080, rows[5][1][:4]), (40, rows[40][1]), (60, rows[61][1]), (-20, [0.0] * width), (2100, [1e4, -1e4] + [0.0] * (width - 2))]
    return rows


@pytest.mark.parametrize("block_rows", [1 << 16, 90])
def test_topk(spark, rng, block_rows):
    rows = vector_rows(rng)
    got = bitslices.topk_search(vectors(spark, rows), block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == brute_topk(rows)


def test_topk_few_rows(spark):
    rows = [(0, [0.5, -0.25]), (20, [0.1, 0.9]), (21, [0.1, 0.9])]
    assert sorted(map(tuple, bitslices.topk_search(vectors(spark, rows)).collect())) == brute_topk(rows)
    assert bitslices.topk_search(vectors(spark, rows[:1])).count() == 0
    same = [(i, [0.25, 0.25]) for i in range(45)]  # no slices at all
    assert sorted(map(tuple, bitslices.topk_search(vectors(spark, same)).collect())) == brute_topk(same)


def test_bitmap_sums(rng):
    for low_bits in (0, 1, 2, 5):
        values = rng.integers(-40, 60, (500, 7))
        index = bitslices.load(*(x.tobytes() for x in (np.arange(500), *bitslices.build(np.arange(500), values))))
        query = rng.integers(-30, 30, 7)
        ids, score = bitslices.search_block(index, -1, query, 25, low_bits)
        exact = values @ query
        want = np.lexsort((np.arange(500), -exact))[:25]
        assert (ids == want).all() and (score == exact[want]).all()
    maps = {0: rng.integers(0, 2**63, (9, 4)).astype(np.uint64), 3: rng.integers(0, 2**63, (2, 4)).astype(np.uint64)}
    total = bitslices.add_up(maps)
    plain = sum((1 << p) * np.unpackbits(m.view(np.uint8), axis=1, bitorder="little").astype(int).sum(axis=0) for p, m in maps.items())
    bits = np.unpackbits(total.view(np.uint8), axis=1, bitorder="little").astype(int)
    assert (plain == (bits << np.arange(len(total))[:, None]).sum(axis=0)).all()


def test_topk_overflow():
    values = np.array([[2**40, 0], [0, 2**40]])
    index = bitslices.load(*(x.tobytes() for x in (np.arange(2), *bitslices.build(np.arange(2), values))))
    with pytest.raises(OverflowError):
        bitslices.search_block(index, 5, np.array([2**40, 1]), 1)


def test_empty_tables(spark):
    none = docs(spark, [(1, "x", "en")]).where("doc_id = 0")
    assert infill.fill_query(none).count() == 0
    assert collocations.collocations(none).count() == 0
    assert bitslices.topk_search(vectors(spark, [(0, [0.1])]).where("vec_id = 1")).count() == 0
    blank = docs(spark, [(1, None, None), (2, "", "en")])
    assert collocations.collocations(blank, least=1).count() == 0 and infill.fill_query(blank).count() == 2
