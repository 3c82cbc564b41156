"""Training-data operators against brute force, on texts with odd rows: nulls, blanks, ties, repeated rows, clashing columns."""

import hashlib
import os
import random
import re
import sys
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from quillon.llm import bpe, classifier, exact, html, jaccard, lines, packing, quality, queries, shards, stars, substrings, tokens  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, h string, id bigint, n_words string, token string, __k string"


def sentence(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """(id, text) with copies, near copies, shared passages, junk and odd rows."""
    rng = random.Random(5)
    passage, line = sentence(rng, 60), sentence(rng, 12)
    out = [(i, "\n".join(sentence(rng, rng.randrange(5, 60)) for _ in range(3))) for i in range(40)]
    base = sentence(rng, 150, 5000)
    for i in range(40, 60):
        w = base.split()
        for _ in range(i % 5):
            w[rng.randrange(len(w))] = f"x{rng.randrange(99)}"
        out.append((i, " ".join(w)))
    out += [(60 + i, f"{sentence(rng, 30)}\n{line}\n\n{passage} {sentence(rng, 9)}") for i in range(6)]
    out += [(66, "a " * 200), (67, "a b " * 90), (68, "a"), (69, "a b"), (70, "A  B\t"), (71, None), (72, ""), (73, " \n\t "),
            (74, out[3][1]), (75, out[3][1].replace(" ", "  ")), (76, line), (77, f"{line}\n{line}"), (78, "É" * 300 + " é x" * 40), (79, sentence(rng, 9000))]
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, "h", 1, "n", "t", "k") for i, t in rows], SCHEMA).repartition(3)


ODD = [(None, "no id " * 30), (5, "second text of an id"), (74, None)]


def words(t):
    return WORD.findall(t or "")


def test_exact(spark, corpus):
    rows = corpus + ODD + [corpus[0]]
    got = exact.exact_dedup(table(spark, rows)).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = {(i, min((x for x in v if x is not None), default=None), len(v), hashlib.sha256(k.encode()).hexdigest()) for k, v in groups.items() for i in v}
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def brute_windows(rows, width=20):
    seen, out = set(), {}
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for a in range(len(w) - width + 1):
            key = tuple(w[a : a + width])
            if key in seen:
                gone[a : a + width] = [True] * width
            seen.add(key)
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return out


def test_substrings(spark, corpus):
    got = substrings.substring_query(table(spark, corpus)).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute_windows(sorted(corpus, key=lambda r: r[0]))
    kept = {r.doc_id: r.text for r in substrings.substring_dedup(table(spark, corpus)).collect()}
    assert kept[71] is None and kept[0] == corpus[0][1] and kept[74].strip() == ""
    odd = substrings.substring_query(table(spark, corpus + ODD + [corpus[0]])).collect()
    assert len(odd) == len(corpus) + 4 and sorted(r.n_removed for r in odd if r.doc_id == 0) == [0, len(words(corpus[0][1]))]


def settled_windows(rows, hot):
    """The rows filed for ``rows``, and the windows settled as later copies, without Spark."""
    batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([t for _, t in rows])], ["__id", "text"])
    filed = pa.Table.from_batches(substrings._file(iter([batch]), 20, 2, hot)).combine_chunks().sort_by("key")
    got = pa.Table.from_batches(substrings._settled(iter(filed.to_batches()))).to_pylist()
    return filed, sorted((r["id"], r["at"] + k) for r in got for k in range(r["n"]))


def test_substrings_hot_key(spark):
    """A phrase shorter than a window in every text, with different surroundings: its key is dealt out, the result is the same."""
    rng = random.Random(8)
    phrase = sentence(rng, 14, 9000)
    rows = [(i, f"{sentence(rng, 30, 9000)} {phrase} {sentence(rng, 30, 9000)}") for i in range(200)]
    rows += [(200 + i, rows[i][1]) for i in range(20)]
    whole, want = settled_windows(rows, np.zeros(substrings.COUNTERS, dtype=bool))
    docs = spark.createDataFrame(rows, "__id bigint, text string")
    hot = substrings.hot_counters(docs, 20, 2, 500)
    dealt, got = settled_windows(rows, hot)
    load = lambda t: t.to_pandas().groupby("key").n.sum().max()
    assert hot.any() and load(whole) > 500 and load(dealt) < 500 and got == want and len(want) == 20 * 55
    found = substrings.repeated_windows(docs, hot_windows=500).collect()
    assert sorted((r.id, r["at"] + k) for r in found for k in range(r.n)) == want


def test_substrings_compare_64_bits(monkeypatch):
    """Windows that meet under one key and agree in 40 bits of their hash are not copies."""
    rng = random.Random(9)
    rows = [(i, sentence(rng, 40, 9000)) for i in range(30)]
    monkeypatch.setattr(substrings, "anchors", lambda h, first, width, rounds, f=substrings.anchors: (lambda w, k, p, x: (w, k * np.uint64(0) + np.uint64(7), p, x))(*f(h, first, width, rounds)))
    of = substrings.Prefix.of
    monkeypatch.setattr(substrings.Prefix, "of", lambda self, a, b: of(self, a, b) << np.uint64(40))
    assert settled_windows(rows, np.zeros(substrings.COUNTERS, dtype=bool))[1] == []


def brute_lines(rows, min_lines=2, min_words=8):
    first, pair, out = {}, {}, {}
    for i, t in rows:
        own = [x.strip(" \t\n\x0b\x0c\r") for x in (t or "").split("\n")]
        own = [x for x in own if x]
        gone = set()
        for p, x in enumerate(own):
            if first.setdefault(x, (i, p)) != (i, p) and len(words(x)) >= min_words:
                gone.add(p)
            if p + 1 < len(own) and pair.setdefault((x, own[p + 1]), (i, p)) != (i, p):
                gone |= {p, p + 1}
        out[i] = (len(own), len(gone))
    return out


def test_lines(spark, corpus):
    rows = sorted(corpus, key=lambda r: r[0])
    got = lines.line_dedup(table(spark, corpus)).collect()
    assert {r.doc_id: (r.n_lines, r.n_removed) for r in got} == brute_lines(rows)
    by = {r.doc_id: r for r in got}
    assert by[71].text is None and by[0].text == rows[0][1] and by[76].text == "" and by[0].token == "t"
    assert lines.line_dedup(table(spark, corpus + ODD + [corpus[0]])).count() == len(corpus) + 4
    runs = [(0, "p\nq\nr\ns"), (1, "x\np\nq\nr\ny"), (2, "q\n\nr\ns\nz")]
    three = {r.doc_id: r.text for r in lines.line_dedup(table(spark, runs), min_lines=3).collect()}
    assert three == {0: "p\nq\nr\ns", 1: "x\ny", 2: "z"}


def shingles(t, width):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[a : a + width]) for a in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(rows, width, percent):
    sets, parent = {i: shingles(t, width) for i, t in rows}, {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("width,percent,block", [(3, 90, 4096), (5, 80, 4096), (3, 70, 3)])
def test_jaccard(spark, corpus, width, percent, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    got = jaccard.jaccard_components(table(spark, corpus), width, percent).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == brute_components(corpus, width, percent)


def test_jaccard_odd_rows(spark, corpus):
    rows = corpus[:4] + [corpus[0], (None, corpus[1][1]), (1, "other"), (9, None)]
    got = sorted(map(tuple, jaccard.jaccard_components(table(spark, rows)).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(0, 0), (0, 0), (1, 1), (1, 1), (2, 2), (3, 3), (None, 1), (9, 9)], key=str)


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.vocabulary())


STRANGE = ["lllles aaaa", "don't DON'T 'S x<|endoftext|>y <|startoftext|>", "日本語 🙂 ǅ İ Σας é é", "!!'s _-_ 12 3.4", "ab" * 500, "!" * 300, "×a÷b", " ", "a\x1cb"]


def test_tokens(spark, corpus):
    lib, rows = library(), corpus + [(100 + i, t) for i, t in enumerate(STRANGE)] + ODD
    ids = {t: lib.encode(t or "", add_special_tokens=False).ids for _, t in rows}
    flat, first = tokens.encoder(queries.vocabulary()).texts(pa.array([t for _, t in rows]))
    assert [list(flat[a:b]) for a, b in zip(first[:-1], first[1:])] == [ids[t] for _, t in rows]
    want = sorted((str(i), len(ids[t]), hashlib.sha256(np.array(ids[t], "<u4").tobytes()).hexdigest(),
                   hashlib.sha256(lib.decode(ids[t], skip_special_tokens=False).encode()).hexdigest()) for i, t in rows)
    got = bpe.encode_decode(table(spark, rows), queries.vocabulary()).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == want


def test_packing(spark, corpus):
    lib, capacity = library(), 64
    got = pd.DataFrame([r.asDict() for r in packing.pack_documents(table(spark, corpus), queries.vocabulary(), capacity).collect()])
    for i, t in corpus:
        own = np.array([*lib.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        mine = got[got.doc_id == i].sort_values("piece")
        assert list(mine.start) == list(range(0, len(own), capacity)) and mine.length.sum() == len(own)
        assert list(mine.ids_crc32) == [zlib.crc32(own[a : a + capacity].tobytes()) for a in range(0, len(own), capacity)]
    ordered = got.sort_values(["sequence_id", "offset"])
    end = ordered.offset + ordered.length
    assert (ordered.offset == end.groupby(ordered.sequence_id).shift(1).fillna(0)).all() and end.max() <= capacity
    bins = []  # best fit decreasing, one by one
    for n in sorted(got.length, reverse=True):
        fits = [i for i, g in enumerate(bins) if g >= n]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= n
        else:
            bins.append(capacity - n)
    assert got.sequence_id.nunique() == len(bins)
    assert packing.pack_documents(table(spark, corpus[:3] + ODD + [corpus[0]]), queries.vocabulary()).count() == 7


def test_shards(spark, corpus, tmp_path):
    for n in (1, 2, 7, 64, 1000):
        assert sorted(shards.feistel(np.arange(n), n, 9)) == list(range(n))
    lib, out = library(), str(tmp_path / "s")
    layout, index = shards.materialise(table(spark, corpus), queries.vocabulary(), out, seq_len=32, shard_bytes=500)
    stored = list(shards.read_slots(out))
    assert len(stored) == layout.sequences and all((a == b).all() for a, b in zip(stored[11:], shards.read_slots(out, 11)))
    parts = defaultdict(list)
    for r in index.collect():
        parts[r.doc_id].append((r.start, list(stored[r.slot][r.offset : r.offset + r.length])))
    for i, t in corpus:
        assert [x for _, p in sorted(parts[i]) for x in p] == [*lib.encode(t or "", add_special_tokens=False).ids, shards.SEPARATOR]


def test_quality_rules(spark, corpus):
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(3, 0), (None, 1)], "doc_id bigint, quality int")
    got = {r.doc_id: r for r in quality.quality_rules(table(spark, corpus), labels).collect()}
    for i, t in corpus:
        w = words(t)
        windows = defaultdict(list)
        for a in range(len(w) - 2):
            windows[tuple(w[a : a + 3])].append(a)
        again = len({a + k for v in windows.values() if len(v) > 1 for a in v for k in range(3)})
        full = [x for x in (t or "").split("\n") if words(x)]
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(full) - len(set(full)), again)
        assert r.base_failed == (len(w) < 50 or 100 * again > 50 * len(w)) and r.kept == (not r.base_failed and r.llr >= quality.THRESHOLD)
    assert quality.quality_stage(table(spark, corpus), labels).columns == table(spark, corpus).columns
    assert quality.quality_rules(table(spark, ODD), labels.limit(0)).count() == 3


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_quality_rules_held_out(spark, sf):
    """Good documents whose label is withheld are kept, and most bad ones go (README: how many stay, and sf0.001)."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    fold = "crc32(cast(doc_id as string)) % 5 = 1"
    got = quality.quality_rules(docs, labels.where(f"not {fold}")).where(f"not base_failed and {fold}").join(labels, "doc_id").toPandas()
    good, bad = got[got.quality == 1], got[got.quality == 0]
    assert len(good) > 10 and len(bad) > 0 and good.kept.mean() > 0.98 and bad.kept.mean() < 0.25


def test_quality_rules_leave_own_counts_out(spark):
    """A trusted document scores as it would with its label withheld; the only one of its kind gains nothing by it."""
    rng = random.Random(4)
    docs = table(spark, [(i, sentence(rng, 80, 9000)) for i in range(12)])
    labels = lambda ids: spark.createDataFrame([(i, 1) for i in ids], "doc_id bigint, quality int")
    full, without = ({r.doc_id: r.llr for r in quality.quality_rules(docs, labels(ids)).collect()} for ids in (range(6), range(1, 6)))
    assert full[0] == pytest.approx(without[0], abs=1e-12) and full[6] != without[6]


def test_classifier(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = classifier.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.9 and got.score.between(0, 1).all()
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id)
    odd = classifier.quality_scores(table(spark, ODD + [(1, "x")] * 2), labels.where("quality = 1")).collect()
    assert len(odd) == 5 and {r.predicted for r in odd} == {1}


def test_html(spark):
    body = "<p>one &amp; two<br>three</p><h1>Head\n line</h1><script>var t='</p>'</script>tail"
    rows = [(0, "http://h.x/a/1", f"<nav>menu</nav><article>{body}<div class='comments'>no</div></article><footer>f</footer>"),
            (1, "http://t.x/a/1", "<div>Site</div><p>alpha text</p><p>Terms of use</p>"), (2, "http://t.x/a/2?q", "<div>Site</div><p>beta text</p><p>Terms of use</p>"),
            (3, "http://u.x/a", "<p>same</p><p>page</p>"), (4, "http://u.x/b", "<p>same</p><p>page</p>"), (5, None, None), (None, "bad url", "<p>plain"), (5, None, None)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")
    got = [(r.page_id, r.text, r.n_chars) for r in html.main_text(pages).collect()]
    want = [(0, "one & two three\n\nHead line\n\ntail"), (1, "alpha text"), (2, "beta text"), (3, "same\n\npage"), (4, "same\n\npage"), (5, ""), (None, "plain"), (5, "")]
    assert sorted(got, key=str) == sorted([(*w, len(w[1])) for w in want], key=str)


def test_html_keeps_the_article(spark):
    """Other attributes' values, compound classes, ids and formulas cost an article nothing; what pages of a host share there goes."""
    share = '<div class="share">Share this page</div>'
    body = ('<p><a href="/hidden-valley" title="The hidden valley">valley</a> <b data-hidden="false">shown</b> <i href="/p?id=search" data-id="share-prices">price</i></p>'
            '<section id="discussion"><h2 id="related-work">Discussion {0}</h2><p>since {0}</p></section><div class="article-header">Lead {0}</div>'
            '<p>so <math><mi>x</mi><mo>=</mo><mn>{0}</mn></math></p><p hidden>gone</p><div class="ad">buy</div><div aria-hidden="true">gone</div>')
    rows = [(i, f"http://v.x/a/{i}", f"<div>Site</div><article><h1>Title {i}</h1>{body.format(i)}{share}</article>") for i in (1, 2)]
    rows.append((3, "http://w.x/a", rows[0][2]))
    rows.append((4, "http://w.x/b", rows[0][2]))
    got = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    want = {i: f"Title {i}\n\nvalley shown price\n\nDiscussion {i}\n\nsince {i}\n\nLead {i}\n\nso x={i}" for i in (1, 2)}
    copy = want[1] + "\n\nShare this page"
    assert got == {**want, 3: copy, 4: copy}


def test_shared_lines_is_longest(spark):
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(9))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        assert len(html.shared_lines(a, b)) == best[-1, -1]


def test_empty_tables(spark):
    docs = table(spark, [(1, "x")]).where("doc_id = 0")
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    path = queries.vocabulary()
    made = [exact.exact_dedup(docs), substrings.substring_query(docs), lines.line_query(docs), jaccard.jaccard_components(docs), bpe.encode_decode(docs, path),
            packing.pack_documents(docs, path), shards.training_order(spark, docs, path), quality.quality_rules(docs, labels), classifier.quality_scores(docs, labels),
            html.main_text(spark.createDataFrame([], "page_id bigint, url string, html string"))]
    assert [d.count() for d in made] == [0] * len(made)


def test_pipeline(spark):
    """Stages 8, 5, 1 and 4 by brute force on what the quality rules keep."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, SMALL)
    rows = sorted((r.doc_id, r.text) for r in kept.collect())
    after = corpus_pipeline.line_dedup(spark, kept, SMALL)
    counts = brute_lines(rows)
    lined = sorted((r.doc_id, r.text) for r in after.collect())
    assert [i for i, _ in lined] == [i for i, _ in rows if not counts[i][1] or counts[i][1] < counts[i][0]]
    components = brute_components(lined, 5, 80)
    single = [(i, t) for i, t in lined if components[i][1] == i]
    removed = brute_windows(single)
    want = [i for i, _ in single if not removed[i][1] or removed[i][1] < removed[i][0]]
    got = corpus_pipeline.run(spark, SMALL).toPandas()
    assert sorted(set(got.doc_id)) == want and not got.duplicated(["doc_id", "piece"]).any()
    assert (got.groupby("sequence_id").length.sum() <= packing.CAPACITY).all()
    assert after.columns == docs.columns


@pytest.mark.parametrize("edges", [
    [], [(3, 3)], [(1, 2), (1, 3), (1, 3), (5, 4)], [(i, i + 1) for i in range(40)], [(7, i) for i in range(6)] + [(9, 7), (9, 20)],
    [(random.Random(2).randrange(90) * (i % 7 + 1) % 97, (i * 31) % 97) for i in range(60)]])
def test_star_components(spark, edges):
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    found = stars.star_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, found)) == sorted((x, y) for x, y in root.items() if x != y)


def test_jaccard_merges_components(spark):
    """Two groups of near copies, linked by a pair that is the nearest of neither end."""
    a = [f"p{i}" for i in range(200)]
    texts = [a[:], a[:], a[:], a[:]]
    for t, cut in enumerate([0, 3, 9, 12]):
        texts[t][100 : 100 + cut] = [f"x{i}" for i in range(cut)]
    rows = [(10 * t + i, " ".join([*w, *([f"y{i}"] * i)])) for t, w in enumerate(texts) for i in range(3)]
    for width, percent in [(1, 90), (3, 90), (2, 95), (1, 94)]:
        got = jaccard.jaccard_components(table(spark, rows), width, percent).collect()
        assert {r[0]: tuple(r[1:]) for r in got} == brute_components(rows, width, percent)
