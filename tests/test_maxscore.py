"""Top-k sums under score bounds against the full sums."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quillon.operators import lexical as L
from quillon.operators import maxscore as M


def brute(queries, texts, k, k1=1.5, b=0.75):
    bags = {i: Counter(t.split()) for i, t in texts}
    n, df = len(bags), Counter(w for bag in bags.values() for w in bag)
    mean = sum(sum(bag.values()) for bag in bags.values()) / n
    out = {}
    for q, text in queries:
        scores = []
        for i, bag in bags.items():
            s = sum(c * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * bag[w] * (k1 + 1) / (bag[w] + k1 * (1 - b + b * sum(bag.values()) / mean))
                    for w, c in Counter(text.split()).items() if w in bag)
            if any(w in bag for w in text.split()):
                scores.append((-round(s, 9), i))
        out[q] = [(i, round(-s, 6)) for s, i in sorted(scores)[:k]]
    return {q: hits for q, hits in out.items() if hits}


def corpus(rng, n=600):
    """Word w0 is in most texts; others thin out; some texts are copies."""
    texts = []
    for i in range(n):
        words = [f"w{min(int(x), 80)}" for x in rng.zipf(1.3, rng.integers(3, 40))]
        texts.append((i, " ".join(words + ["common"] * (i % 5 > 0))))
    texts[100:130] = [(i, texts[99][1]) for i in range(100, 130)]
    return texts


@pytest.mark.parametrize("slice_texts", [50, 10_000])
def test_same_hits(spark, rng, slice_texts):
    texts = corpus(rng)
    queries = [(q, " ".join(rng.choice([f"w{i}" for i in range(60)], 4).tolist() + ["common", "common"])) for q in range(30)]
    queries += [(30, "common"), (31, "nowhere"), (32, "w59"), (33, texts[99][1])]
    q, d = (spark.createDataFrame(x, "id bigint, text string").repartition(3) for x in (queries, texts))
    got = {}
    for r in sorted(L.bm25_search(q, d, 7, broadcast_terms=0, slice_texts=slice_texts).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.corpus_id, round(r.score, 6)))
    assert got == brute(queries, texts, 7)


def impacts(spark, rng):
    """One word in all texts with small impacts, one rare word with a great one."""
    rows = [(i, "often", float(rng.uniform(0.01, 0.1))) for i in range(4000)] + [(i * 100, "rare", float(rng.uniform(4, 5))) for i in range(40)]
    return rows, spark.createDataFrame(rows, "corpus_id bigint, token string, impact double")


def test_no_row_below_the_floor(spark, rng):
    rows, table = impacts(spark, rng)
    terms = spark.createDataFrame([(1, "often", 1), (1, "rare", 1), (2, "often", 2)], "query_id bigint, token string, qtf bigint")
    floors = {r.query_id: r.floor for r in M.query_floors(terms, table.withColumn("slice", table.corpus_id % 4), 5).collect()}
    got = M.block_max_search(terms, table, 4000, 5, slice_texts=500).collect()
    assert all(r.score >= floors[r.query_id] for r in got)
    total = Counter()
    for i, w, x in rows:
        total[1, i] += x
        total[2, i] += 2 * x * (w == "often")
    for q in (1, 2):
        want = sorted(((-round(s, 9), i) for (p, i), s in total.items() if p == q))[:5]
        assert sorted((-r.score, r.corpus_id) for r in got if r.query_id == q)[:5] == want
    assert sum(r.query_id == 1 for r in got) <= 40  # of 4,000 texts that share a word with it


def test_a_word_in_most_texts_names_no_candidates(spark, rng):
    rows, _ = impacts(spark, rng)
    tokens, ids, weights = (list(x) for x in zip(*[(w, i, x) for i, w, x in rows]))
    index = M.Slice(pa.array(tokens), np.array(ids), np.array(weights))
    found, score = index.search(["often", "rare"], [1.0, 1.0], 5, 4.0)
    assert len(found) == 5 and index.scored == 40
    before = index.scored
    index.search(["often"], [1.0], 5, 0.0999)  # only the blocks of great impact
    assert index.scored - before <= 4 * M.BLOCK


def test_nothing_to_find(spark):
    q = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "id bigint, text string")
    d = spark.createDataFrame([(1, "c"), (2, None), (3, "a")], "id bigint, text string")
    assert [(r.query_id, r.corpus_id) for r in L.bm25_search(q, d, 3, broadcast_terms=0).collect()] == [(1, 3)]
    assert L.bm25_search(q, d.where("id = 9"), 3, broadcast_terms=0).count() == 0
    assert L.bm25_search(q.where("id = 9"), d, 3, broadcast_terms=0).count() == 0
