"""Multi-probe search: the order of the buckets, the bound that ends it, and exactness when nothing is capped."""

import itertools

import numpy as np
import pytest
from conftest import rows, unit

from quillon.operators import probing as P
from quillon.operators import search as S


def test_probe_order(rng):
    for bits in (1, 2, 5, 7):
        costs = np.round(rng.random(bits), 1)  # ties
        want = sorted(sum(c) for n in range(bits + 1) for c in itertools.combinations(costs, n))
        masks, totals = P.probe_order(costs, 1 << bits)
        assert np.allclose(totals, want) and sorted(masks) == list(range(1 << bits)) and masks[0] == 0
        assert np.allclose([sum(costs[i] for i in range(bits) if m >> i & 1) for m in masks], totals)
        assert P.probe_order(costs, 3) == (masks[:3], totals[:3])


def test_bound_holds(rng):
    """No row of a bucket is nearer than the bucket's bound."""
    mat = unit(rng.normal(size=(300, 12)))
    tables = P.make_tables(300, 12, 2, 6, 1, 4)
    home, y = tables.buckets(mat)
    for q in range(20):
        for t in range(2):
            masks, totals = P.probe_order(y[q, t] ** 2, 64)
            bound = {int(home[q, t]) ^ m: 1 - c / 2 for m, c in zip(masks, totals)}
            assert all(mat[q] @ mat[x] <= bound[int(home[x, t])] + 1e-9 for x in range(300))


@pytest.mark.parametrize("tables,bits", [(1, 4), (2, 3), (1, None)])
def test_exact_without_a_cap(vectors, rng, tables, bits):
    mat = rng.normal(size=(250, 6))
    mat[40:70] = mat[40]
    emb = vectors(mat)
    hits, compared = P.multiprobe_search(emb, emb, 5, tables=tables, bits=bits, probes=64, bucket_rows=20, chunk_rows=30)
    cols = ("query_id", "corpus_id", "rank", "score")
    assert rows(hits, *cols) == rows(S.semantic_search(emb, emb, 5), *cols)
    assert 0 < compared <= tables * 250 * 250


def test_stops_early_on_narrow_clusters(vectors, rng):
    centres = unit(rng.normal(size=(20, 16)))
    emb = vectors(np.repeat(centres, 30, axis=0) + 0.002 * rng.normal(size=(600, 16)))
    hits, compared = P.multiprobe_search(emb, emb, 5, tables=1, bits=5, probes=32)
    cols = ("query_id", "corpus_id", "rank")
    assert rows(hits, *cols) == rows(S.semantic_search(emb, emb, 5), *cols)
    assert P.compared_share(emb, emb, compared) < 0.5


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0], "x"), (2, [1.0, 0.0], "x"), (3, None, "x"), (None, [1.0, 0.0], "x"), (4, [0.0, 0.0], "x")], "id bigint, embedding array<double>, bucket string")
    hits, _ = P.multiprobe_search(df, df, 2, tables=1, bits=1, probes=2)
    assert [r for r in rows(hits, "query_id", "corpus_id", "rank") if r[0] < 3] == [(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2)]
    none = df.where("id = 9")
    assert P.multiprobe_search(df, none, 2)[0].count() == 0 and P.multiprobe_search(none, df, 2)[0].count() == 0
