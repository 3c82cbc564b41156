"""The pivot join finds the pairs of the full product, whatever the pivots, leaves and copies."""

import numpy as np
import pytest
from conftest import rows, unit

from quillon.operators import pivots as P
from quillon.operators import search as S


def clustered(rng, n=900, clusters=12, width=10, spread=0.25):
    centres = unit(rng.normal(size=(clusters, width)))
    mat = centres[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, width)) / np.sqrt(width)
    mat[50:150] = mat[50]  # copies of one vector
    return mat


def brute(mat, threshold):
    u = unit(mat)
    s = np.round(u @ u.T, 9)
    i, j = np.nonzero(np.triu(s >= threshold, 1))
    return sorted(zip(i.tolist(), j.tolist()))


@pytest.mark.parametrize("threshold,options", [(0.9, {}), (0.97, {"leaf_rows": 20}), (0.6, {"pivots": 5, "leaf_rows": 64}), (0.9, {"pivots": 1}), (1.0, {"leaf_rows": 9}), (0.05, {"pivots": 30})])
def test_pairs_are_those_of_the_product(vectors, rng, threshold, options):
    mat = clustered(rng)
    pairs, work = P.pivot_join(vectors(mat), threshold, **options)
    got = rows(pairs)
    assert [(a, b) for a, b, _ in got] == brute(mat, threshold)
    assert got == rows(S.similarity_join(vectors(mat), threshold))
    total = len(mat) * (len(mat) - 1) // 2
    compared = sum(r.compared for r in work.collect())
    assert compared >= len(got)
    if threshold >= 0.9 and options.get("pivots") != 1:
        assert compared < 0.25 * total


def test_share_on_narrow_clusters(vectors, rng):
    mat = clustered(rng, 2000, 40, 24, 0.2)
    row = P.compared_share(vectors(mat), 0.9).head()
    assert (row.n_rows, row.n_pairs) == (2000, len(brute(mat, 0.9))) and row.share < 0.1


def test_leaves_hold_their_bound(rng):
    mat = unit(clustered(rng))
    pivots = mat[:7]
    cell, angle = P._homes(mat, pivots)[1:]
    import pyarrow as pa
    key, n = np.unique(cell * P.BINS + P._bin(angle), return_counts=True)
    leaves = P.cut_leaves(pivots, pa.table({"cell": key // P.BINS, "bin": key % P.BINS, "n": n}), 30)
    row, leaf, guest = P.routes(leaves, np.arange(len(mat)), mat, 0.3)
    home = leaf[~guest]
    assert sorted(row[~guest]) == list(range(len(mat))) and (leaves.cell[home] == cell).all()
    assert (angle >= leaves.low[home] - 1e-9).all() and (angle <= leaves.high[home] + 1e-9).all()
    assert np.bincount(home).max() <= 60  # a slice of copies is dealt by hash, so it holds its share on average
    seen = set(zip(row[guest], leaf[guest]))
    assert len(seen) == guest.sum() and not any((r, h) in seen for r, h in zip(row[~guest], home))


def test_odd_rows(spark):
    table = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (None, [1.0, 0.0]), (5, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 7, "x") for i, v in table], "id bigint, embedding array<double>, leaf int, v string")
    assert rows(P.pivot_join(df, 0.5)[0]) == [(1, 2, 1.0)]
    none = df.where("id = 9")
    pairs, work = P.pivot_join(none, 0.5)
    assert pairs.count() == 0 and work.count() == 0
    assert P.compared_share(none, 0.5).head().share == 0
    with pytest.raises(ValueError):
        P.pivot_join(df, 0.0)


def test_guests_of_a_leaf_are_dealt_to_slices(spark, vectors, rng, monkeypatch):
    from quillon.operators import pivots, search
    mat = rng.standard_normal((200, 6))
    mat[50:90] = mat[3]
    emb = vectors(mat)
    want = sorted(tuple(r) for r in search.similarity_join(emb, 0.5).select("id1", "id2").collect())
    whole = pivots.pivot_join(emb, 0.5, pivots=4, leaf_rows=20)[1]
    monkeypatch.setattr(pivots, "GUEST_ROWS", 30)
    met, work = pivots.pivot_join(emb, 0.5, pivots=4, leaf_rows=20)
    assert sorted(tuple(r) for r in met.select("id1", "id2").collect()) == want
    assert sorted(r["leaf"] for r in work.collect()) == sorted(r["leaf"] for r in whole.collect())
    # Seven slices of a leaf's guests: a task's share is far below the table.
    seen = []
    real = type(emb).repartition
    monkeypatch.setattr(type(emb), "repartition", lambda self, *a: seen.append(self) or real(self, *a))
    pivots.pivot_join(emb, 0.5, pivots=4, leaf_rows=20)
    assert seen[0].where("guest").groupBy("leaf").count().agg({"count": "max"}).head()[0] <= 70


def test_a_row_travels_once_to_a_bundle_of_leaves(spark, vectors, rng, monkeypatch):
    """On evenly spread vectors every row meets most leaves; its copies are bounded by the bundles."""
    mat = rng.standard_normal((600, 8))
    seen = []
    emb = vectors(mat)
    real = type(emb).repartition
    monkeypatch.setattr(type(emb), "repartition", lambda self, *a: seen.append(self) or real(self, *a))
    pairs, work = P.pivot_join(emb, 0.5, pivots=40, leaf_rows=15)
    got = [(a, b) for a, b, _ in rows(pairs)]
    assert got == brute(mat, 0.5) and work.count() > 50
    copies = seen[0].count() / len(mat)  # four cores: 6 bundles, 3 slices
    assert copies <= 3 + 6 / 2 + 0.5
    assert seen[0].select("leaf").distinct().count() <= 8 * 3
