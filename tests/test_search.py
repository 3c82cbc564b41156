import numpy as np
import pytest
from conftest import rows, unit
from pyspark.sql import functions as F

from quillon.operators import blocks as B
from quillon.operators import lexical as L
from quillon.operators import search as S


def exact(q, c, k, same=False):
    s = np.round(unit(q) @ unit(c).T, 9)
    out = []
    for i in range(len(q)):
        order = sorted((j for j in range(len(c)) if not (same and i == j)), key=lambda j: (-s[i, j], j))[:k]
        out += [(i, j, r) for r, j in enumerate(order, 1)]
    return sorted(out)


@pytest.fixture
def points(rng):
    mat = rng.standard_normal((60, 8))
    mat[40:55] = mat[3]  # a quarter of the rows are copies
    mat[7] = 0
    return mat


@pytest.mark.parametrize("k", [1, 5, 100])
def test_search_broadcast_and_blocks_agree_with_numpy(spark, vectors, points, k):
    q, c = vectors(points[:20]), vectors(points)
    want = exact(points[:20], points, k)
    assert rows(S.semantic_search(q, c, k), "query_id", "corpus_id", "rank") == want
    blocked = S.top_k(S.block_search(q, c, k), "query_id", "score", "corpus_id", k)
    assert rows(blocked, "query_id", "corpus_id", "rank") == want


@pytest.mark.parametrize("per", [5, 17, 64])
def test_every_unordered_pair_meets_once_whatever_the_block_size(spark, vectors, points, per):
    from pyspark.sql import types as T

    class Count(B.Kernel):
        def pair(self, left, right, same):
            i, j = np.triu_indices(len(left.ids), 1) if same else [x.ravel() for x in np.indices((len(left.ids), len(right.ids)))]
            a, b = left.ids[i], (left if same else right).ids[j]
            yield [np.minimum(a, b), np.maximum(a, b)]

    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    packed = B.pack(vectors(points), rows_per_block=per)
    got = rows(B.product(packed, None, Count, schema))
    assert got == [(i, j) for i in range(60) for j in range(i + 1, 60)]


def test_hot_block_is_cut_into_pieces(spark):
    df = spark.range(200).select(F.lit(5).cast("bigint").alias("id"), F.array(F.col("id").cast("float")).alias("embedding"))
    packed = B.pack(df, rows_per_block=10)
    sizes = [len(r["ids"]) // 8 for r in packed.data.collect()]
    assert sum(sizes) == 200 and max(sizes) <= 20


def test_neighbours_and_mining(spark, vectors, points):
    want = exact(points, points, 4, same=True)
    assert rows(S.neighbours(vectors(points), 4), "query_id", "corpus_id", "rank") == want
    pairs = {(min(i, j), max(i, j)) for i, j, _ in want}
    mined = S.paraphrase_mining(vectors(points), 4, None)
    assert {(r["id1"], r["id2"]) for r in mined.collect()} == pairs
    best = S.paraphrase_mining(vectors(points), 4, 10)
    top = sorted(mined.collect(), key=lambda r: (-r["score"], r["id1"], r["id2"]))[:10]
    assert rows(best) == sorted(tuple(r) for r in top)


def test_similarity_join(spark, vectors, points):
    s = np.round(unit(points) @ unit(points).T, 9)
    want = [(i, j) for i in range(60) for j in range(i + 1, 60) if s[i, j] >= .3]
    assert rows(S.similarity_join(vectors(points), .3), "id1", "id2") == want


def test_matrices(spark, vectors, points):
    a, b = points[:6], points[10:30]
    m = S.score_matrix(vectors(a), vectors(b), "dot")
    assert all(abs(r["score"] - a[r["left_id"]] @ b[r["right_id"]]) < 1e-8 for r in m.collect()) and m.count() == 120
    d = S.distance_matrix(vectors(a), vectors(b), squared=True)
    assert all(abs(r["distance"] - ((a[r["left_id"]] - b[r["right_id"]]) ** 2).sum()) < 1e-8 for r in d.collect())


def test_null_vectors_and_empty_tables(spark, vectors, points):
    c = vectors(points).unionByName(spark.createDataFrame([(99, None)], "id bigint, embedding array<double>"))
    assert 99 not in {r["corpus_id"] for r in S.semantic_search(vectors(points[:2]), c, 100).collect()}
    none = vectors(points).where("id < 0")
    assert S.semantic_search(none, c, 3).count() == 0
    assert S.semantic_search(c, none, 3).count() == 0
    assert S.similarity_join(none, .5).count() == 0


def test_ragged_vectors_are_an_error(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "id bigint, embedding array<double>")
    with pytest.raises(Exception, match="different length"):
        S.similarity_join(df, .5).count()


@pytest.mark.parametrize("search", ["ivf", "lsh"])
def test_approximate_search_finds_most_and_scores_exactly(spark, vectors, rng, search):
    centres = rng.standard_normal((6, 16)) * 4
    mat = centres[rng.integers(0, 6, 300)] + rng.standard_normal((300, 16))
    emb = vectors(mat)
    if search == "ivf":
        ann = S.ivf_search(emb, emb, 6, 2, 5, chunk_rows=40)
    else:
        ann = S.lsh_search(emb, emb, 5, tables=10, bits=4, chunk_rows=40)
    ann.persist()
    truth = S.semantic_search(emb, emb, 5)
    report, missed = S.ann_recall(ann, truth)
    assert report.agg(F.avg("recall")).head()[0] > .8
    assert missed.count() == report.agg(F.sum(F.col("expected") - F.col("hits"))).head()[0]
    s = np.round(unit(mat) @ unit(mat).T, 9)
    assert all(abs(r["score"] - s[r["query_id"], r["corpus_id"]]) < 1e-8 for r in ann.collect())
    assert ann.groupBy("query_id", "corpus_id").count().where("count > 1").count() == 0


def test_ivf_with_all_probes_is_exact(spark, vectors, points):
    emb = vectors(points[:30])
    assert rows(S.ivf_search(emb, emb, 3, 3, 4, chunk_rows=5), "query_id", "corpus_id", "rank") == exact(points[:30], points[:30], 4)


def test_zero_shot_ties_go_to_the_first_label(spark, vectors):
    labels = vectors([[1, 0], [0, 1], [1, 0]])
    got = {r["id"]: r["label"] for r in S.zero_shot_classify(vectors([[2, 0], [0, 3], [1, 1]]), labels).collect()}
    assert got == {0: 0, 1: 1, 2: 0}


TEXTS = ["The cat, the cat!", "a dog and a cat", "dog's -- life", "", None, "cat cat dog bird"]


def test_bm25_paths_agree_with_the_formula(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, text string")
    q = spark.createDataFrame([(0, "cat dog"), (1, "cat cat"), (2, "nothing here")], "id bigint, text string")
    toks = [["the", "cat", "the", "cat"], ["a", "dog", "and", "a", "cat"], ["dog's", "life"], [], [], ["cat", "cat", "dog", "bird"]]
    n, avg = len(toks), sum(map(len, toks)) / len(toks)
    want = {}
    for qi, query in enumerate([["cat", "dog"], ["cat", "cat"], ["nothing", "here"]]):
        for di, d in enumerate(toks):
            s = 0.0
            for w in query:
                df = sum(w in t for t in toks)
                tf = d.count(w)
                s += np.log(1 + (n - df + .5) / (df + .5)) * tf * 2.5 / (tf + 1.5 * (.25 + .75 * len(d) / avg)) if tf else 0.0
            if s:
                want[qi, di] = s
    for limit in (1000, 0):
        got = {(r["query_id"], r["corpus_id"]): r["score"] for r in L.bm25_search(q, docs, 10, broadcast_terms=limit).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-8 for k in want)


def test_rerank_with_column_and_function(spark):
    hits = spark.createDataFrame([(1, 10, "ab", "abcd"), (1, 11, "ab", "a"), (1, 12, "ab", "xyz")], "query_id bigint, corpus_id bigint, query_text string, corpus_text string")
    by_column = S.rerank(hits, F.length("corpus_text").cast("double"), 2)
    by_function = S.rerank(hits, lambda q, p: p.str.len().astype(float), 2)
    assert rows(by_column, "corpus_id", "rerank_rank") == rows(by_function, "corpus_id", "rerank_rank") == [(10, 1), (12, 2)]


def test_encode_is_the_same_in_parallel_and_in_one_task(spark):
    df = spark.createDataFrame([(i, "w " * (i % 9)) for i in range(50)], "id bigint, text string")
    calls = lambda: lambda texts: np.array([[len(t), 1.0] for t in texts])
    many = S.encode(df.repartition(4), "text", calls, 3, normalize=True)
    one = S.encode(df.coalesce(1), "text", calls, 50, normalize=True)
    assert rows(many, "id", "embedding") == rows(one, "id", "embedding")
    assert all(abs(np.linalg.norm(r["embedding"]) - 1) < 1e-5 for r in many.collect())


def test_encode_tokens_has_no_padding(spark):
    df = spark.createDataFrame([(0, "a bb ccc"), (1, ""), (2, "x")], "id bigint, text string")
    out = S.encode_tokens(df, "id", "text", lambda: lambda ts: [np.array([[len(w)] for w in t.split()]).reshape(-1, 1) for t in ts], 2)
    assert rows(out, "id", "pos", "vector") == [(0, 0, [1.0]), (0, 1, [2.0]), (0, 2, [3.0]), (2, 0, [1.0])]


def test_predict_pairs_activations(spark):
    df = spark.createDataFrame([("a", "bb"), ("ccc", "d")], "a string, b string")
    raw = lambda: lambda a, b: np.array([[len(x), len(y), 0.0] for x, y in zip(a, b)])
    out = S.predict_pairs(df, "a", "b", raw, num_outputs=3, softmax=True).collect()
    assert all(abs(sum(r["score"]) - 1) < 1e-9 for r in out)
    one = S.predict_pairs(df, "a", "b", lambda: lambda a, b: np.zeros(len(a))).collect()
    assert [r["score"] for r in one] == [.5, .5]
    assert [r["score"] for r in S.predict_pairs(df, "a", "b", lambda: lambda a, b: np.ones(len(a)), activation=lambda x: x).collect()] == [1.0, 1.0]


def test_kmeans_groups_separated_points(spark, vectors, rng):
    mat = np.vstack([rng.standard_normal((20, 4)) + 30 * i for i in range(3)])
    out, _ = S.kmeans(vectors(mat), 3, seed=1)
    got = {r["id"]: r["cluster"] for r in out.collect()}
    assert all(len({got[i] for i in range(20 * g, 20 * g + 20)}) == 1 for g in range(3)) and len(set(got.values())) == 3


def test_each_distinct_text_is_encoded_once(spark, tmp_path):
    df = spark.createDataFrame([(i, ["a", "bb", None][i % 3]) for i in range(30)], "id bigint, text string")
    log = str(tmp_path)

    def make():
        def run(texts):
            import uuid
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(f"<{t}>" for t in texts))
            return np.array([[float(len(t))] for t in texts])
        return run

    out = S.encode_distinct(df, "text", make)
    assert rows(out, "id", "embedding") == [(i, [[1.0], [2.0], [0.0]][i % 3]) for i in range(30)]
    seen = sorted(x for p in tmp_path.iterdir() for x in p.read_text().split("\n"))
    assert seen == ["<>", "<a>", "<bb>"]


def test_nested_hits(spark, vectors, points):
    hits = S.semantic_search(vectors(points[:4]), vectors(points), 3)
    out = S.nested_hits(hits).collect()
    assert len(out) == 4 and all([h["rank"] for h in r["hits"]] == [1, 2, 3] for r in out)


def test_a_bucket_has_few_chunks_until_they_are_heavy(spark):
    sizes = [1, 2000, 8192, 50_000, 130_000, 1_000_000]
    df = spark.createDataFrame([(n,) for n in sizes], "n bigint").select("n", B.chunk_count(F.col("n"), 2048, 64).alias("c"))
    got = dict(tuple(r) for r in df.collect())
    assert [got[n] for n in sizes] == [1, 1, 4, 4, 4, 31]


def test_scores_of_copies_are_held_a_slice_at_a_time():
    import tracemalloc
    mat = np.ones((2048, 8))
    block, other = B.Block(0, np.arange(2048), mat), B.Block(1, np.arange(2048, 4096), mat)
    top = B.TopK(3, "cos", both=False)
    a, b = top.load(block), top.load(other)
    tracemalloc.start()
    top.pair(a, b, False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20  # the double scores alone would be 32 MB, and several copies of them
    row, who, _ = top.leave(a)[0]
    assert row.tolist() == np.repeat(np.arange(2048), 3).tolist() and set(who.tolist()) == {2048, 2049, 2050}


@pytest.mark.parametrize("left, right", [(1, 1), (1, 50), (24, 24), (147, 147), (400, 3), (1000, 1000)])
def test_a_product_of_two_tables_has_few_groups_and_enough_tasks(left, right):
    groups, slices = B._grid(left, right, 12)
    assert groups <= right and slices <= left and -(-right // groups) <= B.BLOCKS_PER_GROUP
    assert groups * slices >= min(24, left * right) // 2
    if left >= 24:
        assert groups == -(-right // B.BLOCKS_PER_GROUP)


@pytest.mark.parametrize("tables,bits", [(3, 2), (12, 5)])
def test_dense_buckets_are_searched_by_blocks(spark, vectors, rng, monkeypatch, tables, bits):
    mat = rng.standard_normal((260, 8))
    mat[40:60] = mat[3]
    mat[7] = 0
    emb, other = vectors(mat), vectors(mat[:90] + 0.2, ids=range(1000, 1090))
    packed = []
    real = B.pack
    monkeypatch.setattr(B, "pack", lambda *a, **k: packed.append(a) or real(*a, **{**k, "rows_per_block": 64}))
    for q, c in ((emb, emb), (other, emb)):
        monkeypatch.setattr(S, "DENSE", 9.0)
        buckets = rows(S.lsh_search(q, c, 6, tables=tables, bits=bits, chunk_rows=40))
        assert not packed
        monkeypatch.setattr(S, "DENSE", 0.0)
        assert rows(S.lsh_search(q, c, 6, tables=tables, bits=bits)) == buckets
        assert len(packed) == 1 + (q is not c)
        packed.clear()
    twice = emb.unionByName(emb.where("id < 9"))  # an id that comes twice must not fill a list
    S.lsh_search(emb, twice, 6, tables=tables, bits=bits)
    assert not packed


def test_few_copies_where_buckets_are_dense(vectors, rng):
    """Twenty-four tables of four bits: a row is not copied to a bucket of each."""
    emb = vectors(rng.standard_normal((200, 8)))
    plan = S.lsh_search(emb, emb, 3, tables=24, bits=4)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapCoGroups" not in plan


def test_lists_are_sorted_once_for_many_blocks(rng, monkeypatch):
    """The few entries of a late block wait; the lists are those of all entries."""
    mat, sorts = rng.standard_normal((1200, 6)), []
    real = B.Best.settle
    monkeypatch.setattr(B.Best, "settle", lambda self: sorts.append(len(self.waiting)) or real(self))
    top = B.TopK(10, "dot", both=False)
    left = top.load(B.Block(0, np.arange(50), mat[:50]))
    for i, lo in enumerate(range(0, 1200, 20)):
        list(top.pair(left, top.load(B.Block(i, np.arange(lo, lo + 20), mat[lo : lo + 20])), False))
    q, c, s = top.leave(left)[0]
    want = np.round(mat[:50] @ mat.T, 9)
    for i in range(50):
        best = np.lexsort((np.arange(1200), -want[i]))[:10]
        assert c[q == i].tolist() == best.tolist() and s[q == i] == pytest.approx(want[i, best])
    assert len(sorts) < 25 and sum(sorts) == 60
