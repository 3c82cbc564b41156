from collections import Counter

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from quillon.operators import datasets as N


def test_nli_triplets_need_both_kinds(spark):
    df = spark.createDataFrame([("a", "b", "entailment"), ("a", "c", "contradiction"), ("a", "d", "neutral"), ("x", "y", "entailment")], "s1 string, s2 string, label string")
    assert rows(N.nli_triplets(df)) == [("first", "a", "b", "c"), ("second", "b", "a", "c")]


def test_label_triplets(spark, rng):
    labels = [0] * 60 + [1] * 20 + [2] * 2 + [3]
    df = spark.createDataFrame(list(enumerate(labels)), "id bigint, label bigint")
    got = N.label_triplets(df, "label").collect()
    assert sorted(r["anchor"] for r in got) == list(range(82))
    for a, p, n in got:
        assert labels[a] == labels[p] and a != p and labels[a] != labels[n]
    assert rows(N.label_triplets(df.repartition(7), "label")) == sorted(tuple(r) for r in got)


def brute(mat, labels, ids):
    d = np.round(np.sqrt(((mat[:, None] - mat[None]) ** 2).sum(2)), 9)
    out = {}
    for i in ids:
        p = [j for j in ids if labels[j] == labels[i] and j != i]
        n = [j for j in ids if labels[j] != labels[i]]
        if p and n:
            out[i] = (max(p, key=lambda j: (d[i, j], -j)), min(n, key=lambda j: (d[i, j], j)))
    return out


@pytest.mark.parametrize("chunk", [3, 1000])
def test_hard_triplets_do_not_depend_on_chunks(spark, vectors, rng, chunk):
    mat, labels = rng.standard_normal((40, 3)), rng.integers(0, 3, 40).tolist()
    batch = [0] * 25 + [1] * 15
    df = vectors(mat, label=labels, batch=batch)
    got = {r["anchor"]: (r["positive"], r["negative"]) for r in N.hard_triplets(df, chunk_rows=chunk).collect()}
    want = {**brute(mat, labels, range(25)), **brute(mat, labels, range(25, 40))}
    assert got == want


def test_large_batch_is_an_error_not_a_cut(spark, vectors, rng):
    df = vectors(rng.standard_normal((20, 2)), label=[0, 1] * 10, batch=[0] * 20)
    with pytest.raises(Exception, match="more than 10 rows"):
        N.hard_triplets(df, mode="all", max_batch=10).collect()


@pytest.mark.parametrize("chunk", [4, 1000])
def test_hardest_in_batch_negative(spark, vectors, rng, chunk):
    a, p = rng.standard_normal((30, 4)), rng.standard_normal((30, 4))
    df = vectors(a, batch=[0] * 20 + [1] * 10).withColumnRenamed("embedding", "anchor").join(vectors(p).withColumnRenamed("embedding", "positive"), "id")
    s = np.round((a / np.linalg.norm(a, axis=1, keepdims=True)) @ (p / np.linalg.norm(p, axis=1, keepdims=True)).T, 9)
    got = {r["query_id"]: r["corpus_id"] for r in N.hardest_in_batch_negative(df, "batch", chunk_rows=chunk).collect()}
    for i in range(30):
        others = [j for j in (range(20) if i < 20 else range(20, 30)) if j != i]
        assert got[i] == max(others, key=lambda j: (s[i, j], -j))


def test_filtered_negatives_serve_systems_in_turn(spark):
    pos = spark.createDataFrame([(1, 100), (1, 101), (3, 100)], "query_id bigint, corpus_id bigint")
    neg = spark.createDataFrame([(1, "a", p, i) for i, p in enumerate([1, 2, 3, 4])] + [(1, "b", p, i) for i, p in enumerate([2, 1, 3, 5])] + [(2, "a", 1, 0)],
                                "query_id bigint, system string, corpus_id bigint, position bigint")
    scores = spark.createDataFrame([(1, 100, 9.0), (1, 101, 8.0), (1, 1, 1.0), (1, 2, 2.0), (1, 3, 1.0), (1, 4, 1.0), (1, 5, 7.0), (2, 1, 0.0)], "query_id bigint, corpus_id bigint, score double")
    out = N.ce_filtered_negatives(pos, neg, scores, ["a", "b"], margin=3.0, per_system=2)
    assert rows(out, "query_id", "system", "corpus_id") == [(1, "a", 1), (1, "a", 2), (1, "b", 3)]


def test_margin_labels_rotate(spark):
    pos = spark.createDataFrame([(1, 10), (1, 11)], "query_id bigint, corpus_id bigint")
    neg = spark.createDataFrame([(1, 20), (1, 21), (1, 22)], "query_id bigint, corpus_id bigint")
    sc = spark.createDataFrame([(1, c, float(c)) for c in (10, 11, 20, 21, 22)], "query_id bigint, corpus_id bigint, score double")
    assert [tuple(N.margin_labels(pos, neg, sc, r).head())[1:] for r in range(3)] == [(10, 20, -10.0), (11, 21, -10.0), (10, 22, -12.0)]


def test_holdout_and_ratio(spark):
    t = spark.createDataFrame([(i, i % 4, 100 + i % 3, 200 + i) for i in range(40)], "line bigint, query_id bigint, pos_id bigint, neg_id bigint")
    dev, train = N.holdout_queries(t, 2, 3)
    assert {r["query_id"] for r in dev.collect()} == {0, 1} and {r["query_id"] for r in train.collect()} == {2, 3}
    assert dev.where("NOT is_positive").groupBy("query_id").count().where("count <> 3").count() == 0
    out = N.ratio_sample(t, 4, dev.select("query_id").distinct()).orderBy("position").collect()
    assert [r["label"] for r in out] == [1, 0, 0, 0, 0] * 4 and {r["query_id"] for r in out} == {2, 3}


def test_duplicate_split_never_cuts_a_component(spark, rng):
    pairs = spark.createDataFrame([(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))], "id1 bigint, id2 bigint")
    split = N.duplicate_split(pairs)
    assert split.groupBy("component").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert {r["split"] for r in split.collect()} == {"dev", "test", "train"}


def test_task_tables(spark, tmp_path, rng):
    edges = [(i, i + 1) for i in range(0, 300, 3)] + [(i, i) for i in range(300)]
    split = N.duplicate_split(spark.createDataFrame(edges, "id1 bigint, id2 bigint"))
    texts = spark.createDataFrame([(i, f"t{i}") for i in range(300)], "id bigint, text string")
    t = N.task_tables(spark.createDataFrame([(a, b, 1) for a, b in edges if a != b] + [(2, 5, 0)], "id1 bigint, id2 bigint, is_duplicate int"), texts, split, {"dev": 3, "test": 100})
    q = {r["id"] for r in t["retrieval_queries"].collect()}
    assert t["retrieval_queries"].where("split = 'dev'").count() == 3
    corpus = {r["id"] for r in t["retrieval_corpus"].collect()}
    assert not q & corpus and q | corpus == set(range(300))
    assert {r["corpus_id"] for r in t["retrieval_relevant"].collect()} <= corpus
    N.write_task_files(t, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/classification").count() == t["classification"].count()


def test_task_tables_take_all_components(spark):
    """Without an explicit number every dev and test component with duplicates gives a query."""
    n = 5_200
    split = spark.range(2 * n).selectExpr("id AS node", "id div 2 AS component", "'dev' AS split")
    pairs = spark.range(n).selectExpr("2 * id AS id1", "2 * id + 1 AS id2", "1 AS is_duplicate")
    t = N.task_tables(pairs, spark.range(2 * n).selectExpr("id", "cast(id AS string) AS text"), split)
    assert [t[f"retrieval_{x}"].count() for x in ("queries", "relevant", "corpus")] == [n, n, n]


def test_scored_pairs_equal_the_sequential_rule(spark, rng):
    data = [(i, float(s), f"a{x}", f"b{y}") for i, (s, x, y) in enumerate(zip(rng.random(200) + .9, rng.integers(0, 30, 200), rng.integers(0, 30, 200)))]
    data += [(200, 1.5, "same", "same"), (201, 1.5, "a0", "new")]
    used, dev, train = set(), [], []
    for o, s, a, b in data:
        if s < 1.075 or a == b or a in used or b in used:
            continue
        if len(dev) < 8:
            dev.append((o, a, b))
            used |= {a, b}
        else:
            train.append((o, a, b))
    want = sorted([(*r, "dev") for r in dev] + [(*r, "train") for r in train if not {r[1], r[2]} & used])
    df = spark.createDataFrame(data, "order bigint, score double, sent1 string, sent2 string")
    assert rows(N.parallel_pairs_scored(df, n_dev=8)) == want


def test_scored_pairs_with_a_sentence_on_every_other_row(spark):
    """The shared sentence fills many heads; each round removes it, and the head stays bounded."""
    df = spark.createDataFrame([(i, 2.0, "hot" if i < 300 else f"a{i}", f"b{i}") for i in range(400)], "order bigint, score double, sent1 string, sent2 string")
    out = N.parallel_pairs_scored(df, n_dev=4)
    assert sorted(r["order"] for r in out.where("split = 'dev'").collect()) == [0, 300, 301, 302]
    assert out.where("split = 'train'").count() == 97


def test_scored_pairs_with_too_few_dev_candidates(spark):
    df = spark.createDataFrame([(1, 2.0, "a", "b"), (2, 2.0, "a", "c")], "order bigint, score double, sent1 string, sent2 string")
    assert rows(N.parallel_pairs_scored(df, n_dev=10)) == [(1, "a", "b", "dev")]


def checked_batches(out, size, *columns):
    """Rows per batch, after the rules: full batches, every id once, no text twice in a batch over all columns."""
    per = {}
    for r in out.collect():
        per.setdefault(r["batch"], []).append(r)
    for group in per.values():
        keys = [k for r in group for k in {str(r[c]).strip().lower() for c in columns}]
        assert len(group) == size and len(keys) == len(set(keys))
    ids = [r["id"] for group in per.values() for r in group]
    assert len(ids) == len(set(ids))
    return per


@pytest.mark.parametrize("tasks", [1, 100])
def test_every_batch_is_filled_beside_a_hot_text(spark, tasks):
    """A text on every fifth row, batches of four: all 1,000 batches are full whatever the number of tasks."""
    df = spark.range(4000).repartition(tasks).withColumn("t", F.when(F.col("id") % 5 == 0, " Hot ").otherwise(F.col("id").cast("string")))
    assert len(checked_batches(N.no_duplicate_batches(df, ["t"], 4), 4, "t")) == 1000


def test_batches_without_duplicates(spark, rng):
    texts = [f" T{x} " if x % 2 else f"t{x}" for x in rng.integers(0, 60, 300)]
    texts[:60] = ["Hot"] * 30 + ["hot "] * 30
    df = spark.createDataFrame([(i, t, f"u{i}") for i, t in enumerate(texts)], "id bigint, a string, b string")
    # 60 rows of one text: with B batches at most min(60, B) of them find a place, which 37 batches allow.
    assert len(checked_batches(N.no_duplicate_batches(df.select("id", "a"), ["a"], 8), 8, "a")) == max(
        b for b in range(38) if sum(min(n, b) for n in Counter(t.strip().lower() for t in texts).values()) >= 8 * b)


def test_batches_over_two_columns(spark, rng):
    """Pairs that meet in either column or the guid are kept apart; every batch that the rows allow is filled."""
    a, b = rng.integers(0, 90, 300), rng.integers(100, 160, 300)
    df = spark.createDataFrame([(i, f"t{x}", f"t{y}", i // 3) for i, (x, y) in enumerate(zip(a, b))], "id bigint, a string, b string, g bigint")
    per = checked_batches(N.no_duplicate_batches(df, ["a", "b"], 6, guid="g"), 6, "a", "b")
    assert len(per) == 50
    assert all(len({r["g"] for r in group}) == 6 for group in per.values())


def test_batches_with_more_copies_than_batches(spark):
    df = spark.createDataFrame([(i, "x" if i < 50 else f"y{i}") for i in range(70)], "id bigint, t string")
    assert len(checked_batches(N.no_duplicate_batches(df, ["t"], 3), 3, "t")) == 10  # 20 other rows, two per batch
    assert N.no_duplicate_batches(df.where("id < 50"), ["t"], 3).count() == 0
    assert N.no_duplicate_batches(df.limit(0), ["t"], 3).count() == 0


def test_batches_that_cannot_be_filled(spark):
    """Three rows that meet pairwise in different columns."""
    df = spark.createDataFrame([(1, "a", "b"), (2, "b", "c"), (3, "c", "a")], "id bigint, a string, b string")
    assert N.no_duplicate_batches(df, ["a", "b"], 3, patience=1).count() == 0


def test_batches_are_stable_under_partitioning(spark):
    df = spark.range(100).withColumn("t", (F.col("id") % 40).cast("string"))
    assert rows(N.no_duplicate_batches(df, ["t"], 5)) == rows(N.no_duplicate_batches(df.repartition(6), ["t"], 5))


def test_label_batches(spark):
    df = spark.createDataFrame([(i, "big" if i < 31 else "small" if i < 34 else "one") for i in range(35)], "id bigint, label string")
    out = N.label_batches(df, "label", 3).collect()
    groups = {}
    for r in out:
        groups.setdefault((r["label"], r["draw"]), set()).add(r["slot"])
    assert all(v == {0, 1, 2} for v in groups.values()) and len(groups) == 11
    # Labels take turns: the small label's only draw is among the first two.
    served = list(dict.fromkeys((r["order_key"], r["label"]) for r in sorted(out, key=lambda r: r["order_key"])))
    assert {label for _, label in served[:2]} == {"big", "small"}


def test_label_batches_with_replacement(spark):
    df = spark.createDataFrame([(i, "big" if i < 31 else "small" if i < 34 else "one") for i in range(35)], "id bigint, label string")
    out = N.label_batches(df, "label", 3, replace=True).collect()
    per = {}
    for r in out:
        per.setdefault((r["order_key"], r["label"], r["draw"]), []).append(r["id"])
    assert len(per) == 12 and all(len(v) == len(set(v)) == 3 for v in per.values())  # 34 rows of both labels, three a draw
    served = [label for _, label, _ in sorted(per)]
    assert all({served[i], served[i + 1]} == {"big", "small"} for i in range(0, 12, 2))
    assert N.label_batches(df.where("label = 'one'"), "label", 3, replace=True).count() == 0


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 31, 47])
def test_contrastive_pairs(spark, n):
    out = sorted(map(tuple, N.contrastive_pairs(spark.range(n)).collect()))
    # Plain loop over the shuffled rows.
    at, want, count = 0, [], 0
    while at + 1 < n:
        if count % 8:
            at, want = at + 2, want + [0]
        else:
            at, want = at + 1, want + [1]
        count += 1
    if want and want[-1] == 0 and at > n:
        want.pop()
    assert [r[3] for r in out] == want
    used = [x for _, a, b, y in out for x in ({a, b} if y else (a, b))]
    assert len(used) == len(set(used)) and all((a == b) == bool(y) for _, a, b, y in out)


def test_multi_dataset_schedule(spark):
    big = spark.range(200).withColumn("t", F.concat(F.lit("b"), F.col("id")))
    small = spark.range(20).withColumn("t", F.concat(F.lit("s"), F.col("id")))
    rows_, plan = N.multi_dataset_batches({"big": big, "small": small}, ["t"], 10, None)
    steps = plan.orderBy("step").collect()
    assert [r["step"] for r in steps] == list(range(22))
    assert {(r["dataset"], r["batch_no"]) for r in steps} <= {(r["dataset"], r["batch_no"]) for r in rows_.collect()}
    assert rows_.groupBy("dataset", "batch_no").count().where("count <> 10").count() == 0


def test_small_ones(spark):
    df = spark.createDataFrame([(1, " ab "), (2, None), (3, "  "), (4, "abcdef")], "id bigint, text string")
    assert rows(N.identity_pairs(df, keep=["id"])) == [(1, ["ab", "ab"]), (4, ["abcdef", "abcdef"])]
    assert rows(N.identity_pairs(df, min_chars=3, keep=["id"])) == [(4, ["abcdef", "abcdef"])]
    assert rows(N.denoise_pairs(df.where("id = 4"), noise=lambda t, i: F.upper(t))) == [(4, "ABCDEF", "abcdef")]
    pool = N.sentence_pool(spark.createDataFrame([("a", "b"), ("b", None), ("c", "a")], "x string, y string"), ["x", "y"], 2)
    assert sorted(r["sentence"] for r in pool.collect()) == ["a", "b", "c"] and pool.where("split = 'dev'").count() == 2
    groups = N.translation_groups(spark.createDataFrame([(["s", "t"],), (["s", "t", "u"],)], "texts array<string>"))
    assert rows(groups) == [("s", "s"), ("s", "t"), ("s", "u")]
    hard = N.hard_pairs(spark.createDataFrame([(0, .1, 1), (0, .5, 1), (0, .3, 0), (0, .9, 0), (1, .1, 1), (1, .2, 0)], "b int, distance double, label int"), "b")
    assert rows(hard, "b", "distance", "label") == [(0, .3, 0), (0, .5, 1)]
