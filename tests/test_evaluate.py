import math

import numpy as np
import pytest
from conftest import rows, unit
from pyspark.sql import functions as F

from quillon.operators import evaluate as E
from quillon.operators import tabular as T


def sweep(scores, labels, high):
    order = sorted(range(len(scores)), key=lambda i: (-scores[i] if high else scores[i], i))
    s, y = [scores[i] for i in order], [labels[i] for i in order]
    acc, acc_t, f1, f1_row = 0.0, -1.0, 0.0, (0.0, 0.0, 0.0, 0.0)
    hits = 0
    for i in range(len(s) - 1):
        hits += y[i]
        left = (len(y) - sum(y)) - (i + 1 - hits)
        a = (hits + left) / len(y)
        if a > acc:
            acc, acc_t = a, (s[i] + s[i + 1]) / 2
        if hits:
            f = 2 * hits / (i + 1 + sum(y))
            if f > f1 + 1e-15:
                f1, f1_row = f, (f, hits / (i + 1), hits / sum(y), (s[i] + s[i + 1]) / 2)
    return (acc, acc_t), f1_row


def step_ap(scores, labels):
    total, ap, hits, seen = sum(labels), 0.0, 0, 0
    for v in sorted(set(scores), reverse=True):
        at = [i for i in range(len(scores)) if scores[i] == v]
        p = sum(labels[i] for i in at)
        hits, seen = hits + p, seen + len(at)
        ap += p / total * hits / seen if total else 0.0
    return ap


@pytest.mark.parametrize("high", [True, False])
@pytest.mark.parametrize("kind", ["random", "ties", "equal", "positive", "negative", "one"])
def test_thresholds_and_ap(spark, rng, high, kind):
    n = 1 if kind == "one" else 80
    scores = {"ties": rng.integers(0, 6, n).astype(float), "equal": np.full(n, 2.0)}.get(kind, rng.standard_normal(n)).tolist()
    labels = {"positive": [1] * n, "negative": [0] * n}.get(kind, rng.integers(0, 2, n).tolist())
    df = spark.createDataFrame([(i, s, y) for i, (s, y) in enumerate(zip(scores, labels))], "id bigint, s double, y bigint")
    acc, f1 = sweep(scores, labels, high)
    got = E.best_accuracy_threshold(df, "s", "y", "id", high).head()
    assert tuple(got) == pytest.approx(acc)
    assert tuple(E.best_f1_threshold(df, "s", "y", "id", high).head()) == pytest.approx(f1)
    ap = E.average_precision(df, "s", "y", higher_is_similar=high).head()[0]
    assert ap == pytest.approx(step_ap(scores if high else [-x for x in scores], labels))


def test_threshold_reproduces_its_accuracy(spark, rng):
    scores, labels = rng.standard_normal(300), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(i, float(s), int(y)) for i, (s, y) in enumerate(zip(scores, labels))], "id bigint, s double, y bigint")
    acc, t = E.best_accuracy_threshold(df, "s", "y", "id").head()
    assert acc == pytest.approx(((scores > t) == labels).mean())


def test_groups_are_swept_apart(spark, rng):
    data = [(i, int(rng.choice([0, 1, 2], p=[.8, .1, .1])), float(rng.standard_normal()), int(rng.integers(0, 2))) for i in range(200)]
    df = spark.createDataFrame(data, "id bigint, g bigint, s double, y bigint")
    got = {r["g"]: tuple(r)[1:] for r in E.best_f1_threshold(df, "s", "y", "id", by=["g"]).collect()}
    for g in range(3):
        part = [d for d in data if d[1] == g]
        assert got[g] == pytest.approx(sweep([d[2] for d in part], [d[3] for d in part], True)[1])


def test_binary_report_rejects_other_labels(spark):
    df = spark.createDataFrame([(0, [1.0], [2.0], 2)], "id bigint, a array<double>, b array<double>, y bigint")
    with pytest.raises(Exception, match="0 or 1"):
        E.binary_classification_report(df, "y").collect()


def test_spearman_with_ties(spark):
    df = spark.createDataFrame(list(enumerate([1.0, 2.0, 2.0, 4.0, 3.0])), "id bigint, a double").withColumn("b", F.element_at(F.array(*[F.lit(x) for x in (1.0, 3.0, 3.0, 3.0, 5.0)]), (F.col("id") + 1).cast("int")))
    ra, rb = np.array([1, 2.5, 2.5, 5, 4]), np.array([1, 3, 3, 3, 5])
    assert T.spearman(df, "a", "b", "id").head()[0] == pytest.approx(np.corrcoef(ra, rb)[0, 1])


def test_information_retrieval(spark):
    hits = spark.createDataFrame([(1, 10, .9), (1, 11, .8), (1, 12, .7), (2, 10, .5), (4, 10, .5)], "query_id bigint, corpus_id bigint, score double")
    queries = spark.createDataFrame([(1,), (2,), (3,), (4,)], "query_id bigint")
    rel = spark.createDataFrame([(1, 11), (1, 99), (2, 11), (3, 10), (3, 10), (77, 10)], "query_id bigint, corpus_id bigint")
    out = {(r["metric"], r["k"]): r["value"] for r in E.information_retrieval(hits, queries, rel, mrr=(10,), ndcg=(2,), accuracy=(1, 3), precision_recall=(3,), map=(10,)).collect()}
    # Queries 1, 2, 3 have relevants; query 3 has no hit, query 4 no relevants.
    assert out["accuracy", 1] == 0 and out["accuracy", 3] == pytest.approx(1 / 3)
    assert out["precision", 3] == pytest.approx(1 / 9) and out["recall", 3] == pytest.approx(.5 / 3)
    assert out["mrr", 10] == pytest.approx(.5 / 3)
    assert out["ndcg", 2] == pytest.approx((1 / math.log2(3)) / (1 + 1 / math.log2(3)) / 3)
    assert out["map", 10] == pytest.approx((.5 / 2) / 3)


def test_ir_main_score(spark):
    rep = spark.createDataFrame([("cos", "map", 10, .1), ("cos", "map", 100, .3), ("dot", "map", 100, .4), ("dot", "mrr", 10, .9)], "system string, metric string, k bigint, value double")
    assert E.ir_main_score(rep, ["system"]).head()[0] == .4
    assert E.ir_main_score(rep, ["system"], "cos").head()[0] == .3


def test_reranking_drops_one_sided_queries(spark):
    data = [(1, 1, 1, .2), (1, 2, 0, .9), (1, 3, 0, .1), (2, 1, 1, .5), (3, 1, 0, .5), (4, 1, 0, .7), (4, 2, 1, .7)]
    df = spark.createDataFrame(data, "query_id bigint, doc_id bigint, is_relevant int, score double")
    r = E.reranking(df, 10).head()
    assert r["queries"] == 2 and r["mrr"] == pytest.approx((1 / 2 + 1 / 2) / 2)
    assert r["map"] == pytest.approx((1 / 2 + 1 / 2) / 2)
    assert E.ce_reranking(df, 1).head()["mrr"] == 0


def test_mining_eval_counts_missed_gold(spark):
    pairs = spark.createDataFrame([(.9, 1, 2), (.8, 5, 1), (.7, 3, 4)], "score double, id1 bigint, id2 bigint")
    gold = spark.createDataFrame([(2, 1), (1, 2), (3, 4), (7, 8), (6, 6)], "id1 bigint, id2 bigint")
    r = E.paraphrase_mining_eval(pairs, gold).head()
    assert r["total_gold"] == 3 and r["ap"] == pytest.approx((1 + 2 / 3) / 3)
    assert (r["f1"], r["precision"], r["recall"]) == pytest.approx((2 / 3, 2 / 3, 2 / 3)) and r["threshold"] == pytest.approx(.7)
    limited = E.paraphrase_mining_eval(pairs, gold, ids=spark.createDataFrame([(i,) for i in range(1, 6)], "id bigint")).head()
    assert limited["total_gold"] == 2


def test_mining_eval_closure_equals_listed_pairs(spark):
    pairs = spark.createDataFrame([(.9, 1, 3), (.8, 1, 9), (.7, 2, 4)], "score double, id1 bigint, id2 bigint")
    chain = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "id1 bigint, id2 bigint")
    full = spark.createDataFrame([(i, j) for i in range(1, 5) for j in range(i + 1, 5)], "id1 bigint, id2 bigint")
    assert E.paraphrase_mining_eval(pairs, chain, closure=True).head() == E.paraphrase_mining_eval(pairs, full).head()


def test_mining_eval_without_hits(spark):
    pairs = spark.createDataFrame([(.9, 1, 3)], "score double, id1 bigint, id2 bigint")
    gold = spark.createDataFrame([(7, 8)], "id1 bigint, id2 bigint")
    assert tuple(E.paraphrase_mining_eval(pairs, gold).head()) == (1, 0.0, 0.0, 0.0, 0.0, 0.0)
    none = pairs.where("id1 < 0")
    assert tuple(E.paraphrase_mining_eval(none, gold).head() or (1, 0, 0, 0, 0, 0))[0] == 1


def test_translation(spark, vectors, rng):
    a = rng.standard_normal((12, 5))
    b = a.copy()
    b[[2, 3]] = b[[3, 2]]
    r = E.translation_accuracy(vectors(a), vectors(b)).head()
    assert tuple(r) == pytest.approx((10 / 12, 10 / 12, 10 / 12))
    assert {x["query_id"] for x in E.translation_misses(vectors(a), vectors(b)).collect()} == {2, 3}


def test_triplets_mse_and_argmax(spark):
    t = spark.createDataFrame([([1.0, 0.0], [1.0, 0.1], [0.0, 1.0]), ([1.0, 0.0], [1.0, 0.0], [1.0, 0.0])], "a array<double>, p array<double>, n array<double>")
    assert E.triplet_accuracy(t).head()["main"] == .5
    a = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.0, 0.0])], "id bigint, embedding array<double>")
    b = spark.createDataFrame([(1, [1.0, 4.0]), (2, [1.0, 0.0])], "id bigint, embedding array<double>")
    assert tuple(E.embedding_mse(a, b).head()) == (125.0, -125.0)
    s = spark.createDataFrame([([.2, .7, .7], 1), ([.9, .1, 0.], 2)], "s array<double>, y bigint")
    assert E.label_accuracy(s, "s", "y").head()[0] == .5
    assert E.sequential_evaluation([a.selectExpr("max(id) m"), a.selectExpr("min(id) m")], lambda c: F.array_max(c)).head()["main"] == 2.0


def test_embedding_similarity_matches_numpy(spark, rng):
    a, b, gold = rng.standard_normal((40, 6)), rng.standard_normal((40, 6)), rng.integers(0, 5, 40).astype(float)
    df = spark.createDataFrame([(i, x.tolist(), y.tolist(), float(g)) for i, (x, y, g) in enumerate(zip(a, b, gold))], "id bigint, a array<double>, b array<double>, gold double")
    out = {r["metric"]: r for r in E.embedding_similarity(df, "gold").collect()}
    cos = (unit(a) * unit(b)).sum(1)
    assert out["cosine"]["pearson"] == pytest.approx(np.corrcoef(gold, cos)[0, 1])
    assert out["manhattan"]["pearson"] == pytest.approx(np.corrcoef(gold, -np.abs(a - b).sum(1))[0, 1])
    assert out["dot"]["main"] == max(r["spearman"] for r in out.values())


def test_score_line_alignment(spark):
    gold = ["#head", "g\tf\ty\tx\t5", "", "g\tf\ty\tx\t1", "g\tf\ty\tx\t7"]
    system = ["4.5 a", "9.9 dropped", "1.5 b", "#note", "2.5 c"]
    table = lambda ls: spark.createDataFrame([(i, v) for i, v in enumerate(ls, 1)], "line bigint, value string")
    assert rows(T.score_lines(table(gold), table(system))) == [(1, 5.0, 4.5, True), (2, 1.0, 1.5, True), (3, 7.0, 2.5, False)]


def test_rows_of_a_null_group_are_kept(spark, rng):
    data = [(i, [None, "a"][i % 2], float(i % 7), float((i * 5) % 11), int(i % 3 == 0)) for i in range(60)]
    df = spark.createDataFrame(data, "id bigint, g string, s double, t double, y bigint")
    assert {r["g"] for r in E.best_f1_threshold(df, "s", "y", "id", by=["g"]).collect()} == {None, "a"}
    both = {r["g"]: r["spearman"] for r in E.correlation_report(df, "s", "t", "id", ["g"]).collect()}
    assert both[None] == pytest.approx(T.spearman(df.where("g IS NULL"), "s", "t", "id").head()[0])
    split = T.dev_split(df, ["g"], ["id"], 5)
    assert split.count() == 60 and split.where("split = 'dev' AND g IS NULL").count() == 5
    assert T.weighted_pearson(df, "s", "t", "id", ["g"]).count() == 2
