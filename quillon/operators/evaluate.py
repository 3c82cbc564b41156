"""Evaluation operators (K). Each returns metric rows; with ``by`` one set of rows per group.

Sweeps over sorted scores run as segmented prefix sums (:mod:`.prefix`), so a group of any size is spread over many
tasks. Equal scores keep the order of the row id unless a rule says that they form one step.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..session import cut_lineage
from . import blocks as B
from .graph import in_closure, transitive_closure
from .prefix import join_groups, running
from .search import semantic_search, top_k
from .tabular import correlations
from .thresholds import threshold_measures

MEASURES = ["cosine", "euclidean", "manhattan", "dot"]


def _measures(a: str, b: str) -> dict[str, Column]:
    """Similarities of two vector columns; distances are negated so that more is more similar."""
    raw = {"cosine": V.cosine(a, b), "euclidean": -V.euclidean(a, b), "manhattan": -V.manhattan(a, b), "dot": V.dot(a, b)}
    return {k: F.round(c, B.SCORE_DECIMALS) for k, c in raw.items()}


def embedding_similarity(
    pairs: DataFrame, gold: str, id: str = "id", a: str = "a", b: str = "b", by: Sequence[str] = (), main: str | None = None
) -> DataFrame:
    """``(by..., metric, pearson, spearman, main)``; ``main`` is the Spearman of the chosen measure or the best one."""
    scored = pairs.select(id, *by, gold, *[c.alias(n) for n, c in _measures(a, b).items()])
    out = correlations(scored, gold, MEASURES, id, by)
    pick = F.max("spearman") if main is None else F.max(F.when(F.col("metric") == main, F.col("spearman")))
    best = out.groupBy(*by).agg(pick.alias("main"))
    if by:
        return join_groups(out, best, by)
    return out.withColumn("__k", F.lit(1)).join(F.broadcast(best.withColumn("__k", F.lit(1))), "__k").drop("__k")


def correlation_report(df: DataFrame, pred: str, gold: str, id: str = "id", by: Sequence[str] = ()) -> DataFrame:
    return correlations(df, gold, [pred], id, by).drop("metric")


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(by)) if by else (df.withColumn("__g", F.lit(0)), ["__g"])


def _signed(df: DataFrame, score: str, higher: bool) -> DataFrame:
    return df if higher else df.withColumn(score, -F.col(score))


def best_accuracy_threshold(
    df: DataFrame, score: str, label: str, order: str, higher_is_similar: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """``(by..., accuracy, threshold)``. The last row is never a cut; the first best cut wins; -1 without a cut."""
    out = threshold_measures(_signed(df, score, higher_is_similar), score, label, order, by, ["accuracy"])
    out = out.withColumnRenamed("accuracy_threshold", "threshold")
    return out.select(*by, "accuracy", _unsign(higher_is_similar, "threshold", "accuracy"))


def _unsign(higher: bool, c: str, value: str) -> Column:
    # Without any cut the default stays as it is.
    return (F.col(c) if higher else F.when(F.col(value) > 0, -F.col(c)).otherwise(F.col(c))).alias(c)


def best_f1_threshold(
    df: DataFrame, score: str, label: str, order: str, higher_is_similar: bool = True, by: Sequence[str] = ()
) -> DataFrame:
    """``(by..., f1, precision, recall, threshold)``, swept like the accuracy; zeros without a cut."""
    out = threshold_measures(_signed(df, score, higher_is_similar), score, label, order, by, ["f1"])
    out = out.withColumnRenamed("f1_threshold", "threshold")
    return out.select(*by, "f1", "precision", "recall", _unsign(higher_is_similar, "threshold", "f1"))


def average_precision(df: DataFrame, score: str, label: str, by: Sequence[str] = (), higher_is_similar: bool = True) -> DataFrame:
    """``(by..., ap)``: sum of recall steps times precision; rows with an equal score are one step."""
    keyed, keys = _grouped(_signed(df, score, higher_is_similar), by)
    steps = keyed.groupBy(*keys, score).agg(F.count(F.lit(1)).alias("c"), F.sum(F.col(label).cast("double")).alias("p"))
    run = running(steps, [F.col(score).desc()], {"cum": F.col("c"), "hit": F.col("p")}, by=keys)
    ap = run.groupBy(*keys).agg(F.try_divide(F.sum(F.col("p") * F.col("hit") / F.col("cum")), F.sum("p")).alias("ap"))
    return ap.select(*by, F.coalesce("ap", F.lit(0.0)).alias("ap"))


def binary_classification_report(
    pairs: DataFrame, label: str, id: str = "id", a: str = "a", b: str = "b", by: Sequence[str] = ()
) -> DataFrame:
    """``(by..., metric, accuracy, accuracy_threshold, f1, precision, recall, f1_threshold, ap, main)``.

    The four measures are swept together in long form: one sort, one pass for the cuts, one more for the average precision. ``main`` is the greatest ap. A label other
    than 0 or 1 is an error.
    """
    checked = F.when(F.col(label).isin(0, 1), F.col(label)).otherwise(F.raise_error(F.lit("labels must be 0 or 1"))).cast("int")
    long = pairs.select(id, *by, checked.alias("y"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), c.alias("s")) for n, c in _measures(a, b).items()])).alias("m")
    ).select(id, *by, "y", "m.metric", "m.s")
    out = threshold_measures(long, "s", "y", id, [*by, "metric"])
    distance = F.col("metric").isin("euclidean", "manhattan")
    for c, v in (("accuracy_threshold", "accuracy"), ("f1_threshold", "f1")):
        out = out.withColumn(c, F.when(distance & (F.col(v) > 0), -F.col(c)).otherwise(F.col(c)))
    best = out.groupBy(*by).agg(F.max("ap").alias("main")) if by else out.agg(F.max("ap").alias("main"))
    if by:
        return join_groups(out, best, by)
    return out.withColumn("__k", F.lit(1)).join(F.broadcast(best.withColumn("__k", F.lit(1))), "__k").drop("__k")


def information_retrieval(
    hits: DataFrame,
    queries: DataFrame,
    qrels: DataFrame,
    mrr: Sequence[int] = (10,),
    ndcg: Sequence[int] = (10,),
    accuracy: Sequence[int] = (1, 3, 5, 10),
    precision_recall: Sequence[int] = (1, 3, 5, 10),
    map: Sequence[int] = (100,),
    by: Sequence[str] = (),
) -> DataFrame:
    """``(by..., metric, k, value)`` from ``hits(by..., query_id, corpus_id, score)``, ``queries(query_id)`` and
    ``qrels(query_id, corpus_id)``. ``by`` may name score functions or systems.

    Queries without relevant documents are left out; a query without hits counts as zero.
    """
    by = list(by)
    rel = qrels.select("query_id", "corpus_id").distinct()
    known = rel.join(queries.select("query_id").distinct(), "query_id", "left_semi")
    n_rel = known.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_rel"))
    depth = max([*mrr, *ndcg, *accuracy, *precision_recall, *map])
    ranked = top_k(hits, [*by, "query_id"], "score", "corpus_id", depth)
    marked = ranked.join(rel.withColumn("__good", F.lit(True)), ["query_id", "corpus_id"], "left")
    # Relevant ranks of one query: at most ``depth`` numbers. Written once: the search behind the hits is not run again for the systems.
    lists = cut_lineage(marked.groupBy(*by, "query_id").agg(F.array_sort(F.collect_list(F.when(F.col("__good"), F.col("rank")))).alias("ranks")))
    if by:
        base = n_rel.withColumn("__k", F.lit(1)).join(F.broadcast(lists.select(*by).distinct().withColumn("__k", F.lit(1))), "__k").drop("__k")
    else:
        base = n_rel
    per = base.join(lists, [*by, "query_id"], "left").withColumn("ranks", F.coalesce("ranks", F.array().cast("array<bigint>")))

    ranks, found = F.col("ranks"), lambda k: F.filter("ranks", lambda r: r <= k)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    rows = []

    def add(name, k, value):
        rows.append(F.struct(F.lit(name).alias("metric"), F.lit(k).cast("bigint").alias("k"), F.avg(value).alias("value")))

    for k in accuracy:
        add("accuracy", k, F.when(F.size(found(k)) > 0, 1.0).otherwise(0.0))
    for k in precision_recall:
        add("precision", k, F.size(found(k)) / F.lit(float(k)))
        add("recall", k, F.size(found(k)) / F.col("n_rel"))
    for k in mrr:
        first = F.get(ranks, F.lit(0))
        add("mrr", k, F.when(first <= k, 1.0 / first).otherwise(0.0))
    for k in ndcg:
        ideal, acc = [], 0.0
        for i in range(k):
            acc += 1.0 / math.log2(i + 2)
            ideal.append(acc)
        dcg = total(F.transform(found(k), lambda r: 1.0 / F.log2(r + 1.0)))
        add("ndcg", k, dcg / F.element_at(F.array(*[F.lit(x) for x in ideal]), F.least(F.lit(k), F.col("n_rel")).cast("int")))
    for k in map:
        precisions = F.transform(found(k), lambda r, i: (i + 1.0) / r)
        add("map", k, total(precisions) / F.least(F.lit(k), F.col("n_rel")))
    return per.groupBy(*by).agg(F.array(*rows).alias("s")).select(*by, F.inline("s"))


def ir_main_score(report: DataFrame, by: Sequence[str] = (), main: str | None = None) -> DataFrame:
    """One row: MAP at the greatest k of the chosen score function, or of the best one."""
    maps = report.where(F.col("metric") == "map")
    if main is not None:
        maps = maps.where(F.col(by[0]) == main)
    last = maps.groupBy(*by).agg(F.max_by("value", "k").alias("v")) if by else maps.agg(F.max_by("value", "k").alias("v"))
    return last.agg(F.max("v").alias("main"))


def _judged(samples: DataFrame, query: str) -> DataFrame:
    """Samples of queries that have a positive and a negative."""
    both = samples.groupBy(query).agg(F.max("is_relevant").alias("hi"), F.min("is_relevant").alias("lo"))
    return samples.join(both.where("hi = 1 AND lo = 0").select(query), query, "left_semi")


def _reciprocal_rank(samples: DataFrame, query: str, doc: str, k: int) -> DataFrame:
    """Reciprocal rank of the best relevant row: one plus the rows ahead of it, counted without sorting a query."""
    key = F.struct(F.col("score").alias("s"), (-F.col(doc)).alias("d"))
    top = samples.where("is_relevant = 1").groupBy(query).agg(F.max(key).alias("best"))
    ahead = samples.join(top, query).groupBy(query).agg(F.sum(F.when(key > F.col("best"), 1).otherwise(0)).alias("ahead"))
    return ahead.select(query, F.when(F.col("ahead") < k, 1.0 / (F.col("ahead") + 1)).otherwise(0.0).alias("rr"))


def reranking(samples: DataFrame, k: int = 10, query: str = "query_id", doc: str = "doc_id") -> DataFrame:
    """``(queries, map, mrr)`` from ``(query, doc, is_relevant 0/1, score)``; ties in score go to the lower doc id."""
    kept = _judged(samples, query)
    ap = average_precision(kept, "score", "is_relevant", [query])
    both = ap.join(_reciprocal_rank(kept, query, doc, k), query)
    return both.agg(F.count(F.lit(1)).alias("queries"), F.avg("ap").alias("map"), F.avg("rr").alias("mrr"))


def ce_reranking(samples: DataFrame, k: int = 10, query: str = "query_id", doc: str = "doc_id") -> DataFrame:
    """``(queries, mrr)`` from pair scores."""
    rr = _reciprocal_rank(_judged(samples, query), query, doc, k)
    return rr.agg(F.count(F.lit(1)).alias("queries"), F.avg("rr").alias("mrr"))


def paraphrase_mining_eval(pairs: DataFrame, gold: DataFrame, closure: bool = False, ids: DataFrame | None = None) -> DataFrame:
    """``(total_gold, ap, f1, precision, recall, threshold)`` of mined ``(score, id1, id2)`` against gold pairs.

    Gold pairs that were never mined count in the total. With ``closure`` gold is closed transitively, in counts: pairs
    are compared by component. ``ids(id)`` limits gold to known sentences.
    """
    canon = lambda df: df.select(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2")).where("id1 <> id2").distinct()
    g = canon(gold)
    if ids is not None:
        known = ids.select(F.col("id"))
        g = g.join(known.withColumnRenamed("id", "id1"), "id1", "left_semi").join(known.withColumnRenamed("id", "id2"), "id2", "left_semi")
    mined = pairs.groupBy(F.least("id1", "id2").alias("id1"), F.greatest("id1", "id2").alias("id2")).agg(F.max("score").alias("s"))
    if closure:
        comp = transitive_closure(g)
        total = comp.agg((F.coalesce(F.sum(F.col("size") - 1), F.lit(0)) / 2).alias("total"))
        marked = in_closure(mined, comp).withColumn("y", F.col("related").cast("double"))
    else:
        total = g.agg(F.count(F.lit(1)).cast("double").alias("total"))
        marked = mined.join(g.withColumn("y", F.lit(1.0)), ["id1", "id2"], "left").fillna(0.0, subset=["y"])
    run = running(marked.select("id1", "id2", "s", "y"), [F.col("s").desc(), F.col("id1").asc(), F.col("id2").asc()], {"hits": F.col("y")})
    run = run.withColumn("__k", F.lit(1))
    run = run.join(F.broadcast(total.withColumn("__k", F.lit(1))), "__k")
    f1 = 2 * F.col("hits") / (F.col("position") + F.col("total"))
    hit = F.col("y") == 1.0
    best = run.groupBy("__k").agg(
        F.max(F.when(hit, F.struct(f1.alias("f1"), (-F.col("position")).alias("neg"), F.col("s"), F.col("hits")))).alias("m"),
        F.coalesce(F.sum(F.when(hit, F.col("hits") / F.col("position"))), F.lit(0.0)).alias("ap_sum"), F.max("position").alias("last"))
    best = best.join(F.broadcast(total.withColumn("__k", F.lit(1))), "__k").withColumn("at", F.least(-F.col("m.neg") + 1, F.col("last")))
    nxt = run.select("__k", F.col("position").alias("at"), F.col("s").alias("s_next"))
    out = best.join(nxt, ["__k", "at"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return out.select(
        F.col("total").cast("bigint").alias("total_gold"), zero(F.try_divide("ap_sum", "total")).alias("ap"), zero(F.col("m.f1")).alias("f1"),
        zero(F.col("m.hits") / -F.col("m.neg")).alias("precision"), zero(F.try_divide(F.col("m.hits"), F.col("total"))).alias("recall"),
        zero((F.col("m.s") + F.col("s_next")) / 2).alias("threshold"))


def translation_accuracy(src: DataFrame, trg: DataFrame, id: str = "id", vector: str = "embedding") -> DataFrame:
    """``(src2trg, trg2src, mean)``: is row ``i`` the nearest of row ``i`` on the other side?"""
    def share(a, b, name):
        best = semantic_search(a, b, 1, "cos", False, id, vector)
        return best.agg(F.avg(F.when(F.col("query_id") == F.col("corpus_id"), 1.0).otherwise(0.0)).alias(name)).withColumn("__k", F.lit(1))

    both = share(src, trg, "src2trg").join(F.broadcast(share(trg, src, "trg2src")), "__k").drop("__k")
    return both.withColumn("mean", (F.col("src2trg") + F.col("trg2src")) / 2)


def translation_misses(src: DataFrame, trg: DataFrame, k: int = 5, id: str = "id", vector: str = "embedding") -> DataFrame:
    """Top ``k`` candidates of the rows whose own translation is not ranked first."""
    hits = semantic_search(src, trg, k, "cos", False, id, vector)
    right = hits.where("rank = 1 AND query_id = corpus_id").select("query_id")
    return hits.join(right, "query_id", "left_anti")


def triplet_accuracy(triplets: DataFrame, anchor: str = "a", positive: str = "p", negative: str = "n") -> DataFrame:
    """``(cosine, manhattan, euclidean, main)``: share of rows whose positive is strictly nearer than the negative."""
    def share(dp, dn, name):
        return F.avg(F.when(F.round(dp, B.SCORE_DECIMALS) < F.round(dn, B.SCORE_DECIMALS), 1.0).otherwise(0.0)).alias(name)

    out = triplets.agg(
        share(1 - V.cosine(anchor, positive), 1 - V.cosine(anchor, negative), "cosine"),
        share(V.manhattan(anchor, positive), V.manhattan(anchor, negative), "manhattan"),
        share(V.euclidean(anchor, positive), V.euclidean(anchor, negative), "euclidean"))
    return out.withColumn("main", F.greatest("cosine", "manhattan", "euclidean"))


def _squared(a: str, b: str) -> Column:
    d = F.zip_with(V.as_double(a), V.as_double(b), lambda x, y: x - y)
    return F.aggregate(d, F.lit(0.0), lambda s, x: s + x * x)


def embedding_mse(a: DataFrame, b: DataFrame, id: str = "id", vector: str = "embedding") -> DataFrame:
    """``(mse, score)``: mean squared difference over all elements times 100, and its negative."""
    pairs = a.select(id, F.col(vector).alias("__a")).join(b.select(id, F.col(vector).alias("__b")), id)
    return _mse(pairs, [])


def _mse(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    out = pairs.groupBy(*by).agg((100 * F.sum(_squared("__a", "__b")) / F.sum(F.size("__a"))).alias("mse"))
    return out.withColumn("score", -F.col("mse"))


def mse_by_language_pair(
    wide: DataFrame, combos: Sequence[tuple[str, str]], teacher: Callable[[Column], Column], student: Callable[[Column], Column],
) -> DataFrame:
    """``(src, trg, mse, score)`` per combination of text columns; rows with a blank side are skipped.

    ``teacher`` and ``student`` turn a text column into a vector column. One scan serves all combinations. The mean
    over the rows of the result is the overall score.
    """
    sides = F.array(*[
        F.struct(F.lit(s).alias("src"), F.lit(t).alias("trg"), F.col(s).alias("s"), F.col(t).alias("t")) for s, t in combos])
    long = wide.select(F.inline(sides))
    filled = lambda c: X.strip(F.coalesce(F.col(c), F.lit(""))) != ""
    long = long.where(filled("s") & filled("t"))
    return _mse(long.select("src", "trg", teacher(F.col("s")).alias("__a"), student(F.col("t")).alias("__b")), ["src", "trg"])


def argmax(scores: str) -> Column:
    """Position of the largest score, first one on ties."""
    return (F.array_position(F.col(scores), F.array_max(scores)) - 1).cast("bigint")


def label_accuracy(df: DataFrame, scores: str, label: str) -> DataFrame:
    return df.agg(F.avg(F.when(argmax(scores) == F.col(label), 1.0).otherwise(0.0)).alias("accuracy"))


def binary_accuracy(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    return df.agg(F.avg(F.when((F.col(score) > threshold).cast("int") == F.col(label).cast("int"), 1.0).otherwise(0.0)).alias("accuracy"))


def sequential_evaluation(frames: Sequence[DataFrame], main: str | Callable[[Column], Column] = "last") -> DataFrame:
    """``(main, scores)`` over several one-column metric rows, in order. ``main`` is last, mean or a function of the list."""
    rows = [f.select(F.lit(i).alias("i"), F.col(f.columns[0]).cast("double").alias("v")) for i, f in enumerate(frames)]
    union = reduce(DataFrame.unionByName, rows)
    # One entry per evaluator.
    scores = union.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias("scores"))
    if callable(main):
        col = main(F.col("scores"))
    elif main == "mean":
        col = F.aggregate("scores", F.lit(0.0), lambda s, x: s + x) / F.size("scores")
    else:
        col = F.element_at("scores", -1)
    return scores.select(col.alias("main"), "scores")


def graded_ndcg(run: DataFrame, qrels: DataFrame, k: int = 10) -> DataFrame:
    """``(query_id, ndcg)`` with graded relevance, linear gain and a log2 discount; ideal from the best ``k`` grades."""
    gain = lambda g, r: F.sum(F.col(g) / F.log2(F.col(r) + 1.0))
    rel = qrels.where("relevance > 0")
    ideal = top_k(rel, "query_id", "relevance", "corpus_id", k).groupBy("query_id").agg(gain("relevance", "rank").alias("idcg"))
    got = top_k(run, "query_id", "score", "corpus_id", k).join(rel, ["query_id", "corpus_id"])
    got = got.groupBy("query_id").agg(gain("relevance", "rank").alias("dcg"))
    return ideal.join(got, "query_id", "left").select("query_id", (F.coalesce("dcg", F.lit(0.0)) / F.col("idcg")).alias("ndcg"))
