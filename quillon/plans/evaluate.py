"""Evaluation operators (K)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..operators import evaluate as E
from ..operators import lexical as L
from ..operators import search as S
from .common import SQL_EMB, embeddings, r6, table
from .search import COS, SQL_BM25, benchmark
from .text import STOP, docs

STEPS = 3


def pairs(spark, sf):
    """Every vector with the next three: ``(id, step, a, b, same, gap)``."""
    e = embeddings(spark, sf).select(F.col("id").alias("x"), "embedding", "label")
    left = e.select("x", F.col("embedding").alias("a"), F.col("label").alias("la"), F.explode(F.sequence(F.lit(1), F.lit(STEPS))).alias("step"))
    right = e.select(F.col("x").alias("y"), F.col("embedding").alias("b"), F.col("label").alias("lb"))
    both = left.join(right, F.col("x") + F.col("step") == F.col("y"))
    return both.select((F.col("x") * 10 + F.col("step")).alias("id"), F.col("step").cast("bigint").alias("step"), "a", "b",
                       (F.col("la") == F.col("lb")).cast("bigint").alias("same"), F.abs(F.col("la") - F.col("lb")).alias("gap"))


def scored_docs(spark, sf):
    """Labelled documents with a word count as score: ``(id, score, quality, lang)``."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id")
    return d.select(F.col("doc_id").alias("id"), F.size(X.words("text")).cast("double").alias("score"), "quality", "toxic", "lang")


def k01(spark, sf):
    out = E.embedding_similarity(pairs(spark, sf), "gap", by=["step"])
    return out.select("step", "metric", r6("pearson", "pearson"), r6("spearman", "spearman"), r6("main", "main"))


def k02(spark, sf):
    d = scored_docs(spark, sf)
    hi = E.best_accuracy_threshold(d, "score", "quality", "id").withColumn("mode", F.lit("high"))
    lo = E.best_accuracy_threshold(d, "score", "quality", "id", False).withColumn("mode", F.lit("low"))
    return hi.unionByName(lo).select("mode", r6("accuracy", "accuracy"), r6("threshold", "threshold"))


def k03(spark, sf):
    out = E.best_f1_threshold(scored_docs(spark, sf), "score", "quality", "id", by=["lang"])
    return out.select("lang", r6("f1", "f1"), r6("precision", "precision"), r6("recall", "recall"), r6("threshold", "threshold"))


def k04(spark, sf):
    return E.average_precision(scored_docs(spark, sf), "score", "quality", ["lang"]).select("lang", r6("ap", "ap"))


def k05(spark, sf):
    out = E.binary_classification_report(pairs(spark, sf), "same")
    return out.select("metric", *[r6(c, c) for c in out.columns if c != "metric"])


def qrels(spark, sf):
    """Documents that hold a benchmark item's whole text."""
    d, b = docs(spark, sf).select(F.col("id").alias("corpus_id"), "text"), benchmark(spark, sf)
    # Candidates share the item's longest word, then the text is checked in full.
    key = F.array_max(F.transform(X.words("text"), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    q = b.select(F.col("id").alias("query_id"), F.col("text").alias("item"), key.alias("w"))
    inner = d.select("corpus_id", "text", F.explode(F.array_distinct(X.words("text"))).alias("w"))
    return inner.join(q, "w").where(F.col("text").contains(F.col("item"))).select("query_id", "corpus_id").distinct()


def label_qrels(spark, sf):
    """Per vector the vectors of its label among the ten ids around it."""
    e = embeddings(spark, sf).select("id", "label")
    near = e.select(F.col("id").alias("query_id"), F.col("label").alias("ql"), F.explode(F.sequence(F.col("id") - 10, F.col("id") + 10)).alias("corpus_id"))
    out = near.join(e.select(F.col("id").alias("corpus_id"), "label"), "corpus_id").where("ql = label AND query_id <> corpus_id")
    return out.select("query_id", "corpus_id")


def k06(spark, sf):
    e = embeddings(spark, sf)
    hits = [S.semantic_search(e, e, 100, s, True).withColumn("system", F.lit(n)) for s, n in (("cos", "cos_sim"), ("dot", "dot_score"))]
    out = E.information_retrieval(reduce(DataFrame.unionByName, hits), e.select(F.col("id").alias("query_id")), label_qrels(spark, sf), by=["system"])
    return out.select("system", "metric", "k", r6("value", "value"))


def samples(spark, sf):
    """Fifty nearest vectors per vector; relevant if the label is the same."""
    e = embeddings(spark, sf)
    lab = e.select("id", "label")
    hits = S.semantic_search(e, e, 50, "cos", True)
    hits = hits.join(lab.select(F.col("id").alias("query_id"), F.col("label").alias("ql")), "query_id")
    hits = hits.join(lab.select(F.col("id").alias("corpus_id"), F.col("label").alias("cl")), "corpus_id")
    return hits.select("query_id", F.col("corpus_id").alias("doc_id"), (F.col("ql") == F.col("cl")).cast("int").alias("is_relevant"), F.round("score", 2).alias("score"))


def k07(spark, sf):
    return E.reranking(samples(spark, sf), 10).select("queries", r6("map", "map"), r6("mrr", "mrr"))


def k08(spark, sf):
    return E.ce_reranking(samples(spark, sf), 3).select("queries", r6("mrr", "mrr"))


def gold_pairs(spark, sf):
    """Vectors ten ids apart that share a label."""
    e = embeddings(spark, sf).select("id", "label")
    return e.select(F.col("id").alias("id1"), "label").join(e.select((F.col("id") - 10).alias("id1"), F.col("id").alias("id2"), F.col("label").alias("l2")), "id1").where(
        "label = l2").select("id1", "id2")


def _mined(spark, sf):
    return S.paraphrase_mining(embeddings(spark, sf), k=20, max_pairs=None)


def k09(spark, sf):
    out = E.paraphrase_mining_eval(_mined(spark, sf), gold_pairs(spark, sf))
    return out.select("total_gold", *[r6(c, c) for c in ("ap", "f1", "precision", "recall", "threshold")])


def k09_closure(spark, sf):
    out = E.paraphrase_mining_eval(_mined(spark, sf), gold_pairs(spark, sf), closure=True)
    return out.select("total_gold", *[r6(c, c) for c in ("ap", "f1", "precision", "recall", "threshold")])


def shifted(spark, sf):
    """The vectors with every third element set to zero: a noisy translation of the table."""
    return embeddings(spark, sf).select("id", F.transform(V.as_double("embedding"), lambda x, i: F.when(i % 3 == 0, 0.0).otherwise(x)).alias("embedding"))


def k10(spark, sf):
    src = embeddings(spark, sf).select("id", V.as_double("embedding").alias("embedding"))
    out = E.translation_accuracy(src, shifted(spark, sf))
    return out.select(*[r6(c, c) for c in out.columns])


def triplets(spark, sf):
    """Each vector with the next and the next but one."""
    e = embeddings(spark, sf).select("id", "embedding")
    return (e.select("id", F.col("embedding").alias("a")).join(e.select((F.col("id") - 1).alias("id"), F.col("embedding").alias("p")), "id")
            .join(e.select((F.col("id") - 2).alias("id"), F.col("embedding").alias("n")), "id"))


def k11(spark, sf):
    out = E.triplet_accuracy(triplets(spark, sf))
    return out.select(*[r6(c, c) for c in out.columns])


def k12(spark, sf):
    return E.embedding_mse(embeddings(spark, sf), shifted(spark, sf)).select(r6("mse", "mse"), r6("score", "score"))


def wide(spark, sf):
    """Documents as rows of one text per language: the i-th texts of each language in a run of 64 ids share a row.

    Every text has its cell; a cell is null where a language has fewer texts in the run.
    """
    d = table(spark, sf, "documents").withColumn("run", F.floor(F.col("doc_id") / 64))
    place = Window.partitionBy("run", "lang").orderBy("doc_id", "text")  # 64 rows at most, beyond repeated ids
    d = d.withColumn("g", F.col("run") * 64 + F.row_number().over(place) - 1)
    return d.groupBy("g").agg(*[F.max(F.when(F.col("lang") == lang, F.col("text"))).alias(lang) for lang in ("en", "de", "fr", "es")])


def text_vector(c):
    return F.array((F.length(c) / 1000.0), F.size(X.words(c)) / 100.0, F.length(F.regexp_replace(c, "[^e]", "")) / 100.0)


def k13(spark, sf):
    out = E.mse_by_language_pair(wide(spark, sf), [("en", "de"), ("en", "fr"), ("en", "es")], text_vector, text_vector)
    return out.select("src", "trg", r6("mse", "mse"), r6("score", "score"))


def k14(spark, sf):
    d = embeddings(spark, sf).select("label", F.col("embedding").alias("scores"))
    return E.label_accuracy(d, "scores", "label").select(r6("accuracy", "accuracy"))


def k15(spark, sf):
    return E.binary_accuracy(scored_docs(spark, sf), "score", "quality", 200.0).select(r6("accuracy", "accuracy"))


def k16(spark, sf):
    out = E.correlation_report(scored_docs(spark, sf), "score", "toxic", by=["lang"])
    return out.select("lang", r6("pearson", "pearson"), r6("spearman", "spearman"))


def k17(spark, sf):
    d = scored_docs(spark, sf)
    frames = [E.binary_accuracy(d, "score", "quality", t) for t in (50.0, 200.0, 500.0)]
    a = E.sequential_evaluation(frames).select(F.lit("last").alias("mode"), r6("main", "main"))
    return a.unionByName(E.sequential_evaluation(frames, "mean").select(F.lit("mean").alias("mode"), r6("main", "main")))


def k18(spark, sf):
    run = L.bm25_search(benchmark(spark, sf), docs(spark, sf), 50, stop=STOP)
    grades = run.join(docs(spark, sf).select(F.col("id").alias("corpus_id"), "lang"), "corpus_id").select(
        "query_id", "corpus_id", F.when(F.col("lang") == "en", F.col("corpus_id") % 3).otherwise(0).alias("relevance"))
    return E.graded_ndcg(run, grades, 10).select("query_id", r6("ndcg", "ndcg"))


SD = """sd AS (SELECT doc_id AS id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> ''))::DOUBLE AS score, quality, toxic, lang
        FROM documents JOIN labels USING (doc_id))"""
PAIRS = f"""{SQL_EMB},
p AS (SELECT a.vec_id * 10 + s AS id, s AS step, a.v AS av, b.v AS bv, (a.label = b.label)::BIGINT AS same, abs(a.label - b.label) AS gap
      FROM e a, (SELECT unnest(range(1, {STEPS + 1})) AS s), e b WHERE b.vec_id = a.vec_id + s),
m AS (SELECT id, step, same, gap, 'cosine' AS metric, round(list_cosine_similarity(av, bv), 9) AS s FROM p
      UNION ALL SELECT id, step, same, gap, 'euclidean', round(-list_distance(av, bv), 9) FROM p
      UNION ALL SELECT id, step, same, gap, 'manhattan', round(-list_sum(list_transform(list_zip(av, bv), lambda z: abs(z[1] - z[2]))), 9) FROM p
      UNION ALL SELECT id, step, same, gap, 'dot', round(list_inner_product(av, bv), 9) FROM p)"""


def _cut(src: str, key: str, default: str, best: str) -> str:
    return f"""
r AS (SELECT {key}, s, row_number() OVER w AS pos, sum(y) OVER w AS hits, count(*) OVER (PARTITION BY {key}) AS n,
             sum(y) OVER (PARTITION BY {key}) AS total, lead(s) OVER w AS nxt
      FROM {src} WINDOW w AS (PARTITION BY {key} ORDER BY s DESC, id ROWS UNBOUNDED PRECEDING)),
acc AS (SELECT {key}, arg_max(struct_pack(v := v, t := (s + nxt) / 2), {{'a': v, 'b': -pos}}) AS b FROM (SELECT *, (hits + (n - total) - (pos - hits)) / n AS v FROM r) WHERE pos < n GROUP BY {key}),
f AS (SELECT {key}, arg_max(struct_pack(v := v, t := (s + nxt) / 2, p := hits / pos, r := hits / total), {{'a': v, 'b': -pos}}) AS b
      FROM (SELECT *, 2.0 * hits / (pos + total) AS v FROM r) WHERE pos < n AND hits > 0 GROUP BY {key})"""


AP = """st AS (SELECT {key}, s, count(*) AS c, sum(y) AS p FROM {src} GROUP BY {key}, s),
ru AS (SELECT {key}, p, sum(c) OVER w AS cc, sum(p) OVER w AS pp FROM st WINDOW w AS (PARTITION BY {key} ORDER BY s DESC ROWS UNBOUNDED PRECEDING)),
ap AS (SELECT {key}, sum(p * pp / cc) / sum(p) AS ap FROM ru GROUP BY {key})"""
NEAR = f"""{SQL_EMB}, s AS (SELECT a.vec_id AS q, b.vec_id AS c, {COS} AS score, (a.label = b.label)::INT AS rel FROM e a, e b WHERE a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, c) AS rank FROM s)"""
SAMPLES = NEAR + """, j AS (SELECT q, c, rel AS y, round(score, 2) AS s FROM r WHERE rank <= 50),
k AS (SELECT * FROM j WHERE q IN (SELECT q FROM j GROUP BY q HAVING max(y) = 1 AND min(y) = 0)),
o AS (SELECT q, y, row_number() OVER (PARTITION BY q ORDER BY s DESC, c) AS pos FROM k),
rr AS (SELECT q, coalesce(max(1.0 / pos) FILTER (WHERE y = 1 AND pos <= {k}), 0) AS rr FROM o GROUP BY q)"""
GOLD = "g AS (SELECT a.vec_id AS id1, b.vec_id AS id2 FROM e a JOIN e b ON b.vec_id = a.vec_id + 10 AND a.label = b.label)"
MINE = """mp AS (SELECT max(score) AS s, least(q, c) AS id1, greatest(q, c) AS id2 FROM r WHERE rank <= 20 AND score > -1 GROUP BY 2, 3)"""
SWEEP = """w AS (SELECT *, row_number() OVER o AS pos, sum(y) OVER o AS hits, lead(s, 1, s) OVER o AS nxt FROM k WINDOW o AS (ORDER BY s DESC, id1, id2 ROWS UNBOUNDED PRECEDING)),
b AS (SELECT arg_max(struct_pack(f := f, p := hits / pos, r := hits / total, t := (s + nxt) / 2), {{'a': f, 'b': -pos}}) AS b, sum(hits / pos) AS aps
      FROM (SELECT w.*, total, 2.0 * hits / (pos + total) AS f FROM w, t) WHERE y = 1)
SELECT total::BIGINT AS total_gold, round(aps / total, 6) AS ap, round(b.f, 6) AS f1, round(b.p, 6) AS precision, round(b.r, 6) AS recall, round(b.t, 6) AS threshold FROM b, t"""


def _ir_sql() -> str:
    ks = (1, 3, 5, 10)
    out = []
    per = []
    for k in ks:
        per.append(("accuracy", k, f"(count(*) FILTER (WHERE rank <= {k}) > 0)::INT"))
        per.append(("precision", k, f"count(*) FILTER (WHERE rank <= {k}) / {k}.0"))
        per.append(("recall", k, f"count(*) FILTER (WHERE rank <= {k}) / any_value(n_rel)"))
    per.append(("mrr", 10, "coalesce(1.0 / min(rank) FILTER (WHERE rank <= 10), 0)"))
    per.append(("ndcg", 10, "coalesce(sum(1 / log2(rank + 1)) FILTER (WHERE rank <= 10), 0) / any_value((SELECT sum(1 / log2(i + 2)) FROM range(10) t(i) WHERE i < least(10, n_rel)))"))
    per.append(("map", 100, "coalesce(sum(num / rank) FILTER (WHERE rank <= 100), 0) / any_value(least(100, n_rel))"))
    cols = ", ".join(f"{x} AS {m}_{k}" for m, k, x in per)
    for m, k, _ in per:
        out.append(f"SELECT system, '{m}' AS metric, {k}::BIGINT AS k, round(avg({m}_{k}), 6) AS value FROM pq GROUP BY system")
    return f"""
WITH {SQL_EMB},
s AS (SELECT a.vec_id AS q, b.vec_id AS c, {COS} AS x, round(list_inner_product(a.v, b.v), 9) AS y FROM e a, e b WHERE a.vec_id <> b.vec_id),
h AS (SELECT 'cos_sim' AS system, q, c, row_number() OVER (PARTITION BY q ORDER BY x DESC, c) AS rank FROM s
      UNION ALL SELECT 'dot_score', q, c, row_number() OVER (PARTITION BY q ORDER BY y DESC, c) FROM s),
ql AS (SELECT a.vec_id AS q, b.vec_id AS c FROM e a JOIN e b ON abs(a.vec_id - b.vec_id) <= 10 AND a.vec_id <> b.vec_id AND a.label = b.label),
nr AS (SELECT q, count(*) AS n_rel FROM ql GROUP BY q),
g AS (SELECT system, q, rank, row_number() OVER (PARTITION BY system, q ORDER BY rank) AS num FROM h JOIN ql USING (q, c) WHERE rank <= 100),
pq AS (SELECT sy.system, nr.q, {cols} FROM nr CROSS JOIN (VALUES ('cos_sim'), ('dot_score')) sy(system) LEFT JOIN g ON g.q = nr.q AND g.system = sy.system GROUP BY 1, 2)
""" + " UNION ALL ".join(out)


SQL_SHIFT = "sh AS (SELECT vec_id, list_transform(v, lambda x, i: CASE WHEN (i - 1) % 3 = 0 THEN 0.0 ELSE x END) AS v FROM e)"
TV = "[length({x}) / 1000.0::DOUBLE, len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')) / 100.0::DOUBLE, length(regexp_replace({x}, '[^e]', '', 'g')) / 100.0::DOUBLE]"

SQL_WIDE = """t AS (SELECT (doc_id // 64) * 64 + row_number() OVER (PARTITION BY doc_id // 64, lang ORDER BY doc_id, text) - 1 AS g, lang, text FROM documents),
        w AS (SELECT g, max(text) FILTER (WHERE lang = 'en') AS en, max(text) FILTER (WHERE lang = 'de') AS de,
                     max(text) FILTER (WHERE lang = 'fr') AS fr, max(text) FILTER (WHERE lang = 'es') AS es FROM t GROUP BY 1)"""

QUERIES = {
    "k01_embedding_similarity": (k01, f"""
        WITH {PAIRS},
        q AS (SELECT step, metric, gap, s,
                rank() OVER (PARTITION BY step, metric ORDER BY gap) + (count(*) OVER (PARTITION BY step, metric, gap) - 1) / 2.0 AS ra,
                rank() OVER (PARTITION BY step, metric ORDER BY s) + (count(*) OVER (PARTITION BY step, metric, s) - 1) / 2.0 AS rb FROM m),
        c AS (SELECT step, metric, corr(gap, s) AS pe, corr(ra, rb) AS sp FROM q GROUP BY 1, 2)
        SELECT step, metric, round(pe, 6) AS pearson, round(sp, 6) AS spearman, round(max(sp) OVER (PARTITION BY step), 6) AS main FROM c"""),
    "k02_best_accuracy": (k02, f"""
        WITH {SD}, x AS (SELECT 'high' AS mode, id, score AS s, quality AS y FROM sd UNION ALL SELECT 'low', id, -score, quality FROM sd), {_cut('x', 'mode', '-1', 'acc')}
        SELECT mode, round(b.v, 6) AS accuracy, round(CASE mode WHEN 'low' THEN -b.t ELSE b.t END, 6) AS threshold FROM acc"""),
    "k03_best_f1": (k03, f"""
        WITH {SD}, x AS (SELECT lang, id, score AS s, quality AS y FROM sd), {_cut('x', 'lang', '0', 'f')}
        SELECT lang, round(b.v, 6) AS f1, round(b.p, 6) AS precision, round(b.r, 6) AS recall, round(b.t, 6) AS threshold FROM f"""),
    "k04_average_precision": (k04, f"WITH {SD}, x AS (SELECT lang, score AS s, quality AS y FROM sd), {AP.format(key='lang', src='x')} SELECT lang, round(ap, 6) AS ap FROM ap"),
    "k05_binary_report": (k05, f"""
        WITH {PAIRS}, x AS (SELECT metric, id, s, same AS y FROM m), {_cut('x', 'metric', '0', 'f')}, {AP.format(key='metric', src='x')},
        z AS (SELECT metric, acc.b AS a, f.b AS f, ap, CASE WHEN metric IN ('euclidean', 'manhattan') THEN -1 ELSE 1 END AS sg FROM acc JOIN f USING (metric) JOIN ap USING (metric))
        SELECT metric, round(a.v, 6) AS accuracy, round(sg * a.t, 6) AS accuracy_threshold, round(f.v, 6) AS f1, round(f.p, 6) AS precision, round(f.r, 6) AS recall,
               round(sg * f.t, 6) AS f1_threshold, round(ap, 6) AS ap, round(max(ap) OVER (), 6) AS main FROM z"""),
    "k06_information_retrieval": (k06, _ir_sql()),
    "k07_reranking": (k07, f"WITH {SAMPLES.format(k=10)}, {AP.format(key='q', src='k')} SELECT count(*) AS queries, round(avg(ap), 6) AS map, round(avg(rr), 6) AS mrr FROM ap JOIN rr USING (q)"),
    "k08_ce_reranking": (k08, f"WITH {SAMPLES.format(k=3)} SELECT count(*) AS queries, round(avg(rr), 6) AS mrr FROM rr"),
    "k09_mining_evaluation": (k09, f"WITH {NEAR}, {MINE}, {GOLD}, t AS (SELECT count(*)::DOUBLE AS total FROM g), k AS (SELECT mp.*, (g.id1 IS NOT NULL)::INT AS y FROM mp LEFT JOIN g USING (id1, id2)), {SWEEP.format()}"),
    "k09_mining_evaluation_closure": (k09_closure, f"""
        WITH RECURSIVE {NEAR}, {MINE}, {GOLD}, ed AS (SELECT id1 AS a, id2 AS b FROM g UNION ALL SELECT id2, id1 FROM g),
        reach AS (SELECT a AS node, a AS root FROM ed UNION SELECT ed.b, reach.root FROM reach JOIN ed ON ed.a = reach.node),
        cc AS (SELECT node, min(root) AS comp FROM reach GROUP BY 1),
        t AS (SELECT sum(n * (n - 1) / 2)::DOUBLE AS total FROM (SELECT count(*) AS n FROM cc GROUP BY comp)),
        k AS (SELECT mp.*, coalesce(x.comp = y.comp, false)::INT AS y FROM mp LEFT JOIN cc x ON x.node = id1 LEFT JOIN cc y ON y.node = id2), {SWEEP.format()}"""),
    "k10_translation_accuracy": (k10, f"""
        WITH {SQL_EMB}, {SQL_SHIFT}, s AS (SELECT a.vec_id AS x, b.vec_id AS y, {COS} AS score FROM e a, sh b),
        f AS (SELECT avg((x = y)::INT) AS p FROM (SELECT *, row_number() OVER (PARTITION BY x ORDER BY score DESC, y) AS r FROM s) WHERE r = 1),
        g AS (SELECT avg((x = y)::INT) AS q FROM (SELECT *, row_number() OVER (PARTITION BY y ORDER BY score DESC, x) AS r FROM s) WHERE r = 1)
        SELECT round(p, 6) AS src2trg, round(q, 6) AS trg2src, round((p + q) / 2, 6) AS mean FROM f, g"""),
    "k11_triplet_accuracy": (k11, f"""
        WITH {SQL_EMB}, t AS (SELECT a.v AS a, p.v AS p, n.v AS n FROM e a JOIN e p ON p.vec_id = a.vec_id + 1 JOIN e n ON n.vec_id = a.vec_id + 2),
        c AS (SELECT avg((list_cosine_similarity(a, p) > list_cosine_similarity(a, n))::INT) AS c,
              avg((list_sum(list_transform(list_zip(a, p), lambda z: abs(z[1] - z[2]))) < list_sum(list_transform(list_zip(a, n), lambda z: abs(z[1] - z[2]))))::INT) AS m,
              avg((list_distance(a, p) < list_distance(a, n))::INT) AS u FROM t)
        SELECT round(c, 6) AS cosine, round(m, 6) AS manhattan, round(u, 6) AS euclidean, round(greatest(c, m, u), 6) AS main FROM c"""),
    "k12_embedding_mse": (k12, f"WITH {SQL_EMB}, {SQL_SHIFT}, x AS (SELECT 100 * sum(list_distance(e.v, sh.v) ** 2) / sum(len(e.v)) AS m FROM e JOIN sh USING (vec_id)) SELECT round(m, 6) AS mse, round(-m, 6) AS score FROM x"),
    "k13_mse_by_language_pair": (k13, f"""
        WITH {SQL_WIDE},
        l AS (SELECT 'en' AS src, 'de' AS trg, en AS s, de AS t FROM w UNION ALL SELECT 'en', 'fr', en, fr FROM w UNION ALL SELECT 'en', 'es', en, es FROM w),
        x AS (SELECT src, trg, 100 * sum(list_distance({TV.format(x='s')}, {TV.format(x='t')}) ** 2) / sum(3) AS m FROM l WHERE trim(s) <> '' AND trim(t) <> '' GROUP BY 1, 2)
        SELECT src, trg, round(m, 6) AS mse, round(-m, 6) AS score FROM x"""),
    "k14_label_accuracy": (k14, f"WITH {SQL_EMB}, x AS (SELECT label, v AS s FROM e) SELECT round(avg((list_position(s, list_max(s)) - 1 = label)::INT), 6) AS accuracy FROM x"),
    "k15_binary_accuracy": (k15, f"WITH {SD} SELECT round(avg(((score > 200)::INT = quality)::INT), 6) AS accuracy FROM sd"),
    "k16_correlation_report": (k16, f"""
        WITH {SD}, r AS (SELECT lang, score, toxic, rank() OVER (PARTITION BY lang ORDER BY score) + (count(*) OVER (PARTITION BY lang, score) - 1) / 2.0 AS ra,
                         rank() OVER (PARTITION BY lang ORDER BY toxic) + (count(*) OVER (PARTITION BY lang, toxic) - 1) / 2.0 AS rb FROM sd)
        SELECT lang, round(corr(score, toxic), 6) AS pearson, round(corr(ra, rb), 6) AS spearman FROM r GROUP BY 1"""),
    "k17_sequential_evaluation": (k17, f"""
        WITH {SD}, a AS (SELECT avg(((score > 50)::INT = quality)::INT) AS x, avg(((score > 200)::INT = quality)::INT) AS y, avg(((score > 500)::INT = quality)::INT) AS z FROM sd)
        SELECT 'last' AS mode, round(z, 6) AS main FROM a UNION ALL SELECT 'mean', round((x + y + z) / 3, 6) FROM a"""),
    "k18_graded_ndcg": (k18, f"""
        WITH {SQL_BM25}, g AS (SELECT query_id, corpus_id, rank, CASE WHEN lang = 'en' THEN corpus_id % 3 ELSE 0 END AS rel FROM bm JOIN documents ON doc_id = corpus_id WHERE rank <= 50),
        i AS (SELECT query_id, sum(rel / log2(ir + 1)) AS idcg FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rel DESC, corpus_id) AS ir FROM g WHERE rel > 0) WHERE ir <= 10 GROUP BY 1),
        gd AS (SELECT query_id, sum(rel / log2(rank + 1)) AS dcg FROM g WHERE rank <= 10 AND rel > 0 GROUP BY 1)
        SELECT query_id, round(coalesce(dcg, 0) / idcg, 6) AS ndcg FROM i LEFT JOIN gd USING (query_id)"""),
}
