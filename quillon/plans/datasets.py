"""Dataset construction (N)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..operators import datasets as N
from ..operators import search as S
from .common import SQL_EMB, embeddings, r6, sql_hash, sql_hash_int, table
from .evaluate import GOLD, PAIRS, SQL_SHIFT, SQL_WIDE, gold_pairs, label_qrels, pairs, shifted, wide
from .search import COS, EDGES, benchmark, copy_pairs, length_gap, sql_bm25, turn_pairs
from .tabular import doc_links
from .text import STOP, docs, sql_words, turns


def nli_pairs(spark, sf):
    """Consecutive documents with a label by length."""
    d = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    nxt = d.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("s2"))
    label = F.element_at(F.array(F.lit("contradiction"), F.lit("entailment"), F.lit("neutral")), (F.col("n_chars") % 3 + 1).cast("int"))
    return d.join(nxt, "doc_id").select(F.col("text").alias("s1"), "s2", label.alias("label"))


def n01(spark, sf):
    out = N.nli_triplets(nli_pairs(spark, sf))
    return out.select("kind", *[F.md5(c).alias(c) for c in ("anchor", "positive", "negative")])


def n02(spark, sf):
    return N.label_triplets(embeddings(spark, sf), "label")


def batched(spark, sf):
    return embeddings(spark, sf).withColumn("batch", F.floor(F.col("id") / 50))


def _hard(mode):
    def query(spark, sf):
        out = N.hard_triplets(batched(spark, sf), mode=mode, margin=0.1)
        # Sums of nine-decimal distances: nine decimals hold them without ties.
        return out.select(*[F.round(c, 9 if c == "loss" else 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])
    return query


def n04(spark, sf):
    p = pairs(spark, sf).select("id", F.floor(F.col("id") / 200).alias("batch"), "same", F.round(1 - V.cosine("a", "b"), 9).alias("distance"))
    return N.hard_pairs(p, "batch", label="same").select("id", "batch", "same", r6("distance", "distance"))


def anchors(spark, sf):
    e = batched(spark, sf).select("id", "batch", V.as_double("embedding").alias("anchor"))
    return e.join(shifted(spark, sf).select("id", F.col("embedding").alias("positive")), "id")


def n05(spark, sf):
    a = anchors(spark, sf)
    inside = N.hardest_in_batch_negative(a, "batch").withColumn("scope", F.lit("batch"))
    over_all = N.hardest_in_batch_negative(a).withColumn("scope", F.lit("all"))
    return inside.unionByName(over_all).select("scope", "query_id", "corpus_id", r6("score", "score"))


def mined_negatives(spark, sf):
    """Hits of two systems that are not relevant, with their ranks."""
    e, q = embeddings(spark, sf), label_qrels(spark, sf)
    hits = [S.semantic_search(e, e, 20, s, True).withColumn("system", F.lit(s)) for s in ("cos", "dot")]
    hits = reduce(DataFrame.unionByName, hits).join(q, ["query_id", "corpus_id"], "left_anti")
    return hits.select("query_id", "system", "corpus_id", F.col("rank").alias("position"))


def pair_scores(spark, sf, *keys):
    """Cosine times ten for the named (query, passage) pairs."""
    e = embeddings(spark, sf).select("id", "embedding")
    want = reduce(DataFrame.unionByName, [k.select("query_id", "corpus_id") for k in keys]).distinct()
    rows = want.join(e.select(F.col("id").alias("query_id"), F.col("embedding").alias("a")), "query_id").join(
        e.select(F.col("id").alias("corpus_id"), F.col("embedding").alias("b")), "corpus_id")
    return rows.select("query_id", "corpus_id", F.round(10 * V.cosine("a", "b"), 6).alias("score"))


def n06(spark, sf):
    pos, neg = label_qrels(spark, sf), mined_negatives(spark, sf)
    return N.ce_filtered_negatives(pos, neg, pair_scores(spark, sf, pos, neg), ["cos", "dot"], margin=-2.0, per_system=3)


def n07(spark, sf):
    pos, neg = label_qrels(spark, sf), mined_negatives(spark, sf)
    out = N.margin_labels(pos, neg, pair_scores(spark, sf, pos, neg), round=2)
    return out.select("query_id", "positive", "negative", r6("label", "label"))


def triples(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.col("event_id").alias("line"), F.col("user_id").alias("query_id"), (F.col("event_id") % 97).alias("pos_id"),
                    F.floor(F.col("value") * 10).alias("neg_id"))


def n08(spark, sf):
    t = triples(spark, sf)
    dev, _ = N.holdout_queries(t, 20, 15)
    return N.ratio_sample(t, 4, held_out=dev.select("query_id").distinct())


def n09(spark, sf):
    dev, train = N.holdout_queries(triples(spark, sf), 20, 15)
    rest = train.select("query_id", F.col("neg_id").alias("passage_id"), F.lit("train").alias("part"))
    return dev.select("query_id", "passage_id", F.when(F.col("is_positive"), "dev_pos").otherwise("dev_neg").alias("part")).unionByName(rest)


def n10(spark, sf):
    e = embeddings(spark, sf)
    dense = N.augment_silver_pairs(e, gold_pairs(spark, sf), 3).withColumn("retriever", F.lit("dense"))
    b = benchmark(spark, sf)
    none = b.select(F.col("id").alias("id1"), (F.col("id") + 1).alias("id2"))
    lexical = N.augment_silver_pairs(b, none, 3, "bm25", STOP).withColumn("retriever", F.lit("bm25"))
    return dense.unionByName(lexical).select("retriever", "id1", "id2", r6("score", "score"))


def n11(spark, sf):
    return N.cross_domain_labels(turn_pairs(spark, sf), "text", "reply", length_gap).select("id", r6("score", "score"), "label")


def n12(spark, sf):
    return N.duplicate_split(copy_pairs(spark, sf)).select("node", "component", "split")


def n12_rounds(spark, sf):
    """The components without their driver-side ending."""
    return N.duplicate_split(copy_pairs(spark, sf), small=0).select("node", "component", "split")


def n13(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    edges = copy_pairs(spark, sf)
    split = N.duplicate_split(edges.unionByName(d.select(F.col("id").alias("id1"), F.col("id").alias("id2"))))
    labelled = edges.distinct().withColumn("is_duplicate", F.lit(1))
    t = N.task_tables(labelled, d, split)
    rows = []
    for name, df in t.items():
        key = "id1" if name == "classification" else "corpus_id" if name == "retrieval_relevant" else "id"
        parts = [F.lit(name).alias("task"), (F.col("split") if "split" in df.columns else F.lit("all")).alias("split"), F.col(key).alias("id")]
        rows.append(df.select(*parts))
    return reduce(DataFrame.unionByName, rows).groupBy("task", "split").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


def n14(spark, sf):
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang")
    needed = table(spark, sf, "labels").where("quality = 0").select(F.col("doc_id").alias("id"))
    return N.retrieval_subcorpus(d, needed, 300)


def n15(spark, sf):
    out = N.parallel_pairs_wide(wide(spark, sf), "en", ["de", "fr", "es"], 10, "g")
    return out.select("lang", "g", "split", F.md5("src_text").alias("src"), F.md5("trg_text").alias("trg"))


def n16(spark, sf):
    out = N.parallel_pairs_links(docs(spark, sf).select("id", "lang", "text"), doc_links(spark, sf), ["en"], ["de", "fr", "es"], 20)
    return out.select("src_lang", "trg_lang", "split", F.md5("src_text").alias("src"), F.md5("trg_text").alias("trg"))


def mined_sentences(spark, sf):
    d = table(spark, sf, "documents")
    return d.select(F.col("doc_id").alias("order"), (1.0 + (F.col("n_chars") % 100) / 500.0).alias("score"),
                    F.concat("source", F.lit("-"), (F.col("doc_id") % 7).cast("string")).alias("sent1"), F.concat("lang", F.lit("-"), (F.col("doc_id") % 50).cast("string")).alias("sent2"))


def n17(spark, sf):
    return N.parallel_pairs_scored(mined_sentences(spark, sf), 1.075, swap=True, n_dev=5)


def n18(spark, sf):
    d = table(spark, sf, "documents").select(F.array("source", "lang", F.concat("source", F.lit("/"), "lang")).alias("texts"))
    return N.translation_groups(d)


def n19(spark, sf):
    t = turns(spark, sf).select("id", "text", "role")
    out = N.no_duplicate_batches(t, ["text"], 16)
    return out.groupBy("batch").agg(F.count(F.lit(1)).alias("n"), F.countDistinct(X.pooled_key("text")).alias("texts"))


def n20(spark, sf):
    return N.label_batches(table(spark, sf, "documents"), "source", 4, id="doc_id")


def n20_replace(spark, sf):
    return N.label_batches(table(spark, sf, "documents"), "source", 4, id="doc_id", replace=True)


def n21(spark, sf):
    return N.contrastive_pairs(table(spark, sf, "documents").select("doc_id"), id="doc_id")


def n22(spark, sf):
    """Per dataset: rows served, full batches without a repeated text, scheduled steps that name no such batch; and all steps."""
    d = docs(spark, sf).select("id", "text", "lang")
    rows, plan = N.multi_dataset_batches({lang: d.where(F.col("lang") == lang) for lang in ("en", "de", "fr")}, ["text"], 8, 2.0)
    texts = d.select("id", X.pooled_key("text").alias("k"))
    good = rows.join(texts, "id").groupBy("dataset", "batch_no").agg(F.countDistinct("id").alias("n"), F.countDistinct("k").alias("k")).where("n = 8 AND k = 8")
    steps = plan.agg(F.count(F.lit(1)).alias("steps"), F.countDistinct("step").alias("different"))
    wrong = plan.join(good, ["dataset", "batch_no"], "left_anti").agg(F.count(F.lit(1)).alias("wrong_steps"))
    per = rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("rows")).join(good.groupBy("dataset").agg(F.count(F.lit(1)).alias("batches")), "dataset")
    totals = steps.withColumn("one", F.lit(1)).join(F.broadcast(wrong.withColumn("one", F.lit(1))), "one")  # one row each
    return per.withColumn("one", F.lit(1)).join(F.broadcast(totals), "one").drop("one")


def n23(spark, sf):
    out = N.identity_pairs(docs(spark, sf), min_chars=50, keep=["id"])
    return out.select("id", F.md5(F.get("texts", F.lit(0))).alias("a"), F.md5(F.get("texts", F.lit(1))).alias("b"))


def n24(spark, sf):
    return N.denoise_pairs(turns(spark, sf), seed=5)


def n25(spark, sf):
    return N.sentence_pool(table(spark, sf, "part"), ["p_name", "p_type", "p_brand"], 20)


NLI = """p AS (SELECT trim(a.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s1, trim(b.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s2, ['contradiction', 'entailment', 'neutral'][a.n_chars % 3 + 1] AS l FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1),
r AS (SELECT s1 AS s, s2 AS o, l FROM p UNION ALL SELECT s2, s1, l FROM p)"""


def _pick(name: str, n: int) -> str:
    return f"(min({{'h': md5('{n}:' || s || ':' || o), 'o': o}}) FILTER (WHERE l = '{name}')).o AS {name[:3]}{n}"


BATCH = f"""{SQL_EMB},
d AS (SELECT a.vec_id // 50 AS batch, a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, round(list_distance(a.v, b.v), 9) AS d
      FROM e a JOIN e b ON a.vec_id // 50 = b.vec_id // 50 AND a.vec_id <> b.vec_id)"""
HITS2 = f"""{SQL_EMB},
s AS MATERIALIZED (SELECT a.vec_id AS q, b.vec_id AS c, {COS} AS x, round(list_inner_product(a.v, b.v), 9) AS y, round(10 * list_cosine_similarity(a.v, b.v), 6) AS sc FROM e a, e b WHERE a.vec_id <> b.vec_id),
ql AS (SELECT a.vec_id AS q, b.vec_id AS c FROM e a JOIN e b ON abs(a.vec_id - b.vec_id) <= 10 AND a.vec_id <> b.vec_id AND a.label = b.label),
h AS (SELECT q, c, sc, row_number() OVER (PARTITION BY q ORDER BY x DESC, c) AS rx, row_number() OVER (PARTITION BY q ORDER BY y DESC, c) AS ry FROM s),
ng AS MATERIALIZED (SELECT q, c, sc, rx, ry FROM h ANTI JOIN ql USING (q, c) WHERE rx <= 20 OR ry <= 20)"""
_DRAW = sql_hash_int("(id || '-' || {i})", 5)
COMP = f"""{EDGES}, al AS (SELECT doc_id AS node, coalesce(component, doc_id) AS component, text FROM documents LEFT JOIN cc ON node = doc_id),
sp AS (SELECT *, CASE WHEN b < 1 THEN 'dev' WHEN b < 3 THEN 'test' ELSE 'train' END AS split FROM (SELECT *, {sql_hash_int('component')} % 10 AS b FROM al))"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _most_batches(source: str, size: int) -> str:
    """``bt(source, total, b)``: the largest number of batches that the copies of each text allow."""
    return f"""
        tx AS ({source}), cp AS (SELECT source, k, count(*) AS n FROM tx GROUP BY 1, 2), hs AS (SELECT source, n, count(*) AS keys FROM cp GROUP BY 1, 2),
        al AS (SELECT source, sum(n * keys) AS total FROM hs GROUP BY 1), tr AS (SELECT source, total, unnest(range(0, (total // {size} + 1)::BIGINT)) AS i FROM al),
        bt AS (SELECT source, total, max(i) AS b FROM (SELECT source, total, i, sum(least(n, i) * keys) AS held FROM tr JOIN hs USING (source) GROUP BY 1, 2, 3) WHERE held >= {size} * i GROUP BY 1, 2)"""


QUERIES = {
    "n01_nli_triplets": (n01, f"""
        WITH {NLI}, g AS (SELECT s, {_pick('entailment', 0)}, {_pick('entailment', 1)}, {_pick('contradiction', 0)}, {_pick('contradiction', 1)} FROM r GROUP BY s)
        SELECT 'first' AS kind, md5(s) AS anchor, md5(ent0) AS positive, md5(con0) AS negative FROM g WHERE ent0 IS NOT NULL AND con0 IS NOT NULL
        UNION ALL SELECT 'second', md5(ent1), md5(s), md5(con1) FROM g WHERE ent0 IS NOT NULL AND con0 IS NOT NULL"""),
    "n02_label_triplets": (n02, f"""
        WITH p AS (SELECT vec_id AS id, label, row_number() OVER (PARTITION BY label ORDER BY {sql_hash('vec_id')}, vec_id) AS pos, count(*) OVER (PARTITION BY label) AS n, count(*) OVER () AS total FROM embeddings),
        x AS (SELECT *, (SELECT count(*) FROM embeddings b WHERE b.label < p.label) AS start FROM p),
        a AS (SELECT *, start + pos % n + 1 AS p_at, {sql_hash_int('id', 1)} % (total - n) AS r FROM x WHERE n > 1 AND total > n)
        SELECT a.id AS anchor, y.id AS positive, z.id AS negative FROM a JOIN x y ON y.start + y.pos = p_at JOIN x z ON z.start + z.pos = CASE WHEN r < a.start THEN r ELSE r + a.n END + 1"""),
    "n03_hard_triplets": (_hard("hard"), f"""
        WITH {BATCH}, p AS (SELECT a, arg_max(b, {{'d': d, 'x': -b}}) AS positive, max(d) AS pd FROM d WHERE same GROUP BY a), n AS (SELECT a, arg_min(b, {{'d': d, 'x': b}}) AS negative, min(d) AS nd FROM d WHERE NOT same GROUP BY a)
        SELECT a AS anchor, positive, round(pd, 6) AS p_dist, negative, round(nd, 6) AS n_dist FROM p JOIN n USING (a)"""),
    "n03_semi_hard_triplets": (_hard("semi_hard"), f"""
        WITH {BATCH}, j AS (SELECT p.a, p.b AS p, p.d AS pd, n.b AS n, n.d AS nd FROM d p JOIN d n ON p.a = n.a WHERE p.same AND NOT n.same),
        g AS (SELECT a, p, pd, arg_min({{'n': n, 'd': nd}}, {{'d': nd, 'x': n}}) FILTER (WHERE nd > pd) AS o, arg_max({{'n': n, 'd': nd}}, {{'d': nd, 'x': -n}}) AS i FROM j GROUP BY 1, 2, 3)
        SELECT a AS anchor, p AS positive, round(pd, 6) AS p_dist, coalesce(o, i).n AS negative, round(coalesce(o, i).d, 6) AS n_dist FROM g"""),
    "n03_batch_all": (_hard("all"), f"""
        WITH {BATCH}, j AS (SELECT p.a, p.d - n.d + 0.1 AS l FROM d p JOIN d n ON p.a = n.a WHERE p.same AND NOT n.same), k AS (SELECT a, count(*) AS valid, count(*) FILTER (WHERE l > 0) AS active, coalesce(sum(l) FILTER (WHERE l > 0), 0) AS loss FROM j GROUP BY 1)
        SELECT vec_id AS anchor, coalesce(valid, 0) AS valid, coalesce(active, 0) AS active, round(coalesce(loss, 0), 9) AS loss FROM embeddings LEFT JOIN k ON a = vec_id"""),
    "n04_hard_pairs": (n04, f"""
        WITH {PAIRS}, x AS (SELECT id, id // 200 AS batch, same, round(1 - list_cosine_similarity(av, bv), 9) AS d FROM p),
        l AS (SELECT batch, CASE WHEN count(*) FILTER (WHERE same = 1) > 1 THEN max(d) FILTER (WHERE same = 1) ELSE avg(d) FILTER (WHERE same = 0) END AS near,
                     CASE WHEN count(*) FILTER (WHERE same = 0) > 1 THEN min(d) FILTER (WHERE same = 0) ELSE avg(d) FILTER (WHERE same = 1) END AS far FROM x GROUP BY 1)
        SELECT id, batch, same, round(d, 6) AS distance FROM x JOIN l USING (batch) WHERE (same = 0 AND d < near) OR (same = 1 AND d > far)"""),
    "n05_hardest_in_batch": (n05, f"""
        WITH {SQL_EMB}, {SQL_SHIFT}, s AS (SELECT a.vec_id AS q, b.vec_id AS c, {COS} AS score FROM e a, sh b WHERE a.vec_id <> b.vec_id),
        r AS (SELECT 'all' AS scope, *, row_number() OVER (PARTITION BY q ORDER BY score DESC, c) AS n FROM s UNION ALL SELECT 'batch', *, row_number() OVER (PARTITION BY q ORDER BY score DESC, c) FROM s WHERE q // 50 = c // 50)
        SELECT scope, q AS query_id, c AS corpus_id, round(score, 6) AS score FROM r WHERE n = 1"""),
    "n06_filtered_negatives": (n06, f"""
        WITH {HITS2}, fl AS (SELECT q, min(sc) + 2 AS lim FROM ql JOIN s USING (q, c) GROUP BY q),
        u AS (SELECT ng.* FROM ng JOIN fl USING (q) WHERE sc <= lim),
        one AS (SELECT q, c, rx FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY rx, c) AS n FROM u WHERE rx <= 20) WHERE n <= 3),
        two AS (SELECT q, c, ry FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY ry, c) AS n FROM (SELECT * FROM u ANTI JOIN one USING (q, c) WHERE ry <= 20)) WHERE n <= 3)
        SELECT q AS query_id, 'cos' AS system, c AS corpus_id, rx AS position FROM one UNION ALL SELECT q, 'dot', c, ry FROM two"""),
    "n07_margin_labels": (n07, f"""
        WITH {HITS2}, g AS MATERIALIZED (SELECT q, c, s.sc FROM ql JOIN s USING (q, c)),
        p AS MATERIALIZED (SELECT q, c, sc FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY c) - 1 AS i, count(*) OVER (PARTITION BY q) AS n FROM g) WHERE i = 2 % n),
        n AS MATERIALIZED (SELECT q, c, sc FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY c) - 1 AS i, count(*) OVER (PARTITION BY q) AS n FROM ng) WHERE i = 2 % n)
        SELECT p.q AS query_id, p.c AS positive, n.c AS negative, round(p.sc - n.sc, 6) AS label FROM p JOIN n ON p.q = n.q"""),
    "n08_ratio_sample": (n08, """
        WITH f AS (SELECT user_id FROM events GROUP BY 1 ORDER BY min(event_id) LIMIT 20), r AS (SELECT *, row_number() OVER (ORDER BY event_id) AS position FROM events WHERE user_id NOT IN (FROM f))
        SELECT position, user_id AS query_id, CASE WHEN (position - 1) % 5 = 0 THEN event_id % 97 ELSE floor(value * 10)::BIGINT END AS passage_id, ((position - 1) % 5 = 0)::BIGINT AS label FROM r"""),
    "n09_holdout_queries": (n09, """
        WITH t AS (SELECT event_id AS line, user_id AS q, event_id % 97 AS p, floor(value * 10)::BIGINT AS n FROM events), f AS (SELECT q FROM t GROUP BY q ORDER BY min(line) LIMIT 20),
        g AS (SELECT q, n, row_number() OVER (PARTITION BY q ORDER BY min(line), n) AS r FROM t WHERE q IN (FROM f) GROUP BY q, n)
        SELECT DISTINCT q AS query_id, p AS passage_id, 'dev_pos' AS part FROM t WHERE q IN (FROM f) UNION ALL SELECT q, n, 'dev_neg' FROM g WHERE r <= 15 UNION ALL SELECT q, n, 'train' FROM t WHERE q NOT IN (FROM f)"""),
    "n10_silver_pairs": (n10, f"""
        WITH {SQL_EMB}, {GOLD}, s AS (SELECT a.vec_id AS q, b.vec_id AS c, {COS} AS score FROM e a, e b WHERE a.vec_id <> b.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, c) AS rank FROM s),
        {sql_bm25('benchmark', 'item_id', True)}
        SELECT 'dense' AS retriever, q AS id1, c AS id2, round(score, 6) AS score FROM r WHERE rank <= 3 AND NOT EXISTS (SELECT 1 FROM g WHERE (id1 = q AND id2 = c) OR (id1 = c AND id2 = q))
        UNION ALL SELECT 'bm25', query_id, corpus_id, round(score, 6) FROM bm WHERE rank <= 3 AND abs(query_id - corpus_id) <> 1"""),
    "n11_cross_domain_labels": (n11, f"""
        WITH x AS (SELECT a.conv_id * 1000 + a.turn AS id, 1 / (1 + exp(-(len({sql_words('a.text')}) - len({sql_words('b.text')})) / 10.0::DOUBLE)) AS s FROM conversations a JOIN conversations b ON a.conv_id * 1000 + a.turn + 1 = b.conv_id * 1000 + b.turn)
        SELECT id, round(s, 6) AS score, (s >= 0.5)::BIGINT AS label FROM x"""),
    "n12_duplicate_split": (n12, f"WITH RECURSIVE {COMP} SELECT node, component, split FROM sp WHERE node IN (SELECT node FROM cc)"),
    "n13_task_files": (n13, f"""
        WITH RECURSIVE {COMP}, pe AS (SELECT DISTINCT a AS id1, b AS id2 FROM pr WHERE a <> b),
        q AS (SELECT component, any_value(split) AS split, arg_min(node, {{'h': {sql_hash('node')}, 'n': node}}) AS id, count(*) AS n FROM sp GROUP BY 1 HAVING count(*) > 1),
        qq AS (SELECT * FROM q WHERE split <> 'train'),
        t AS (SELECT 'classification' AS task, x.split, pe.id1 AS id FROM pe JOIN sp x ON x.node = id1 JOIN sp y ON y.node = id2 AND y.split = x.split
              UNION ALL SELECT 'mining_corpus', split, node FROM sp UNION ALL SELECT 'mining_gold', sp.split, node FROM sp JOIN q USING (component)
              UNION ALL SELECT 'retrieval_queries', split, id FROM qq UNION ALL SELECT 'retrieval_relevant', qq.split, node FROM qq JOIN sp USING (component) WHERE node <> id
              UNION ALL SELECT 'retrieval_corpus', 'all', node FROM sp WHERE node NOT IN (SELECT id FROM qq))
        SELECT task, split, count(*) AS n, sum(id)::BIGINT AS ids FROM t GROUP BY 1, 2"""),
    "n14_retrieval_subcorpus": (n14, f"""
        WITH nd AS (SELECT doc_id AS id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)),
        ot AS (SELECT doc_id AS id, lang, row_number() OVER (ORDER BY {sql_hash('doc_id')}, doc_id) AS n FROM documents WHERE doc_id NOT IN (SELECT id FROM nd))
        SELECT id, lang FROM nd UNION ALL SELECT id, lang FROM ot WHERE n <= 300 - (SELECT count(*) FROM nd)"""),
    "n15_parallel_wide": (n15, f"""
        WITH {SQL_WIDE},
        l AS (SELECT 'de' AS lang, g, en AS s, de AS t FROM w UNION ALL SELECT 'fr', g, en, fr FROM w UNION ALL SELECT 'es', g, en, es FROM w),
        x AS (SELECT lang, g, trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s, trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM l WHERE trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' AND trim(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '')
        SELECT lang, g, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY g) <= 10 THEN 'dev' ELSE 'train' END AS split, md5(s) AS src, md5(t) AS trg FROM x"""),
    "n16_parallel_links": (n16, """
        WITH l AS (SELECT a.lang AS sl, b.lang AS tl, a.doc_id, a.text AS s, b.text AS t FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 WHERE a.lang = 'en' AND b.lang IN ('de', 'fr', 'es')),
        f AS (SELECT sl, tl, s, row_number() OVER (PARTITION BY sl, tl ORDER BY min(doc_id)) AS n FROM l GROUP BY sl, tl, s)
        SELECT sl AS src_lang, tl AS trg_lang, CASE WHEN n <= 20 THEN 'dev' ELSE 'train' END AS split, md5(s) AS src, md5(t) AS trg FROM l JOIN f USING (sl, tl, s)"""),
    "n17_parallel_scored": (n17, """
        WITH d AS (SELECT doc_id AS o, 1.0 + (n_chars % 100) / 500.0 AS score, source || '-' || (doc_id % 7) AS t, lang || '-' || (doc_id % 50) AS s FROM documents),
        c AS (SELECT * FROM d WHERE score >= 1.075 AND s <> t),
        w AS (SELECT list_reduce(list({'o': o, 's': s, 't': t, 'dev': []::BIGINT[], 'used': []::VARCHAR[]} ORDER BY o),
                lambda a, x: CASE WHEN len(a.dev) = 5 OR list_has_any(a.used, [x.s, x.t]) THEN a
                             ELSE {'o': NULL::BIGINT, 's': NULL::VARCHAR, 't': NULL::VARCHAR, 'dev': list_append(a.dev, x.o), 'used': list_concat(a.used, [x.s, x.t])} END,
                {'o': NULL::BIGINT, 's': NULL::VARCHAR, 't': NULL::VARCHAR, 'dev': []::BIGINT[], 'used': []::VARCHAR[]}) AS r FROM c)
        SELECT o AS "order", s AS src_text, t AS trg_text, CASE WHEN list_contains(r.dev, o) THEN 'dev' ELSE 'train' END AS split
        FROM c, w WHERE list_contains(r.dev, o) OR NOT list_has_any(r.used, [s, t])"""),
    "n18_translation_groups": (n18, "SELECT DISTINCT source, unnest([source, lang, source || '/' || lang]) AS sentence FROM documents"),
    "n19_no_duplicate_batches": (n19, f"""
        WITH {_most_batches(f"SELECT 'all' AS source, lower(trim(text, {_BLANKS})) AS k FROM conversations", 16)}
        SELECT unnest(range(0, b)) AS batch, 16::BIGINT AS n, 16::BIGINT AS texts FROM bt"""),
    "n20_label_batches": (n20, f"""
        WITH p AS (SELECT doc_id AS id, source AS label, row_number() OVER (PARTITION BY source ORDER BY {sql_hash('doc_id')}, doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM documents)
        SELECT id, label, pos // 4 AS draw, pos % 4 AS slot, lpad((pos // 4)::VARCHAR, 12, '0') || ':' || md5('1:' || label || ':' || (pos // 4)) AS order_key FROM p WHERE (pos // 4 + 1) * 4 <= n"""),
    "n20_label_batches_replacement": (n20_replace, f"""
        WITH p AS (SELECT doc_id AS id, source AS label, row_number() OVER (PARTITION BY source ORDER BY {sql_hash('doc_id')}, doc_id) AS pos, count(*) OVER (PARTITION BY source) AS rows FROM documents),
        l AS (SELECT label, rows, row_number() OVER (ORDER BY {sql_hash('label', 3)}, label) - 1 AS turn, count(*) OVER () AS labels, sum(rows) OVER () AS total FROM (SELECT DISTINCT label, rows FROM p WHERE rows >= 4)),
        d AS (SELECT label, rows, t // labels AS draw FROM (SELECT *, unnest(range(0, ((total + 3) // 4)::BIGINT)) AS t FROM l) WHERE t % labels = turn),
        x AS (SELECT label, draw, slot, ({sql_hash_int("(label || ':' || draw)", 2)} + slot) % rows + 1 AS pos FROM d, range(4) s(slot))
        SELECT id, label, draw, slot, lpad(draw::VARCHAR, 12, '0') || ':' || md5('1:' || label || ':' || draw) AS order_key FROM x JOIN p USING (label, pos)"""),
    "n21_contrastive_pairs": (n21, f"""
        WITH p AS (SELECT doc_id AS id, row_number() OVER (ORDER BY {sql_hash('doc_id')}, doc_id) - 1 AS i, count(*) OVER () AS n FROM documents),
        x AS (SELECT a.i // 15 * 8 + (a.i % 15 + 1) // 2 AS pair, a.id AS a, CASE WHEN a.i % 15 = 0 THEN a.id ELSE b.id END AS b, (a.i % 15 = 0)::BIGINT AS label FROM p a JOIN p b ON b.i = a.i + 1 WHERE a.i % 15 = 0 OR (a.i % 15) % 2 = 1)
        SELECT pair, a, b, label FROM x"""),
    "n22_multi_dataset_batches": (n22, f"""
        WITH {_most_batches(f"SELECT lang AS source, lower(trim(text, {_BLANKS})) AS k FROM documents WHERE lang IN ('en', 'de', 'fr')", 8)}
        SELECT source AS dataset, (8 * b)::BIGINT AS rows, b::BIGINT AS batches, (sum(total) OVER () // 8)::BIGINT AS steps, (sum(total) OVER () // 8)::BIGINT AS different, 0::BIGINT AS wrong_steps FROM bt"""),
    "n23_identity_pairs": (n23, "SELECT doc_id AS id, md5(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS a, md5(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) AS b FROM documents WHERE length(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) >= 50"),
    "n24_denoise_pairs": (n24, f"""
        WITH t AS (SELECT conv_id * 1000 + turn AS id, text, {sql_words('text')} AS w FROM conversations),
        x AS (SELECT id, i, w[i + 1] AS word, {_DRAW.format(i='i')} AS h FROM t, LATERAL (SELECT unnest(range(len(w))) AS i)),
        k AS (SELECT id, string_agg(word, ' ' ORDER BY i) FILTER (WHERE h % 1000 >= 600) AS kept, arg_min(word, h * 100000 + i) AS lone FROM x GROUP BY id)
        SELECT t.id, coalesce(kept, lone, '') AS noised, text AS original FROM t LEFT JOIN k USING (id)"""),
    "n25_sentence_pool": (n25, f"""
        WITH s AS (SELECT p_name AS sentence FROM part UNION SELECT p_type FROM part UNION SELECT p_brand FROM part)
        SELECT sentence, CASE WHEN row_number() OVER (ORDER BY {sql_hash('sentence')}) <= 20 THEN 'dev' ELSE 'train' END AS split FROM s"""),
}

QUERIES["n12_duplicate_split_rounds"] = (n12_rounds, QUERIES["n12_duplicate_split"][1])
