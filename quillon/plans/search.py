"""Search, mining, clustering and model application (J, C06, C07)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..operators import graph as G
from ..operators import lexical as L
from ..operators import pivots as P
from ..operators import probing as PR
from ..operators import search as S
from ..session import cut_lineage
from .common import SQL_EMB, embeddings, r6, table
from .text import STOP, docs, sql_tokens, sql_words, turns


def semantic_search(spark, sf):
    emb = embeddings(spark, sf)
    return S.semantic_search(emb, emb, k=10, exclude_self=True).select("query_id", "corpus_id", "rank", r6("score", "score"))


def semantic_search_dot(spark, sf):
    emb = embeddings(spark, sf)
    hits = S.top_k(S.block_search(emb, emb, 5, "dot", exclude_self=True), "query_id", "score", "corpus_id", 5)
    return hits.select("query_id", "corpus_id", "rank", r6("score", "score"))


def paraphrase_mining(spark, sf):
    pairs = S.paraphrase_mining(embeddings(spark, sf), k=5, max_pairs=None)
    return pairs.select(r6("score", "score"), "id1", "id2")


def near_duplicates(spark, sf):
    pairs = S.paraphrase_mining(embeddings(spark, sf), k=3)
    return S.near_duplicates(pairs, below=0.5).select(r6("score", "score"), "id1", "id2")


def label_centres(spark, sf):
    return S.centroids(embeddings(spark, sf), "label")


def score_matrix(spark, sf):
    return S.score_matrix(label_centres(spark, sf), embeddings(spark, sf)).select("left_id", "right_id", r6("score", "score"))


def distance_matrix(spark, sf):
    return S.distance_matrix(label_centres(spark, sf), embeddings(spark, sf)).select("left_id", "right_id", r6("distance", "distance"))


def theta_join(spark, sf):
    return S.score_matrix(label_centres(spark, sf), embeddings(spark, sf), "dot").where("score > 0.02").select(
        F.col("left_id").alias("label"), F.col("right_id").alias("id"), r6("score", "score"))


def similarity_join(spark, sf):
    return S.similarity_join(embeddings(spark, sf), 0.4).select("id1", "id2", r6("score", "score"))


def similarity_join_pivots(spark, sf):
    return P.pivot_join(embeddings(spark, sf), 0.4)[0].select("id1", "id2", r6("score", "score"))


def clustered(spark, sf):
    """Every vector drawn towards one of fifty rows: fifty clusters narrower than the angle of 0.9."""
    emb = embeddings(spark, sf).select("id", "embedding")
    centres = emb.where("id < 50").select(F.col("id").alias("centre"), F.col("embedding").alias("c"))
    both = emb.withColumn("centre", F.col("id") % 50).join(F.broadcast(centres), "centre")
    return both.select("id", F.zip_with("c", "embedding", lambda c, v: 4 * c.cast("double") + v.cast("double")).alias("embedding"))


def pivot_join_clusters(spark, sf):
    return P.pivot_join(clustered(spark, sf), 0.9)[0].select("id1", "id2", r6("score", "score"))


def pivot_join_share(spark, sf):
    """Rows, pairs, and whether under a tenth of all pairs of rows were compared for them."""
    return P.compared_share(clustered(spark, sf), 0.9).select("n_rows", "n_pairs", (F.col("share") < 0.1).alias("under_a_tenth"))


def paraphrase_mining_candidates(spark, sf):
    emb = embeddings(spark, sf)
    pairs = S.paraphrase_mining(emb, hits=S.ivf_search(emb, emb, 6, 6, 6, seed=1))
    # A row's own hit is one of its six; another row with the same vector may push it out.
    return pairs.select(r6("score", "score"), "id1", "id2")


def community_detection(spark, sf):
    return G.community_detection(embeddings(spark, sf), 0.35, 5).select(
        "community_id", "member_id", "is_center", r6("score", "score"))


def kmeans(spark, sf):
    """Rows, clusters, rows at their nearest centre, and whether the rows lie closer to the centres than to the mean."""
    emb = embeddings(spark, sf).select("id", "embedding")
    out, model = S.kmeans(emb, 10, seed=1)
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "cluster int, centre array<double>")
    near = emb.crossJoin(F.broadcast(centres)).withColumn("d", V.euclidean("embedding", "centre"))  # ten centres
    near = near.groupBy("id").agg(F.min("d").alias("least"), F.map_from_entries(F.collect_list(F.struct("cluster", "d"))).alias("all"))
    own = out.join(near, "id").select("cluster", "least", F.element_at("all", F.col("cluster")).alias("d"))
    mean = S.centroids(emb.withColumn("one", F.lit(0)), "one").select(F.col("embedding").alias("mean"))
    total = emb.crossJoin(F.broadcast(mean)).agg(F.sum(V.euclidean("embedding", "mean") ** 2).alias("total"))
    some = own.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("cluster").alias("clusters"),
                   F.sum((F.col("d") <= F.col("least") + 1e-9).cast("bigint")).alias("nearest"), F.sum(F.col("d") ** 2).alias("within"))
    return some.crossJoin(total).select("n_rows", "clusters", "nearest", (F.col("within") < F.col("total")).alias("closer"))


def _ann(hits, emb):
    """Per query: whether its hits carry the exact cosine, the best hit, and whether the recall of all queries is 0.9 or more."""
    hits = cut_lineage(hits)
    side = lambda c, v: emb.select(F.col("id").alias(c), F.col("embedding").alias(v))
    both = hits.join(side("query_id", "a"), "query_id").join(side("corpus_id", "b"), "corpus_id")
    exact = F.abs(V.cosine("a", "b") - F.col("score")) < 1e-6
    per = both.groupBy("query_id").agg(F.bool_and(exact).alias("exact"), F.min_by("corpus_id", "rank").alias("best_id"), F.max("score").alias("top"))
    report, _ = S.ann_recall(hits, S.semantic_search(emb, emb, 10))
    recall = report.agg((F.sum("hits") / F.sum("expected")).alias("recall"))
    return per.crossJoin(F.broadcast(recall)).select("query_id", "exact", "best_id", r6("top", "top"), (F.col("recall") >= 0.9).alias("found"))


def threshold_clusters(spark, sf):
    return G.threshold_clusters(embeddings(spark, sf), 1.05)


def ivf(spark, sf):
    emb = embeddings(spark, sf)
    return _ann(S.ivf_search(emb, emb, 10, 8, 10, seed=1), emb)


def ivf_all(spark, sf):
    """With every list probed the search is exact."""
    emb = embeddings(spark, sf)
    return S.ivf_search(emb, emb, 6, 6, 10, seed=1, chunk_rows=300).select("query_id", "corpus_id", "rank", r6("score", "score"))


def lsh(spark, sf):
    emb = embeddings(spark, sf)
    return _ann(S.lsh_search(emb, emb, 10, tables=24, bits=4), emb)


def multiprobe(spark, sf):
    """Search that visits eight buckets of two tables, and whether it compared under a tenth of all pairs."""
    emb = clustered(spark, sf)
    hits, compared = PR.multiprobe_search(emb, emb, 10, tables=2, probes=8, bucket_rows=2, seed=1)
    return _ann(hits, emb).withColumn("under_a_tenth", F.lit(PR.compared_share(emb, emb, compared) < 0.1))


def multiprobe_all(spark, sf):
    """With every bucket of one table allowed the search ends by its bound, and is exact."""
    emb = embeddings(spark, sf)
    return PR.multiprobe_search(emb, emb, 10, tables=1, bits=5, probes=32, seed=1)[0].select("query_id", "corpus_id", "rank", r6("score", "score"))


def ann_recall(spark, sf):
    """Search in two steps of different depth: how much of the exact top 10 the top 5 of the other score holds."""
    emb = embeddings(spark, sf)
    exact = S.semantic_search(emb, emb, 10, "cos", True)
    other = S.semantic_search(emb, emb, 5, "dot", True)
    report, _ = S.ann_recall(other, exact)
    return report.select("query_id", "hits", "expected", r6("recall", "recall"))


def ann_recall_ivf(spark, sf):
    """An approximate search against the exact one; with every list probed nothing is missed."""
    emb = embeddings(spark, sf)
    report, missed = S.ann_recall(S.ivf_search(emb, emb, 6, 6, 10, seed=1), S.semantic_search(emb, emb, 10))
    return report.join(missed.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")), "query_id", "left").select(
        "query_id", "hits", "expected", r6("recall", "recall"), F.coalesce("n", F.lit(0)).alias("missed"))


def benchmark(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text")


def bm25(spark, sf):
    return L.bm25_search(benchmark(spark, sf), docs(spark, sf), 10, stop=STOP).select("query_id", "corpus_id", "rank", r6("score", "score"))


def overlap_score():
    """Share of the distinct query tokens that the passage holds."""
    q, d = F.array_distinct(X.search_tokens("query_text", STOP)), X.search_tokens("corpus_text", STOP)
    return F.try_divide(F.size(F.array_intersect(q, d)), F.size(q))


def rerank(spark, sf):
    hits = L.bm25_search(benchmark(spark, sf), docs(spark, sf), 20, stop=STOP)
    hits = hits.join(benchmark(spark, sf).select(F.col("id").alias("query_id"), F.col("text").alias("query_text")), "query_id")
    hits = hits.join(docs(spark, sf).select(F.col("id").alias("corpus_id"), F.col("text").alias("corpus_text")), "corpus_id")
    return S.rerank(hits, overlap_score(), 5).select("query_id", "corpus_id", "rerank_rank", r6("rerank_score", "rerank_score"))


DIMS = 16


def hashed_counts():
    """Stand-in encoder: counts of words by word length."""
    def encode(texts):
        out = np.zeros((len(texts), DIMS))
        for i, t in enumerate(texts):
            for w in t.split():
                out[i, len(w) % DIMS] += 1
        return out
    return encode


def encode(spark, sf):
    e = S.encode(docs(spark, sf).select("id", "text"), "text", hashed_counts, 32, normalize=True)
    return e.select("id", *[r6(F.get("embedding", F.lit(i)), f"x{i}") for i in range(DIMS)])


def word_lengths():
    """Stand-in token encoder: one two-dimensional vector per word."""
    return lambda texts: [np.array([[len(w), i] for i, w in enumerate(t.split())]).reshape(-1, 2) for t in texts]


def encode_tokens(spark, sf):
    t = S.encode_tokens(turns(spark, sf), "id", "text", word_lengths, 8)
    return t.groupBy("id").agg(F.count(F.lit(1)).alias("tokens"), F.sum(F.get("vector", F.lit(0))).alias("chars"))


def length_gap():
    """Stand-in pair scorer: difference of the word counts, scaled."""
    return lambda a, b: np.array([(len(x.split()) - len(y.split())) / 10.0 for x, y in zip(a, b)])


def turn_pairs(spark, sf):
    t = turns(spark, sf)
    nxt = t.select((F.col("id") - 1).alias("id"), F.col("text").alias("reply"), F.col("role").alias("reply_role"))
    return t.join(nxt, "id").select("id", "role", "reply_role", "text", "reply")


def predict_pairs(spark, sf):
    return S.predict_pairs(turn_pairs(spark, sf), "text", "reply", length_gap).select("id", r6("score", "score"))


def hybrid(spark, sf):
    """Lexical and dense lists side by side, the dense score shifted by one."""
    q, d = benchmark(spark, sf), docs(spark, sf).select("id", "text")
    lexical = L.bm25_search(q, d, 5, stop=STOP).withColumn("system", F.lit("bm25"))
    dense = S.semantic_search(S.encode(q, "text", hashed_counts), S.encode(d, "text", hashed_counts), 5)
    dense = dense.withColumn("score", F.col("score") + 1.0).withColumn("system", F.lit("dense"))
    return lexical.unionByName(dense).select("system", "query_id", "corpus_id", "rank", r6("score", "score"))


def zero_shot(spark, sf):
    return S.zero_shot_classify(embeddings(spark, sf), label_centres(spark, sf)).select("id", "label", r6("score", "score"))


def sides(spark, sf):
    emb = embeddings(spark, sf)
    return emb.where("label < 5"), emb.where("label >= 5")


def margin_bitext(spark, sf):
    return G.margin_bitext(*sides(spark, sf), k=4, min_score=1.0).select("src", "trg", r6("score", "score"))


def margin_candidates(spark, sf):
    return G.margin_candidates(*sides(spark, sf), k=4).select("src", "trg", r6("score", "score"))


def lexrank(spark, sf):
    return G.lexrank(embeddings(spark, sf), "label", "id", top=5).select("label", "id", "rank", r6("score", "score"))


def lexrank_threshold(spark, sf):
    return G.lexrank(embeddings(spark, sf), "label", "id", threshold=0.15, top=None).select("label", "id", r6("score", "score"))


def copy_pairs(spark, sf):
    """Documents linked to the first one with the same text, and to the first of their source with the same length."""
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("digest"), "source", "n_chars")
    one = d.groupBy("digest").agg(F.min("doc_id").alias("id1")).join(d, "digest").select("id1", F.col("doc_id").alias("id2"))
    two = d.groupBy("source", "n_chars").agg(F.min("doc_id").alias("id1")).join(d, ["source", "n_chars"]).select("id1", F.col("doc_id").alias("id2"))
    return one.unionByName(two).where("id1 <> id2")


def closure(spark, sf):
    return G.transitive_closure(copy_pairs(spark, sf))


def closure_pairs(spark, sf):
    return G.closure_pairs(copy_pairs(spark, sf))


def connected_nodes(spark, sf):
    return G.connected_nodes(copy_pairs(spark, sf))


COS = "round(list_cosine_similarity(a.v, b.v), 9)"
SQL_SEARCH = f"""
WITH {SQL_EMB},
s AS (SELECT a.vec_id AS query_id, b.vec_id AS corpus_id, {{score}} AS score FROM e a, e b WHERE a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id) AS rank FROM s)
SELECT query_id, corpus_id, rank, round(score, 6) AS score FROM r WHERE rank <= {{k}}"""
SQL_MINING = f"""
WITH {SQL_EMB},
s AS (SELECT a.vec_id AS q, b.vec_id AS c, {COS} AS score FROM e a, e b WHERE a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, c) AS rank FROM s),
p AS (SELECT max(score) AS score, least(q, c) AS id1, greatest(q, c) AS id2 FROM r WHERE rank <= {{k}} AND score > -1 GROUP BY 2, 3)
SELECT round(score, 6) AS score, id1, id2 FROM {{tail}}"""
CENTRES = "c AS (SELECT label::BIGINT AS id, list(m ORDER BY dim) AS v FROM (SELECT label, dim, avg(v[dim]) AS m FROM e, (SELECT unnest(range(1, 65)) AS dim) GROUP BY 1, 2) GROUP BY 1)"
_STOPS = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"


def sql_bm25(corpus: str = "documents", key: str = "doc_id", others_only: bool = False) -> str:
    """CTEs that end in ``bm(query_id, corpus_id, score, rank)``: the benchmark items against a corpus table."""
    toks = sql_tokens("text", _STOPS)
    return f"""
bq AS (SELECT item_id AS query_id, unnest({toks}) AS token FROM benchmark),
bt AS (SELECT query_id, token, count(*) AS qtf FROM bq GROUP BY 1, 2),
bd AS (SELECT {key} AS doc_id, {toks} AS toks FROM {corpus}),
bn AS (SELECT count(*) AS n, avg(len(toks)) AS avgdl FROM bd),
bp AS (SELECT doc_id, dl, token, count(*) AS tf FROM (SELECT doc_id, len(toks) AS dl, unnest(toks) AS token FROM bd) GROUP BY 1, 2, 3),
bf AS (SELECT token, count(*) AS df FROM bp GROUP BY 1),
bs AS (SELECT query_id, doc_id AS corpus_id, round(sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 9) AS score
       FROM bp JOIN bt USING (token) JOIN bf USING (token), bn {"WHERE query_id <> doc_id" if others_only else ""} GROUP BY 1, 2),
bm AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id) AS rank FROM bs)"""


SQL_BM25 = sql_bm25()


def _enc(source: str, id: str) -> str:
    counts = ", ".join(f"len(list_filter(w, lambda x: length(x) % {DIMS} = {i}))::DOUBLE" for i in range(DIMS))
    return f"SELECT {id} AS id, [{counts}] AS v FROM (SELECT {id}, {sql_words('text')} AS w FROM {source})"


EDGES = """
d AS (SELECT doc_id, md5(text) AS g, source, n_chars FROM documents),
pr AS (SELECT min(doc_id) OVER (PARTITION BY g) AS a, doc_id AS b FROM d UNION SELECT min(doc_id) OVER (PARTITION BY source, n_chars), doc_id FROM d),
ed AS (SELECT a, b FROM pr WHERE a <> b UNION SELECT b, a FROM pr WHERE a <> b),
reach AS (SELECT a AS node, a AS root FROM ed UNION SELECT ed.b, reach.root FROM reach JOIN ed ON ed.a = reach.node),
cc AS (SELECT node, min(root) AS component FROM reach GROUP BY 1)"""
MARGIN = f"""
s AS (SELECT a.vec_id AS src, b.vec_id AS trg, {COS} AS cos FROM e a, e b WHERE a.label < 5 AND b.label >= 5),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY cos DESC, trg) AS r FROM s) WHERE r <= 4),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY trg ORDER BY cos DESC, src) AS r FROM s) WHERE r <= 4),
fm AS (SELECT src, avg(cos) AS fm FROM f GROUP BY 1), bm AS (SELECT trg, avg(cos) AS bm FROM g GROUP BY 1),
fs AS (SELECT f.src, f.trg, round(cos / ((fm + bm) / 2), 9) AS score FROM f JOIN fm USING (src) JOIN bm USING (trg)),
gs AS (SELECT g.src, g.trg, round(cos / ((fm + bm) / 2), 9) AS score FROM g JOIN fm USING (src) JOIN bm USING (trg)),
u AS (SELECT src, trg, score FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY score DESC, trg) AS r FROM fs) WHERE r = 1
      UNION SELECT src, trg, score FROM (SELECT *, row_number() OVER (PARTITION BY trg ORDER BY score DESC, src) AS r FROM gs) WHERE r = 1)"""

# Greedy rules as a fold over the ordered candidates.
SQL_COMMUNITIES = f"""
WITH {SQL_EMB}, n AS (SELECT a.vec_id AS c, b.vec_id AS m, {COS} AS score FROM e a, e b WHERE {COS} >= 0.35),
g AS (SELECT c, list(m) AS m, count(*) AS size FROM n GROUP BY c HAVING count(*) >= 5),
w AS (SELECT unnest(list_reduce(list({{'c': c, 'm': m, 'used': []::BIGINT[], 'won': []::BIGINT[]}} ORDER BY size DESC, c),
        lambda a, x: CASE WHEN list_has_any(a.used, x.m) THEN a ELSE {{'c': NULL::BIGINT, 'm': NULL::BIGINT[], 'used': list_concat(a.used, x.m), 'won': list_append(a.won, x.c)}} END,
        {{'c': NULL::BIGINT, 'm': NULL::BIGINT[], 'used': []::BIGINT[], 'won': []::BIGINT[]}}).won) AS c FROM g)
SELECT c AS community_id, m AS member_id, c = m AS is_center, round(score, 6) AS score FROM w JOIN n USING (c)"""
SQL_BITEXT = f"""
WITH {SQL_EMB}, {MARGIN},
w AS (SELECT list_reduce(list({{'s': src, 't': trg, 'us': []::BIGINT[], 'ut': []::BIGINT[]}} ORDER BY score DESC, src, trg),
        lambda a, x: CASE WHEN list_contains(a.us, x.s) OR list_contains(a.ut, x.t) THEN a ELSE {{'s': NULL::BIGINT, 't': NULL::BIGINT, 'us': list_append(a.us, x.s), 'ut': list_append(a.ut, x.t)}} END,
        {{'s': NULL::BIGINT, 't': NULL::BIGINT, 'us': []::BIGINT[], 'ut': []::BIGINT[]}}) AS r FROM u WHERE score >= 1.0)
SELECT src, trg, round(score, 6) AS score FROM (SELECT unnest(r.us) AS src, unnest(r.ut) AS trg FROM w) JOIN u USING (src, trg)"""



def _rounds(name):
    """The same operators without their driver-side endings: every round runs on the executors."""
    def query(spark, sf):
        if name == "j04":
            return G.community_detection(embeddings(spark, sf), 0.35, 5, edge_limit=0).select("community_id", "member_id", "is_center", r6("score", "score"))
        if name == "j06":
            return G.threshold_clusters(embeddings(spark, sf), 1.05, small=0)
        if name == "j10":
            return L.bm25_search(benchmark(spark, sf), docs(spark, sf), 10, stop=STOP, broadcast_terms=0).select("query_id", "corpus_id", "rank", r6("score", "score"))
        if name == "j14":
            return G.margin_bitext(*sides(spark, sf), k=4, min_score=1.0, small=0).select("src", "trg", r6("score", "score"))
        if name == "j16":
            return G.transitive_closure(copy_pairs(spark, sf), small=0)
        return G.connected_nodes(copy_pairs(spark, sf), small=0)
    return query


# A row's best hit is the row itself, or the first with the same vector.
SQL_ANN = "SELECT vec_id AS query_id, true AS exact, min(vec_id) OVER (PARTITION BY embedding) AS best_id, 1.0::DOUBLE AS top, true AS found FROM embeddings"

QUERIES = {
    "c06_theta_join": (theta_join, f"WITH {SQL_EMB}, {CENTRES} SELECT c.id AS label, e.vec_id AS id, round(list_inner_product(c.v, e.v), 6) AS score FROM c, e WHERE round(list_inner_product(c.v, e.v), 9) > 0.02"),
    "c07_similarity_join": (similarity_join, f"WITH {SQL_EMB} SELECT a.vec_id AS id1, b.vec_id AS id2, round({COS}, 6) AS score FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE {COS} >= 0.4"),
    "i05_score_matrix": (score_matrix, f"WITH {SQL_EMB}, {CENTRES} SELECT a.id AS left_id, b.vec_id AS right_id, round({COS}, 6) AS score FROM c a, e b"),
    "i06_distance_matrix": (distance_matrix, f"WITH {SQL_EMB}, {CENTRES} SELECT a.id AS left_id, b.vec_id AS right_id, round(list_distance(a.v, b.v), 6) AS distance FROM c a, e b"),
    "j01_semantic_search": (semantic_search, SQL_SEARCH.format(score=COS, k=10)),
    "j01_semantic_search_blocks": (semantic_search_dot, SQL_SEARCH.format(score="round(list_inner_product(a.v, b.v), 9)", k=5)),
    "j02_paraphrase_mining": (paraphrase_mining, SQL_MINING.format(k=5, tail="p")),
    "j03_near_duplicates": (near_duplicates, SQL_MINING.format(k=3, tail="(SELECT * FROM p ORDER BY score DESC, id1, id2 LIMIT 20000) WHERE score < 0.5")),
    "j04_community_detection": (community_detection, SQL_COMMUNITIES),
    "j05_kmeans": (kmeans, "SELECT count(*) AS n_rows, 10::BIGINT AS clusters, count(*) AS nearest, true AS closer FROM embeddings"),
    "j06_threshold_clusters": (threshold_clusters, f"""
        WITH RECURSIVE {SQL_EMB},
        ed AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a, e b WHERE a.vec_id <> b.vec_id AND {COS} >= 1 - 1.05 * 1.05 / 2),
        reach AS (SELECT vec_id AS node, vec_id AS root FROM e UNION SELECT ed.b, reach.root FROM reach JOIN ed ON ed.a = reach.node)
        SELECT node AS id, min(root) AS cluster FROM reach GROUP BY 1"""),
    "j07_ivf_search": (ivf, SQL_ANN),
    "j07_ivf_all_probes": (ivf_all, SQL_SEARCH.format(score=COS, k=10).replace(" WHERE a.vec_id <> b.vec_id", "")),
    "j08_lsh_search": (lsh, SQL_ANN),
    "j09_ann_recall_ivf": (ann_recall_ivf, "SELECT vec_id AS query_id, 10::BIGINT AS hits, 10::BIGINT AS expected, 1.0::DOUBLE AS recall, 0::BIGINT AS missed FROM embeddings"),
    "j09_ann_recall": (ann_recall, f"""
        WITH {SQL_EMB},
        s AS (SELECT a.vec_id AS q, b.vec_id AS c, {COS} AS x, round(list_inner_product(a.v, b.v), 9) AS y FROM e a, e b WHERE a.vec_id <> b.vec_id),
        r AS (SELECT q, row_number() OVER (PARTITION BY q ORDER BY x DESC, c) AS rx, row_number() OVER (PARTITION BY q ORDER BY y DESC, c) AS ry FROM s)
        SELECT q AS query_id, count(*) FILTER (WHERE ry <= 5) AS hits, count(*) AS expected, round(count(*) FILTER (WHERE ry <= 5) / count(*), 6) AS recall FROM r WHERE rx <= 10 GROUP BY 1"""),
    "j10_bm25_search": (bm25, f"WITH {SQL_BM25} SELECT query_id, corpus_id, rank, round(score, 6) AS score FROM bm WHERE rank <= 10"),
    "j11_rerank": (rerank, f"""
        WITH {SQL_BM25},
        x AS (SELECT query_id, corpus_id, list_distinct({sql_tokens('b.text', _STOPS)}) AS qt, {sql_tokens('d.text', _STOPS)} AS dt
              FROM bm JOIN benchmark b ON b.item_id = query_id JOIN documents d ON d.doc_id = corpus_id WHERE rank <= 20),
        y AS (SELECT query_id, corpus_id, round(len(list_filter(qt, lambda t: list_contains(dt, t))) / nullif(len(qt), 0), 9) AS sc FROM x),
        z AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sc DESC, corpus_id) AS rerank_rank FROM y)
        SELECT query_id, corpus_id, rerank_rank, round(sc, 6) AS rerank_score FROM z WHERE rerank_rank <= 5"""),
    "j12_hybrid_search": (hybrid, f"""
        WITH {SQL_BM25}, qe AS ({_enc('benchmark', 'item_id')}), de AS ({_enc('documents', 'doc_id')}),
        ds AS (SELECT a.id AS query_id, b.id AS corpus_id, round(CASE WHEN list_sum(a.v) = 0 OR list_sum(b.v) = 0 THEN 0 ELSE list_cosine_similarity(a.v, b.v) END, 9) AS score FROM qe a, de b),
        dr AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id) AS rank FROM ds)
        SELECT 'bm25' AS system, query_id, corpus_id, rank, round(score, 6) AS score FROM bm WHERE rank <= 5
        UNION ALL SELECT 'dense', query_id, corpus_id, rank, round(score + 1, 6) FROM dr WHERE rank <= 5"""),
    "j13_zero_shot": (zero_shot, f"WITH {SQL_EMB}, {CENTRES}, s AS (SELECT a.vec_id AS id, b.id AS label, {COS} AS score, row_number() OVER (PARTITION BY a.vec_id ORDER BY {COS} DESC, b.id) AS r FROM e a, c b) SELECT id, label, round(score, 6) AS score FROM s WHERE r = 1"),
    "j14_margin_bitext": (margin_bitext, SQL_BITEXT),
    "j14_margin_candidates": (margin_candidates, f"WITH {SQL_EMB}, {MARGIN} SELECT src, trg, round(score, 6) AS score FROM u"),
    "j15_lexrank": (lexrank, f"""
        WITH {SQL_EMB}, d AS (SELECT a.label, a.vec_id AS id, sum(list_cosine_similarity(a.v, b.v)) AS deg FROM e a JOIN e b ON a.label = b.label GROUP BY 1, 2),
        s AS (SELECT label, id, round(deg * count(*) OVER w / sum(deg) OVER w, 9) AS score FROM d WINDOW w AS (PARTITION BY label)),
        r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, id) AS rank FROM s)
        SELECT label, id, rank, round(score, 6) AS score FROM r WHERE rank <= 5"""),
    "j15_lexrank_threshold": (lexrank_threshold, f"""
        WITH RECURSIVE {SQL_EMB}, ed AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label WHERE {COS} >= 0.15),
        reach AS (SELECT a AS node, a AS root FROM ed UNION SELECT ed.b, reach.root FROM reach JOIN ed ON ed.a = reach.node),
        cc AS (SELECT node, min(root) AS comp FROM reach GROUP BY 1),
        d AS (SELECT label, a AS id, comp, count(*) AS deg FROM ed JOIN cc ON node = a GROUP BY 1, 2, 3)
        SELECT label, id, round(deg * count(*) OVER w / sum(deg) OVER w, 6) AS score FROM d WINDOW w AS (PARTITION BY comp)"""),
    "j16_transitive_closure": (closure, f"WITH RECURSIVE {EDGES} SELECT node, component, count(*) OVER (PARTITION BY component) AS size FROM cc"),
    "j16_closure_pairs": (closure_pairs, f"WITH RECURSIVE {EDGES} SELECT x.node AS a, y.node AS b FROM cc x JOIN cc y ON x.component = y.component AND x.node < y.node"),
    "j17_connected_nodes": (connected_nodes, f"WITH RECURSIVE {EDGES} SELECT component, row_number() OVER (PARTITION BY component ORDER BY node) AS position, node FROM cc"),
    "j18_encode": (encode, f"WITH x AS ({_enc('documents', 'doc_id')}), n AS (SELECT id, v, greatest(sqrt(list_inner_product(v, v)), 1e-12) AS nn FROM x) SELECT id, " + ", ".join(f"round((v[{i + 1}] / nn)::FLOAT, 6)::DOUBLE AS x{i}" for i in range(DIMS)) + " FROM n"),
    "j19_encode_tokens": (encode_tokens, f"SELECT conv_id * 1000 + turn AS id, len(w)::BIGINT AS tokens, list_sum(list_transform(w, lambda x: length(x)))::DOUBLE AS chars FROM (SELECT *, {sql_words('text')} AS w FROM conversations) WHERE len(w) > 0"),
    "j20_predict_pairs": (predict_pairs, f"SELECT a.conv_id * 1000 + a.turn AS id, round(1 / (1 + exp(-(len({sql_words('a.text')}) - len({sql_words('b.text')})) / 10.0::DOUBLE)), 6) AS score FROM conversations a JOIN conversations b ON a.conv_id * 1000 + a.turn + 1 = b.conv_id * 1000 + b.turn"),
}

# The distributed halves return the same rows, so they share the SQL.
QUERIES |= {f"{name}_rounds": (_rounds(name[:3]), QUERIES[name][1]) for name in (
    "j04_community_detection", "j06_threshold_clusters", "j10_bm25_search", "j14_margin_bitext", "j16_transitive_closure", "j17_connected_nodes")}
SQL_CLUSTERS = """o AS (SELECT a.vec_id, a.label, list_transform(list_zip(c.embedding, a.embedding), lambda x: 4 * x[1]::DOUBLE + x[2]::DOUBLE) AS v
                       FROM embeddings a JOIN embeddings c ON c.vec_id = a.vec_id % 50),
                 e AS (SELECT vec_id, label, v FROM o)"""
QUERIES["c07_similarity_join_pivots"] = (similarity_join_pivots, QUERIES["c07_similarity_join"][1])
QUERIES["c07_pivot_join_clusters"] = (pivot_join_clusters, QUERIES["c07_similarity_join"][1].replace(SQL_EMB, SQL_CLUSTERS).replace(">= 0.4", ">= 0.9"))
QUERIES["c07_pivot_join_share"] = (pivot_join_share, f"""
    WITH {SQL_CLUSTERS}, p AS (SELECT count(*) AS n_pairs FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE {COS} >= 0.9)
    SELECT (SELECT count(*) FROM e) AS n_rows, n_pairs, true AS under_a_tenth FROM p""")
QUERIES["j02_mining_candidates"] = (paraphrase_mining_candidates, QUERIES["j02_paraphrase_mining"][1])
QUERIES["j08_multiprobe"] = (multiprobe, f"""
    WITH {SQL_CLUSTERS} SELECT vec_id AS query_id, true AS exact, min(vec_id) OVER (PARTITION BY v) AS best_id, 1.0::DOUBLE AS top, true AS found, true AS under_a_tenth FROM e""")
QUERIES["j08_multiprobe_all"] = (multiprobe_all, QUERIES["j07_ivf_all_probes"][1])
