"""Vector functions."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import features as H
from ..session import cut_lineage
from .common import SQL_EMB, embeddings, r6
from .evaluate import PAIRS, pairs


def i01(spark, sf):
    u = embeddings(spark, sf).select("id", V.l2_normalize("embedding").alias("u"))
    return u.select("id", r6(V.norm("u"), "norm"), r6(F.get("u", F.lit(0)), "first"), r6(F.element_at("u", -1), "last"), r6(V.vsum(F.col("u")), "total"))


def _pairwise(name):
    def query(spark, sf):
        return pairs(spark, sf).select("id", *[r6(f("a", "b"), n) for n, f in name.items()])
    return query


i02 = _pairwise({"dot": V.dot})
i03 = _pairwise({"cosine": V.cosine})
i04 = _pairwise({"euclidean": V.euclidean, "manhattan": V.manhattan})


def i09(spark, sf):
    layers = embeddings(spark, sf).select("id", F.array(*[F.slice("embedding", 1 + 8 * i, 8) for i in range(8)]).alias("layers"))
    out = layers.select("id", V.weighted_layers("layers", [1.0, 2.0, 3.0, 4.0], start=4).alias("v"))
    return out.select("id", *[r6(F.get("v", F.lit(i)), f"x{i}") for i in range(8)])


def i10(spark, sf):
    """On all axes a vector keeps its length (they are orthonormal) and the first eight axes hold the most variance of any."""
    emb = embeddings(spark, sf)
    dim = len(emb.head()["embedding"])
    out = cut_lineage(H.project(emb, H.fit_projection(emb, dim)).select("id", "embedding"))
    axes = out.select(F.posexplode("embedding").alias("axis", "x")).groupBy("axis").agg(F.var_samp("x").alias("v"))
    order = W.orderBy(F.col("axis"))  # one row per axis
    falls = axes.withColumn("next", F.lead("v").over(order)).agg(F.bool_and(F.col("next").isNull() | (F.col("v") >= F.col("next") - 1e-9)).alias("falls"), F.sum("v").alias("v"))
    few = H.project(emb, H.fit_projection(emb, 8)).select("id", F.size("embedding").cast("bigint").alias("width"))
    return out.select("id", r6(V.norm("embedding"), "norm")).join(few, "id").crossJoin(F.broadcast(falls)).select("id", "norm", "width", "falls", r6("v", "variance"))


def i11(spark, sf):
    f = pairs(spark, sf).select("id", V.pair_features("a", "b", mult=True).alias("f"))
    return f.select("id", F.size("f").cast("bigint").alias("width"), *[r6(V.vsum(F.slice("f", 1 + 64 * i, 64)), n) for i, n in enumerate(("a", "b", "diff", "prod"))])


QUERIES = {
    "i01_l2_normalize": (i01, f"WITH {SQL_EMB}, u AS (SELECT vec_id AS id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS u FROM e) SELECT id, round(sqrt(list_inner_product(u, u)), 6) AS norm, round(u[1], 6) AS first, round(u[64], 6) AS last, round(list_sum(u), 6) AS total FROM u"),
    "i02_dot": (i02, f"WITH {PAIRS} SELECT id, round(list_inner_product(av, bv), 6) AS dot FROM p"),
    "i03_cosine": (i03, f"WITH {PAIRS} SELECT id, round(list_cosine_similarity(av, bv), 6) AS cosine FROM p"),
    "i04_distances": (i04, f"WITH {PAIRS} SELECT id, round(list_distance(av, bv), 6) AS euclidean, round(list_sum(list_transform(list_zip(av, bv), lambda z: abs(z[1] - z[2]))), 6) AS manhattan FROM p"),
    "i09_weighted_layers": (i09, f"WITH {SQL_EMB} SELECT vec_id AS id, " + ", ".join(f"round((v[{33 + i}] + 2 * v[{41 + i}] + 3 * v[{49 + i}] + 4 * v[{57 + i}]) / 10, 6) AS x{i}" for i in range(8)) + " FROM e"),
    "i10_projection": (i10, f"""
        WITH {SQL_EMB}, x AS (SELECT generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e), t AS (SELECT sum(s) AS s FROM (SELECT var_samp(x) AS s FROM x GROUP BY i))
        SELECT vec_id AS id, round(sqrt(list_inner_product(v, v)), 6) AS norm, 8::BIGINT AS width, true AS falls, round(t.s, 6) AS variance FROM e, t"""),
    "i11_pair_features": (i11, f"WITH {PAIRS} SELECT id, 256::BIGINT AS width, round(list_sum(av), 6) AS a, round(list_sum(bv), 6) AS b, round(list_sum(list_transform(list_zip(av, bv), lambda z: abs(z[1] - z[2]))), 6) AS diff, round(list_inner_product(av, bv), 6) AS prod FROM p"),
}
