"""Spark ML features."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import IndexToString, OneHotEncoder, StandardScaler, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import features as H
from ..operators import selection as S
from .common import embeddings, r6, table
from .text import docs

NUM = ["l_quantity", "l_discount", "l_tax"]
KEY = ["l_orderkey", "l_linenumber", "l_partkey"]


def lines(spark, sf):
    return table(spark, sf, "lineitem")


def gaps(spark, sf):
    """lineitem with missing quantities, set by key."""
    return lines(spark, sf).withColumn("l_quantity", F.when(F.col("l_partkey") % 7 != 0, F.col("l_quantity")))


def h01(spark, sf):
    v = H.assemble(NUM).transform(lines(spark, sf)).withColumn("a", vector_to_array("features"))
    return v.select(*KEY, *[F.get("a", F.lit(i)).alias(f"x{i}") for i in range(3)])


def h02(spark, sf):
    b = H.bucketize("l_quantity", [-1.0, 5.0, 10.0, 15.0, 20.0, float("inf")], "bucket").transform(lines(spark, sf))
    return b.select(*KEY, F.col("bucket").cast("bigint").alias("bucket"))


def h03(spark, sf):
    v = H.assemble(NUM).transform(lines(spark, sf))
    v = Pipeline(stages=[StandardScaler(inputCol="features", outputCol="a"), StandardScaler(inputCol="features", outputCol="b", withMean=True, withStd=True)]).fit(v).transform(v)
    v = v.select(*KEY, vector_to_array("a").alias("a"), vector_to_array("b").alias("b"))
    return v.select(*KEY, *[r6(F.get("a", F.lit(i)), f"a{i}") for i in range(3)], *[r6(F.get("b", F.lit(i)), f"b{i}") for i in range(3)])


MEDIANS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def h04_exact(spark, sf):
    """Every third quantity is taken away and filled again; the sums tell the filled columns."""
    d = table(spark, sf, "lineitem").withColumn("l_quantity", F.when(F.col("l_orderkey") % 3 != 0, F.col("l_quantity")))
    return S.fill_medians(d, MEDIANS).groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), *[F.round(F.sum(c), 2).alias(f"sum_{c[2:]}") for c in MEDIANS], r6(F.min(F.when(F.col("l_orderkey") % 3 == 0, F.col("l_quantity"))), "median"))


def h04(spark, sf):
    d = gaps(spark, sf).select(*KEY, "l_quantity")
    model = H.median_imputer(["l_quantity"]).fit(d)
    fill = float(model.surrogateDF.head()["l_quantity"])
    out = model.transform(d).agg(F.count(F.lit(1)).alias("n_rows"), F.count("l_quantity").alias("n_filled"))
    q = F.col("l_quantity")
    share = d.where(q.isNotNull()).agg(F.avg(F.when(q < fill, 1.0).otherwise(0.0)).alias("below"), F.avg(F.when(q <= fill, 1.0).otherwise(0.0)).alias("upto"))
    out = out.withColumn("k", F.lit(1)).join(F.broadcast(share.withColumn("k", F.lit(1))), "k")
    return out.select("n_rows", "n_filled", ((F.col("below") <= 0.502) & (F.col("upto") >= 0.498)).alias("is_median"))


def indexed(spark, sf):
    d = table(spark, sf, "orders")
    return StringIndexer(inputCol="o_orderpriority", outputCol="idx").fit(d).transform(d)


def h05(spark, sf):
    return indexed(spark, sf).select("o_orderkey", F.col("idx").cast("bigint").alias("idx"))


def h06(spark, sf):
    return IndexToString(inputCol="idx", outputCol="back").transform(indexed(spark, sf)).select("o_orderkey", "o_orderpriority", "back")


def h07(spark, sf):
    d = indexed(spark, sf)
    hot = OneHotEncoder(inputCol="idx", outputCol="hot").fit(d).transform(d).withColumn("a", vector_to_array("hot"))
    return hot.select("o_orderkey", *[F.get("a", F.lit(i)).cast("bigint").alias(f"h{i}") for i in range(4)])


def h08(spark, sf):
    d = H.hashed_text_pipeline("text").fit(docs(spark, sf)).transform(docs(spark, sf))
    a = vector_to_array("features")
    return d.select("id", F.size("tokens").cast("bigint").alias("tokens"), F.aggregate(a, F.lit(0.0), lambda s, x: s + x).cast("bigint").alias("mass"))


def h09(spark, sf):
    d = docs(spark, sf).select("id", X.words(F.lower("text")).alias("tokens"))
    model = H.count_vectorizer("tokens", "cv", 3, 2.0).fit(d)
    rows = [(i, w) for i, w in enumerate(model.vocabulary)]
    names = spark.createDataFrame(rows, "i bigint, word string")
    out = model.transform(d).select(F.posexplode(vector_to_array("cv")).alias("i", "n")).groupBy("i").agg(F.sum("n").cast("bigint").alias("n"))
    return out.withColumn("i", F.col("i").cast("bigint")).join(names, "i").select("i", "word", "n")


def wide_embeddings(spark, sf):
    """All coordinates as columns ``x0, x1, ...``."""
    emb = embeddings(spark, sf)
    width = emb.agg(F.max(F.size("embedding"))).head()[0] or 0
    return emb.select("id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"x{i}") for i in range(width)]), width


def h10(spark, sf):
    """19 standardized components of all coordinates (mean 0, deviation 1), beside the variance of the full projection."""
    d, width = wide_embeddings(spark, sf)
    columns = [f"x{i}" for i in range(width)]
    out = H.pca_pipeline(columns, 19).fit(d).transform(d).select("id", vector_to_array("features").alias("f"))
    flat = out.select(F.posexplode("f").alias("dim", "x")).groupBy("dim").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), F.count("x").alias("n"))
    # A rotation keeps the total variance: the full projection has that of the coordinates.
    full = H.pca_pipeline(columns, width).fit(d).transform(d).select(F.posexplode(vector_to_array("pca")).alias("dim", "x"))
    total = full.groupBy("dim").agg(F.var_samp("x").alias("v")).agg(F.sum("v").alias("variance"))
    return flat.crossJoin(total).select(F.col("dim").cast("bigint").alias("dim"), F.abs(F.round("mean", 6)).alias("mean"), r6("sd", "sd"), "n", r6("variance", "variance"))


def h11(spark, sf):
    d = gaps(spark, sf)
    out = H.feature_pipeline(["l_quantity", "l_discount", "l_tax"], ["l_returnflag", "l_linestatus"], ["l_quantity"]).fit(d).transform(d)
    a = out.select(*KEY, vector_to_array("features").alias("f"))
    return a.select(*KEY, F.size("f").cast("bigint").alias("width"), F.aggregate(F.slice("f", 4, 100), F.lit(0.0), lambda s, x: s + x).cast("bigint").alias("ones"),
                    r6(F.get("f", F.lit(1)), "discount"))


K = ", ".join(KEY)
ORD = "r AS (SELECT o_orderpriority AS p, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS idx FROM orders GROUP BY 1)"
WORDS = "list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '')"

QUERIES = {
    "h01_vector_assembler": (h01, f"SELECT {K}, l_quantity AS x0, l_discount AS x1, l_tax AS x2 FROM lineitem"),
    "h02_bucketizer": (h02, f"SELECT {K}, CASE WHEN l_quantity < 5 THEN 0 WHEN l_quantity < 10 THEN 1 WHEN l_quantity < 15 THEN 2 WHEN l_quantity < 20 THEN 3 ELSE 4 END::BIGINT AS bucket FROM lineitem"),
    "h03_standard_scaler": (h03, "WITH s AS (SELECT " + ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS d{i}" for i, c in enumerate(NUM)) + f" FROM lineitem) SELECT {K}, "
                            + ", ".join(f"round({c} / d{i}, 6) AS a{i}, round(({c} - m{i}) / d{i}, 6) AS b{i}" for i, c in enumerate(NUM)) + " FROM lineitem, s"),
    "h04_exact_median": (h04_exact, """
        WITH d AS (SELECT * REPLACE (CASE WHEN l_orderkey % 3 <> 0 THEN l_quantity::DOUBLE END AS l_quantity) FROM lineitem), m AS (SELECT median(l_quantity) AS q FROM d)
        SELECT l_linenumber, count(*) AS n, round(sum(coalesce(l_quantity, q)), 2) AS sum_quantity, round(sum(l_extendedprice::DOUBLE), 2) AS sum_extendedprice,
               round(sum(l_discount::DOUBLE), 2) AS sum_discount, round(sum(l_tax::DOUBLE), 2) AS sum_tax, round(min(q) FILTER (WHERE l_orderkey % 3 = 0), 6) AS median
        FROM d, m GROUP BY 1"""),
    "h04_imputer": (h04, """
        WITH d AS (SELECT CASE WHEN l_partkey % 7 <> 0 THEN l_quantity END AS q FROM lineitem), m AS (SELECT quantile_disc(q, 0.5) AS m FROM d),
        s AS (SELECT avg((q < m)::INT) AS below, avg((q <= m)::INT) AS upto FROM d, m WHERE q IS NOT NULL)
        SELECT count(*) AS n_rows, count(coalesce(q, m)) AS n_filled, any_value(below <= 0.502 AND upto >= 0.498) AS is_median FROM d, m, s"""),
    "h05_string_indexer": (h05, f"WITH {ORD} SELECT o_orderkey, idx FROM orders JOIN r ON p = o_orderpriority"),
    "h06_index_to_string": (h06, "SELECT o_orderkey, o_orderpriority, o_orderpriority AS back FROM orders"),
    "h07_one_hot": (h07, f"WITH {ORD} SELECT o_orderkey, " + ", ".join(f"(idx = {i})::BIGINT AS h{i}" for i in range(4)) + " FROM orders JOIN r ON p = o_orderpriority"),
    "h08_hashing_tf": (h08, f"SELECT doc_id AS id, len({WORDS})::BIGINT AS tokens, len({WORDS})::BIGINT AS mass FROM documents"),
    "h09_count_vectorizer": (h09, f"WITH w AS (SELECT doc_id, unnest({WORDS}) AS word FROM documents), c AS (SELECT word, count(*) AS n FROM w GROUP BY 1 HAVING count(DISTINCT doc_id) >= 2) SELECT row_number() OVER (ORDER BY n DESC) - 1 AS i, word, n FROM c ORDER BY n DESC LIMIT 3"),
    "h10_pca": (h10, """
        WITH x AS (SELECT unnest(range(len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings), c AS (SELECT i, var_samp(v) AS v FROM x GROUP BY i)
        SELECT d.range AS dim, 0.0::DOUBLE AS mean, 1.0::DOUBLE AS sd, (SELECT count(*) FROM embeddings) AS n, (SELECT round(sum(v), 6) FROM c) AS variance FROM range(19) d"""),
    "h11_nested_stages": (h11, f"WITH s AS (SELECT avg(l_discount) AS m, stddev_samp(l_discount) AS d, count(DISTINCT l_returnflag) + count(DISTINCT l_linestatus) AS w FROM lineitem) SELECT {K}, 3 + w AS width, 2::BIGINT AS ones, round((l_discount - m) / d, 6) AS discount FROM lineitem, s"),
}
