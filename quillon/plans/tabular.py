"""Projection, joins, statistics, windows, splits and set operations (B-F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prefix as P
from ..operators import search as S
from ..operators import tabular as T
from .common import r6, sql_hash, sql_hash_int, table


def doc_labels(spark, sf):
    """documents with their labels, null where a document has none."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")


def b01(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.expr("o_custkey + 3").alias("key3"), (F.col("o_totalprice") + 3).alias("price3"))


def b02(spark, sf):
    return table(spark, sf, "lineitem").where("l_quantity < 20").where(F.col("l_discount") >= 0.05).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")


def b03(spark, sf):
    return doc_labels(spark, sf).where(F.col("quality").isNull() & F.col("lang").isNotNull()).select("doc_id")


def b04(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.col("p_name").like("red%").alias("is_red"))


def b05(spark, sf):
    return table(spark, sf, "part").withColumn("small", F.col("p_size") < 20).select("p_partkey", "p_size", "small")


def b06(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", T.ratio("l_extendedprice", "l_quantity").alias("unit_price"),
        T.ratio("l_tax", "l_discount").alias("tax_per_discount"))


def b07(spark, sf):
    return table(spark, sf, "customer").withColumnRenamed("c_custkey", "id").drop("c_acctbal", "c_mktsegment")


def b08(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").cast("double").alias("key_d"), F.col("p_retailprice").cast("bigint").alias("price_i"),
                                           F.col("p_size").cast("string").alias("size_s"))


def b09(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", r6(T.rescale("l_quantity", 0, 50, -1, 1), "scaled"),
                                               r6(T.rescale("l_quantity", 0, 50, 0, 1), "unit"))


def b10(spark, sf):
    o = table(spark, sf, "orders").withColumn("status", F.expr("nullif(o_orderstatus, 'P')"))
    return o.na.fill("", subset=["status"]).select("o_orderkey", "status")


def b11(spark, sf):
    ev = table(spark, sf, "events").withColumn("label_id", T.label_id("event_type", ["click", "view", "purchase"]))
    return ev.where(F.col("label_id").isNotNull()).select("event_id", "label_id")


def b12(spark, sf):
    return table(spark, sf, "events").select("event_id", T.binarize("value", 10.0).alias("at_least"), T.binarize("value", 10.0, True).alias("above"))


def b13(spark, sf):
    return table(spark, sf, "documents").where(T.length_between("text", 100, 2000)).select("doc_id")


def b14(spark, sf):
    docs = table(spark, sf, "documents")
    names = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("schema", F.lit(names))


def b15(spark, sf):
    o = table(spark, sf, "orders").withColumn("mark", F.expr("CASE o_orderstatus WHEN 'P' THEN 'dev' WHEN 'F' THEN 'test' ELSE o_orderstatus END"))
    routed = o.select("o_orderkey", T.route("mark").alias("split"))
    return T.routed_first(routed, "split", [F.col("o_orderkey").asc()], {"dev": 1000})


def c01(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    c = table(spark, sf, "customer")
    return c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner").join(r, n["n_regionkey"] == r["r_regionkey"], "left_outer").select(
        "c_custkey", "n_name", "r_name")


def c02(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


def doc_links(spark, sf):
    """Links between consecutive documents."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("src"), (F.col("doc_id") + 1).alias("trg"))


def c03(spark, sf):
    d, links = table(spark, sf, "documents"), doc_links(spark, sf)
    src = d.where("lang = 'en'").select(F.col("doc_id").alias("src"), F.md5("text").alias("src_text"))
    trg = d.where("lang <> 'en'").select(F.col("doc_id").alias("trg"), F.col("lang").alias("trg_lang"), F.md5("text").alias("trg_text"))
    return links.join(src, "src").join(trg, "trg")


def c04(spark, sf):
    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    return o.join(li.where("l_quantity > 45"), o["o_orderkey"] == li["l_orderkey"], "left_semi").select("o_orderkey", "o_custkey")


def c05(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders").where("o_totalprice > 300000")
    return c.join(o, c["c_custkey"] == o["o_custkey"], "left_anti").select("c_custkey", "c_name")


def d01(spark, sf):
    return doc_labels(spark, sf).agg(
        F.count(F.lit(1)).alias("n"), F.count("quality").alias("n_labelled"), F.round(F.avg("n_chars"), 4).alias("mean_chars"),
        F.max("n_chars").alias("max_chars"), F.min("n_chars").alias("min_chars"), F.sum("n_chars").alias("sum_chars"))


def d02(spark, sf):
    return T.first_last(table(spark, sf, "events"), ["user_id"], "event_type", ["ts", "event_id"])


def d03(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
        F.round(F.avg("l_extendedprice"), 4).alias("avg_price"))


def d04(spark, sf):
    return spark.sql(
        "SELECT l_shipdate, count(*) AS n, "
        "CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DOUBLE) AS revenue "
        "FROM {lineitem} GROUP BY l_shipdate HAVING count(*) > 1 ORDER BY n DESC", lineitem=table(spark, sf, "lineitem"))


def a21(spark, sf):
    return spark.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM {orders} GROUP BY o_orderstatus, o_orderpriority", orders=table(spark, sf, "orders"))


def d05(spark, sf):
    return table(spark, sf, "lineitem").agg(F.countDistinct("l_orderkey").alias("orders"), F.countDistinct("l_partkey", "l_suppkey").alias("part_supp"))


def d06(spark, sf):
    d = T.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    return d.select("column", "n", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"), "min", "max")


def d07(spark, sf):
    return T.null_report(doc_labels(spark, sf))


def d08(spark, sf):
    m = T.correlation_matrix(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return m.select("a", "b", r6("r", "r"))


def d09(spark, sf):
    d = table(spark, sf, "lineitem")
    plain = T.weighted_pearson(d, "l_quantity", "l_extendedprice", by=["l_returnflag"])
    weighted = T.weighted_pearson(d, "l_quantity", "l_extendedprice", "l_linenumber", by=["l_returnflag"])
    return plain.join(weighted.withColumnRenamed("pearson", "weighted"), "l_returnflag")


def d10(spark, sf):
    ev = table(spark, sf, "events")
    return T.spearman(ev.withColumn("minute", F.minute("ts")), "value", "minute", "event_id", by=["event_type"]).select(
        "event_type", r6("spearman", "spearman"))


def d11(spark, sf):
    return T.group_items(table(spark, sf, "events"), ["event_type"], ["user_id"], unique=True)


def d12(spark, sf):
    return T.size_report(table(spark, sf, "lineitem"), "l_orderkey").select("groups", "min_size", r6("mean_size", "mean_size"), "max_size")


def d13(spark, sf):
    return T.frequency_order(table(spark, sf, "orders"), "o_orderpriority")


def e01(spark, sf):
    top = S.top_k(table(spark, sf, "orders"), "o_custkey", "o_totalprice", "o_orderkey", 3)
    return top.select("o_custkey", "o_orderkey", "o_totalprice", "rank")


def e02(spark, sf):
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "n_chars", "quality")
    run = P.running(d, [F.col("n_chars").desc(), F.col("doc_id").asc()], {"hits": F.col("quality")})
    total = d.agg(F.sum("quality").alias("total")).withColumn("one", F.lit(1))
    run = run.withColumn("one", F.lit(1)).join(F.broadcast(total), "one")
    return run.select("doc_id", "position", F.col("hits").cast("bigint").alias("hits"), r6(F.col("hits") / F.col("position"), "precision"),
                      r6(F.col("hits") / F.col("total"), "recall"))


def e03(spark, sf):
    d = T.cap_per_key(table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey"),
                      ["l_suppkey", "l_returnflag"], [F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey")], 5)
    return d


def e04(spark, sf):
    return T.dev_split(table(spark, sf, "documents").select("doc_id", "lang"), ["lang"], ["doc_id"], 20)


def e05(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "text")
    out = T.first_occurrence(d, "doc_id", F.lower(F.trim("text")))
    return out.select("doc_id", "first_id", (F.col("doc_id") == F.col("first_id")).alias("is_first"))


def f01(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "o_custkey")


def f02(spark, sf):
    return T.hash_sample(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 10, seed=7)


def f03(spark, sf):
    return T.hash_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", {"train": 0.7, "dev": 0.2, "test": 0.1}, seed=3)


def f04(spark, sf):
    return T.both_directions(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey"), "l_partkey", "l_suppkey")


def f05(spark, sf):
    d = table(spark, sf, "part")
    return T.distinct_union(d, ["p_name", "p_type"]).unionByName(T.distinct_union(d, ["p_brand", "p_type"], 10, seed=1))


def f06(spark, sf):
    o = T.hash_split(table(spark, sf, "orders"), "o_custkey", {"train": 0.8, "test": 0.2}, seed=1)
    return T.overlap(o.where("split = 'train'"), o.where("split = 'test'"), "o_custkey")


def f07(spark, sf):
    li = table(spark, sf, "lineitem")
    return T.difference(li, li.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"])


def f08(spark, sf):
    sizes = table(spark, sf, "documents").groupBy(F.col("lang").alias("dataset")).agg(F.count(F.lit(1)).alias("n"))
    a = T.dataset_weights(sizes, 2.0).withColumn("mode", F.lit("temperature"))
    return a.unionByName(T.dataset_weights(sizes, None).withColumn("mode", F.lit("equal")))


def f09(spark, sf):
    d = table(spark, sf, "labels").withColumn("weight", F.when(F.col("quality") == 1, 3).otherwise(1))
    return T.repeat_weighted(d, "weight").select("doc_id", "copy")


DL = "(SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


QUERIES = {
    "a21_temp_view": (a21, "SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_totalprice) AS top FROM orders GROUP BY 1, 2"),
    "b01_select_expressions": (b01, "SELECT o_orderkey, o_custkey + 3 AS key3, o_totalprice + 3 AS price3 FROM orders"),
    "b02_filter": (b02, "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice FROM lineitem WHERE l_quantity < 20 AND l_discount >= 0.05"),
    "b03_is_null": (b03, f"SELECT doc_id FROM {DL} WHERE quality IS NULL AND lang IS NOT NULL"),
    "b04_like": (b04, "SELECT p_partkey, p_name LIKE 'red%' AS is_red FROM part"),
    "b05_derived_column": (b05, "SELECT p_partkey, p_size, p_size < 20 AS small FROM part"),
    "b06_ratio_columns": (b06, "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_quantity, 0) AS unit_price, l_tax / nullif(l_discount, 0) AS tax_per_discount FROM lineitem"),
    "b07_rename_drop": (b07, "SELECT c_custkey AS id, c_name, c_nationkey FROM customer"),
    "b08_cast": (b08, "SELECT p_partkey::DOUBLE AS key_d, trunc(p_retailprice)::BIGINT AS price_i, p_size::VARCHAR AS size_s FROM part"),
    "b09_rescale": (b09, "SELECT l_orderkey, l_linenumber, l_partkey, round(-1 + (l_quantity - 0) * (2 / 50.0::DOUBLE), 6) AS scaled, round(l_quantity / 50.0::DOUBLE, 6) AS unit FROM lineitem"),
    "b10_fill_nulls": (b10, "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), '') AS status FROM orders"),
    "b11_label_map": (b11, "SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'purchase' THEN 2 END::BIGINT AS label_id FROM events WHERE event_type IN ('click', 'view', 'purchase')"),
    "b12_binarize": (b12, "SELECT event_id, (value >= 10)::BIGINT AS at_least, (value > 10)::BIGINT AS above FROM events"),
    "b13_length_predicate": (b13, "SELECT doc_id FROM documents WHERE length(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))) BETWEEN 100 AND 2000"),
    "b14_schema_count": (b14, "SELECT count(*) AS n_rows, 'doc_id:bigint,text:string,lang:string,source:string,n_chars:bigint' AS schema FROM documents"),
    "b15_route_split": (b15, "WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'dev' WHEN 'F' THEN 'test' ELSE 'train' END AS split FROM orders), n AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY o_orderkey) AS rn FROM r) SELECT o_orderkey, split FROM n WHERE split <> 'dev' OR rn <= 1000"),
    "c01_inner_join": (c01, "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"),
    "c02_lookup_join": (c02, "SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey"),
    "c03_link_join": (c03, "SELECT l.doc_id AS src, t.doc_id AS trg, md5(l.text) AS src_text, t.lang AS trg_lang, md5(t.text) AS trg_text FROM documents l JOIN documents t ON t.doc_id = l.doc_id + 1 WHERE l.lang = 'en' AND t.lang <> 'en'"),
    "c04_semi_join": (c04, "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)"),
    "c05_anti_join": (c05, "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)"),
    "d01_global_aggregates": (d01, f"SELECT count(*) AS n, count(quality) AS n_labelled, round(avg(n_chars), 4) AS mean_chars, max(n_chars) AS max_chars, min(n_chars) AS min_chars, sum(n_chars)::BIGINT AS sum_chars FROM {DL}"),
    "d02_first_last": (d02, "SELECT user_id, arg_min(event_type, {'a': ts, 'b': event_id}) AS first, arg_max(event_type, {'a': ts, 'b': event_id}) AS last FROM events GROUP BY user_id"),
    "d03_group_by": (d03, "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(avg(l_extendedprice), 4) AS avg_price FROM lineitem GROUP BY 1, 2"),
    "d04_sql_view": (d04, "SELECT l_shipdate, count(*) AS n, sum(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)))::DOUBLE AS revenue FROM lineitem GROUP BY l_shipdate HAVING count(*) > 1"),
    "d05_count_distinct": (d05, "SELECT count(DISTINCT l_orderkey) AS orders, count(DISTINCT (l_partkey, l_suppkey)) AS part_supp FROM lineitem"),
    "d06_describe": (d06, " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem" for c in ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])),
    "d07_null_report": (d07, " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM {DL}" for c in ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"])),
    "d08_correlation_matrix": (d08, " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"] for b in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])),
    "d09_weighted_pearson": (d09, """
        WITH m AS (SELECT l_returnflag AS f, sum(l_linenumber*l_quantity)/sum(l_linenumber) AS mx, sum(l_linenumber*l_extendedprice)/sum(l_linenumber) AS my FROM lineitem GROUP BY 1)
        SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 5) AS pearson,
               round(sum(l_linenumber*(l_quantity-mx)*(l_extendedprice-my)) / sqrt(sum(l_linenumber*(l_quantity-mx)**2) * sum(l_linenumber*(l_extendedprice-my)**2)), 5) AS weighted
        FROM lineitem JOIN m ON l_returnflag = f GROUP BY 1"""),
    "d10_spearman": (d10, """
        WITH v AS (SELECT event_type, value, minute(ts) AS m FROM events),
        r AS (SELECT event_type,
                rank() OVER (PARTITION BY event_type ORDER BY value) + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0 AS ra,
                rank() OVER (PARTITION BY event_type ORDER BY m) + (count(*) OVER (PARTITION BY event_type, m) - 1) / 2.0 AS rb FROM v)
        SELECT event_type, round(corr(ra, rb), 6) AS spearman FROM r GROUP BY 1"""),
    "d11_group_items": (d11, "SELECT event_type, user_id, row_number() OVER (PARTITION BY event_type ORDER BY user_id) AS position FROM (SELECT DISTINCT event_type, user_id FROM events)"),
    "d12_size_report": (d12, "SELECT count(*) AS groups, min(n) AS min_size, round(avg(n), 6) AS mean_size, max(n) AS max_size FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)"),
    "d13_frequency_order": (d13, "SELECT o_orderpriority AS label, row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS index FROM orders GROUP BY 1"),
    "e01_top_k": (e01, "SELECT o_custkey, o_orderkey, o_totalprice, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3"),
    "e02_running_precision_recall": (e02, """
        WITH d AS (SELECT doc_id, n_chars, quality FROM documents JOIN labels USING (doc_id)),
        r AS (SELECT doc_id, row_number() OVER w AS position, sum(quality) OVER w AS hits, sum(quality) OVER () AS total FROM d
              WINDOW w AS (ORDER BY n_chars DESC, doc_id ROWS UNBOUNDED PRECEDING))
        SELECT doc_id, position, hits::BIGINT AS hits, round(hits / position, 6) AS precision, round(hits / total, 6) AS recall FROM r"""),
    "e03_cap_per_key": (e03, "SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_orderkey, l_linenumber, l_partkey) AS rn FROM lineitem) WHERE rn <= 5"),
    "e04_dev_split": (e04, "SELECT doc_id, lang, CASE WHEN row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 20 THEN 'dev' ELSE 'train' END AS split FROM documents"),
    "e05_first_occurrence": (e05, "SELECT doc_id, first_id, doc_id = first_id AS is_first FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY lower(trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)))) AS first_id FROM documents)"),
    "f01_sort": (f01, "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1"),
    "f02_random_sample": (f02, f"SELECT doc_id, lang FROM documents ORDER BY {sql_hash('doc_id', 7)}, doc_id LIMIT 10"),
    "f03_random_split": (f03, f"SELECT o_orderkey, CASE WHEN {sql_hash_int('o_orderkey', 3)} % 10000 < 7000 THEN 'train' WHEN {sql_hash_int('o_orderkey', 3)} % 10000 < 9000 THEN 'dev' ELSE 'test' END AS split FROM orders"),
    "f04_both_directions": (f04, "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem UNION ALL SELECT l_orderkey, l_suppkey, l_partkey FROM lineitem"),
    "f05_distinct_union": (f05, f"(SELECT p_name AS sentence FROM part UNION SELECT p_type FROM part) UNION ALL (SELECT sentence FROM (SELECT p_brand AS sentence FROM part UNION SELECT p_type FROM part) ORDER BY {sql_hash('sentence', 1)}, sentence LIMIT 10)"),
    "f06_disjointness": (f06, f"WITH s AS (SELECT o_custkey, {sql_hash_int('o_custkey', 1)} % 10000 < 8000 AS is_train FROM orders), x AS (SELECT o_custkey FROM s WHERE is_train INTERSECT SELECT o_custkey FROM s WHERE NOT is_train) SELECT count(*) AS shared, count(*) = 0 AS disjoint FROM x"),
    "f07_set_difference": (f07, "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'"),
    "f08_dataset_weights": (f08, "WITH s AS (SELECT lang AS dataset, count(*) AS n FROM documents GROUP BY 1) SELECT dataset, n, greatest(1, floor(pow(n / sum(n) OVER (), 0.5) * 1000))::BIGINT AS weight, 'temperature' AS mode FROM s UNION ALL SELECT dataset, n, 100, 'equal' FROM s"),
    "f09_weighted_repetition": (f09, "SELECT doc_id, unnest(range(1, CASE WHEN quality = 1 THEN 4 ELSE 2 END)) AS copy FROM labels"),
}
