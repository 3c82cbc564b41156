"""Sources and sinks (A). Each query writes rows of a given table in the format and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluate as E
from ..operators import search as S
from ..session import scratch_path
from ..sources import readers as R
from ..sources import sinks as K
from .common import r6, table
from .search import hashed_counts
from .text import STOP, docs, sql_tokens, token_rows, word_vectors


def flat(c):
    return F.regexp_replace(c, r"\s+", " ")


def _write_lines(df, spark, name, order, **options):
    """Text lines in the order of a column, so that line numbers are known."""
    path = scratch_path(spark, name)
    df.orderBy(order).select("value").write.options(**options).text(path)
    return path


def a01(spark, sf):
    path = scratch_path(spark, "json")
    table(spark, sf, "orders").write.json(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    return R.read_json(spark, path, schema, drop=["o_orderpriority"])


def a02(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).option("sep", ";").csv(path)
    return R.read_csv(spark, path, header=True, infer=True, sep=";").select(F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_acctbal")


def a03(spark, sf):
    path = scratch_path(spark, "tsv")
    table(spark, sf, "part").write.option("sep", "\t").csv(path)
    return R.read_positional_tsv(spark, path, {0: "key", 1: "name", 5: "price"}).select(
        F.col("key").cast("bigint").alias("key"), "name", F.col("price").cast("double").alias("price"))


def a04(spark, sf):
    e = table(spark, sf, "embeddings")
    cells = F.transform("embedding", lambda x, i: F.when(i % 2 == 0, F.concat_ws(":", (i + 1).cast("string"), x.cast("double").cast("string"))))
    lines = e.select("vec_id", F.concat_ws(" ", F.col("label").cast("string"), F.array_compact(cells)).alias("value"))
    data = R.read_libsvm(spark, _write_lines(lines, spark, "libsvm", "vec_id"), 64)
    from pyspark.ml.functions import vector_to_array
    v = vector_to_array("features")
    return data.groupBy("label").agg(F.count(F.lit(1)).alias("n"), r6(F.sum(F.aggregate(v, F.lit(0.0), lambda s, x: s + x)), "mass"))


def a05(spark, sf):
    """A literal lookup table joined to the nations."""
    names = R.inline_table(spark, [(0, "zero"), (1, "one"), (2, "two")], "n_regionkey int, word string")
    ids = R.id_range(spark, 25, "n_nationkey", "int")
    return table(spark, sf, "nation").join(names, "n_regionkey").join(ids, "n_nationkey").select("n_nationkey", "word")


def sts_lines(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.concat_ws("\t", "lang", "source", F.lit("2020"), F.lit("x"), (F.col("n_chars") % 6).cast("string"), flat("text"), F.col("source")).alias("value"))


def a06(spark, sf):
    path = _write_lines(sts_lines(spark, sf), spark, "sts", "doc_id")
    out = R.read_sts_pairs(spark, path, name="sts-")
    return out.select("guid", F.md5(F.get("texts", F.lit(0))).alias("s1"), F.get("texts", F.lit(1)).alias("s2"), r6("label", "label"))


def a07(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.concat_ws("\t", flat("text"), "lang", "source").alias("value"))
    head = spark.createDataFrame([(-1, "a\tb\tc")], "doc_id bigint, value string")
    out = R.read_triplets(spark, _write_lines(d.unionByName(head), spark, "triplets", "doc_id"), has_header=True)
    return out.select("line", F.md5(F.get("texts", F.lit(0))).alias("t1"), F.get("texts", F.lit(1)).alias("t2"), F.get("texts", F.lit(2)).alias("t3"))


def a08(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.concat_ws("\t", "source", flat("text")).alias("value"))
    out = R.read_labelled_sentences(spark, _write_lines(d, spark, "labelled", "doc_id"))
    return out.select("line", "label", "label_id", F.length("text").cast("bigint").alias("n"))


def a09(spark, sf):
    d = table(spark, sf, "documents")
    a = _write_lines(d.select("doc_id", flat("text").alias("value")), spark, "left", "doc_id")
    b = _write_lines(d.where("doc_id > 9").select("doc_id", F.col("source").alias("value")), spark, "right", "doc_id")
    out = R.read_paired_files(spark, [a, b])
    return out.select(F.col("guid").cast("bigint").alias("guid"), F.md5(F.get("texts", F.lit(0))).alias("a"), F.get("texts", F.lit(1)).alias("b"), "label")


def nli_label():
    return F.element_at(F.array(F.lit("contradiction"), F.lit(" Entailment"), F.lit("neutral"), F.lit("-")), (F.col("n_chars") % 4 + 1).cast("int"))


def a10(spark, sf):
    d = table(spark, sf, "documents")
    files = [_write_lines(d.select("doc_id", c.alias("value")), spark, "nli", "doc_id", compression="gzip") for c in (flat("text"), F.col("source"), nli_label())]
    out = R.read_nli(spark, *files)
    return out.select(F.col("guid").cast("bigint").alias("guid"), F.md5(F.get("texts", F.lit(0))).alias("a"), "label")


def a11(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.concat_ws("\t", "source", flat("text"), "lang").alias("value"))
    out = R.read_parallel_tsv(spark, _write_lines(d, spark, "parallel", "doc_id"), max_len=600)
    return out.select("line", F.get("texts", F.lit(0)).alias("source"), F.length(F.get("texts", F.lit(1))).cast("bigint").alias("n"))


def a12(spark, sf):
    v = word_vectors(spark, sf).withColumn("vector", F.transform("vector", lambda x: F.round(x, 4)))
    lines = v.select("word", F.concat_ws(" ", F.col("word"), F.col("vector").cast("array<string>")).alias("value"))
    bad = table(spark, sf, "nation").select(F.concat(F.lit("~~"), "n_name").alias("word"), F.concat(F.col("n_name"), F.lit(" 1 2")).alias("value"))
    out = R.read_word_vectors(spark, _write_lines(lines.unionByName(bad), spark, "vectors", "word"))
    return out.select("word", F.size("vector").cast("bigint").alias("dims"), F.round(F.get("vector", F.lit(0)).cast("double"), 4).alias("x0"))


def a13(spark, sf):
    from ..operators.lexical import idf
    t = token_rows(spark, sf)
    f = idf(t).select("token", F.concat_ws("\t", "token", F.col("df").cast("string")).alias("value"))
    n = t.agg(F.countDistinct("id").cast("string").alias("value")).select(F.lit("").alias("token"), "value")
    out = R.read_doc_frequencies(spark, _write_lines(f.unionByName(n), spark, "freq", "token"), STOP)
    return out.select("token", "df", r6("weight", "weight"))


def a14(spark, sf):
    """The same lines as gzip and as bzip2, chosen by suffix."""
    d = table(spark, sf, "pages").select("page_id", F.col("url").alias("value"))
    out = None
    for name, codec in (("gz", "gzip"), ("bz2", "bzip2")):
        part = R.read_lines(spark, _write_lines(d, spark, name, "page_id", compression=codec)).withColumn("codec", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out.select("codec", "value")


def a15(spark, sf):
    li = table(spark, sf, "lineitem").select(F.concat_ws("\t", F.col("l_orderkey").cast("string"), F.lit("0"), F.col("l_partkey").cast("string"), (F.col("l_linenumber") % 3).cast("string")).alias("value"))
    path = scratch_path(spark, "qrels")
    li.write.text(path)
    return R.read_qrels(spark, path).select(F.col("query_id").cast("bigint").alias("query_id"), F.col("corpus_id").cast("bigint").alias("corpus_id"), "relevance")


def a16(spark, sf):
    from .evaluate import scored_docs
    path = scratch_path(spark, "metrics")
    d = scored_docs(spark, sf)
    for epoch, t in enumerate((50.0, 200.0, 500.0)):
        K.append_metrics(E.binary_accuracy(d, "score", "quality", t), path, epoch, 100 * epoch)
    return R.read_csv(spark, path, header=True, schema="epoch bigint, steps bigint, accuracy double").select("epoch", "steps", r6("accuracy", "accuracy"))


def a17(spark, sf):
    path = scratch_path(spark, "out")
    K.write_tsv(table(spark, sf, "pages").select("page_id", "url", "html"), path)
    return R.read_positional_tsv(spark, path, {0: "page_id", 1: "url", 2: "html"}).select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", F.md5("html").alias("digest"))


def a18(spark, sf):
    """The texts of one language are encoded first, then all: the second call adds only the missing ones."""
    path = scratch_path(spark, "cache")
    d = docs(spark, sf).select("id", "text", "lang")
    encode = lambda df: S.encode(df, "text", hashed_counts)
    K.cached_embeddings(d.where("lang = 'en'"), path, "id", encode)
    out = K.cached_embeddings(d, path, "id", encode)
    return out.select("id", F.get("embedding", F.lit(2)).cast("double").alias("x2"), F.get("embedding", F.lit(3)).cast("double").alias("x3"))


def a20(spark, sf):
    d = K.keep(table(spark, sf, "events").where("event_type LIKE 'c%'"))
    out = d.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).join(d.groupBy("user_id").agg(F.max("value").alias("top")), "user_id")
    return out


FLAT = "regexp_replace(text, '\\s+', ' ', 'g')"
N = "row_number() OVER (ORDER BY doc_id) - 1"
TOK = f"tk AS (SELECT doc_id AS id, unnest({sql_tokens('text')}) AS token FROM documents)"

QUERIES = {
    "a01_read_json": (a01, "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"),
    "a02_read_csv": (a02, "SELECT c_custkey, c_name, c_acctbal FROM customer"),
    "a03_positional_tsv": (a03, "SELECT p_partkey AS key, p_name AS name, p_retailprice AS price FROM part"),
    "a04_libsvm": (a04, "SELECT label::DOUBLE AS label, count(*) AS n, round(sum(list_sum(list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN i % 2 = 1 THEN x ELSE 0 END))), 6) AS mass FROM embeddings GROUP BY 1"),
    "a05_inline_table": (a05, "SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' ELSE 'two' END AS word FROM nation WHERE n_regionkey < 3"),
    "a06_sts_pairs": (a06, f"SELECT 'sts-' || ({N}) AS guid, md5({FLAT}) AS s1, source AS s2, round((n_chars % 6) / 5.0, 6)::DOUBLE AS label FROM documents"),
    "a07_triplets": (a07, f"SELECT {N} AS line, md5({FLAT}) AS t1, lang AS t2, source AS t3 FROM documents"),
    "a08_labelled_sentences": (a08, f"""
        WITH d AS (SELECT {N} AS line, source AS label, length(rtrim({FLAT}, ' ')) AS n FROM documents), f AS (SELECT label, row_number() OVER (ORDER BY min(line)) - 1 AS label_id FROM d GROUP BY 1)
        SELECT line, label, label_id, n FROM d JOIN f USING (label)"""),
    "a09_paired_files": (a09, f"WITH l AS (SELECT {N} AS guid, md5({FLAT}) AS a FROM documents), r AS (SELECT {N} AS guid, source AS b FROM documents WHERE doc_id > 9) SELECT guid, a, b, 1 AS label FROM l JOIN r USING (guid)"),
    "a10_nli": (a10, f"SELECT {N} AS guid, md5({FLAT}) AS a, CASE WHEN n_chars % 4 < 3 THEN n_chars % 4 END AS label FROM documents"),
    "a11_parallel_tsv": (a11, f"WITH d AS (SELECT {N} AS line, source, length({FLAT}) AS n FROM documents) SELECT line, source, n FROM d WHERE n <= 600"),
    "a12_word_vectors": (a12, f"WITH {TOK}, w AS (SELECT DISTINCT token FROM tk) SELECT token AS word, 4::BIGINT AS dims, round(('0x' || substr(md5(token), 1, 8))::BIGINT / 4294967296.0::DOUBLE, 4) AS x0 FROM w UNION ALL SELECT 'PADDING_TOKEN', 4, 0"),
    "a13_doc_frequencies": (a13, f"WITH {TOK}, f AS (SELECT token, count(DISTINCT id) AS df FROM tk GROUP BY 1) SELECT token, df, round(ln((SELECT count(DISTINCT id) FROM tk) / df), 6) AS weight FROM f WHERE token NOT IN ({', '.join(repr(w) for w in STOP)})"),
    "a14_compressed": (a14, "SELECT unnest(['gz', 'bz2']) AS codec, url AS value FROM pages"),
    "a15_qrels": (a15, "SELECT l_orderkey AS query_id, l_partkey AS corpus_id, l_linenumber % 3 AS relevance FROM lineitem WHERE l_linenumber % 3 > 0"),
    "a16_metric_sink": (a16, """
        WITH d AS (SELECT len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS s, quality FROM documents JOIN labels USING (doc_id)), t AS (SELECT unnest([0, 1, 2]) AS epoch, unnest([50, 200, 500]) AS cut)
        SELECT epoch::BIGINT AS epoch, (100 * epoch)::BIGINT AS steps, round(avg(((s > cut)::INT = quality)::INT), 6) AS accuracy FROM d, t GROUP BY 1, 2"""),
    "a17_tsv_sink": (a17, "SELECT page_id, url, md5(regexp_replace(html, '[\\t\\r\\n]', ' ', 'g')) AS digest FROM pages"),
    "a18_embedding_cache": (a18, "SELECT doc_id AS id, len(list_filter(w, lambda x: length(x) % 16 = 2))::DOUBLE AS x2, len(list_filter(w, lambda x: length(x) % 16 = 3))::DOUBLE AS x3 FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS w FROM documents)"),
    "a20_persist": (a20, "SELECT user_id, count(*) AS n, max(value) AS top FROM events WHERE event_type LIKE 'c%' GROUP BY 1"),
}
