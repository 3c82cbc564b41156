"""Text rules (G), bags of words and word vectors."""

from __future__ import annotations

from pyspark.ml.feature import RegexTokenizer, StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import boundaries as B
from ..operators import lexical as L
from ..session import cut_lineage
from .common import r6, sql_hash_int, table

STOP = ["the", "and", "of", "der", "die", "und", "la", "le", "de", "el"]


def docs(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text", "lang", "source")


def turns(spark, sf):
    return table(spark, sf, "conversations").withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))


def g01(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.upper("url").alias("up"), F.lower(F.trim("url")).alias("low"),
        F.regexp_replace("url", "^https?://", "").alias("bare"), F.translate("url", "/:", "  ").alias("blanked"))


def g02(spark, sf):
    d = docs(spark, sf)
    out = Tokenizer(inputCol="text", outputCol="tok").transform(d)
    out = RegexTokenizer(inputCol="text", outputCol="rtok", pattern=r"\s+").transform(out)
    return out.select("id", F.size("tok").cast("bigint").alias("n_tok"), F.size("rtok").cast("bigint").alias("n_rtok"), F.md5(F.array_join("rtok", "|")).alias("digest"))


def g03(spark, sf):
    out = RegexTokenizer(inputCol="text", outputCol="tok", pattern=r"\s+").transform(docs(spark, sf))
    out = StopWordsRemover(inputCol="tok", outputCol="kept", stopWords=STOP).transform(out)
    return out.select("id", F.array_join("kept", " ").alias("kept"))


def vocabulary(spark, sf):
    """Words of the benchmark items, numbered alphabetically by frequency of use in this table."""
    w = table(spark, sf, "benchmark").select(F.explode(X.words(F.lower("text"))).alias("word"))
    return w.groupBy("word").agg(F.count(F.lit(1)).alias("idx"))


def g04(spark, sf):
    t = X.vocab_tokens(docs(spark, sf), "id", "text", vocabulary(spark, sf), STOP)
    return t.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("idx").alias("idx_sum"), F.sum(F.col("pos") * F.length("token")).alias("pos_mass"))


def g05(spark, sf):
    return docs(spark, sf).select("id", F.array_join(X.search_tokens("text", STOP), " ").alias("tokens"))


def g06(spark, sf):
    d = docs(spark, sf).select("id", X.words("text").alias("tokens"))
    pairs = table(spark, sf, "benchmark").select(X.words(F.lower("text")).alias("w"))
    grams = pairs.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws("_", F.get("w", i - 1), F.get("w", i)))).alias("phrase"))
    out = X.merge_phrases(d, "tokens", grams)
    return out.select("id", F.size("tokens").alias("before"), F.size("merged").alias("after"), F.md5(F.array_join("merged", " ")).alias("digest"))


def g07(spark, sf):
    return docs(spark, sf).select("id", F.md5(X.duplicate_key("text", STOP)).alias("key"))


def g08(spark, sf):
    p = docs(spark, sf).select("id", F.posexplode(X.passage_windows("text", 3, r"\n")).alias("pos", "passage"))
    return p.select("id", F.col("pos").cast("bigint").alias("pos"), "passage")


def g09(spark, sf):
    p = docs(spark, sf).select("id", F.posexplode(X.sentences("text")).alias("pos", "sentence"))
    return p.select("id", F.col("pos").cast("bigint").alias("pos"), "sentence")


def g09_scores(spark, sf):
    return B.abbreviation_scores(docs(spark, sf), "text", ["lang"]).select("lang", "kind", "n_stop", "n_plain", r6("score", "score"))


def g09_learned(spark, sf):
    return B.learned_sentences(docs(spark, sf), "id", "text", ["lang"])


def g10(spark, sf):
    return docs(spark, sf).select("id", X.joined_fields("source", "lang", "text").alias("joined"))


def g11(spark, sf):
    d = docs(spark, sf).select("id", X.paragraphs("text", r"\n").alias("p"))
    d = d.select("id", F.get("p", F.lit(0)).alias("first_paragraph"), F.posexplode("p").alias("pos", "paragraph"))
    return d.select("id", F.col("pos").cast("bigint").alias("pos"), F.md5("first_paragraph").alias("first_digest"), "paragraph")


def g12(spark, sf):
    return turns(spark, sf).select("id", X.delete_words("text", "id", 0.6, seed=5).alias("noised"))


def g13(spark, sf):
    return docs(spark, sf).select("id", F.md5(X.pooled_key("text")).alias("key"))


def token_lists(spark, sf):
    """The tokens of every text, written once as one string: the queries read them more than once, and no token holds a blank."""
    return cut_lineage(docs(spark, sf).select("id", F.array_join(X.search_tokens("text"), " ").alias("line")))


def _tokens():
    return F.filter(F.split("line", " "), lambda w: w != "")


def token_rows(spark, sf, lists=None):
    """A row per token, the texts dealt by id: what is counted per text afterwards needs no shuffle of tokens."""
    lists = token_lists(spark, sf) if lists is None else lists
    return lists.repartition("id").select("id", F.posexplode(_tokens()).alias("pos", "token"))


def h12(spark, sf):
    lists = token_lists(spark, sf)
    t = token_rows(spark, sf, lists)
    n = lists.where("line <> ''").agg(F.countDistinct("id").alias("n"))
    w = cut_lineage(L.idf(t, n_docs=n).where("df > 1").select("token", F.col("idf").alias("weight"), "df"))
    b = L.bow(t, w, cumulative={"tfidf": True, "binary": False}).where(F.col("id").isNotNull())
    return b.groupBy("id").agg(F.count(F.lit(1)).alias("terms"), r6(F.sum("tfidf"), "tfidf"), r6(F.sum("binary"), "binary"))


def h13(spark, sf):
    return L.idf(token_rows(spark, sf)).select("token", "df", r6("idf", "idf"))


def word_vectors(spark, sf, lists=None):
    """Deterministic 4-dimensional word vectors, derived from the words themselves."""
    lists = token_lists(spark, sf) if lists is None else lists
    t = lists.select(F.explode(_tokens()).alias("word")).distinct()
    dims = [F.conv(F.substring(F.md5("word"), 1 + 8 * i, 8), 16, 10).cast("bigint") / 4294967296.0 for i in range(4)]
    return t.select("word", F.array(*dims).alias("vector"))


def h14(spark, sf):
    lists = token_lists(spark, sf)
    v = L.average_word_vectors(token_rows(spark, sf, lists), word_vectors(spark, sf, lists))
    return v.select("id", *[r6(F.get("embedding", F.lit(i)), f"x{i}") for i in range(4)])


def i08(spark, sf):
    lists = token_lists(spark, sf)
    t = token_rows(spark, sf, lists)
    w = L.idf(t).select("token", F.col("idf").alias("weight"))
    v = L.average_word_vectors(t, word_vectors(spark, sf, lists), w)
    return v.select("id", *[r6(F.get("embedding", F.lit(i)), f"x{i}") for i in range(4)])


def i07(spark, sf):
    lists = token_lists(spark, sf)
    words = word_vectors(spark, sf, lists).withColumnRenamed("word", "token")
    v = L.pool_tokens(L.join_words(token_rows(spark, sf, lists), words), modes=("cls", "max", "mean", "sqrt"), width=4)
    return v.select("id", *[r6(F.get("embedding", F.lit(i)), f"x{i}") for i in range(16)])


_STOP = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"


def sql_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> '')"


def sql_tokens(x: str, stop: str | None = None) -> str:
    drop = f" AND NOT list_contains({stop}, w)" if stop else ""
    return (f"list_filter(list_transform({sql_words(f'lower({x})')}, "
            f"lambda w: regexp_replace(regexp_replace(w, '^[[:punct:]]+', ''), '[[:punct:]]+$', '')), lambda w: w <> ''{drop})")


TOK = f"tk AS (SELECT id, pos, toks[pos + 1] AS token FROM (SELECT doc_id AS id, {sql_tokens('text')} AS toks FROM documents) t, LATERAL (SELECT unnest(range(len(toks))) AS pos))"
VEC = "wv AS (SELECT word, [" + ", ".join(f"('0x' || substr(md5(word), {1 + 8 * i}, 8))::BIGINT / 4294967296.0::DOUBLE" for i in range(4)) + "] AS v FROM (SELECT DISTINCT token AS word FROM tk))"
IDF = "df AS (SELECT token, count(DISTINCT id) AS df FROM tk GROUP BY 1), idf AS (SELECT token, df, ln((SELECT count(DISTINCT id) FROM tk) / df) AS idf FROM df)"
SENTS = "list_filter(list_transform(string_split(regexp_replace({x}, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda s: trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda s: s <> '')"
PARAS = "list_filter(list_transform(string_split(text, chr(10)), lambda p: trim(p, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda p: p <> '')"

_KIND = "regexp_replace(lower({x}), '^[\"''(\\[]+|\\.$', '', 'g')"


def _g2(both: str, a: str, b: str, n: str) -> str:
    cells = [(both, a, b), (f"({a} - {both})", a, f"({n} - {b})"), (f"({b} - {both})", f"({n} - {a})", b), (f"({n} - {a} - {b} + {both})", f"({n} - {a})", f"({n} - {b})")]
    parts = [f"CASE WHEN {o} > 0 THEN {o} * ln({o}::DOUBLE * {n} / ({r}::DOUBLE * {c})) ELSE 0 END" for o, r, c in cells]
    return f"CASE WHEN {both}::DOUBLE * {n} > {a}::DOUBLE * {b} THEN 2 * ({' + '.join(parts)}) ELSE 0 END"


LEARNED = f"""
    wd AS (SELECT lang, {sql_words('text')} AS w FROM documents),
    tn AS (SELECT lang, w[i + 1] AS token, w[i + 2] AS following FROM wd, LATERAL (SELECT unnest(range(len(w))) AS i)),
    tt AS (SELECT lang, {_KIND.format(x='token')} AS kind, {_KIND.format(x='following')} AS following, token LIKE '%.' AS stop, regexp_matches(token, '[.!?]$') AS fin,
           regexp_matches(following, '^[\"''(\\[]*\\p{{Lu}}') AS up, regexp_matches(following, '^[\"''(\\[]*\\p{{Ll}}') AS low FROM tn),
    kn AS (SELECT lang, kind, count(*) AS n, count(*) FILTER (WHERE stop) AS n_stop FROM tt GROUP BY 1, 2),
    ks AS (SELECT lang, least(greatest(sum(n_stop) / sum(n), 1e-9), 1 - 1e-9) AS q, sum(n)::BIGINT AS tokens FROM kn GROUP BY 1),
    sc AS (SELECT lang, kind, n_stop, n - n_stop AS n_plain, length(replace(kind, '.', '')) AS m,
           2 * (n_stop * ln(0.99::DOUBLE / q) + (n - n_stop) * ln((1 - 0.99::DOUBLE) / (1 - q))) * exp(-m) * (length(kind) - m + 1) * power(m::DOUBLE, n_stop - n) AS score
           FROM kn JOIN ks USING (lang) WHERE n_stop > 0 AND regexp_matches(kind, '\\p{{L}}'))"""


def _learned_sql() -> str:
    last = f"list_extract({sql_words('s[i + 1]')}, -1)"
    return f"""
        WITH {LEARNED}, ab AS (SELECT lang, kind FROM sc WHERE score >= 0.3),
        mk AS (SELECT tt.*, coalesce(ab.kind IS NOT NULL AND stop, false) AS short FROM tt LEFT JOIN ab ON ab.lang = tt.lang AND ab.kind = tt.kind),
        en AS (SELECT lang, count(*) FILTER (WHERE fin AND NOT short AND following IS NOT NULL) AS ends FROM mk GROUP BY 1),
        op AS (SELECT lang, following, count(*) FILTER (WHERE fin AND NOT short) AS x, count(*) FILTER (WHERE low) AS low, count(*) FILTER (WHERE up AND NOT fin) AS inn
               FROM mk WHERE regexp_matches(following, '\\p{{L}}') GROUP BY 1, 2),
        oq AS (SELECT op.lang, op.following, {_g2('op.x', 'en.ends', 'kn.n', 'ks.tokens')} >= 30 AS starts, op.low > 0 AND op.inn = 0 AS ordinary
               FROM op JOIN en USING (lang) JOIN ks USING (lang) JOIN kn ON kn.lang = op.lang AND kn.kind = op.following),
        mt AS (SELECT lang, kind, following, count(*) AS x FROM mk WHERE short AND regexp_matches(following, '\\p{{L}}') GROUP BY 1, 2, 3 HAVING count(*) > 1),
        co AS (SELECT mt.lang, mt.kind, mt.following FROM mt JOIN ks USING (lang) JOIN kn a ON a.lang = mt.lang AND a.kind = mt.kind JOIN kn b ON b.lang = mt.lang AND b.kind = mt.following
               WHERE {_g2('mt.x', 'a.n', 'b.n', 'ks.tokens')} >= 7.88),
        ps AS (SELECT doc_id AS id, lang, {SENTS.format(x='text')} AS s FROM documents),
        pe AS (SELECT id, lang, i, s[i + 1] AS piece, {last} AS token, {sql_words('s[i + 2]')}[1] AS nxt FROM ps, LATERAL (SELECT unnest(range(len(s))) AS i)),
        cl AS (SELECT pe.id, pe.i, pe.piece, coalesce(token LIKE '%.' AND nxt IS NOT NULL AND ab.kind IS NOT NULL
                 AND NOT (regexp_matches(nxt, '^[\"''(\\[]*\\p{{Lu}}') AND (coalesce(oq.starts, false) OR (coalesce(oq.ordinary, false) AND (co.kind IS NULL OR coalesce(oq.starts, false))))), false) AS open
               FROM pe LEFT JOIN ab ON ab.lang = pe.lang AND ab.kind = {_KIND.format(x='token')}
               LEFT JOIN oq ON oq.lang = pe.lang AND oq.following = {_KIND.format(x='nxt')} LEFT JOIN co ON co.lang = pe.lang AND co.kind = ab.kind AND co.following = oq.following),
        gr AS (SELECT *, count(*) FILTER (WHERE NOT open) OVER (PARTITION BY id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM cl)
        SELECT id, g AS pos, string_agg(piece, ' ' ORDER BY i) AS sentence FROM gr GROUP BY id, g"""


def _dup_sql() -> str:
    x = "lower(text)"
    for a, b in X.PHRASES:
        x = f"replace({x}, '{a}', '{b}')"
    chars = X.BLANKED.replace("'", "''")
    x = f"translate({x}, '{chars}', '{' ' * len(X.BLANKED)}')"
    return f"array_to_string(list_filter({sql_words(x)}, lambda w: NOT list_contains({_STOP}, w)), '')"


_DRAW = sql_hash_int("(id || '-' || {i})", 5)

QUERIES = {
    "g01_string_functions": (g01, "SELECT page_id, upper(url) AS up, lower(trim(url)) AS low, regexp_replace(url, '^https?://', '') AS bare, translate(url, '/:', '  ') AS blanked FROM pages"),
    "g02_tokenizers": (g02, "SELECT doc_id AS id, len(string_split(regexp_replace(rtrim(lower(text), ' ' || chr(10)), '\\s', ' ', 'g'), ' '))::BIGINT AS n_tok, len(t)::BIGINT AS n_rtok, md5(array_to_string(t, '|')) AS digest FROM (SELECT *, " + sql_words("lower(text)") + " AS t FROM documents)"),
    "g03_stop_words": (g03, f"SELECT doc_id AS id, array_to_string(list_filter({sql_words('lower(text)')}, lambda w: NOT list_contains({_STOP}, w)), ' ') AS kept FROM documents"),
    "g04_vocab_tokenizer": (g04, f"""
        WITH vocab AS (SELECT word, count(*) AS idx FROM (SELECT unnest({sql_words('lower(text)')}) AS word FROM benchmark) GROUP BY 1),
        raw AS (SELECT doc_id AS id, pos, w[pos + 1] AS t0 FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents) d, LATERAL (SELECT unnest(range(len(w))) AS pos)),
        f AS (SELECT *, regexp_replace(regexp_replace(t0, '^[[:punct:]]+', ''), '[[:punct:]]+$', '') AS t1 FROM raw),
        g AS (SELECT f.*, lower(t1) AS t2, v0.idx AS i0, v1.idx AS i1, v2.idx AS i2 FROM f LEFT JOIN vocab v0 ON v0.word = t0 LEFT JOIN vocab v1 ON v1.word = t1 LEFT JOIN vocab v2 ON v2.word = lower(t1)),
        c AS (SELECT id, pos, CASE WHEN list_contains({_STOP}, t0) THEN NULL WHEN i0 IS NOT NULL THEN i0 WHEN list_contains({_STOP}, t1) THEN NULL WHEN i1 IS NOT NULL THEN i1 WHEN list_contains({_STOP}, t2) THEN NULL ELSE i2 END AS idx,
              CASE WHEN i0 IS NOT NULL THEN t0 ELSE t1 END AS token FROM g)
        SELECT id, count(*) AS n, sum(idx)::BIGINT AS idx_sum, sum(pos * length(token))::BIGINT AS pos_mass FROM c WHERE idx IS NOT NULL GROUP BY id"""),
    "g05_search_tokens": (g05, f"SELECT doc_id AS id, array_to_string({sql_tokens('text', _STOP)}, ' ') AS tokens FROM documents"),
    "g06_phrase_merge": (g06, """
        WITH b AS (SELECT list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: w <> '') AS w FROM benchmark),
        g AS (SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1])) AS phrase FROM b),
        d AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '') AS w FROM documents),
        t AS (SELECT id, unnest(w) AS t, generate_subscripts(w, 1) AS i FROM d), n AS (SELECT *, t || '_' || lead(t) OVER (PARTITION BY id ORDER BY i) AS gram FROM t),
        h AS (SELECT id, i, t, coalesce(x.phrase, y.phrase) AS hit FROM n LEFT JOIN g x ON x.phrase = gram LEFT JOIN g y ON y.phrase = lower(gram)),
        r AS (SELECT *, i - max(CASE WHEN hit IS NULL THEN i ELSE 0 END) OVER (PARTITION BY id ORDER BY i) AS nth FROM h),
        k AS (SELECT id, i, t, hit, nth % 2 = 1 AND hit IS NOT NULL AS taken FROM r), m AS (SELECT *, coalesce(lag(taken) OVER (PARTITION BY id ORDER BY i), false) AS second FROM k)
        SELECT d.id, len(w)::INT AS before, count(i) FILTER (WHERE NOT second)::INT AS after, md5(coalesce(string_agg(CASE WHEN taken THEN hit ELSE t END, ' ' ORDER BY i) FILTER (WHERE NOT second), '')) AS digest
        FROM d LEFT JOIN m USING (id) GROUP BY d.id, w"""),
    "g07_duplicate_key": (g07, f"SELECT doc_id AS id, md5({_dup_sql()}) AS key FROM documents"),
    "g08_passage_windows": (g08, f"""
        WITH p AS (SELECT doc_id, pi, {SENTS.format(x='ps[pi]')} AS s FROM (SELECT doc_id, {PARAS} AS ps FROM documents) d, LATERAL (SELECT unnest(range(1, len(ps) + 1)) AS pi)),
        w AS (SELECT doc_id, pi, gi, array_to_string(s[gi * 3 + 1 : gi * 3 + 3], ' ') AS passage FROM p, LATERAL (SELECT unnest(range(ceil(len(s) / 3.0)::INT)) AS gi))
        SELECT doc_id AS id, row_number() OVER (PARTITION BY doc_id ORDER BY pi, gi) - 1 AS pos, passage FROM w"""),
    "g09_sentence_split": (g09, f"SELECT id, pos, s[pos + 1] AS sentence FROM (SELECT doc_id AS id, {SENTS.format(x='text')} AS s FROM documents) d, LATERAL (SELECT unnest(range(len(s))) AS pos)"),
    "g09_abbreviation_scores": (g09_scores, f"WITH {LEARNED} SELECT lang, kind, n_stop, n_plain, round(score, 6) AS score FROM sc"),
    "g09_learned_sentences": (g09_learned, _learned_sql()),
    "g10_joined_fields": (g10, "SELECT doc_id AS id, source || '[SEP]' || lang || '[SEP]' || text AS joined FROM documents"),
    "g11_paragraphs": (g11, f"SELECT id, pos, md5(p[1]) AS first_digest, p[pos + 1] AS paragraph FROM (SELECT doc_id AS id, {PARAS} AS p FROM documents) d, LATERAL (SELECT unnest(range(len(p))) AS pos)"),
    "g12_word_deletion": (g12, f"""
        WITH t AS (SELECT conv_id * 1000 + turn AS id, {sql_words('text')} AS w FROM conversations),
        x AS (SELECT id, len(w) AS n, i, w[i + 1] AS word, {_DRAW.format(i='i')} AS h FROM t, LATERAL (SELECT unnest(range(len(w))) AS i)),
        k AS (SELECT id, string_agg(word, ' ' ORDER BY i) FILTER (WHERE h % 1000 >= 600) AS kept, arg_min(word, h * 100000 + i) AS lone FROM x GROUP BY id)
        SELECT t.id, coalesce(kept, lone, '') AS noised FROM t LEFT JOIN k USING (id)"""),
    "g13_pooled_key": (g13, "SELECT doc_id AS id, md5(lower(trim(text, ' ' || chr(10)))) AS key FROM documents"),
    "h12_bag_of_words": (h12, f"""
        WITH {TOK}, {IDF}, tf AS (SELECT id, token, count(*) AS tf FROM tk GROUP BY 1, 2),
        v AS (SELECT id, tf, CASE WHEN df > 1 THEN idf ELSE 1.0 END AS w FROM tf JOIN idf USING (token))
        SELECT id, count(*) AS terms, round(sum(tf * w), 6) AS tfidf, round(sum(w), 6) AS binary FROM v GROUP BY id"""),
    "h13_idf": (h13, f"WITH {TOK}, {IDF} SELECT token, df, round(idf, 6) AS idf FROM idf"),
    "h14_word_vector_sentences": (h14, f"WITH {TOK}, {VEC} SELECT id, " + ", ".join(f"round(avg(v[{i + 1}]), 6) AS x{i}" for i in range(4)) + " FROM tk JOIN wv ON word = token GROUP BY id"),
    "i07_pooling": (i07, f"WITH {TOK}, {VEC} SELECT id, " + ", ".join(
        [f"round(arg_min(v[{i + 1}], pos), 6) AS x{i}" for i in range(4)] + [f"round(max(v[{i + 1}]), 6) AS x{4 + i}" for i in range(4)]
        + [f"round(avg(v[{i + 1}]), 6) AS x{8 + i}" for i in range(4)] + [f"round(sum(v[{i + 1}]) / sqrt(count(*)), 6) AS x{12 + i}" for i in range(4)])
        + " FROM tk JOIN wv ON word = token GROUP BY id"),
    "i08_token_weighting": (i08, f"WITH {TOK}, {VEC}, {IDF} SELECT id, " + ", ".join(f"round(sum(v[{i + 1}] * idf) / greatest(sum(idf), 1e-9), 6) AS x{i}" for i in range(4)) + " FROM tk JOIN wv ON word = token JOIN idf USING (token) GROUP BY id"),
}
