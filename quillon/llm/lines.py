"""Line dedup: repeated runs of lines, found by prefix doubling over the documents' line-id sequences.

Every line that occurs more than once gets an id. A suffix (a line position) starts with the id of its line as its rank; a
doubling round ranks the pairs (rank here, rank ``2^j`` lines on) in sorted order, which is the order of the suffixes by their
first ``2^(j+1)`` lines. Suffixes of one rank form a longest-common-prefix interval of at least that many lines; a suffix whose
pair is alone shares no longer prefix with any other and takes no part in further rounds. Only DataFrame functions are used:
ranks are ``monotonically_increasing_id`` after a range sort of the distinct pairs, and need no dense numbering.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .ids import set_aside

MIN_LINES = 2
MIN_WORDS = 8
_BLANK = "' \\t\\n\\u000b\\f\\r'"
_DOC = ["k", "t"]


def _identity(docs: DataFrame, id: str, text: str) -> list[Column]:
    """``k`` and ``t`` tell documents apart and order them; a null id comes last."""
    return [F.coalesce(F.col(id).cast("bigint"), F.lit(2**63 - 1)).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("t")]


def _split(text: str) -> str:
    return f"split(coalesce(`{text}`, ''), '\\n', -1)"


def _lines(docs: DataFrame, id: str, text: str) -> DataFrame:
    """``k, t, pos, raw, h1, h2, words``: the lines with a word, numbered by ``pos``; ``raw`` counts blank lines too."""
    filled = F.expr(f"filter(transform({_split(text)}, (x, i) -> struct(btrim(x, {_BLANK}) as line, i as raw)), s -> s.line <> '')")
    out = docs.select(*_identity(docs, id, text), F.posexplode(filled).alias("pos", "s"))
    return out.select(*_DOC, "pos", "s.raw", F.xxhash64("s.line").alias("h1"), F.xxhash64(F.lit(1), "s.line").alias("h2"),
                      F.size(F.split("s.line", r"[\x20\x09-\x0D]+")).alias("words"))


def _ranked(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The classes of ``keys`` with two or more rows: ``keys, next`` (their rank) and ``first`` (their first place).

    Equal keys are merged in each task before the shuffle, so a line that a third of the corpus repeats is one row a task.
    """
    classes = rows.groupBy(*keys).agg(F.min(F.struct(*_DOC, "pos")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ordered = classes.drop("n").repartitionByRange(*keys).sortWithinPartitions(*keys)
    return cut_lineage(ordered.withColumn("next", F.monotonically_increasing_id()))


def _refined(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that share ``keys`` with others, by ``rank``, and whether they do so ``later`` than the first."""
    joined = rows.join(_ranked(rows, keys), keys).withColumn("later", F.col("first") < F.struct(*_DOC, "pos"))
    return cut_lineage(joined.drop("first", *keys).withColumnRenamed("next", "rank"))


def repeated_windows(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Windows with an earlier copy, as ``k, t, pos, raw, raw_end``: ``min_lines`` lines, or one line of ``min_words`` words.

    Every maximal repeated run of at least ``min_lines`` lines is the union of its windows of ``min_lines`` lines.
    """
    rows = _refined(_lines(docs, id, text).withColumn("raw_end", F.col("raw")), ["h1", "h2"])
    found = [rows.where("later").where((F.col("words") >= min_words) | F.lit(min_lines <= 1))]
    width = 1
    while width < min_lines:
        step = min(width, min_lines - width)  # the two prefixes overlap in the last round unless it doubles
        after = rows.select(*_DOC, (F.col("pos") - step).alias("pos"), F.col("rank").alias("rank2"), F.col("raw_end").alias("end2"))
        pairs = rows.drop("later", "words").join(after, [*_DOC, "pos"]).drop("raw_end")
        rows = _refined(pairs.withColumnsRenamed({"rank": "rank1", "end2": "raw_end"}), ["rank1", "rank2"])
        width += step
        if width == min_lines:
            found.append(rows.where("later"))
    return reduce(DataFrame.unionByName, [f.select(*_DOC, "pos", F.lit(i * (min_lines - 1) + 1).alias("n"), "raw", "raw_end") for i, f in enumerate(found)])


def line_dedup(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``text`` freed of repeated line runs, and ``n_lines, n_removed, n_runs`` (bigint) added.

    Lines are the pieces between line ends, compared without white space at their ends; lines without a word take no part. A
    line goes if it lies in a run of at least ``min_lines`` lines, or is one line of at least ``min_words`` words, that starts
    earlier in the corpus as well: at a smaller id, or in the same document. Copies are judged on the input. Blank lines
    between two removed lines go with them; the other lines are joined as they were.

    A null text has no lines and stays null. Rows that repeat an id are ordered by a hash of their text, and wholly repeated
    rows count as one document, so neither loses lines to the other. Null ids come after all others. Other columns pass
    through, whatever their names but the three added ones, which are replaced. An empty table gives an empty table.
    """
    docs = docs.drop("n_lines", "n_removed", "n_runs")
    names, docs = docs.columns, set_aside(docs, id, text)
    windows = repeated_windows(docs, min_lines, min_words, id, text)
    gone = windows.select(*_DOC, F.explode(F.when(F.col("n") == 1, F.array(F.struct("pos", "raw"))).otherwise(
        F.expr("transform(sequence(0, n - 1), i -> struct(pos + i as pos, if(i = 0, raw, if(i = n - 1, raw_end, null)) as raw))"))).alias("s"))
    gone = gone.groupBy(*_DOC, "s.pos").agg(F.max("s.raw").alias("raw"))
    in_doc = Window.partitionBy(*_DOC).orderBy("pos")  # a document's own lines
    islands = gone.withColumn("island", F.col("pos") - F.row_number().over(in_doc)).groupBy(*_DOC, "island").agg(
        F.min("raw").alias("a"), F.max("raw").alias("b"), F.count(F.lit(1)).alias("n"))
    cuts = islands.groupBy(*_DOC).agg(F.collect_list(F.struct("a", "b")).alias("__cuts"), F.sum("n").alias("n_removed"), F.count(F.lit(1)).alias("n_runs"))
    keys = ["__k", "__t"]
    cuts = cuts.withColumnsRenamed(dict(zip(_DOC, keys))).withColumnsRenamed({"n_removed": "__removed", "n_runs": "__runs"})
    k, t = _identity(docs, id, text)
    out = docs.join(cuts, (k == F.col("__k")) & (t == F.col("__t")), "left")
    kept = F.expr(f"array_join(filter({_split(text)}, (x, i) -> not exists(__cuts, c -> i between c.a and c.b)), '\n')")
    filled = F.expr(f"size(filter({_split(text)}, x -> btrim(x, {_BLANK}) <> ''))")
    return out.withColumns({
        text: F.when(F.col("__cuts").isNull(), F.col(text)).otherwise(kept), "n_lines": filled.cast("bigint"),
        "n_removed": F.coalesce("__removed", F.lit(0)).cast("bigint"), "n_runs": F.coalesce("__runs", F.lit(0)).cast("bigint"),
    }).drop("__cuts", "__removed", "__runs", *keys).toDF(*names, "n_lines", "n_removed", "n_runs")


def line_stage(docs: DataFrame) -> DataFrame:
    """The documents without repeated line runs; those that lose all their words go. Columns as they were."""
    out = line_dedup(set_aside(docs, "doc_id", "text")).where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return out.drop("n_lines", "n_removed", "n_runs").toDF(*docs.columns)


def line_query(docs: DataFrame) -> DataFrame:
    out = line_dedup(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


_ENDS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL = f"""
WITH raws AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS raw FROM documents),
l AS (SELECT doc_id, raw, trim(line, {_ENDS}) AS s, row_number() OVER (PARTITION BY doc_id ORDER BY raw) AS pos FROM raws WHERE trim(line, {_ENDS}) <> ''),
p AS (SELECT *, lead(s) OVER (PARTITION BY doc_id ORDER BY pos) AS s2 FROM l),
f AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, pos) > 1 AS later1,
             s2 IS NOT NULL AND row_number() OVER (PARTITION BY s, s2 ORDER BY doc_id, pos) > 1 AS later2 FROM p),
gone AS (SELECT doc_id, pos FROM f WHERE later1 AND len(regexp_split_to_array(s, '[\x20\x09-\x0D]+')) >= {MIN_WORDS}
         UNION SELECT doc_id, pos FROM f WHERE later2 UNION SELECT doc_id, pos + 1 FROM f WHERE later2),
cuts AS (SELECT doc_id, min(raw) AS a, max(raw) AS b, count(*) AS n FROM
         (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM gone JOIN l USING (doc_id, pos)) GROUP BY doc_id, island),
marked AS (SELECT r.doc_id, r.raw, r.line FROM raws r WHERE NOT EXISTS (SELECT 1 FROM cuts c WHERE c.doc_id = r.doc_id AND r.raw BETWEEN c.a AND c.b)),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY raw) AS text FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_lines, coalesce(c.n, 0)::BIGINT AS n_removed, coalesce(c.runs, 0) AS n_runs, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id) n USING (doc_id)
LEFT JOIN (SELECT doc_id, sum(n) AS n, count(*) AS runs FROM cuts GROUP BY doc_id) c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
