"""Bags of words, idf, word-vector sentences, pooling and BM25."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vectors as V
from ..session import cut_lineage
from . import blocks as B
from .maxscore import SLICE_TEXTS, block_max_search
from .search import top_k


def idf(tokens: DataFrame, id: str = "id", token: str = "token", n_docs: DataFrame | None = None) -> DataFrame:
    """``(token, df, idf)`` with ``idf = ln(N / df)``.

    ``n_docs`` is a one-row table ``(n)``; by default the number of ids that have a token.
    """
    n = n_docs if n_docs is not None else tokens.agg(F.countDistinct(id).alias("n"))
    # Counting distinct (id, token) rows first keeps a frequent token from being one task's work.
    df = tokens.select(id, token).distinct().groupBy(token).agg(F.count(F.lit(1)).alias("df"))
    one = F.broadcast(n.select(F.col("n"), F.lit(1).alias("__k")))  # a single row
    return df.withColumn("__k", F.lit(1)).join(one, "__k").select(
        F.col(token).alias("token"), "df", F.log(F.col("n") / F.col("df")).alias("idf"))


BROADCAST_WORDS = 1_000_000  # rows of a table of words that may be shipped to every task


def join_words(
    rows: DataFrame, words: DataFrame, how: str = "inner", token: str = "token", most: int | None = None, frequency: str | None = None,
) -> DataFrame:
    """``rows`` joined (``inner`` or ``left``) with a table of words, both by ``token``.

    A table counted to have at most ``most`` rows is broadcast, so that the rows stay where they are. Of a larger one the words
    that are most frequent in the rows are broadcast, and only the rows of the rare words are shuffled. ``frequency`` names a column
    of ``words`` that says in how many rows a word is, so that they are not counted here; it is not in the result.
    """
    most = BROADCAST_WORDS if most is None else most
    words = cut_lineage(words)
    counts = words.select(token, F.col(frequency).alias("__n")) if frequency else None
    words = words.drop(frequency) if frequency else words
    if words.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(words), token, how)
    if counts is None:
        counts = cut_lineage(rows.where(F.col(token).isNotNull()).groupBy(token).agg(F.count(F.lit(1)).alias("__n")))
    scale = F.floor(F.log2("__n")).cast("int")
    steps = {r[0]: r[1] for r in counts.groupBy(scale.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per power of two
    least, held = 63, 0
    while least > 0 and held + steps.get(least - 1, 0) <= most:
        least -= 1
        held += steps.get(least, 0)
    frequent = cut_lineage(counts.where(scale >= least).select(token))
    # Frequent words that the table lacks are listed too, so that they are not shuffled either.
    listed = cut_lineage(frequent.join(words, token, how))
    many = rows.join(F.broadcast(frequent), token, "left_semi").join(F.broadcast(listed), token, how)
    few = rows.join(F.broadcast(frequent), token, "left_anti").join(words, token, how)
    return many.unionByName(few)


def bow(
    tokens: DataFrame, weights: DataFrame | None = None, cumulative: bool | dict[str, bool] = True, unknown: float = 1.0,
    id: str = "id", token: str = "token",
) -> DataFrame:
    """``(id, token, value)``: sparse bag of words. Each occurrence adds the token's weight, or sets it once.

    Both bags come from one pass where ``cumulative`` names a column for each. ``weights(token, weight)`` may have a ``df``,
    the texts that hold the token.
    """
    counts = tokens.groupBy(id, token).agg(F.count(F.lit(1)).alias("tf"))
    if weights is not None:
        known = "df" if "df" in weights.columns else None
        words = weights.select(F.col("token").alias(token), "weight", *([known] if known else []))
        counts = join_words(counts, words, "left", token, frequency=known)
        w = F.coalesce(F.col("weight"), F.lit(float(unknown)))
    else:
        w = F.lit(float(unknown))
    names = cumulative if isinstance(cumulative, dict) else {"value": cumulative}
    return counts.select(id, token, *[(F.col("tf") * w if c else w).cast("double").alias(name) for name, c in names.items()])


MOST_COLUMNS = 64  # the most elements of a vector that are added up as columns of their own


def _over_elements(aggregate, column: str, width: int):
    return F.array(*[aggregate(F.get(column, F.lit(i))) for i in range(width)])


def pool_tokens(
    tokens: DataFrame, id: str = "id", pos: str = "pos", vector: str = "vector", modes: Sequence[str] = ("mean",),
    weight: str | None = None, width: int | None = None,
) -> DataFrame:
    """``(id, embedding)``: pooled token vectors, the chosen parts concatenated in the order cls, max, mean, sqrt.

    Vector aggregates with map-side partial sums: a text of any length is never gathered. With ``weight`` every token
    vector is scaled first and the mean divides by the weight sum (floor 1e-9). With ``width``, the number of elements, up to
    64 of them are columns of their own: numbers are aggregated by hash, whole vectors only by sorting all tokens.
    """
    if set(modes) - {"cls", "max", "mean", "sqrt"}:
        raise ValueError(f"unknown pooling modes {modes}")
    vec = V.as_double(vector)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    scaled = F.transform(vec, lambda x: x * w) if weight else vec
    rows = tokens.select(F.col(id).alias("id"), F.col(pos).alias("pos"), w.alias("w"), vec.alias("raw"), scaled.alias("v"))
    wanted, width = [], width if width and width <= MOST_COLUMNS else 0
    if {"mean", "sqrt"} & set(modes):
        wanted += [_over_elements(F.sum, "v", width).alias("s") if width else Summarizer.sum(F.col("v")).alias("s"),
                   F.greatest(F.sum("w"), F.lit(1e-9)).alias("mass")]
    if "max" in modes:
        wanted.append(_over_elements(F.max, "v", width).alias("max") if width else Summarizer.max(F.col("v")).alias("max"))
    if "cls" in modes:
        first = F.when(F.min_by(F.col("raw").isNotNull(), "pos"), _over_elements(lambda x: F.min_by(x, "pos"), "raw", width)) if width else F.min_by("raw", "pos")
        wanted.append(first.alias("cls"))
    if width:
        rows = rows.withColumn("v", F.when(F.size("v") == width, F.col("v")).when(F.col("v").isNotNull(), F.raise_error(F.lit("vectors of different length")).cast("array<double>")))
    else:
        rows = rows.withColumn("v", array_to_vector("v"))
    pooled = rows.groupBy("id").agg(*wanted)
    whole = (lambda c: F.col(c)) if width else vector_to_array
    parts = {
        "cls": lambda: F.col("cls"),
        "max": lambda: whole("max"),
        "mean": lambda: F.transform(whole("s"), lambda x: x / F.col("mass")),
        "sqrt": lambda: F.transform(whole("s"), lambda x: x / F.sqrt("mass")),
    }
    return pooled.select(F.col("id").alias(id), F.concat(*[parts[m]() for m in parts if m in modes]).alias("embedding"))


def average_word_vectors(
    tokens: DataFrame, vectors: DataFrame, weights: DataFrame | None = None, modes: Sequence[str] = ("mean",),
    id: str = "id", unknown: float = 1.0, broadcast_words: int | None = None,
) -> DataFrame:
    """Sentence vectors from ``tokens(id, pos, token)`` and ``vectors(word, vector)``, weighted by ``(token, weight)``.

    Repeated words of a text are counted before the vectors are joined on. Tokens that are dealt by ``id`` already are
    not shuffled again, apart from those of rare words where there are too many words to broadcast (see :func:`join_words`).
    """
    words = vectors.withColumnRenamed("word", "token")
    if weights is not None:
        words = words.join(weights.select("token", "weight"), "token", "left")
    words = cut_lineage(words)
    first = words.where(F.col("vector").isNotNull()).select(F.size("vector")).head()
    width = first[0] if first else None
    if "cls" not in modes:
        tokens = tokens.groupBy(id, "token").agg(F.min("pos").alias("pos"), F.count(F.lit(1)).alias("tf"))
    rows = join_words(tokens, words, most=broadcast_words)
    rows = rows.withColumn("weight", F.lit(1.0) if weights is None else F.coalesce("weight", F.lit(float(unknown))))
    if "cls" in modes or "max" in modes:
        if "tf" in rows.columns:  # max and sums need each occurrence once with its own weight
            rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("tf").cast("int"))))
        return pool_tokens(rows, id, "pos", "vector", modes, "weight", width)
    return pool_tokens(rows.withColumn("weight", F.col("weight") * F.col("tf")), id, "pos", "vector", modes, "weight", width)


BROADCAST_TERMS = 1_000_000  # query words that may be shipped to every task
WEIGHT_BYTES = 64 << 20  # one dense word x query weight matrix


def bm25_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    k1: float = 1.5,
    b: float = 0.75,
    stop: Sequence[str] = (),
    id: str = "id",
    text: str = "text",
    broadcast_terms: int = BROADCAST_TERMS,
    slice_texts: int = SLICE_TEXTS,
) -> DataFrame:
    """``(query_id, corpus_id, score, rank)`` under BM25 with ``idf = ln(1 + (N - df + .5) / (df + .5))``.

    A repeated query word counts each time; texts without a common word are no hits. If the query words are few enough
    to broadcast (counted first), the corpus is scanned twice - for document counts and for scores - and only top lists
    are shuffled. Otherwise an inverted index with score bounds answers them, slice by slice of the texts: a pair of a query
    and a text below the query's floor is never made, however frequent the words they share.
    """
    def toks(c):
        return X.search_tokens(c, stop)

    terms = queries.select(F.col(id).cast("bigint").alias("query_id"), F.explode(toks(text)).alias("token"))
    terms = cut_lineage(terms.groupBy("query_id", "token").agg(F.count(F.lit(1)).alias("qtf")))
    docs = corpus.select(F.col(id).cast("bigint").alias("corpus_id"), toks(text).alias("toks"))
    small = terms.limit(broadcast_terms + 1).count() <= broadcast_terms
    scores = _scan_scores(terms, docs, k, k1, b) if small else _index_scores(terms, docs, k, k1, b, slice_texts)
    return top_k(scores, "query_id", "score", "corpus_id", k)


def _index_scores(terms: DataFrame, docs: DataFrame, k: int, k1: float, b: float, slice_texts: int) -> DataFrame:
    """Top lists per slice of texts from an inverted index with score bounds (see :mod:`maxscore`)."""
    docs = docs.withColumn("dl", F.size("toks"))
    texts, avgdl = docs.agg(F.count(F.lit(1)), F.avg("dl")).head()
    # Corpus words that no query holds are dropped before the shuffle. The index is read twice, so it is written once.
    postings = cut_lineage(
        docs.select("corpus_id", "dl", F.explode("toks").alias("token"))
        .join(terms.select("token").distinct(), "token", "left_semi")
        .groupBy("corpus_id", "token").agg(F.first("dl").alias("dl"), F.count(F.lit(1)).alias("tf")))
    df = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    weighted = df.select("token", F.log(1 + (F.lit(texts) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    tf = F.col("tf")
    impact = F.col("idf") * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / F.lit(avgdl or 1.0)))
    # A frequent word's postings are split by the adaptive skew join.
    impacts = postings.join(weighted, "token").select("corpus_id", "token", impact.alias("impact"))
    return block_max_search(terms, impacts, texts, k, slice_texts)


def _word_counts(toks: pa.ListArray, vocab: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, listed word) pairs as ``text * len(vocab) + word``, how often each occurs, and the text lengths."""
    size = np.diff(toks.offsets.to_numpy())
    at = pc.index_in(toks.flatten(), value_set=vocab)
    hit = at.is_valid().to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(size), dtype=np.int64), size)[hit]
    key, n = np.unique(text * len(vocab) + at.drop_null().to_numpy(), return_counts=True)
    return key, n, size


def _scan_scores(terms: DataFrame, docs: DataFrame, k: int, k1: float, b: float) -> DataFrame:
    """Partial top lists per task: word weights of the queries are broadcast, every text is scored where it is read."""
    spark = docs.sparkSession
    vocab = pa.array(sorted(r[0] for r in terms.select("token").distinct().toLocalIterator()), pa.string())
    words = spark.sparkContext.broadcast(vocab)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, df = 0, 0, np.zeros(len(words.value), dtype=np.int64)
        for batch in batches:
            key, _, size = _word_counts(batch.column("toks"), words.value)
            df += np.bincount(key % max(len(df), 1), minlength=len(df)) if len(df) else 0
            n, total = n + len(size), total + int(size.sum())
        seen = np.flatnonzero(df)
        # Entries -1 and -2 carry the number of texts and of words.
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, -2, seen]), pa.array(np.r_[n, total, df[seen]])], names=["word", "n"])

    counts = docs.select("toks").mapInArrow(count, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")).toPandas()
    counts = dict(zip(counts["word"], counts["n"]))  # at most broadcast_terms + 2 entries
    n, total = counts.pop(-1, 0), counts.pop(-2, 0)
    avgdl = total / n if n else 0.0
    idf = {vocab[int(w)].as_py(): float(np.log(1 + (n - df + 0.5) / (df + 0.5))) for w, df in counts.items()}
    table = terms.toPandas()
    table = table[table["token"].isin(idf)]
    table["w"] = table["qtf"] * table["token"].map(idf)
    groups, held, vocabulary = [], [], set()
    for query, rows in table.groupby("query_id", sort=True):
        grown = vocabulary | set(rows["token"])
        if held and 8 * len(grown) * (len(held) + 1) > WEIGHT_BYTES:
            groups.append(held)
            held, grown = [], set(rows["token"])
        held.append((query, rows))
        vocabulary = grown
    if held:
        groups.append(held)
    shared = spark.sparkContext.broadcast(
        [(np.array([q for q, _ in g], dtype=np.int64), [(r["token"].tolist(), r["w"].to_numpy()) for _, r in g]) for g in groups])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for at, (ids, rows) in enumerate(shared.value):
            vocab = pa.array(sorted({t for tokens, _ in rows for t in tokens}))
            weights = np.zeros((len(vocab), len(ids)))
            for i, (tokens, w) in enumerate(rows):
                weights[pc.index_in(pa.array(tokens), value_set=vocab).to_numpy(), i] = w
            parts.append((B.Block(at, ids, weights), vocab))
        top = B.TopK(k, "dot", both=False)
        for batch in batches:
            ids = batch.column("corpus_id").to_numpy()
            for part, vocab in parts:
                key, tf, size = _word_counts(batch.column("toks"), vocab)
                row, word = key // len(vocab), key % len(vocab)
                gain = tf * (k1 + 1) / (tf + k1 * (1 - b + b * size[row] / avgdl))
                s = np.full((len(part.ids), len(size)), -np.inf)
                edges = np.searchsorted(row, np.arange(len(size) + 1))
                for d in np.unique(row):
                    lo, hi = edges[d], edges[d + 1]
                    s[:, d] = gain[lo:hi] @ part.mat[word[lo:hi]]
                best = top.best("l", part)
                s = np.round(s, B.SCORE_DECIMALS)
                i, j = np.nonzero((s > 0) & (s >= best.floor[:, None]))
                best.add(i, s[i, j], ids[j])
        for out in top.finish():
            yield B.to_batch(out, B.arrow_schema(B.HITS))

    return docs.mapInArrow(run, B.HITS)
