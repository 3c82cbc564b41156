"""Vector search: exact, mined pairs, approximate, and model application."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from ..session import cut_lineage
from . import blocks as B
from .prefix import RANK_LIMIT, first_n, global_row_number


def top_k(df: DataFrame, by: str | list[str], score: str, id: str, k: int, rank: str = "rank") -> DataFrame:
    """Best ``k`` rows per group, score descending, ties to the lower id.

    Up to ``RANK_LIMIT`` Spark trims each group to ``k`` rows per task before the shuffle, so a hot group stays small.
    For a larger ``k`` the rank is a position in a global order, and no group is gathered in one task.
    """
    keys = [by] if isinstance(by, str) else list(by)
    order = [F.col(score).desc(), F.col(id).asc()]
    if k > RANK_LIMIT:
        return global_row_number(df, order, rank, by=keys).where(F.col(rank) <= k)
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("bigint")).where(F.col(rank) <= k)


def semantic_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    score: str = "cos",
    exclude_self: bool = False,
    id: str = "id",
    vector: str = "embedding",
) -> DataFrame:
    """Exact top-k per query: ``(query_id, corpus_id, score, rank)``.

    A query side of checked size is broadcast and the corpus is read once. A larger one goes through the block product.
    """
    small = B.small_matrix(queries, id, vector, k)
    if small is not None:
        hits = B.broadcast_topk(small, corpus, id, vector, k, score, exclude_self)
    else:
        hits = block_search(queries, corpus, k, score, exclude_self, id, vector)
    return top_k(hits, "query_id", "score", "corpus_id", k)


def block_search(queries, corpus, k, score="cos", exclude_self=False, id="id", vector="embedding") -> DataFrame:
    left = B.pack(queries, id, vector)
    right = left if queries is corpus else B.pack(corpus, id, vector)
    extra = 1 if exclude_self else 0

    def kernel():
        return B.TopK(k + extra, score, both=False)

    hits = B.product(left, right, kernel, B.HITS)
    return hits.where(F.col("query_id") != F.col("corpus_id")) if exclude_self else hits


def neighbours(emb: DataFrame, k: int, score: str = "cos", id: str = "id", vector: str = "embedding") -> DataFrame:
    """Top-k other rows of each row of one table."""
    packed = B.pack(emb, id, vector)
    hits = B.product(packed, None, lambda: B.TopK(k, score, both=True), B.HITS)
    return top_k(hits, "query_id", "score", "corpus_id", k)


def paraphrase_mining(
    emb: DataFrame,
    k: int = 100,
    max_pairs: int | None = None,
    score: str = "cos",
    id: str = "id",
    vector: str = "embedding",
    hits: DataFrame | None = None,
) -> DataFrame:
    """Pairs ``(score, id1, id2)`` in which either row is among the other's ``k`` nearest; best ``max_pairs``.

    The nearest are found by comparing all pairs, or are the ``hits`` of an approximate search that the caller ran.
    """
    found = neighbours(emb, k, score, id, vector) if hits is None else hits.where("query_id <> corpus_id")
    hits = found.where(F.col("score") > -1)
    pairs = hits.groupBy(
        F.least("query_id", "corpus_id").alias("id1"), F.greatest("query_id", "corpus_id").alias("id2")
    ).agg(F.max("score").alias("score"))
    pairs = pairs.select("score", "id1", "id2")
    if max_pairs is None:
        return pairs
    return first_n(pairs, [F.col("score").desc(), F.col("id1").asc(), F.col("id2").asc()], max_pairs)


def near_duplicates(pairs: DataFrame, below: float = 0.99) -> DataFrame:
    """Mined pairs under a cut: close, but not copies."""
    return pairs.where(F.col("score") < below)


def kmeans(emb: DataFrame, k: int, seed: int = 0, id: str = "id", vector: str = "embedding", max_iter: int = 20):
    """``(id, cluster)`` plus the fitted model."""
    data = emb.select(id, array_to_vector(V.as_double(vector)).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster").fit(data)
    return model.transform(data).select(id, "cluster"), model


def ivf_search(
    queries: DataFrame,
    corpus: DataFrame,
    n_clusters: int,
    n_probe: int = 3,
    k: int = 10,
    seed: int = 0,
    id: str = "id",
    vector: str = "embedding",
    chunk_rows: int = 2048,
) -> DataFrame:
    """Inverted-list search: each query is compared with the rows of its ``n_probe`` nearest clusters only.

    A cluster is cut into chunks of rows and a query visits every chunk, so a cluster holding a third of the corpus is
    spread over many tasks.
    """
    unit = lambda df: df.select(F.col(id).cast("bigint").alias("id"), V.l2_normalize(vector).alias("embedding"))
    corpus, queries = unit(corpus), unit(queries)
    data = corpus.withColumn("features", array_to_vector("embedding"))
    model = KMeans(k=n_clusters, seed=seed, predictionCol="cluster").fit(data)
    assigned = model.transform(data).drop("features")
    centers = np.array(model.clusterCenters())  # n_clusters x d
    sizes = assigned.groupBy("cluster").count()
    chunks = sizes.select("cluster", B.chunk_count(F.col("count"), chunk_rows, centers.shape[1]).alias("chunks"))
    lists = (
        assigned.join(F.broadcast(chunks), "cluster")  # one row per cluster
        .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
        .select("cluster", "chunk", "id", "embedding")
    )
    probe_schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
         T.StructField("cluster", T.IntegerType())]
    )
    half_norm = 0.5 * np.einsum("ij,ij->i", centers, centers)
    probes = min(n_probe, len(centers))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            near = np.argsort(half_norm - np.vstack(pdf["embedding"]) @ centers.T, axis=1, kind="stable")[:, :probes]
            out = pdf.loc[np.repeat(pdf.index, probes)].reset_index(drop=True)
            out["cluster"] = near.reshape(-1).astype("int32")
            yield out

    near = queries.mapInPandas(probe, probe_schema)
    # Queries that share a list are cut into slices, so that one popular list is no single task. They are counted before
    # they are copied to the chunks of the list.
    q_slices = near.groupBy("cluster").agg(B.chunk_count(F.count("*"), chunk_rows, centers.shape[1]).alias("slices"))
    wanted = (
        near
        .join(F.broadcast(chunks), "cluster")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select("cluster", "chunk", F.pmod(F.xxhash64("id"), F.lit(1 << 20)).alias("spread"), "id", "embedding")
    )
    wanted = wanted.join(F.broadcast(q_slices), "cluster").withColumn(
        "slice", F.pmod(F.col("spread"), F.col("slices")).cast("int")
    )
    lists = lists.join(F.broadcast(q_slices), "cluster").withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    )

    keys = ["cluster", "chunk", "slice"]
    wanted, lists = wanted.select(*keys, "id", "embedding"), lists.select(*keys, "id", "embedding")
    hits = wanted.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInPandas(lambda a, b: B.best_pairs(a, b, k), B.HITS)
    return top_k(hits, "query_id", "score", "corpus_id", k)


DENSE = 0.5  # share of all pairs in buckets from which blocks are multiplied: a bucket's pairs are scored in double


class SharedBuckets(B.TopK):
    """Top lists among the pairs of rows that share a bucket of any table."""

    def __init__(self, k: int, codes: Callable[[np.ndarray], np.ndarray]):
        super().__init__(k, "cos", both=False)
        self.codes = codes

    def load(self, block):
        block = super().load(block)
        codes = self.codes(block.mat)
        block.extra["codes"] = codes.astype(np.min_scalar_type(int(codes.max(initial=0))))
        return block

    def pair(self, left, right, same):
        rough, tol = B.rough_scores(left, right)
        a, b = left.extra["codes"], right.extra["codes"]
        floor = self.best("l", left).floor
        # Rows with a full list: only pairs that can still enter it are looked up.
        i, j = np.nonzero(rough >= np.where(np.isfinite(floor), floor - tol, np.inf)[:, None])
        step = max(1, B.SLICE_SCORES // a.shape[1])
        for lo in range(0, len(i), step):
            x, y = i[lo : lo + step], j[lo : lo + step]
            apart = ~(a[x] == b[y]).any(axis=1)
            rough[x[apart], y[apart]] = -np.inf
        fresh, step = np.flatnonzero(~np.isfinite(floor)), max(1, B.SLICE_SCORES // max(len(b), 1))
        for lo in range(0, len(fresh), step):
            rows = fresh[lo : lo + step]
            shared = np.zeros((len(rows), len(b)), dtype=bool)
            for t in range(a.shape[1]):
                shared |= a[rows, t][:, None] == b[:, t][None, :]
            rough[rows] = np.where(shared, rough[rows], -np.inf)
        self.merge("l", left, right, rough, tol)
        return ()


def lsh_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    tables: int = 8,
    bits: int = 6,
    seed: int = 0,
    id: str = "id",
    vector: str = "embedding",
    chunk_rows: int = 2048,
) -> DataFrame:
    """Approximate search by sign random projection: rows that share a bucket in any table are compared exactly.

    Bucket keys are equi-joined in chunks (see :func:`ivf_search`); the cosine is computed in double for candidates. Each row is
    copied to its bucket in every table, so where the buckets together hold more than ``DENSE`` of all pairs (they are counted
    first), blocks of rows are multiplied instead and only pairs that share a bucket are kept: the same hits.
    """
    usable = lambda df: df.where(F.col(vector).isNotNull() & F.col(id).isNotNull())
    first = usable(corpus).select(F.size(vector)).head()
    if first is None:
        return top_k(queries.sparkSession.createDataFrame([], B.HITS), "query_id", "score", "corpus_id", k)
    dim = first[0]
    planes = np.random.default_rng(seed).standard_normal((tables, bits, dim))

    def codes(mat: np.ndarray) -> np.ndarray:
        """Bucket of every row (unit vectors) in every table."""
        return (np.einsum("tbd,nd->ntb", planes, mat) >= 0) @ (1 << np.arange(bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = codes(B.prepare(B.list_matrix(batch.column("vec")), "cos")) + (np.arange(tables) << bits)
                bucket, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), pa.array(n, pa.int64())], ["bucket", "n"])

    def counted(df: DataFrame, name: str) -> DataFrame:
        return usable(df).select(F.col(vector).alias("vec")).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias(name))

    # tables * 2^bits rows at most
    met = cut_lineage(counted(corpus, "rows").join(counted(queries, "asked"), "bucket"))
    pairs = met.agg(F.sum(F.col("rows").cast("double") * F.col("asked"))).head()[0] or 0.0
    distinct = lambda df: usable(df).agg(F.count(F.lit(1)), F.countDistinct(F.col(id).cast("bigint"))).head()
    (n_corpus, ids), (n_queries, asked) = distinct(corpus), distinct(queries)
    if pairs >= DENSE * n_corpus * n_queries and ids == n_corpus and asked == n_queries:
        left = B.pack(queries, id, vector)
        right = left if queries is corpus else B.pack(corpus, id, vector)
        hits = B.product(left, right, lambda: SharedBuckets(k, codes), B.HITS)
        return top_k(hits, "query_id", "score", "corpus_id", k)

    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
         T.StructField("bucket", T.LongType())]
    )

    def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            keys = codes(np.vstack(pdf["embedding"])) + (np.arange(tables) << bits)
            out = pdf.loc[np.repeat(pdf.index, tables)].reset_index(drop=True)
            out["bucket"] = keys.reshape(-1).astype("int64")
            yield out

    def unit(df):
        rows = usable(df).select(F.col(id).cast("bigint").alias("id"), V.l2_normalize(vector).alias("embedding"))
        return rows.mapInPandas(signatures, schema)

    q, c = unit(queries), unit(corpus)
    size = lambda n: B.chunk_count(F.col(n), chunk_rows, dim)
    grid = F.broadcast(met.select("bucket", size("rows").alias("chunks"), size("asked").alias("slices")))
    spread = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    c = c.join(grid, "bucket").withColumn("chunk", spread("chunks"))
    c = c.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    q = q.join(grid, "bucket").withColumn("slice", spread("slices"))
    q = q.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

    keys = ["bucket", "chunk", "slice"]
    q, c = q.select(*keys, "id", "embedding"), c.select(*keys, "id", "embedding")
    hits = q.groupBy(*keys).cogroup(c.groupBy(*keys)).applyInPandas(lambda a, b: B.best_pairs(a, b, k), B.HITS)
    hits = hits.groupBy("query_id", "corpus_id").agg(F.max("score").alias("score"))
    return top_k(hits, "query_id", "score", "corpus_id", k)


def ann_recall(ann: DataFrame, exact: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(query_id, hits, expected, recall)`` and the missed exact hits."""
    found = ann.select("query_id", "corpus_id").distinct().withColumn("found", F.lit(1))
    marked = exact.join(found, ["query_id", "corpus_id"], "left")
    per_query = marked.groupBy("query_id").agg(
        F.count("found").alias("hits"), F.count(F.lit(1)).alias("expected")
    )
    report = per_query.withColumn("recall", F.col("hits") / F.col("expected"))
    return report, exact.join(ann.select("query_id", "corpus_id"), ["query_id", "corpus_id"], "left_anti")


def zero_shot_classify(items: DataFrame, labels: DataFrame, id: str = "id", vector: str = "embedding") -> DataFrame:
    """``(id, label, score)``: the label vector with the highest cosine, ties to the lower label id."""
    small = B.small_matrix(labels, id, vector, 1)
    if small is None:
        best = top_k(block_search(items, labels, 1, "cos", False, id, vector), "query_id", "score", "corpus_id", 1)
        return best.select(F.col("query_id").alias("id"), F.col("corpus_id").alias("label"), "score")
    shared = items.sparkSession.sparkContext.broadcast(small)
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("label", T.LongType()), T.StructField("score", T.DoubleType())]
    )
    arrow = B.arrow_schema(schema)

    def run(batches):
        ids, mat = shared.value
        mat = B.prepare(mat, "cos")
        for batch in batches:
            if batch.num_rows and len(ids):
                s = B.scores(B.prepare(B.list_matrix(batch.column("vec")), "cos"), mat)
                best = s.argmax(axis=1)
                yield B.to_batch([batch.column("id").to_numpy(), ids[best], s[np.arange(len(s)), best]], arrow)

    rows = items.where(F.col(vector).isNotNull()).select(F.col(id).cast("bigint").alias("id"), F.col(vector).alias("vec"))
    return rows.mapInArrow(run, schema)


def rerank(
    hits: DataFrame, score: Column | Callable[[pd.Series, pd.Series], pd.Series], k: int = 10,
    query_text: str = "query_text", corpus_text: str = "corpus_text",
) -> DataFrame:
    """Rescores ``(query, passage)`` rows and keeps the new top-k. ``score`` is a Column or a batch function."""
    if callable(score) and not isinstance(score, Column):
        score = F.pandas_udf(score, "double")(F.col(query_text), F.col(corpus_text))
    rescored = hits.withColumn("rerank_score", F.round(score, B.SCORE_DECIMALS))
    return top_k(rescored, "query_id", "rerank_score", "corpus_id", k, "rerank_rank")


def encode(
    df: DataFrame,
    text: str,
    make_encoder: Callable[[], Callable[[list[str]], np.ndarray]],
    batch_size: int = 32,
    normalize: bool = False,
    output: str = "embedding",
) -> DataFrame:
    """Adds a vector per row from a user model. The model is made once per task, not per batch.

    Inside a task long texts come first, so that a batch holds texts of similar length. Row identity is the id column,
    so no order has to be restored. Partitions are the chunks a process pool would have worked on.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.ArrayType(T.FloatType()))])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_encoder()
        for pdf in frames:
            if not len(pdf):
                continue
            texts = pdf[text].fillna("").tolist()
            parts = [np.asarray(model(texts[i : i + batch_size])) for i in range(0, len(texts), batch_size)]
            mat = np.vstack(parts).astype(np.float64)
            if normalize:
                mat = B.prepare(mat, "cos")
            out = pdf.copy()
            out[output] = list(mat.astype(np.float32))
            yield out

    return df.sortWithinPartitions(F.length(text).desc_nulls_last()).mapInPandas(run, schema)


def encode_distinct(
    df: DataFrame, text: str, make_encoder: Callable[[], Callable[[list[str]], np.ndarray]], batch_size: int = 32, normalize: bool = False,
    output: str = "embedding",
) -> DataFrame:
    """Like :func:`encode`, but the model sees every distinct text once. The joins move 32-byte digests, not texts."""
    keyed = df.withColumn("__d", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    once = keyed.groupBy("__d").agg(F.first(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    return keyed.join(encode(once, "__t", make_encoder, batch_size, normalize, output).drop("__t"), "__d").drop("__d")


def nested_hits(hits: DataFrame) -> DataFrame:
    """``(query_id, hits)``: a query's list in rank order as one value of at most k entries."""
    entry = F.struct("rank", "corpus_id", "score")
    return hits.groupBy("query_id").agg(F.array_sort(F.collect_list(entry)).alias("hits"))


def encode_tokens(
    df: DataFrame, id: str, text: str, make_encoder: Callable[[], Callable[[list[str]], list[np.ndarray]]],
    batch_size: int = 32,
) -> DataFrame:
    """Per-token output ``(id, pos, vector)``: the model returns one unpadded matrix per text."""
    schema = T.StructType(
        [df.schema[id], T.StructField("pos", T.LongType()), T.StructField("vector", T.ArrayType(T.FloatType()))]
    )

    def run(frames):
        model = make_encoder()
        for pdf in frames:
            texts = pdf[text].fillna("").tolist()
            for i in range(0, len(texts), batch_size):
                for key, mat in zip(pdf[id].iloc[i : i + batch_size], model(texts[i : i + batch_size])):
                    mat = np.asarray(mat, dtype=np.float32)
                    if len(mat):
                        yield pd.DataFrame({id: key, "pos": np.arange(len(mat)), "vector": list(mat)})

    return df.select(id, text).sortWithinPartitions(F.length(text).desc_nulls_last()).mapInPandas(run, schema)


def predict_pairs(
    df: DataFrame,
    a: str,
    b: str,
    make_scorer: Callable[[], Callable[[list[str], list[str]], np.ndarray]],
    num_outputs: int = 1,
    activation: Callable[[np.ndarray], np.ndarray] | None = None,
    softmax: bool = False,
    output: str = "score",
) -> DataFrame:
    """Scores text pairs with a user model: sigmoid by default for one output, identity for several."""
    kind = T.DoubleType() if num_outputs == 1 else T.ArrayType(T.DoubleType())
    schema = T.StructType([*df.schema.fields, T.StructField(output, kind)])

    def run(frames):
        model = make_scorer()
        for pdf in frames:
            if not len(pdf):
                continue
            raw = np.asarray(model(pdf[a].fillna("").tolist(), pdf[b].fillna("").tolist()), dtype=np.float64)
            raw = raw.reshape(len(pdf), num_outputs)
            if activation is not None:
                raw = activation(raw)
            elif num_outputs == 1:
                raw = 1.0 / (1.0 + np.exp(-raw))
            if softmax and num_outputs > 1:
                e = np.exp(raw - raw.max(axis=1, keepdims=True))
                raw = e / e.sum(axis=1, keepdims=True)
            out = pdf.copy()
            out[output] = raw[:, 0] if num_outputs == 1 else list(raw)
            yield out

    return df.mapInPandas(run, schema)


def centroids(emb: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per label ``(id, embedding)``; partial sums are taken before the shuffle."""
    rows = emb.select(F.col(label).cast("bigint").alias("id"), array_to_vector(V.as_double(vector)).alias("v"))
    means = rows.groupBy("id").agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select("id", vector_to_array("m").alias("embedding"))


def score_matrix(left: DataFrame, right: DataFrame, score: str = "cos", id: str = "id", vector: str = "embedding"):
    """``(left_id, right_id, score)`` for every pair of a small left table and a right table.

    The result is as large as the product by definition; the left side is size-checked or cut into blocks.
    """
    schema = T.StructType(
        [T.StructField("left_id", T.LongType()), T.StructField("right_id", T.LongType()),
         T.StructField("score", T.DoubleType())]
    )

    class Full(B.Kernel):
        def load(self, block):
            return B.Block(block.piece, block.ids, B.prepare(block.mat, score), block.extra)

        def pair(self, l, r, same):
            s = B.scores(l.mat, r.mat)
            yield [np.repeat(l.ids, len(r.ids)), np.tile(r.ids, len(l.ids)), s.ravel()]

    return B.product(
        B.pack(left, id, vector), B.pack(right, id, vector), Full, schema
    )


def distance_matrix(emb: DataFrame, other: DataFrame, squared: bool = False, id: str = "id", vector: str = "embedding"):
    """Euclidean ``(left_id, right_id, distance)`` from dot products, clamped at zero before the root."""
    schema = T.StructType(
        [T.StructField("left_id", T.LongType()), T.StructField("right_id", T.LongType()),
         T.StructField("distance", T.DoubleType())]
    )

    class Distance(B.Kernel):
        def load(self, block):
            return B.Block(block.piece, block.ids, block.mat.astype(np.float64), block.extra)

        def pair(self, l, r, same):
            yield [np.repeat(l.ids, len(r.ids)), np.tile(r.ids, len(l.ids)), distances(l.mat, r.mat, squared).ravel()]

    return B.product(
        B.pack(emb, id, vector), B.pack(other, id, vector), Distance, schema
    )


def distances(a: np.ndarray, b: np.ndarray, squared: bool = False) -> np.ndarray:
    d = np.einsum("ij,ij->i", a, a)[:, None] - 2.0 * (a @ b.T) + np.einsum("ij,ij->i", b, b)[None, :]
    d = np.maximum(d, 0.0)
    return d if squared else np.sqrt(d)


def score_candidates(emb: DataFrame, candidates: DataFrame, id: str = "id", vector: str = "embedding") -> DataFrame:
    """``(id1, id2, score)``: the exact cosine of every different unordered pair of ``candidates(query_id, corpus_id)``.

    Candidates are hits of :func:`lsh_search` or :func:`ivf_search`, or come from any other join. Pairs of a row with
    itself and pairs with an unknown id or a null vector drop out.
    """
    pairs = candidates.select(F.least("query_id", "corpus_id").alias("id1"), F.greatest("query_id", "corpus_id").alias("id2"))
    pairs = pairs.where("id1 < id2").distinct()
    rows = emb.where(F.col(vector).isNotNull()).select(F.col(id).cast("bigint").alias("id1"), F.col(vector).alias("__a"))
    both = pairs.join(rows, "id1").join(rows.toDF("id2", "__b"), "id2")
    return both.select("id1", "id2", F.round(V.cosine("__a", "__b"), 9).alias("score"))


def similarity_join(emb: DataFrame, threshold: float, id: str = "id", vector: str = "embedding", candidates: DataFrame | None = None) -> DataFrame:
    """Unordered pairs ``(id1, id2, score)`` with cosine at or above the threshold: the result set itself, no more.

    All pairs are compared, or only ``candidates`` (see :func:`score_candidates`) where the caller names some: a corpus
    too large for all pairs is joined at the recall of its candidates.
    """
    if candidates is not None:
        return score_candidates(emb, candidates, id, vector).where(F.col("score") >= threshold)
    schema = T.StructType(
        [T.StructField("id1", T.LongType()), T.StructField("id2", T.LongType()), T.StructField("score", T.DoubleType())]
    )

    class Above(B.Kernel):
        def load(self, block):
            return B.Block(block.piece, block.ids, B.prepare(block.mat, "cos"), block.extra)

        def pair(self, l, r, same):
            keep = B.at_least(l, r, threshold)
            if same:
                keep &= l.ids[:, None] < r.ids[None, :]
            i, j = np.nonzero(keep)
            a, b = l.ids[i], r.ids[j]
            yield [np.minimum(a, b), np.maximum(a, b), B.pair_scores(l, r, i, j)]

    return B.product(B.pack(emb, id, vector), None, Above, schema)
