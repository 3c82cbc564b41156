"""Construction of labelled pairs, triplets, batches and splits (N).

Random picks are picks by a seeded hash, so they do not depend on partitioning and can be recomputed. Picks inside a
group go through positions in a global order (:mod:`.prefix`): a label or query that holds a third of the rows is
spread like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.hashing import hash_int, hash_key
from ..session import cut_lineage
from . import blocks as B
from .batches import no_duplicate_batches
from .graph import SMALL_EDGES, chunk_grid, components
from .lexical import bm25_search
from .prefix import first_n, global_row_number, running
from .search import distances, predict_pairs, semantic_search
from .tabular import binarize, both_directions, cap_per_key, dev_split, hash_sample


def nli_triplets(pairs: DataFrame, s1: str = "s1", s2: str = "s2", label: str = "label", seed: int = 0) -> DataFrame:
    """``(kind, anchor, positive, negative)``: per sentence with an entailment and a contradiction (both directions
    counted) one triplet that starts and one that ends with the sentence. Partners are picked by lowest hash.
    """
    rows = both_directions(pairs.select(X.strip(s1).alias("s"), X.strip(s2).alias("o"), F.col(label).alias("l")), "s", "o")

    def pick(name, n):
        h = hash_key("s", "o", seed=seed + n)
        return F.min(F.when(F.col("l") == name, F.struct(h.alias("h"), F.col("o").alias("o")))).alias(f"{name}_{n}")

    groups = rows.where(F.col("l").isin("entailment", "contradiction")).groupBy("s").agg(
        *[pick(name, n) for name in ("entailment", "contradiction") for n in (0, 1)])
    groups = groups.where(F.col("entailment_0").isNotNull() & F.col("contradiction_0").isNotNull())
    g = {n: F.col(f"{n}.o") for n in ("entailment_0", "entailment_1", "contradiction_0", "contradiction_1")}
    return groups.select(F.inline(F.array(
        F.struct(F.lit("first").alias("kind"), F.col("s").alias("anchor"), g["entailment_0"].alias("positive"), g["contradiction_0"].alias("negative")),
        F.struct(F.lit("second").alias("kind"), g["entailment_1"].alias("anchor"), F.col("s").alias("positive"), g["contradiction_1"].alias("negative")))))


def label_positions(df: DataFrame, label: str, id: str, seed: int = 0) -> DataFrame:
    """``(label, id, pos, n, start, total)``: place of each row in its label in hash order, and the label's extent."""
    keyed = df.select(F.col(label).alias("label"), F.col(id).alias("id")).where(F.col("label").isNotNull()).withColumn("h", hash_key("id", seed=seed))
    placed = global_row_number(keyed, [F.col("h").asc(), F.col("id").asc()], "pos", by=["label"])
    counts = placed.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    extent = running(counts, [F.col("label").asc()], {"upto": F.col("n")}, position="__p").select(
        "label", "n", (F.col("upto") - F.col("n")).cast("bigint").alias("start"))
    total = counts.agg(F.sum("n").alias("total")).withColumn("__k", F.lit(1))
    out = placed.join(extent, "label").withColumn("__k", F.lit(1)).join(F.broadcast(total), "__k")
    return out.select("label", "id", "pos", "n", "start", "total")


def label_triplets(df: DataFrame, label: str, id: str = "id", seed: int = 0) -> DataFrame:
    """``(anchor, positive, negative)`` ids: per row another row of its label and a row of any other label.

    Labels with one row are skipped. The positive is the next row of the label in hash order, the negative the row at
    a hashed place outside the label's range: two equi-joins on unique positions.
    """
    rows = cut_lineage(label_positions(df, label, id, seed))
    anchors = rows.where("n > 1 AND total > n").select(
        F.col("id").alias("anchor"), (F.col("start") + F.col("pos") % F.col("n") + 1).alias("p_at"),
        F.pmod(hash_int("id", seed=seed + 1), F.col("total") - F.col("n")).alias("r"), "start", "n")
    anchors = anchors.withColumn("n_at", F.when(F.col("r") < F.col("start"), F.col("r")).otherwise(F.col("r") + F.col("n")) + 1)
    at = rows.select((F.col("start") + F.col("pos")).alias("at"), F.col("id").alias("other"))
    out = anchors.join(at.select(F.col("at").alias("p_at"), F.col("other").alias("positive")), "p_at")
    return out.join(at.select(F.col("at").alias("n_at"), F.col("other").alias("negative")), "n_at").select("anchor", "positive", "negative")


def _distance(metric: str):
    if metric == "euclidean":
        return lambda a, b: np.round(distances(a, b), B.SCORE_DECIMALS)
    if metric == "cosine":
        return lambda a, b: 1.0 - B.scores(B.prepare(a, "cos"), B.prepare(b, "cos"))
    raise ValueError(metric)


HARD = T.StructType(
    [T.StructField("anchor", T.LongType()), T.StructField("positive", T.LongType()), T.StructField("p_dist", T.DoubleType()),
     T.StructField("negative", T.LongType()), T.StructField("n_dist", T.DoubleType())])


def hard_triplets(
    emb: DataFrame, label: str = "label", batch: str = "batch", mode: str = "hard", margin: float = 5.0,
    metric: str = "euclidean", id: str = "id", vector: str = "embedding", chunk_rows: int = 1024, max_batch: int = 4096,
) -> DataFrame:
    """Triplets inside a batch.

    * ``hard``: per anchor the farthest positive and the nearest negative, ``(anchor, positive, p_dist, negative,
      n_dist)``. Works on chunks, so a batch may be of any size; each chunk pair emits one row per anchor.
    * ``semi_hard``: per anchor and positive the nearest negative that is farther than the positive, or else the
      farthest negative; same columns. One row per pair of a training batch.
    * ``all``: per anchor the number of valid triplets, of those with ``p_dist - n_dist + margin > 0``, and the sum of
      that loss, ``(anchor, valid, active, loss)``. The triplets themselves, cubic in the batch, are not listed.

    The last two need a whole batch at once; a batch over ``max_batch`` rows is an error, not cut.
    """
    rows = emb.select(F.col(batch).alias("batch"), F.col(id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"),
                      F.col(vector).cast("array<double>").alias("v"))
    measure = _distance(metric)
    if mode == "hard":
        return _batch_hard(rows, measure, chunk_rows)
    sizes = rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    guard = F.when(F.col("n") <= max_batch, F.col("batch")).otherwise(F.raise_error(F.lit(f"a batch has more than {max_batch} rows")))
    rows = rows.join(sizes, "batch").withColumn("batch", guard).drop("n")
    if mode == "semi_hard":
        return rows.groupBy("batch").applyInPandas(lambda pdf: _semi_hard(pdf, measure), HARD)
    if mode == "all":
        return rows.groupBy("batch").applyInPandas(lambda pdf: _batch_all(pdf, measure, margin), "anchor bigint, valid bigint, active bigint, loss double")
    raise ValueError(mode)


def _batch_hard(rows: DataFrame, measure, chunk_rows: int) -> DataFrame:
    grid = chunk_grid(rows, ["batch"], "id", chunk_rows)

    def one_way(a, b, d):
        """Farthest positive and nearest negative of the rows of ``a`` among ``b`` (ids ascending)."""
        same = a["label"].to_numpy()[:, None] == b["label"].to_numpy()[None, :]
        ids = b["id"].to_numpy()
        pos = same & (a["id"].to_numpy()[:, None] != ids[None, :])
        far, near = np.where(pos, d, -np.inf), np.where(~same, d, np.inf)
        i, j, at = far.argmax(1), near.argmin(1), np.arange(len(a))
        has_p, has_n = pos.any(1), (~same).any(1)
        return pd.DataFrame({
            "anchor": a["id"].to_numpy(), "positive": pd.Series(ids[i], dtype="Int64").where(has_p).array,
            "p_dist": np.where(has_p, far[at, i], np.nan), "negative": pd.Series(ids[j], dtype="Int64").where(has_n).array,
            "n_dist": np.where(has_n, near[at, j], np.nan)})

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = pdf[pdf["side"] != 1].sort_values("id"), pdf[pdf["side"] != 0].sort_values("id")
        if not len(a) or not len(b):
            return pd.DataFrame({f.name: [] for f in HARD.fields})
        d = measure(np.vstack(a["v"]), np.vstack(b["v"]))
        out = [one_way(a, b, d)]
        if (pdf["side"] != 2).any():
            out.append(one_way(b, a, d.T))
        return pd.concat(out)

    found = grid.groupBy("batch", "ci", "cj").applyInPandas(best, HARD)
    p = F.when(F.col("positive").isNotNull(), F.struct(F.col("p_dist").alias("d"), (-F.col("positive")).alias("x")))
    n = F.when(F.col("negative").isNotNull(), F.struct(F.col("n_dist").alias("d"), F.col("negative").alias("x")))
    best_of = found.groupBy("anchor").agg(F.max(p).alias("p"), F.min(n).alias("n"))
    return best_of.where("p IS NOT NULL AND n IS NOT NULL").select(
        "anchor", (-F.col("p.x")).alias("positive"), F.col("p.d").alias("p_dist"), F.col("n.x").alias("negative"), F.col("n.d").alias("n_dist"))


def _semi_hard(pdf: pd.DataFrame, measure) -> pd.DataFrame:
    pdf = pdf.sort_values("id")
    ids, labels, mat = pdf["id"].to_numpy(), pdf["label"].to_numpy(), np.vstack(pdf["v"])
    d, out = measure(mat, mat), []
    for i in range(len(ids)):
        neg = np.flatnonzero(labels != labels[i])
        pos = np.flatnonzero((labels == labels[i]) & (np.arange(len(ids)) != i))
        if not len(neg) or not len(pos):
            continue
        order = neg[np.argsort(d[i, neg], kind="stable")]
        dn = d[i, order]
        at = np.searchsorted(dn, d[i, pos], side="right")  # first negative farther than the positive
        farthest = order[np.searchsorted(dn, dn[-1], side="left")]
        chosen = np.where(at < len(order), order[np.minimum(at, len(order) - 1)], farthest)
        out.append(pd.DataFrame({"anchor": ids[i], "positive": ids[pos], "p_dist": d[i, pos], "negative": ids[chosen], "n_dist": d[i, chosen]}))
    return pd.concat(out) if out else pd.DataFrame({f.name: [] for f in HARD.fields})


def _batch_all(pdf: pd.DataFrame, measure, margin: float) -> pd.DataFrame:
    pdf = pdf.sort_values("id")
    ids, labels, mat = pdf["id"].to_numpy(), pdf["label"].to_numpy(), np.vstack(pdf["v"])
    d, out = measure(mat, mat), []
    for i in range(len(ids)):
        neg = np.sort(d[i, labels != labels[i]])
        pos = d[i, (labels == labels[i]) & (np.arange(len(ids)) != i)]
        below = np.searchsorted(neg, pos + margin, side="left")  # negatives with a positive loss
        total = np.concatenate([[0.0], np.cumsum(neg)])
        out.append((ids[i], len(neg) * len(pos), int(below.sum()), float((below * (pos + margin) - total[below]).sum())))
    return pd.DataFrame(out, columns=["anchor", "valid", "active", "loss"])


def hard_pairs(pairs: DataFrame, batch: str, distance: str = "distance", label: str = "label") -> DataFrame:
    """Per batch the negatives nearer than the farthest positive and the positives farther than the nearest negative.

    With one positive (negative) only, the mean of the other kind takes the place of the limit.
    """
    pos, neg = F.when(F.col(label) == 1, F.col(distance)), F.when(F.col(label) == 0, F.col(distance))
    limits = pairs.groupBy(batch).agg(
        F.when(F.count(pos) > 1, F.max(pos)).otherwise(F.avg(neg)).alias("__near"),
        F.when(F.count(neg) > 1, F.min(neg)).otherwise(F.avg(pos)).alias("__far"))
    hard = ((F.col(label) == 0) & (F.col(distance) < F.col("__near"))) | ((F.col(label) == 1) & (F.col(distance) > F.col("__far")))
    return pairs.join(limits, batch).where(hard).drop("__near", "__far")


def hardest_in_batch_negative(
    pairs: DataFrame, batch: str | None = None, id: str = "id", anchor: str = "anchor", positive: str = "positive", chunk_rows: int = 1024,
) -> DataFrame:
    """``(query_id, corpus_id, score)``: per anchor the most similar positive of another row (of its batch)."""
    if batch is None:
        a, p = pairs.select(id, F.col(anchor).alias("embedding")), pairs.select(id, F.col(positive).alias("embedding"))
        return semantic_search(a, p, 1, "cos", True, id).drop("rank")
    rows = pairs.select(F.col(batch).alias("batch"), F.col(id).cast("bigint").alias("id"), F.col(anchor).cast("array<double>").alias("a"),
                        F.col(positive).cast("array<double>").alias("p"))
    grid = chunk_grid(rows, ["batch"], "id", chunk_rows)

    def one_way(x, y):
        s = B.scores(B.prepare(np.vstack(x["a"]), "cos"), B.prepare(np.vstack(y["p"]), "cos"))
        s[x["id"].to_numpy()[:, None] == y["id"].to_numpy()[None, :]] = -np.inf
        j = s.argmax(1)
        out = pd.DataFrame({"query_id": x["id"].to_numpy(), "corpus_id": y["id"].to_numpy()[j], "score": s[np.arange(len(x)), j]})
        return out[np.isfinite(out["score"])]

    def best(pdf):
        x, y = pdf[pdf["side"] != 1].sort_values("id"), pdf[pdf["side"] != 0].sort_values("id")
        if not len(x) or not len(y):
            return pd.DataFrame({"query_id": [], "corpus_id": [], "score": []})
        out = [one_way(x, y)]
        if (pdf["side"] != 2).any():
            out.append(one_way(y, x))
        return pd.concat(out)

    found = grid.groupBy("batch", "ci", "cj").applyInPandas(best, B.HITS)
    top = found.groupBy("query_id").agg(F.max(F.struct("score", (-F.col("corpus_id")).alias("x"))).alias("m"))
    return top.select("query_id", (-F.col("m.x")).alias("corpus_id"), F.col("m.score").alias("score"))


def ce_filtered_negatives(
    positives: DataFrame, negatives: DataFrame, scores: DataFrame, systems: Sequence[str], margin: float = 3.0, per_system: int = 5,
) -> DataFrame:
    """``(query_id, system, corpus_id, position)``: mined negatives that score at most the worst positive minus a margin.

    ``positives(query_id, corpus_id)``, ``negatives(query_id, system, corpus_id, position)``, ``scores(query_id,
    corpus_id, score)``. Systems are served in the given order; a passage taken for one system is not counted again.
    Queries without positives drop out.
    """
    floor = positives.join(scores, ["query_id", "corpus_id"]).groupBy("query_id").agg((F.min("score") - margin).alias("__limit"))
    usable = negatives.join(floor, "query_id").join(scores, ["query_id", "corpus_id"]).where(F.col("score") <= F.col("__limit"))
    usable = usable.groupBy("query_id", "system", "corpus_id").agg(F.min("position").alias("position"))
    usable = cut_lineage(usable)
    taken = None
    for system in systems:
        rows = usable.where(F.col("system") == system)
        if taken is not None:
            rows = rows.join(taken.select("query_id", "corpus_id"), ["query_id", "corpus_id"], "left_anti")
        rows = cap_per_key(rows, ["query_id"], [F.col("position").asc(), F.col("corpus_id").asc()], per_system)
        rows = rows.select("query_id", "system", "corpus_id", "position")
        # Cut in every round: the next one reads it twice.
        taken = cut_lineage(rows if taken is None else taken.unionByName(rows))
    return taken


def _rotating(rows: DataFrame, name: str, round: int) -> DataFrame:
    """Per query the row whose turn it is: position ``round`` modulo the number of rows."""
    placed = global_row_number(rows.select("query_id", "corpus_id").distinct(), [F.col("corpus_id").asc()], "pos", by=["query_id"])
    sizes = placed.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    turn = placed.join(sizes, "query_id").where(F.col("pos") - 1 == F.pmod(F.lit(round), F.col("n")))
    return turn.select("query_id", F.col("corpus_id").alias(name))


def margin_labels(positives: DataFrame, negatives: DataFrame, scores: DataFrame, round: int = 0) -> DataFrame:
    """``(query_id, positive, negative, label)`` with ``label = score(positive) - score(negative)``; picks rotate by round."""
    out = _rotating(positives, "positive", round).join(_rotating(negatives, "negative", round), "query_id")
    side = lambda c, s: scores.select("query_id", F.col("corpus_id").alias(c), F.col("score").alias(s))
    out = out.join(side("positive", "__p"), ["query_id", "positive"]).join(side("negative", "__n"), ["query_id", "negative"])
    return out.select("query_id", "positive", "negative", (F.col("__p") - F.col("__n")).alias("label"))


def ratio_sample(triples: DataFrame, neg_per_pos: int = 4, held_out: DataFrame | None = None, max_rows: int | None = None) -> DataFrame:
    """``(position, query_id, passage_id, label)`` from ``(line, query_id, pos_id, neg_id)``: one positive, then
    ``neg_per_pos`` negatives, by row counter. Queries of ``held_out(query_id)`` are left out before counting.
    """
    rows = triples if held_out is None else triples.join(held_out.select("query_id"), "query_id", "left_anti")
    rows = global_row_number(rows, [F.col("line").asc()])
    if max_rows:
        rows = rows.where(F.col("position") <= max_rows)
    first = (F.col("position") - 1) % (neg_per_pos + 1) == 0
    return rows.select("position", "query_id", F.when(first, F.col("pos_id")).otherwise(F.col("neg_id")).alias("passage_id"),
                       F.when(first, 1).otherwise(0).cast("bigint").alias("label"))


def holdout_queries(triples: DataFrame, n: int = 200, max_neg: int = 200) -> tuple[DataFrame, DataFrame]:
    """Dev ``(query_id, passage_id, is_positive)`` of the first ``n`` queries and the other triples.

    All positives of a dev query are kept, and its first ``max_neg`` distinct negatives.
    """
    order = triples.groupBy("query_id").agg(F.min("line").alias("first"))
    dev_ids = cut_lineage(first_n(order, [F.col("first").asc(), F.col("query_id").asc()], n).select("query_id"))
    rows = triples.join(dev_ids, "query_id", "left_semi")
    pos = rows.select("query_id", F.col("pos_id").alias("passage_id")).distinct()
    neg = rows.groupBy("query_id", F.col("neg_id").alias("passage_id")).agg(F.min("line").alias("line"))
    neg = cap_per_key(neg, ["query_id"], [F.col("line").asc(), F.col("passage_id").asc()], max_neg).drop("line")
    dev = pos.withColumn("is_positive", F.lit(True)).unionByName(neg.withColumn("is_positive", F.lit(False)))
    return dev, triples.join(dev_ids, "query_id", "left_anti")


def augment_silver_pairs(sentences: DataFrame, gold: DataFrame, k: int = 3, retriever: str = "dense", stop: Sequence[str] = ()) -> DataFrame:
    """``(id1, id2, score)``: the ``k`` nearest other sentences of every sentence, without gold pairs of either direction.

    ``sentences(id, embedding)`` for ``dense``, ``sentences(id, text)`` for ``bm25``; ``gold(id1, id2)``.
    """
    if retriever == "dense":
        hits = semantic_search(sentences, sentences, k, "cos", True)
    elif retriever == "bm25":
        hits = bm25_search(sentences, sentences, k + 1, stop=stop).where("query_id <> corpus_id")
        hits = cap_per_key(hits, ["query_id"], [F.col("score").desc(), F.col("corpus_id").asc()], k)
    else:
        raise ValueError(retriever)
    known = both_directions(gold.select("id1", "id2"), "id1", "id2")
    return hits.select(F.col("query_id").alias("id1"), F.col("corpus_id").alias("id2"), "score").join(known, ["id1", "id2"], "left_anti")


def cross_domain_labels(pairs: DataFrame, a: str, b: str, make_scorer: Callable, threshold: float = 0.5) -> DataFrame:
    """Unlabelled pairs with a model's score and the label ``score >= threshold``."""
    return predict_pairs(pairs, a, b, make_scorer).withColumn("label", binarize("score", threshold))


def duplicate_split(pairs: DataFrame, dev: int = 1, test: int = 2, of: int = 10, seed: int = 0, a: str = "id1", b: str = "id2", small: int = SMALL_EDGES) -> DataFrame:
    """``(node, component, split)``: whole components go to one split, by the hash of the component.

    Of ``of`` buckets the first ``dev`` are dev, the next ``test`` test, the rest train; no pair can cross splits.
    """
    comp = components(pairs, a, b, small)
    bucket = F.pmod(hash_int("component", seed=seed), F.lit(of))
    return comp.withColumn("split", F.when(bucket < dev, "dev").when(bucket < dev + test, "test").otherwise("train"))


def task_tables(pairs: DataFrame, texts: DataFrame, split: DataFrame, n_queries: dict[str, int] | None = None, seed: int = 0) -> dict[str, DataFrame]:
    """The tables of three tasks from duplicate pairs ``(id1, id2, is_duplicate)``, ``texts(id, text)`` and a split of
    all ids ``(node, component, split)``; a component is a set of mutual duplicates.

    * ``classification``: pairs whose ends are in one split, with their texts.
    * ``mining_corpus`` ``(split, id, text)`` and ``mining_gold`` ``(split, component, id)``: ids with the same
      component are duplicates, the linear form of the pair list.
    * ``retrieval_queries`` ``(split, id, text)``: one member per dev or test component with duplicates, or at
      most ``n_queries`` of each split it names (the script has ``{"dev": 5000, "test": 10000}``); ``retrieval_relevant`` ``(split, id, corpus_id)``; ``retrieval_corpus`` ``(id, text)``:
      all other sentences.
    """
    side = lambda c, s, t: split.select(F.col("node").alias(c), F.col("split").alias(s)).join(
        texts.select(F.col("id").alias(c), F.col("text").alias(t)), c)
    classification = pairs.join(side("id1", "split", "text1"), "id1").join(side("id2", "__s2", "text2"), "id2")
    classification = classification.where(F.col("split") == F.col("__s2")).drop("__s2")
    corpus = split.join(texts.withColumnRenamed("id", "node"), "node").select("split", F.col("node").alias("id"), "text")
    sizes = split.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.first("split").alias("split"),
                                           F.min(F.struct(hash_key("node", seed=seed).alias("h"), F.col("node").alias("node"))).alias("q"))
    multi = sizes.where("n > 1").select("component", "split", F.col("q.h").alias("h"), F.col("q.node").alias("id"))
    gold = split.join(multi.select("component"), "component", "left_semi").select("split", "component", F.col("node").alias("id"))
    chosen = multi.where("split in ('dev', 'test')")
    if n_queries:
        chosen = reduce(DataFrame.unionByName, [
            first_n(multi.where(F.col("split") == s), [F.col("h").asc(), F.col("id").asc()], n) for s, n in n_queries.items()])
    chosen = cut_lineage(chosen)
    queries = chosen.join(texts, "id").select("split", "id", "text")
    relevant = chosen.select("split", "id", "component").join(split.select("component", F.col("node").alias("corpus_id")), "component")
    relevant = relevant.where("id <> corpus_id").select("split", "id", "corpus_id")
    rest = corpus.select("id", "text").join(chosen.select("id"), "id", "left_anti")
    return {"classification": classification, "mining_corpus": corpus, "mining_gold": gold, "retrieval_queries": queries,
            "retrieval_relevant": relevant, "retrieval_corpus": rest}


def write_task_files(tables: dict[str, DataFrame], path: str) -> None:
    """One folder per table, partitioned by split where there is one."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if "split" in df.columns:
            writer = writer.partitionBy("split")
        writer.parquet(f"{path}/{name}")


def retrieval_subcorpus(corpus: DataFrame, needed: DataFrame, size: int, id: str = "id", seed: int = 0) -> DataFrame:
    """All needed documents and, up to ``size`` in total, distractors in hash order."""
    must = corpus.join(needed.select(id), id, "left_semi")
    room = max(0, size - must.count())
    others = corpus.join(needed.select(id), id, "left_anti")
    return must.unionByName(hash_sample(others, id, room, seed)) if room else must


def parallel_pairs_wide(df: DataFrame, src: str, trgs: Sequence[str], n_dev: int = 1000, order: str = "id") -> DataFrame:
    """``(lang, order, src_text, trg_text, split)`` from one column per language; both sides non-blank after trimming."""
    cells = F.array(*[F.struct(F.lit(t).alias("lang"), X.strip(src).alias("src_text"), X.strip(t).alias("trg_text")) for t in trgs])
    rows = df.select(order, F.inline(cells)).where("src_text <> '' AND trg_text <> ''")
    return dev_split(rows, ["lang"], [order], n_dev)


def parallel_pairs_links(
    sentences: DataFrame, links: DataFrame, src_langs: Sequence[str], trg_langs: Sequence[str], n_dev: int = 1000,
) -> DataFrame:
    """``(src_lang, trg_lang, src_text, trg_text, split)`` from ``sentences(id, lang, text)`` and ``links(src, trg)``.

    Sources with equal text are one; the first ``n_dev`` sources of a language pair (by lowest id) are dev with all
    their translations. Long form: one row per translation.
    """
    side = lambda p, langs: sentences.where(F.col("lang").isin(list(langs))).select(
        F.col("id").alias(p), F.col("lang").alias(f"{p}_lang"), F.col("text").alias(f"{p}_text"))
    rows = links.join(side("src", src_langs), "src").join(side("trg", trg_langs), "trg")
    rows = rows.withColumn("__d", F.sha2("src_text", 256))
    keys = ["src_lang", "trg_lang"]
    firsts = rows.groupBy(*keys, "__d").agg(F.min("src").alias("__first"))
    marked = dev_split(firsts, keys, ["__first", "__d"], n_dev)
    return rows.join(marked, [*keys, "__d"]).select(*keys, "src_text", "trg_text", "split")


def parallel_pairs_scored(df: DataFrame, threshold: float = 1.075, swap: bool = False, n_dev: int = 1000) -> DataFrame:
    """``(order, src_text, trg_text, split)`` from mined ``(order, score, sent1, sent2)``.

    Pairs below the threshold or with equal sides drop out. In ``order``, pairs that share no sentence with an earlier
    dev pair become dev until there are ``n_dev``; any other pair that shares a sentence with dev is left out.
    """
    rows = df.where(F.col("score") >= threshold).select("order", X.strip("sent1").alias("a"), X.strip("sent2").alias("b")).where("a <> b")
    rows = rows.select("order", *(["b", "a"] if swap else ["a", "b"])).toDF("order", "src_text", "trg_text")
    rows = cut_lineage(rows.withColumn("__s", F.sha2("src_text", 256)).withColumn("__t", F.sha2("trg_text", 256)))
    spark = df.sparkSession
    dev, used, open_rows = [], set(), rows
    while len(dev) < n_dev:
        # Every row of a head is taken or shares a sentence with dev, so the next round's head is a new one, and no head
        # has more than 4 * n_dev rows.
        head = first_n(open_rows, [F.col("order").asc()], 4 * n_dev).select("order", "__s", "__t").toArrow().to_pylist()
        for r in sorted(head, key=lambda r: r["order"]):
            if len(dev) < n_dev and r["__s"] not in used and r["__t"] not in used:
                used.update((r["__s"], r["__t"]))
                dev.append(r["order"])
        if len(head) < 4 * n_dev:
            break
        open_rows = _without_sentences(rows, used)
    chosen = spark.createDataFrame([(o,) for o in dev], T.StructType([rows.schema["order"]]))
    picked = rows.join(chosen, "order", "left_semi").withColumn("split", F.lit("dev"))
    rest = _without_sentences(rows, used).withColumn("split", F.lit("train"))
    return picked.unionByName(rest).drop("__s", "__t")


def _without_sentences(rows: DataFrame, used: set[str]) -> DataFrame:
    """Rows whose sentence digests ``__s`` and ``__t`` are both unused (at most two per dev pair)."""
    listed = rows.sparkSession.createDataFrame([(x,) for x in used], "__d string")
    for c in ("__s", "__t"):
        rows = rows.join(listed.withColumnRenamed("__d", c), c, "left_anti")
    return rows.select("order", "src_text", "trg_text", "__s", "__t")


def translation_groups(df: DataFrame, vectors: DataFrame | None = None, texts: str = "texts") -> DataFrame:
    """``(source, sentence[, label])``: every distinct text of a source's rows (itself included), with the source's
    vector as label if ``vectors(text, embedding)`` is given.
    """
    rows = df.select(F.get(texts, F.lit(0)).alias("source"), F.explode(texts).alias("sentence")).where("sentence IS NOT NULL").distinct()
    if vectors is None:
        return rows
    return rows.join(vectors.select(F.col("text").alias("source"), F.col("embedding").alias("label")), "source")


def label_batches(df: DataFrame, label: str, n: int = 2, seed: int = 0, id: str = "id", replace: bool = False) -> DataFrame:
    """``(id, label, draw, slot, order_key)``: draws of ``n`` different random rows of one label.

    Sorting by ``order_key, slot`` serves the labels in turn: every label's first draw, in a shuffled order, then every
    second draw in another order, and so on. Labels with fewer than ``n`` rows and rows without a label are left out.

    Without replacement each row is drawn at most once, and large labels go on alone when the small ones are used up.
    With ``replace`` every label has a draw in every cycle, whatever its size, until as many rows are drawn as the used
    labels have; a row may come again in another draw.
    """
    keyed = df.select(F.col(id).alias("id"), F.col(label).alias("label")).where("label IS NOT NULL").withColumn("h", hash_key("id", seed=seed))
    placed = global_row_number(keyed, [F.col("h").asc(), F.col("id").asc()], "pos", by=["label"])
    sizes = placed.groupBy("label").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= n)
    order = F.concat(F.lpad(F.col("draw").cast("string"), 12, "0"), F.lit(":"), hash_key("label", "draw", seed=seed + 1))
    if not replace:
        draws = placed.join(sizes, "label").withColumn("draw", F.floor((F.col("pos") - 1) / n)).where((F.col("draw") + 1) * n <= F.col("rows"))
        return draws.select("id", "label", "draw", ((F.col("pos") - 1) % n).alias("slot"), order.alias("order_key"))
    listed = cut_lineage(global_row_number(sizes.withColumn("o", hash_key("label", seed=seed + 3)), [F.col("o").asc(), F.col("label").asc()], "turn"))
    labels, rows = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("rows"), F.lit(0))).head()
    draws = df.sparkSession.range(-(-rows // n)).select((F.col("id") % max(labels, 1) + 1).alias("turn"), F.floor(F.col("id") / max(labels, 1)).alias("draw"))
    draws = draws.join(listed.select("turn", "label", "rows"), "turn").withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    # From a random start on, neighbours in the shuffled order of the label: different rows, as n <= rows.
    at = (hash_int("label", "draw", seed=seed + 2) + F.col("slot")) % F.col("rows") + 1
    draws = draws.select("label", "draw", F.col("slot").cast("bigint").alias("slot"), at.alias("pos"))
    return draws.join(placed, ["label", "pos"]).select("id", "label", "draw", "slot", order.alias("order_key"))


def contrastive_pairs(df: DataFrame, ratio: int = 8, seed: int = 0, id: str = "id") -> DataFrame:
    """``(pair, a, b, label)`` ids: of ``ratio`` pairs one is a row with itself (label 1), the others two different
    rows (label 0); rows are shuffled and each is used once.
    """
    block = 2 * ratio - 1
    keyed = df.select(F.col(id).alias("id")).withColumn("h", hash_key("id", seed=seed))
    placed = global_row_number(keyed, [F.col("h").asc(), F.col("id").asc()]).withColumn("i", F.col("position") - 1)
    total = placed.agg(F.count(F.lit(1)).alias("n")).withColumn("__k", F.lit(1))
    j = F.col("i") % block
    pair = F.floor(F.col("i") / block) * ratio + F.floor((j + 1) / 2)
    groups = placed.withColumn("pair", pair).groupBy("pair").agg(
        F.min_by("id", "i").alias("a"), F.max_by("id", "i").alias("b"), F.min("i").alias("first"), F.count(F.lit(1)).alias("c"))
    out = groups.withColumn("__k", F.lit(1)).join(F.broadcast(total), "__k")
    positive = F.col("pair") % ratio == 0
    # A pair needs a row after its first one, also when it is a row with itself.
    out = out.where((F.col("first") + 1 < F.col("n")) & (positive | (F.col("c") == 2)))
    return out.select("pair", "a", "b", F.when(positive, 1).otherwise(0).cast("bigint").alias("label"))


def multi_dataset_batches(
    datasets: dict[str, DataFrame], texts: Sequence[str], size: int, temperature: float | None = None, seed: int = 0, id: str = "id",
    guid: str | None = None, swap: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Batches that each come from one dataset, and the order in which to serve them.

    Returns rows ``(dataset, batch_no, id, swapped)`` and the schedule ``(step, dataset, batch_no)``: datasets take
    turns in a shuffled cycle by their weights (see ``dataset_weights``), each serving its batches round and round.
    """
    from .tabular import dataset_weights

    spark = next(iter(datasets.values())).sparkSession
    parts, sizes = [], []
    for name, df in datasets.items():
        sizes.append((name, df.count()))
        got = no_duplicate_batches(df, texts, size, seed, id, guid)
        numbers = global_row_number(got.select("batch").distinct(), [F.col("batch").asc()], "batch_no")
        swapped = F.pmod(hash_int(id, seed=seed + 3), F.lit(2)) == 1 if swap else F.lit(False)
        parts.append(got.join(numbers, "batch").select(F.lit(name).alias("dataset"), (F.col("batch_no") - 1).alias("batch_no"), F.col(id).alias("id"), swapped.alias("swapped")))
    rows = cut_lineage(reduce(DataFrame.unionByName, parts))
    weights = [(r["dataset"], r["weight"]) for r in dataset_weights(spark.createDataFrame(sizes, "dataset string, n bigint"), temperature).collect()]
    cycle = pd.DataFrame([(d, i) for d, w in weights for i in range(w)], columns=["dataset", "use"])  # a few thousand rows
    cycle = cycle.sample(frac=1.0, random_state=seed).reset_index(drop=True)
    cycle["slot"], cycle["use"] = range(len(cycle)), cycle.groupby("dataset").cumcount()
    cycle["weight"] = cycle["dataset"].map(dict(weights))
    slots = spark.createDataFrame(cycle, "dataset string, use bigint, slot bigint, weight bigint")
    counts = rows.groupBy("dataset").agg((F.max("batch_no") + 1).alias("batches"))
    steps = spark.range(sum(n for _, n in sizes) // size).withColumnRenamed("id", "step").withColumn("slot", F.col("step") % len(cycle))
    plan = steps.join(F.broadcast(slots), "slot").join(F.broadcast(counts), "dataset")
    turn = F.floor(F.col("step") / len(cycle)) * F.col("weight") + F.col("use")
    return rows, plan.select("step", "dataset", (turn % F.col("batches")).alias("batch_no"))


def identity_pairs(df: DataFrame, text: str = "text", min_chars: int = 0, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep..., texts)`` with the same sentence twice; shorter sentences drop out."""
    rows = df.withColumn("__t", X.strip(text)).where(F.length("__t") >= max(min_chars, 1))
    return rows.select(*keep, F.array("__t", "__t").alias("texts"))


def denoise_pairs(df: DataFrame, text: str = "text", id: str = "id", p: float = 0.6, seed: int = 0, noise: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """``(id, noised, original)``; ``noise`` replaces the word-deletion rule."""
    noised = noise(F.col(text), F.col(id)) if noise else X.delete_words(text, id, p, seed)
    return df.select(id, noised.alias("noised"), F.col(text).alias("original"))


def sentence_pool(df: DataFrame, columns: Sequence[str], n_dev: int, seed: int = 0) -> DataFrame:
    """``(sentence, split)``: distinct sentences of several columns, the first ``n_dev`` in hash order as dev."""
    pool = df.select(F.explode(F.array(*columns)).alias("sentence")).where("sentence IS NOT NULL").distinct()
    keyed = pool.withColumn("h", hash_key("sentence", seed=seed)).withColumn("g", F.lit(0))
    return dev_split(keyed, ["g"], ["h"], n_dev).select("sentence", "split")
