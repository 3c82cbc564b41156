"""Everyday table work (B-F): predicates, joins, statistics, splits, samples and set operations.

What Spark already says in one call (select, where, join, groupBy) is used as it is by the queries; here are the
operators with rules of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.hashing import hash_int, hash_key
from .prefix import RANK_LIMIT, average_ranks, first_n, global_row_number, join_groups


def ratio(a: str, b: str) -> Column:
    """``a / b``; a null side or a zero denominator gives null."""
    return F.try_divide(F.col(a), F.col(b))


def rescale(c: Column | str, low: float, high: float, to_low: float, to_high: float) -> Column:
    """Linear map of ``[low, high]`` to ``[to_low, to_high]``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.lit(float(to_low)) + (col - F.lit(float(low))) * F.lit((to_high - to_low) / (high - low))


def label_id(c: str, labels: Sequence[str]) -> Column:
    """Position of the label in ``labels`` after lower-casing and trimming; null if it is not listed."""
    key = F.lower(X.strip(c))
    return F.coalesce(*[F.when(key == name, F.lit(i)) for i, name in enumerate(labels)]).cast("bigint")


def binarize(c: str, threshold: float = 0.5, strict: bool = False) -> Column:
    """1 at or above the threshold (above it when ``strict``), else 0."""
    hit = F.col(c) > threshold if strict else F.col(c) >= threshold
    return F.when(hit, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def length_between(c: str, low: int, high: int) -> Column:
    return F.length(X.strip(c)).between(low, high)


def route(c: str, named: Sequence[str] = ("dev", "test"), other: str = "train") -> Column:
    """Split name of a row: a listed value routes to itself, everything else to ``other``."""
    return F.when(F.col(c).isin(list(named)), F.col(c)).otherwise(F.lit(other))


def routed_first(df: DataFrame, split: str, order: Sequence[Column], caps: dict[str, int]) -> DataFrame:
    """Keeps at most ``caps[s]`` rows of split ``s`` (first by ``order``); splits without a cap stay whole."""
    whole = df.where(~F.col(split).isin(list(caps)))
    parts = [first_n(df.where(F.col(split) == s), order, n) for s, n in caps.items()]
    return reduce(DataFrame.unionByName, parts, whole)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, sample deviation, min, max; one pass over the data."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs.append(
            F.struct(
                F.lit(c).alias("column"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stddev"),
                F.min(x).alias("min"), F.max(x).alias("max"),
            )
        )
    return df.agg(F.array(*aggs).alias("s")).select(F.inline("s"))


def null_report(df: DataFrame) -> DataFrame:
    """``(column, missing)`` for all columns in one pass."""
    counts = [
        F.struct(F.lit(c).alias("column"), F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias("missing"))
        for c in df.columns
    ]
    return df.agg(F.array(*counts).alias("s")).select(F.inline("s"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form ``(a, b, r)``. The matrix has one cell per pair of columns, whatever the row count."""
    vec = VectorAssembler(inputCols=list(columns), outputCol="v", handleInvalid="skip").transform(df).select("v")
    m = Correlation.corr(vec, "v").head()[0].toArray()
    rows = [(a, b, float(m[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def weighted_pearson(df: DataFrame, x: str, y: str, weight: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation under row weights (equal weights if none), from centred moments; 5 decimals."""
    w = F.col(weight).cast("double") if weight else F.lit(100.0)
    rows = df.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), w.alias("w"))
    rows = rows.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    if weight is None:
        # Equal weights cancel out; Spark's corr merges centred moments and is stable.
        return rows.groupBy(*by).agg(F.round(F.corr("x", "y"), 5).alias("pearson"))
    means = rows.groupBy(*by).agg(
        (F.sum(F.col("w") * F.col("x")) / F.sum("w")).alias("mx"), (F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("my")
    )
    if by:
        centred = join_groups(rows, means, by)
    else:
        centred = rows.withColumn("__one", F.lit(1)).join(F.broadcast(means.withColumn("__one", F.lit(1))), "__one")
    dx, dy = F.col("x") - F.col("mx"), F.col("y") - F.col("my")
    cov = F.sum(F.col("w") * dx * dy) / F.sqrt(F.sum(F.col("w") * dx * dx) * F.sum(F.col("w") * dy * dy))
    return centred.groupBy(*by).agg(F.round(cov, 5).alias("pearson"))


def score_lines(gold: DataFrame, system: DataFrame) -> DataFrame:
    """Aligns a gold and a system score file: ``gold(line, value)`` tab-separated with the score in the 5th field,
    ``system(line, value)`` with the score first.

    Gold comment lines (``#``) are not counted. A blank gold line removes the system line of the same number. System
    comment lines are skipped. Output ``(pos, gold, system, in_range)``.
    """
    g = gold.where(~F.col("value").startswith("#"))
    g = global_row_number(g, [F.col("line").asc()], "pos")
    blank = g.where(F.col("value") == "").select("pos")
    g = g.where(F.col("value") != "").withColumn("gold", F.split("value", "\t")[4].cast("double"))
    g = global_row_number(g.select("line", "gold"), [F.col("line").asc()], "pos")
    s = system.join(blank.withColumnRenamed("pos", "line"), "line", "left_anti").where(~F.col("value").startswith("#"))
    s = s.withColumn("system", F.split(X.strip("value"), r"\s+")[0].cast("double"))
    s = global_row_number(s.select("line", "system"), [F.col("line").asc()], "pos")
    return g.select("pos", "gold").join(s.select("pos", "system"), "pos").withColumn("in_range", F.col("gold").between(0, 5))


def rank_columns(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``df`` in long form with average ranks: ``(rid, by..., metric, value, rank)``; needs a unique ``rid`` column.

    All columns are ranked in one pass over one sorted table of distinct values.
    """
    long = df.select("rid", *by, F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("m")).select("rid", *by, "m.metric", "m.value")
    ranks = average_ranks(long, "value", [*by, "metric"])
    # A value shared by very many rows is split by the adaptive skew join.
    return join_groups(long, ranks.drop("n"), [*by, "metric", "value"])


def correlations(df: DataFrame, gold: str, columns: Sequence[str], id: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., metric, pearson, spearman)`` of each column against ``gold``. Ties get average ranks."""
    base = df.select(F.col(id).alias("rid"), *by, gold, *columns).dropna(subset=[gold, *columns])
    ranked = rank_columns(base, [gold, *columns], by)
    wide = ranked.groupBy("rid", *by).agg(
        *[F.max(F.when(F.col("metric") == c, F.col("value"))).alias(f"v_{c}") for c in [gold, *columns]],
        *[F.max(F.when(F.col("metric") == c, F.col("rank"))).alias(f"r_{c}") for c in [gold, *columns]],
    )
    aggs = [
        F.struct(
            F.lit(c).alias("metric"), F.corr(f"v_{gold}", f"v_{c}").alias("pearson"),
            F.corr(f"r_{gold}", f"r_{c}").alias("spearman"),
        )
        for c in columns
    ]
    return wide.groupBy(*by).agg(F.array(*aggs).alias("s")).select(*by, F.inline("s"))


def spearman(df: DataFrame, a: str, b: str, id: str, by: Sequence[str] = ()) -> DataFrame:
    return correlations(df, a, [b], id, by).select(*by, "spearman")


def first_last(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """First and last value per group under an explicit order."""
    key = F.struct(*order)
    return df.groupBy(*by).agg(F.min_by(value, key).alias("first"), F.max_by(value, key).alias("last"))


def group_items(df: DataFrame, by: Sequence[str], order: Sequence[str], unique: bool = False) -> DataFrame:
    """The members of each group as rows ``(by..., order..., position)``.

    The long form of a collected list (or set): a group that holds a third of all rows never becomes one value.
    """
    rows = df.select(*by, *order)
    rows = rows.distinct() if unique else rows
    return global_row_number(rows, [F.col(c).asc() for c in order], by=by)


def size_report(df: DataFrame, by: str) -> DataFrame:
    """Number of groups and the least, mean and greatest number of rows in a group."""
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(F.lit(1)).alias("groups"), F.min("n").alias("min_size"), F.avg("n").alias("mean_size"),
        F.max("n").alias("max_size"),
    )


def frequency_order(df: DataFrame, c: str) -> DataFrame:
    """``(label, index)``: most frequent first, ties alphabetical, null left out. The labels stay distributed."""
    counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).cast("string").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    placed = global_row_number(counts, [F.col("n").desc(), F.col("label").asc()])
    return placed.select("label", (F.col("position") - 1).alias("index"))


def cap_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows per key; ``order`` must be strict. Up to ``RANK_LIMIT`` Spark trims to ``n`` per key and task
    before the shuffle; a larger ``n`` goes by positions in a global order.
    """
    if n > RANK_LIMIT:
        return global_row_number(df, order, "__rn", by=keys).where(F.col("__rn") <= n).drop("__rn")
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def dev_split(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Adds ``split``: the first ``n`` rows of each group are ``dev``, the rest ``train``.

    Only the last dev row of each group is looked up (one row per group); groups are never gathered.
    """
    key = F.struct(*order)
    cut = cap_per_key(df.select(*by, *order), by, [F.col(o).asc() for o in order], n)
    cut = cut.groupBy(*by).agg(F.max(key).alias("__last"))
    return join_groups(df, cut, by).withColumn(
        "split", F.when(key <= F.col("__last"), F.lit("dev")).otherwise(F.lit("train"))
    ).drop("__last")


def first_occurrence(df: DataFrame, id: str, norm: Column) -> DataFrame:
    """Adds ``first_id``: the lowest id with the same normalized text. The join moves 32-byte digests, not texts."""
    keyed = df.withColumn("__d", F.unhex(F.sha2(norm, 256)))
    firsts = keyed.groupBy("__d").agg(F.min(id).alias("first_id"))
    return keyed.join(firsts, "__d").drop("__d")


def hash_sample(df: DataFrame, id: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` pseudo-random rows, the same ones for a seed whatever the partitioning."""
    keyed = df.withColumn("__h", hash_key(id, seed=seed))
    return first_n(keyed, [F.col("__h").asc(), F.col(id).asc()], n).drop("__h")


def hash_split(df: DataFrame, id: str, weights: dict[str, float], seed: int = 0) -> DataFrame:
    """Adds ``split`` by the hash of the id: stable under recomputation, no shuffle."""
    total, upto, col = sum(weights.values()), 0.0, None
    bucket = F.pmod(hash_int(id, seed=seed), F.lit(10000))
    names = list(weights)
    for name in names[:-1]:
        upto += weights[name]
        cond = bucket < F.lit(int(round(10000 * upto / total)))
        col = F.when(cond, F.lit(name)) if col is None else col.when(cond, F.lit(name))
    return df.withColumn("split", F.lit(names[-1]) if col is None else col.otherwise(F.lit(names[-1])))


def both_directions(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Every pair and its reverse; one scan, no second read of the input."""
    rest = [c for c in pairs.columns if c not in (a, b)]
    swapped = F.array(F.struct(F.col(a).alias(a), F.col(b).alias(b)), F.struct(F.col(b).alias(a), F.col(a).alias(b)))
    return pairs.select(*rest, F.inline(swapped)).select(*pairs.columns)


def distinct_union(df: DataFrame, columns: Sequence[str], n: int | None = None, seed: int = 0) -> DataFrame:
    """Distinct values of several text columns; with ``n``, the first ``n`` in hash order."""
    out = df.select(F.explode(F.array(*columns)).alias("sentence")).where(F.col("sentence").isNotNull()).distinct()
    if n is None:
        return out
    keyed = out.withColumn("__h", hash_key("sentence", seed=seed))
    return first_n(keyed, [F.col("__h").asc(), F.col("sentence").asc()], n).drop("__h")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row ``(shared, disjoint)``: how many keys two sets have in common."""
    shared = a.select(key).distinct().join(b.select(key), key, "left_semi")
    return shared.agg(F.count(F.lit(1)).alias("shared")).withColumn("disjoint", F.col("shared") == 0)


def difference(candidates: DataFrame, relevant: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Candidates that are not relevant, as a set."""
    return candidates.select(*keys).distinct().join(relevant.select(*keys), list(keys), "left_anti")


def dataset_weights(sizes: DataFrame, temperature: float | None, name: str = "dataset", n: str = "n") -> DataFrame:
    """``(dataset, n, weight)``: ``max(1, int((n/N)^(1/T) * 1000))``, or 100 each without a temperature.

    One row per dataset, so the total is taken over a table of a handful of rows.
    """
    if not temperature or temperature <= 0:
        return sizes.select(name, n, F.lit(100).cast("bigint").alias("weight"))
    total = F.sum(n).over(W.partitionBy())
    share = F.pow(F.col(n) / total, F.lit(1.0 / temperature))
    return sizes.select(name, n, F.greatest(F.lit(1), F.floor(share * 1000)).cast("bigint").alias("weight"))


def repeat_weighted(df: DataFrame, weight: str) -> DataFrame:
    """Every row as often as its weight says, with the copy number."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(weight).cast("bigint"))))
