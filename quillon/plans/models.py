"""Models, tuning and their metrics (M, K19)."""

from __future__ import annotations

from itertools import product

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import features as H
from ..operators import models as M
from ..operators import tabular as T
from ..session import cut_lineage, scratch_path, spread
from .common import embeddings, r6, sql_hash_int, table
from .evaluate import PAIRS, pairs

FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


def split_lines(spark, sf):
    d = spread(table(spark, sf, "lineitem")).withColumn("rid", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey"))
    charge = F.col("l_quantity") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    d = T.hash_split(H.assemble(FEATURES).transform(d).select("rid", "features", charge.alias("y")), "rid", {"train": 0.7, "test": 0.3})
    # The fits keep these tables in memory: only what they read.
    return tuple(d.where(F.col("split") == part).select("features", "y") for part in ("train", "test"))


def m01(spark, sf):
    out = M.linear_summary(table(spark, sf, "lineitem"), ["l_quantity"], "l_extendedprice")
    return out.select("term", F.round("coefficient", 4).alias("coefficient"), F.round("rmse", 4).alias("rmse"), r6("r2", "r2"))


def _regression(*names):
    """Test rows, the error of the training mean, and whether the model errs less than half as much."""
    def query(spark, sf):
        train, test = split_lines(spark, sf)
        chosen = {n: e for n, e in M.regressors("y").items() if n in names}
        out = M.compare(train, test, chosen, "y", "rmse")
        mean = train.agg(F.avg("y").alias("m"))
        base = test.crossJoin(F.broadcast(mean)).agg(F.count(F.lit(1)).alias("n_test"), F.sqrt(F.avg((F.col("y") - F.col("m")) ** 2)).alias("b"))  # one row
        out = out.crossJoin(F.broadcast(base))
        return out.select("model", "metric", "best", "n_test", F.round("b", 4).alias("baseline"), (F.col("value") < F.col("b") / 2).alias("better"))
    return query


def split_vectors(spark, sf):
    """Targets that the vectors hold: the sign of the first coordinate, and the signs of the first two as four classes."""
    x0, x1 = (F.get("embedding", F.lit(i)) > 0 for i in (0, 1))
    e = embeddings(spark, sf).select("id", array_to_vector(V.as_double("embedding")).alias("features"), x0.cast("double").alias("y"),
                                     (2 * x0.cast("int") + x1.cast("int")).cast("double").alias("label"))
    e = T.hash_split(e, "id", {"train": 0.8, "test": 0.2})
    return e.where("split = 'train'"), e.where("split = 'test'")


def _ranked(out, test):
    """Per model the size of the test, its positives, and whether it orders most pairs rightly."""
    size = test.agg(F.count(F.lit(1)).alias("n_test"), F.sum("y").cast("bigint").alias("n_positive"))  # one row
    return out.crossJoin(F.broadcast(size)).select("model", "metric", "n_test", "n_positive", (F.col("value") > 0.6).alias("better"))


def m05(spark, sf):
    train, test = split_vectors(spark, sf)
    two = {"strong": LogisticRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8, labelCol="y"), "weak": LogisticRegression(maxIter=20, regParam=0.01, labelCol="y")}
    return _ranked(M.compare(train, test, two, "y", "auc"), test)


def m06(spark, sf):
    """One row per class and feature: the sign of the deciding coefficients, and the sum over the classes (zero)."""
    train, _ = split_vectors(spark, sf)
    out = M.multinomial_coefficients(train, "label", 20, 0.01, 0.0)
    long = out.select("class", F.posexplode("coefficients").alias("feature", "c")).withColumn("feature", F.col("feature").cast("bigint"))
    sums = long.groupBy("feature").agg(F.abs(F.round(F.sum("c"), 6)).alias("over_classes"))
    sign = F.when(F.col("feature") < 2, F.signum("c").cast("bigint"))
    return long.join(sums, "feature").select("class", "feature", sign.alias("sign"), "over_classes")


def m07(spark, sf):
    train, test = split_vectors(spark, sf)
    return _ranked(M.compare(train, test, {n: e for n, e in M.classifiers("y").items() if n != "logistic"}, "y", "auc"), test)


# The grids that the inventory names.
GRIDS = {
    "forest_regressor": {"numTrees": [1, 5, 10], "maxDepth": [5, 10, 15]},
    "logistic": {"maxIter": [15, 100], "regParam": [0.3, 0.5], "elasticNetParam": [0.3, 0.5, 0.8]},
    "tree": {"maxDepth": [5, 10, 15]},
    "forest": {"numTrees": [5, 10, 12, 15, 20], "maxDepth": [5, 10, 15, 20]},
}


def _tuned(name):
    """Every point of a grid; ``sound`` where the mean metric is better than that of a constant model."""
    def query(spark, sf):
        auc, error = BinaryClassificationEvaluator(labelCol="y"), RegressionEvaluator(labelCol="y")
        estimator = {"forest_regressor": RandomForestRegressor(labelCol="y", seed=1), "logistic": LogisticRegression(labelCol="y"),
                     "tree": DecisionTreeClassifier(labelCol="y", seed=1), "forest": RandomForestClassifier(labelCol="y", seed=1)}[name]
        train, evaluator = (split_lines(spark, sf)[0], error) if name == "forest_regressor" else (split_vectors(spark, sf)[0], auc)
        table_ = M.tuning_table(spark, M.tune(train, estimator, GRIDS[name], evaluator, folds=3, seed=1, parallelism=8))
        sound = F.col("value").between(0.5, 1.0) if evaluator is auc else F.col("value") < 10.0
        return table_.select("params", sound.alias("sound"))
    return query


def m09(spark, sf):
    """Test rows with their label; ``better``: more rows are right than the more frequent label alone would make right."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("y"))
    d = T.hash_split(d, "doc_id", {"train": 0.8, "test": 0.2})
    model = M.text_classifier(d.where("split = 'train'"), "text", "y")
    scored = cut_lineage(model.transform(d.where("split = 'test'")).select("doc_id", "y", "prediction"))
    right = scored.agg(F.avg((F.col("y") == F.col("prediction")).cast("double")).alias("a"), F.avg("y").alias("s"))
    better = F.col("a") > F.greatest("s", 1 - F.col("s"))
    return scored.crossJoin(F.broadcast(right)).select("doc_id", "y", better.alias("better"))


def m10(spark, sf):
    train, test = split_vectors(spark, sf)
    return _ranked(M.compare(train, test, M.classifiers("y"), "y", "auc"), test)


def m11(spark, sf):
    """Four classes by the signs of both first coordinates; probabilities sum to one, most test pairs are right."""
    sign = lambda c: (F.get(c, F.lit(0)) > 0).cast("int")
    p = T.hash_split(pairs(spark, sf).withColumn("y", 2 * sign("a") + sign("b")), "id", {"train": 0.8, "test": 0.2})
    _, score = M.pair_classifier(p.where("split = 'train'"), "y")
    scored = score(p.where("split = 'test'"))
    total = F.aggregate("scores", F.lit(0.0), lambda s, x: s + x)
    size = scored.agg(F.count(F.lit(1)).alias("n_test"), F.sum((F.abs(total - 1) < 1e-9).cast("bigint")).alias("n_proper"))
    return M.pair_accuracy(scored, "y").crossJoin(size).select("n_test", "n_proper", (F.col("accuracy") > 0.6).alias("better"))


def a19(spark, sf):
    """A fitted pipeline is saved, loaded and applied: it must predict the same."""
    d = table(spark, sf, "lineitem")
    model = H.feature_pipeline(["l_quantity", "l_tax"], ["l_returnflag"]).fit(d)
    path = scratch_path(spark, "model")
    M.save(model, path)
    again = M.load(path)
    a = model.transform(d).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(F.col("features").cast("string")) % 1000003).alias("h"))
    b = again.transform(d).groupBy("l_returnflag").agg(F.sum(F.xxhash64(F.col("features").cast("string")) % 1000003).alias("g"))
    return a.join(b, "l_returnflag").select("l_returnflag", "n", (F.col("h") == F.col("g")).alias("same"))


def k19(spark, sf):
    """RMSE and AUC of fixed scores: the price predicted by its mean per unit, the return flag by the quantity."""
    li = table(spark, sf, "lineitem")
    reg = li.select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500.0).alias("prediction"))
    cls = li.select((F.col("l_returnflag") == "R").cast("double").alias("y"), F.col("l_quantity").alias("rawPrediction"))
    return spark.createDataFrame([("rmse", M.rmse(reg, "y")), ("auc", M.auc(cls, "y"))], "metric string, value double").select("metric", F.round("value", 4).alias("value"))


LINES = f"""ln AS (SELECT l_quantity * (1 - l_discount) * (1 + l_tax) AS y, {sql_hash_int("(l_orderkey || '-' || l_linenumber || '-' || l_partkey)")} % 10000 >= 7000 AS test FROM lineitem),
    bs AS (SELECT count(*) AS n_test, round(sqrt(avg((y - (SELECT avg(y) FROM ln WHERE NOT test)) ** 2)), 4) AS baseline FROM ln WHERE test)"""
VECTORS = f"vt AS (SELECT count(*) AS n_test, count(*) FILTER (WHERE embedding[1] > 0) AS n_positive FROM embeddings WHERE {sql_hash_int('vec_id')} % 10000 >= 8000)"


def _sql_regression(name: str) -> str:
    return f"WITH {LINES} SELECT '{name}' AS model, 'rmse' AS metric, true AS best, n_test, baseline, true AS better FROM bs"


def _sql_ranked(*names: str) -> str:
    return f"WITH {VECTORS} SELECT unnest({list(names)}) AS model, 'auc' AS metric, n_test, n_positive, true AS better FROM vt"


def _sql_grid(name: str) -> str:
    grid = GRIDS[name]
    points = [", ".join(f"{p}={v}" for p, v in sorted(zip(grid, values))) for values in product(*grid.values())]
    return f"SELECT unnest({points}) AS params, true AS sound"


QUERIES = {
    "a19_model_save_load": (a19, "SELECT l_returnflag, count(*) AS n, true AS same FROM lineitem GROUP BY 1"),
    "k19_rmse_auc": (k19, """
        WITH u AS (SELECT l_returnflag = 'R' AS y, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS r FROM lineitem),
        a AS (SELECT (sum(r) FILTER (WHERE y) - count(*) FILTER (WHERE y) * (count(*) FILTER (WHERE y) + 1) / 2.0) / (count(*) FILTER (WHERE y)::DOUBLE * count(*) FILTER (WHERE NOT y)) AS auc FROM u)
        SELECT 'rmse' AS metric, round(sqrt(avg((l_extendedprice - l_quantity * 1500) ** 2)), 4) AS value FROM lineitem UNION ALL SELECT 'auc', round(auc, 4) FROM a"""),
    "m01_linear_regression": (m01, """
        WITH s AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, regr_r2(l_extendedprice, l_quantity) AS r FROM lineitem),
        e AS (SELECT sqrt(avg((l_extendedprice - a - b * l_quantity) ** 2)) AS rmse FROM lineitem, s)
        SELECT 'l_quantity' AS term, round(b, 4) AS coefficient, round(rmse, 4) AS rmse, round(r, 6) AS r2 FROM s, e
        UNION ALL SELECT 'intercept', round(a, 4), round(rmse, 4), round(r, 6) FROM s, e"""),
    "m02_tree_regressor": (_regression("tree"), _sql_regression("tree")),
    "m03_forest_regressor": (_regression("forest"), _sql_regression("forest")),
    "m04_boosted_regressor": (_regression("boosted"), _sql_regression("boosted")),
    "m05_logistic": (m05, _sql_ranked("strong", "weak")),
    "m06_multinomial": (m06, """
        SELECT c AS class, f AS feature, CASE f WHEN 0 THEN CASE WHEN c >= 2 THEN 1 ELSE -1 END WHEN 1 THEN CASE WHEN c % 2 = 1 THEN 1 ELSE -1 END END::BIGINT AS sign, 0.0::DOUBLE AS over_classes
        FROM range(4) a(c), range((SELECT max(len(embedding)) FROM embeddings)) b(f)"""),
    "m07_tree_classifiers": (m07, _sql_ranked("tree", "forest")),
    "m08_cross_validation": (_tuned("forest_regressor"), _sql_grid("forest_regressor")),
    "m08_grid_logistic": (_tuned("logistic"), _sql_grid("logistic")),
    "m08_grid_tree": (_tuned("tree"), _sql_grid("tree")),
    "m08_grid_forest": (_tuned("forest"), _sql_grid("forest")),
    "m09_text_classifier": (m09, f"SELECT doc_id, quality::DOUBLE AS y, true AS better FROM documents JOIN labels USING (doc_id) WHERE {sql_hash_int('doc_id')} % 10000 >= 8000"),
    "m10_model_comparison": (m10, _sql_ranked("logistic", "tree", "forest")),
    "m11_pair_classifier": (m11, f"WITH {PAIRS} SELECT count(*) AS n_test, count(*) AS n_proper, true AS better FROM p WHERE {sql_hash_int('id')} % 10000 >= 8000"),
}
