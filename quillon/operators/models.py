"""Regression, classification, tuning and comparison (M, K19)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame

from ..functions import vectors as V
from .evaluate import label_accuracy


def regressors(label: str, seed: int = 0) -> dict[str, Estimator]:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "linear": LinearRegression(maxIter=15, **common),
        "tree": DecisionTreeRegressor(seed=seed, **common),
        "forest": RandomForestRegressor(seed=seed, **common),
        "boosted": GBTRegressor(seed=seed, **common),
    }


def classifiers(label: str, seed: int = 0) -> dict[str, Estimator]:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "logistic": LogisticRegression(maxIter=10, regParam=0.3, elasticNetParam=0.8, **common),
        "tree": DecisionTreeClassifier(seed=seed, **common),
        "forest": RandomForestClassifier(seed=seed, **common),
    }


def linear_summary(train: DataFrame, features: Sequence[str], label: str, max_iter: int = 10) -> DataFrame:
    """``(term, coefficient, rmse, r2)``: one row per feature and the intercept. Normal equations in one pass."""
    from .features import assemble

    model = LinearRegression(maxIter=max_iter, solver="normal", labelCol=label).fit(assemble(features).transform(train))
    terms = [*zip(features, model.coefficients.tolist()), ("intercept", model.intercept)]
    s = model.summary
    rows = [(t, float(c), s.rootMeanSquaredError, s.r2) for t, c in terms]
    return train.sparkSession.createDataFrame(rows, "term string, coefficient double, rmse double, r2 double")


def multinomial_coefficients(train: DataFrame, label: str, max_iter: int = 10, reg: float = 0.3, elastic: float = 0.8) -> DataFrame:
    """``(class, intercept, coefficients)``: one row per class."""
    model = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg, elasticNetParam=elastic, labelCol=label).fit(train)
    m, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    rows = [(i, float(b[i]), [float(x) for x in m[i]]) for i in range(len(b))]
    return train.sparkSession.createDataFrame(rows, "class bigint, intercept double, coefficients array<double>")


def rmse(predicted: DataFrame, label: str) -> float:
    return RegressionEvaluator(metricName="rmse", labelCol=label).evaluate(predicted)


def auc(predicted: DataFrame, label: str) -> float:
    """Area under the ROC curve over the raw score, never over the hard prediction."""
    return BinaryClassificationEvaluator(metricName="areaUnderROC", labelCol=label, rawPredictionCol="rawPrediction").evaluate(predicted)


ROWS_PER_TASK = 500_000  # rows of a table kept over several fits that one task may hold


def dealt(df: DataFrame) -> DataFrame:
    """The table in tasks of at most about ``ROWS_PER_TASK`` rows; a packed file gives few tasks whatever its rows weigh."""
    tasks = math.ceil(df.count() / ROWS_PER_TASK)
    return df.repartition(tasks) if tasks > df.rdd.getNumPartitions() else df


ROWS_AT_ONCE = 1_000_000  # rows per core that the fits running together may hold, some hundred bytes each


def fits_at_once(df: DataFrame, most: int) -> int:
    """How many fits may run together: each keeps a copy of its rows, which must stay in memory as every level of a tree reads it."""
    held = ROWS_AT_ONCE * max(1, df.sparkSession.sparkContext.defaultParallelism)
    return max(1, min(most, held // max(1, df.count())))


def compare(train: DataFrame, test: DataFrame, estimators: dict[str, Estimator], label: str, metric: str) -> DataFrame:
    """``(model, metric, value, best)`` per estimator; the inputs are kept in memory over the fits."""
    score = {"rmse": rmse, "auc": auc}[metric]
    train, test = dealt(train).persist(), dealt(test).persist()
    try:
        rows = [(name, metric, float(score(e.fit(train).transform(test), label))) for name, e in estimators.items()]
    finally:
        train.unpersist()
        test.unpersist()
    top = (min if metric == "rmse" else max)(v for _, _, v in rows)
    return train.sparkSession.createDataFrame([(n, m, v, v == top) for n, m, v in rows], "model string, metric string, value double, best boolean")


def tune(
    train: DataFrame, estimator: Estimator, grid: dict[str, Sequence], evaluator, folds: int = 3, seed: int = 0, parallelism: int = 4,
) -> CrossValidatorModel:
    """Cross-validated grid search. A grid entry the estimator does not have is an error (Spark would ignore it).

    At most ``parallelism`` fits run together, fewer where their rows are many (see :func:`fits_at_once`).
    """
    builder = ParamGridBuilder()
    for name, values in grid.items():
        if not estimator.hasParam(name):
            raise ValueError(f"{type(estimator).__name__} has no parameter {name}")
        builder = builder.addGrid(estimator.getParam(name), list(values))
    cached = dealt(train).persist()
    try:
        cv = CrossValidator(estimator=estimator, estimatorParamMaps=builder.build(), evaluator=evaluator, numFolds=folds, seed=seed,
                            parallelism=fits_at_once(cached, parallelism))
        return cv.fit(cached)
    finally:
        cached.unpersist()


def tuning_table(spark, model: CrossValidatorModel) -> DataFrame:
    """``(params, value)``: mean metric per grid point."""
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda x: x[0].name)), float(avg))
            for m, avg in zip(model.getEstimatorParamMaps(), model.avgMetrics)]
    return spark.createDataFrame(rows, "params string, value double")


def text_classifier(train: DataFrame, text: str, label: str, features: int = 5000, max_iter: int = 20, reg: float = 0.01) -> PipelineModel:
    """Tokens, hashed counts, logistic regression."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="tokens", pattern=r"\s+"),
        HashingTF(inputCol="tokens", outputCol="features", numFeatures=features),
        LogisticRegression(maxIter=max_iter, regParam=reg, labelCol=label)]).fit(train)


def pair_classifier(pairs: DataFrame, label: str, a: str = "a", b: str = "b", mult: bool = False, max_iter: int = 20, reg: float = 0.01):
    """Multinomial model on ``[u, v, |u-v|(, u*v)]``; returns the model and a function that adds ``scores``."""
    def features(df):
        return df.withColumn("features", array_to_vector(V.pair_features(a, b, mult=mult)))

    model = LogisticRegression(family="multinomial", maxIter=max_iter, regParam=reg, labelCol=label).fit(features(pairs))

    def score(df):
        return model.transform(features(df)).withColumn("scores", vector_to_array("probability"))

    return model, score


def pair_accuracy(scored: DataFrame, label: str) -> DataFrame:
    return label_accuracy(scored, "scores", label)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
