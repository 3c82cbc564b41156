"""Spark ML feature steps and pipelines (H01-H11), and the linear projection of vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA, Bucketizer, CountVectorizer, HashingTF, Imputer, OneHotEncoder, RegexTokenizer, StandardScaler, StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from .tabular import hash_sample


def assemble(columns: Sequence[str], output: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def median_imputer(columns: Sequence[str], relative_error: float = 0.001) -> Imputer:
    """Fills nulls of ``columns`` in place with the approximate median: one pass, bounded sketches."""
    return Imputer(strategy="median", relativeError=relative_error, inputCols=list(columns), outputCols=list(columns))


def bucketize(column: str, splits: Sequence[float], output: str) -> Bucketizer:
    return Bucketizer(splits=list(splits), inputCol=column, outputCol=output)


def numeric_pipeline(columns: Sequence[str], impute: Sequence[str] = (), output: str = "numeric") -> Pipeline:
    """Impute, assemble and standardize (zero mean, unit deviation)."""
    steps = [median_imputer(impute)] if impute else []
    steps += [assemble(columns, f"{output}_raw"),
              StandardScaler(inputCol=f"{output}_raw", outputCol=output, withMean=True, withStd=True)]
    return Pipeline(stages=steps)


def categorical_pipeline(columns: Sequence[str], output: str = "categories") -> Pipeline:
    """Frequency index and one-hot vector (last category dropped) of each column."""
    index = StringIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid="keep")
    hot = OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_hot" for c in columns])
    return Pipeline(stages=[index, hot, assemble([f"{c}_hot" for c in columns], output)])


def feature_pipeline(numeric: Sequence[str], categorical: Sequence[str] = (), impute: Sequence[str] = ()) -> Pipeline:
    """Nested pipelines for both kinds of columns, joined in ``features``."""
    stages, parts = [numeric_pipeline(numeric, impute)], ["numeric"]
    if categorical:
        stages.append(categorical_pipeline(categorical))
        parts.append("categories")
    return Pipeline(stages=[*stages, assemble(parts)])


def pca_pipeline(columns: Sequence[str], k: int) -> Pipeline:
    """PCA on the raw columns, standardized afterwards."""
    return Pipeline(stages=[
        assemble(columns, "raw"), PCA(k=k, inputCol="raw", outputCol="pca"),
        StandardScaler(inputCol="pca", outputCol="features", withMean=True, withStd=True)])


def hashed_text_pipeline(text: str, features: int = 5000) -> Pipeline:
    return Pipeline(stages=[RegexTokenizer(inputCol=text, outputCol="tokens", pattern=r"\s+"),
                            HashingTF(inputCol="tokens", outputCol="features", numFeatures=features)])


def count_vectorizer(tokens: str, output: str, vocabulary: int, min_df: float) -> CountVectorizer:
    return CountVectorizer(inputCol=tokens, outputCol=output, vocabSize=vocabulary, minDF=min_df)


def fit_projection(emb: DataFrame, dim: int, sample: int | None = None, seed: int = 0, id: str = "id", vector: str = "embedding") -> PipelineModel:
    """Principal axes of all rows, or of ``sample`` rows in hash order."""
    rows = emb.select(id, vector) if sample is None else hash_sample(emb.select(id, vector), id, sample, seed)
    rows = rows.select(array_to_vector(V.as_double(vector)).alias("v"))
    return PCA(k=dim, inputCol="v", outputCol="p").fit(rows)


def project(emb: DataFrame, model, vector: str = "embedding") -> DataFrame:
    """Replaces the vector by its coordinates on the axes. The mean is not subtracted."""
    out = model.transform(emb.withColumn("v", array_to_vector(V.as_double(vector))))
    return out.withColumn(vector, vector_to_array(F.col("p"))).drop("v", "p")
