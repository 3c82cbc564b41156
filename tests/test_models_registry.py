import os

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array

from quillon.operators import features as H
from quillon.operators import models as M
from quillon.plans import registry

SF = "/root/testdata/sf0.001"


def test_projection_is_not_centred(spark, vectors, rng):
    mat = rng.standard_normal((80, 6)) * np.arange(1, 7) + 3
    emb = vectors(mat)
    model = H.fit_projection(emb, 2)
    got = np.array([r["embedding"] for r in H.project(emb, model).orderBy("id").collect()])
    assert np.allclose(got, mat @ model.pc.toArray())
    cov = np.cov(mat.T)
    top = np.linalg.eigh(cov)[1][:, ::-1][:, :2]
    assert np.allclose(np.abs(top.T @ model.pc.toArray()), np.eye(2), atol=1e-6)


def test_pca_pipeline_standardizes(spark, rng):
    cols = [f"x{i}" for i in range(4)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in rng.standard_normal((60, 4)) * [1, 5, 9, 2]], cols)
    out = np.array([r[0] for r in H.pca_pipeline(cols, 3).fit(df).transform(df).select(vector_to_array("features")).collect()])
    assert np.allclose(out.mean(0), 0) and np.allclose(out.std(0, ddof=1), 1)


def test_nested_pipeline_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1.0, None, "a"), (2.0, 5.0, "b"), (3.0, 7.0, "a")], "x double, y double, c string")
    model = H.feature_pipeline(["x", "y"], ["c"], ["y"]).fit(df)
    M.save(model, str(tmp_path / "m"))
    a, b = (m.transform(df).select("features").collect() for m in (model, M.load(str(tmp_path / "m"))))
    assert a == b and len(a[0][0]) == 4


@pytest.fixture
def classes(spark, rng):
    y = rng.integers(0, 2, 120)
    x = rng.standard_normal((120, 3)) + y[:, None] * 2
    return spark.createDataFrame([(float(l), [float(v) for v in r]) for l, r in zip(y, x)], "y double, a array<double>").withColumn("features", array_to_vector("a"))


def test_tuning_rejects_foreign_parameters(spark, classes):
    ev = BinaryClassificationEvaluator(labelCol="y")
    with pytest.raises(ValueError, match="numTrees"):
        M.tune(classes, DecisionTreeClassifier(labelCol="y"), {"numTrees": [1]}, ev)
    model = M.tune(classes, DecisionTreeClassifier(labelCol="y"), {"maxDepth": [1, 3]}, ev, folds=2)
    assert M.tuning_table(spark, model).count() == 2


def test_comparison_marks_the_best(spark, classes):
    out = M.compare(classes, classes, M.classifiers("y"), "y", "auc").collect()
    assert len(out) == 3 and sum(r["best"] for r in out) >= 1 and max(r["value"] for r in out) > .9


def test_pair_classifier(spark, rng):
    a = rng.standard_normal((90, 3))
    y = [i % 3 for i in range(90)]
    b = a + np.array(y)[:, None] * 3
    df = spark.createDataFrame([(p.tolist(), q.tolist(), l) for p, q, l in zip(a, b, y)], "a array<double>, b array<double>, y bigint")
    _, score = M.pair_classifier(df, "y")
    assert M.pair_accuracy(score(df), "y").head()[0] > .9


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    q, s = entry.queries(), entry.oracle_sql()
    assert set(s) <= set(q) and len(q) > 150
    done = {k.split("_")[0].upper() for k in q}
    wanted = {f"{f}{i:02d}" for f, n in dict(A=21, B=15, C=7, D=13, E=5, F=9, G=13, H=14, I=11, J=20, K=19, M=11, N=25).items() for i in range(1, n + 1)}
    assert wanted - done == set()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", ["d10_spearman", "k05_binary_report", "j04_community_detection", "n13_task_files", "g04_vocab_tokenizer"])
def test_queries_run(spark, name):
    assert registry()[name][0](spark, SF).count() > 0


def test_kept_tables_have_tasks_of_bounded_rows(spark, monkeypatch):
    from quillon.operators import models as M
    df = spark.range(1000).repartition(2)
    assert M.dealt(df) is df
    monkeypatch.setattr(M, "ROWS_PER_TASK", 100)
    sizes = [len(p) for p in M.dealt(df).rdd.glom().collect()]
    assert len(sizes) == 10 and max(sizes) <= 150 and sum(sizes) == 1000


def test_fits_together_hold_bounded_rows(spark, classes, monkeypatch):
    assert M.fits_at_once(classes, 8) == 8
    monkeypatch.setattr(M, "ROWS_AT_ONCE", 70)  # four cores: 280 rows, two copies of 120
    assert M.fits_at_once(classes, 8) == 2
    seen = []
    real = M.CrossValidator
    monkeypatch.setattr(M, "CrossValidator", lambda **k: seen.append(k["parallelism"]) or real(**k))
    M.tune(classes, DecisionTreeClassifier(labelCol="y"), {"maxDepth": [1, 3]}, BinaryClassificationEvaluator(labelCol="y"), folds=2, parallelism=8)
    monkeypatch.setattr(M, "ROWS_AT_ONCE", 1)
    assert seen == [2] and M.fits_at_once(classes, 8) == 1
