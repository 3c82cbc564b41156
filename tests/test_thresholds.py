import numpy as np
import pytest
from pyspark.sql import functions as F
from test_evaluate import step_ap, sweep

from quillon.operators import evaluate as E
from quillon.operators import thresholds as H


@pytest.mark.parametrize("levels", [2, 5, 400])
def test_cuts_and_steps_over_borders(spark, rng, levels):
    """Four range partitions and batches of seven rows: groups, runs of equal scores and the best cuts cross their borders."""
    n = 400
    group = rng.choice([0, 0, 0, 0, 1, 2], n)
    score = rng.integers(0, levels, n) / 4.0
    label = (rng.random(n) < .3 + .4 * score / score.max()).astype(int)
    df = spark.createDataFrame([(i, int(g), float(s), int(y)) for i, (g, s, y) in enumerate(zip(group, score, label))],
                               "id bigint, g bigint, s double, y bigint")
    got = {r["g"]: r for r in H.threshold_measures(df, "s", "y", "id", ["g"]).collect()}
    for g in range(3):
        # Within a group the order of ids is kept.
        s, y = score[group == g].tolist(), label[group == g].tolist()
        acc, f1 = sweep(s, y, True)
        r = got[g]
        assert (r["accuracy"], r["accuracy_threshold"]) == pytest.approx(acc)
        assert (r["f1"], r["precision"], r["recall"], r["f1_threshold"]) == pytest.approx(f1)
        assert r["ap"] == pytest.approx(step_ap(s, y))


def test_hull_keeps_every_first_best_cut(rng):
    for _ in range(60):
        n = int(rng.integers(1, 60))
        y = rng.integers(0, 2, n)
        points = np.column_stack([np.arange(1, n + 1), np.cumsum(y)]).astype(float)
        corners = {int(a) for a in H._hull(points)[:, 0]}
        for n0, h0, rest in [(0, 0, 0), (7, 3, 5), (50, 1, 20)]:
            at, hits = points[:, 0] + n0, points[:, 1] + h0
            assert int(np.argmax(2 * hits - at)) + 1 in corners
            assert int(np.argmax(hits / (at + hits[-1] + rest + 1))) + 1 in corners


def test_nulls_and_empty(spark):
    schema = "id bigint, g string, s double, y bigint"
    df = spark.createDataFrame([(1, None, .9, 1), (2, None, .5, None), (3, None, None, 0), (4, "a", None, 1)], schema)
    got = {r["g"]: tuple(r)[1:] for r in H.threshold_measures(df, "s", "y", "id", ["g"]).collect()}
    assert got[None] == pytest.approx((1.0, .7, 1.0, 1.0, 1.0, .7, 1.0))
    assert got["a"] == pytest.approx((0.0, -1.0, 0.0, 0.0, 0.0, 0.0, 1.0))
    assert H.threshold_measures(df.where("id > 9"), "s", "y", "id").count() == 0


def test_report_sorts_once(spark, rng, monkeypatch):
    """One range shuffle, and no exchange over rows after it."""
    calls = []
    arrange = H.arrange
    monkeypatch.setattr(H, "arrange", lambda *a, **k: calls.append(a) or arrange(*a, **k))
    rows = [(i, rng.standard_normal(4).tolist(), rng.standard_normal(4).tolist(), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, a array<double>, b array<double>, y int")
    out = E.binary_classification_report(df, "y")
    assert len(calls) == 1 and out.count() == 4
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert out.select(F.max("ap")).head()[0] == out.head()["main"]
