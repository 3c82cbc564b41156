import numpy as np
import pytest

from quillon.operators import selection as S


@pytest.mark.parametrize("bins", [2, 1024])
def test_exact_medians(spark, bins):
    rng = np.random.default_rng(8)
    n = 61
    columns = {
        "odd": rng.normal(size=n), "ties": np.where(np.arange(n) % 3 == 0, 5.0, rng.integers(0, 9, n)), "wide": 10.0 ** rng.integers(-12, 13, n),
        "far": np.where(np.arange(n) % 2 == 0, 1.7e308, -1.7e308), "tiny": np.where(np.arange(n) % 2 == 0, 5e-324, 0.0), "same": np.full(n, 2.5)}
    rows = [tuple(float(columns[c][i]) for c in columns) for i in range(n)]
    holes = [float("nan"), None, float("inf"), float("-inf")]
    rows = [(*r, float(i) if i < 20 else holes[i % 4], None) for i, r in enumerate(rows)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*columns, "holes", "empty"])).repartition(5)
    got = S.exact_medians(df, [*columns, "holes", "empty"], bins)
    assert got == {**{c: float(np.median(v)) for c, v in columns.items()}, "holes": 9.5, "empty": None}


def test_fill_medians(spark):
    df = spark.createDataFrame([(1, 1.0, 4), (2, None, None), (3, float("nan"), 7), (4, 3.0, 9)], "x0 int, a double, n int")
    assert sorted(map(tuple, S.fill_medians(df, ["a", "n"]).collect())) == [(1, 1.0, 4.0), (2, 2.0, 7.0), (3, 2.0, 7.0), (4, 3.0, 9.0)]
    none = spark.createDataFrame([], "a double")
    assert S.exact_medians(none, ["a"]) == {"a": None} and S.exact_medians(none, []) == {} and S.fill_medians(none, ["a"]).count() == 0
