import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillon.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Partitions are not merged, so that small tables still span several of them.
    s = session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.driver.memory": "4g",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "7"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture
def rng():
    return np.random.default_rng(3)


@pytest.fixture
def vectors(spark):
    def make(mat, ids=None, **extra):
        ids = range(len(mat)) if ids is None else ids
        rows = [(int(i), [float(x) for x in v], *[extra[k][n] for k in extra]) for n, (i, v) in enumerate(zip(ids, mat))]
        kinds = "".join(f", {k} {'string' if isinstance(v[0], str) else 'bigint'}" for k, v in extra.items())
        return spark.createDataFrame(rows, f"id bigint, embedding array<double>{kinds}")
    return make


def unit(mat):
    mat = np.asarray(mat, dtype=float)
    return mat / np.maximum(np.linalg.norm(mat, axis=1, keepdims=True), 1e-12)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())
