"""Lines are numbered in file order over the blocks of a file, and their text never crosses an exchange."""

import bz2
import gzip
import os

import pytest
from pyspark.sql import functions as F

from quillon.sources import readers as R

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get(SPLIT)
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(SPLIT, "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.set(SPLIT, before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_blocks(small_blocks, tmp_path):
    spark, want = small_blocks, []
    for name, n in (("a", 300), ("b", 0), ("c", 1), ("d", 120)):
        text = [f"{name} {i} " + "é" * (i % 7) + ("" if i % 11 else "x" * 900) for i in range(n)]  # lines longer than a block
        (tmp_path / f"{name}.txt").write_text("".join(t + "\n" for t in text))
        want += [(os.path.basename(f"{name}.txt"), i, t) for i, t in enumerate(text)]
    df = R.read_lines(spark, str(tmp_path))
    assert df.rdd.getNumPartitions() > 8
    got = df.select(F.regexp_extract("file", "[^/]+$", 0), "line", "value").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    ordered = R.ordered_lines(spark, str(tmp_path))
    assert sorted(map(tuple, ordered.collect())) == [(i, t) for i, (_, _, t) in enumerate(want)]
    for p in (plan(df), plan(ordered)):
        assert "Exchange" not in p.replace("BroadcastExchange", "")


def test_compressed_files(small_blocks, tmp_path):
    spark = small_blocks
    text = [f"line {i} {'abc' * (i % 5)}" for i in range(2000)]
    for name, opened in (("x.gz", gzip.open), ("x.bz2", bz2.open)):
        with opened(tmp_path / name, "wt") as f:
            f.write("\n".join(text))  # no newline at the end
        df = R.read_lines(spark, str(tmp_path / name))
        assert [tuple(r) for r in df.orderBy("line").select("line", "value").collect()] == list(enumerate(text))
        assert "Exchange" not in plan(df).replace("BroadcastExchange", "")


def test_empty_file(spark, tmp_path):
    (tmp_path / "none.txt").write_text("")
    assert R.read_lines(spark, str(tmp_path / "none.txt")).count() == 0 and R.ordered_lines(spark, str(tmp_path / "none.txt")).count() == 0


def test_beyond_the_broadcast(spark, tmp_path, monkeypatch):
    (tmp_path / "a.txt").write_text("x\ny\nz\n")
    monkeypatch.setattr(R, "BLOCK_TABLE_BYTES", 0)
    assert [tuple(r) for r in R.ordered_lines(spark, str(tmp_path / "a.txt")).orderBy("line").collect()] == [(0, "x"), (1, "y"), (2, "z")]
