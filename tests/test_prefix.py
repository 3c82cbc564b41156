import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.operators import prefix as P


def test_running_matches_a_plain_scan(spark, rng):
    n = 500
    data = [(int(i), int(g), float(s), int(x)) for i, g, s, x in zip(range(n), rng.choice([0, 1, 2, 9], n, p=[.7, .1, .1, .1]), rng.integers(0, 5, n), rng.integers(0, 9, n))]
    df = spark.createDataFrame(data, "id bigint, g bigint, s double, x bigint").repartition(5)
    out = {r["id"]: (r["position"], r["t"]) for r in P.running(df, [F.col("s").desc(), F.col("id").asc()], {"t": F.col("x")}, by=["g"]).collect()}
    for g in {d[1] for d in data}:
        total = 0
        for pos, d in enumerate(sorted((d for d in data if d[1] == g), key=lambda d: (-d[2], d[0])), 1):
            total += d[3]
            assert out[d[0]] == (pos, total)
    assert len(out) == n


def test_running_without_groups_spans_partitions(spark):
    df = spark.range(1000).select("id", F.lit("same").alias("v"))
    out = P.running(df, [F.col("v").asc(), F.col("id").asc()], {"t": F.col("id")})
    got = {r["id"]: (r["position"], r["t"]) for r in out.collect()}
    assert all(got[i] == (i + 1, i * (i + 1) / 2) for i in range(1000))
    assert out.rdd.getNumPartitions() > 1


def test_null_groups_are_one_group(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], "id bigint, g string")
    assert {r["id"]: r["position"] for r in P.global_row_number(df, [F.col("id").asc()], by=["g"]).collect()} == {1: 1, 2: 2, 3: 1, 4: 2}


def test_empty(spark):
    df = spark.createDataFrame([], "id bigint, g string")
    assert P.global_row_number(df, [F.col("id").asc()], by=["g"]).count() == 0


@pytest.mark.parametrize("n", [0, 3, 20_000])
def test_first_n(spark, n):
    df = spark.range(12_000).withColumn("k", -F.col("id"))
    out = P.first_n(df, [F.col("k").asc()], n)
    got = sorted(r["id"] for r in out.collect())
    assert got == list(range(12_000))[max(0, 12_000 - n):]


def test_average_ranks(spark):
    df = spark.createDataFrame([(v,) for v in [3.0, 1.0, 3.0, 2.0, None, 3.0]], "v double")
    assert {r["v"]: (r["n"], r["rank"]) for r in P.average_ranks(df, "v").collect()} == {1.0: (1, 1.0), 2.0: (1, 2.0), 3.0: (3, 4.0)}


def test_segments_cross_batches(rng):
    x, starts = rng.integers(0, 9, 50).astype(float), rng.random(50) < .2
    got = P._segmented(x, starts, 4.0)
    total, want = 4.0, []
    for v, s in zip(x, starts):
        total = v if s else total + v
        want.append(total)
    assert np.allclose(got, want)


def test_long_rank_lists_do_not_use_a_window(spark):
    from quillon.operators import search as S
    from quillon.operators import tabular as T
    df = spark.range(4000).select("id", (F.col("id") % 3 == 0).cast("int").alias("g"), (F.col("id") % 50).cast("double").alias("s"))
    top = S.top_k(df, "g", "s", "id", 1200)
    short = S.top_k(df, "g", "s", "id", 900)
    got = {r["id"]: r["rank"] for r in top.collect()}
    assert len(got) == 2400 and all(got[r["id"]] == r["rank"] for r in short.collect())
    assert T.cap_per_key(df, ["g"], [F.col("id").asc()], 1100).groupBy("g").count().where("count <> 1100").count() == 0
