import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quillon.operators import boundaries as B

NOUNS = ["house", "river", "letter", "garden", "winter", "engine"]
VERBS = ["waited", "stopped", "answered", "vanished"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Doctors (`dr.`) stand before names, so they are no end; `etc.` stands at ends before the starter `The` as well."""
    texts = []
    for i in range(120):
        a, b, v = NOUNS[i % 6], NOUNS[(i * 5 + 1) % 6], VERBS[i % 4]
        texts.append(f"The {a} {v} near dr. Marsh and {v}. The {b}, chairs etc. were by the {a}. The {a} {v} with lamps etc. The {b} {v}. Then they {v}!")
    return spark.createDataFrame([(i, "xx" if i % 2 else None, t) for i, t in enumerate(texts)], "id bigint, lang string, text string")


@pytest.mark.parametrize("by", [[], ["lang"]])
def test_abbreviations_do_not_end_sentences(spark, corpus, by):
    new = spark.createDataFrame([
        (1, "xx", "Then dr. Marsh waited. The lamps etc. were old."),
        (2, "xx", "We saw lamps etc. The river stopped. \"Dr. Marsh answered.\" Good"),
        (3, None, "The engine vanished. the river stopped! Dr.\n Marsh"), (4, "xx", None), (5, None, "  ")],
        "id bigint, lang string, text string")
    got = rows(B.learned_sentences(new, "id", "text", by, corpus))
    assert got == [
        (1, 0, "Then dr. Marsh waited."), (1, 1, "The lamps etc. were old."),
        (2, 0, "We saw lamps etc."), (2, 1, "The river stopped."), (2, 2, "\"Dr. Marsh answered.\" Good"),
        (3, 0, "The engine vanished."), (3, 1, "the river stopped!"), (3, 2, "Dr. Marsh")]


def test_scores_follow_the_formula(corpus):
    got = {r.kind: r for r in B.abbreviation_scores(corpus, "text").collect()}
    assert (got["dr"].n_stop, got["dr"].n_plain) == (120, 0)
    words = [w for r in corpus.collect() for w in r.text.split()]
    share = sum(w.endswith(".") for w in words) / len(words)
    assert got["dr"].score == pytest.approx(240 * math.log(.99 / share) * math.exp(-2))
    assert got["dr"].score > B.ABBREVIATION > max(r.score for k, r in got.items() if k not in ("dr", "etc"))


def test_association_is_the_log_likelihood_ratio(spark):
    def plain(both, a, b, n):
        cells = [(both, a * b), (a - both, a * (n - b)), (b - both, (n - a) * b), (n - a - b + both, (n - a) * (n - b))]
        return 2 * sum(o * math.log(o * n / e) for o, e in cells if o) if both * n > a * b else 0.0

    data = [(5, 10, 7, 1000), (1, 10, 700, 1000), (10, 10, 10, 50), (3, 3, 3, 3)]
    df = spark.createDataFrame(data, "both bigint, a bigint, b bigint, n bigint")
    got = df.select(B.association(*[df[c] for c in df.columns])).collect()
    assert [r[0] for r in got] == pytest.approx([plain(*d) for d in data])


def test_empty(spark):
    empty = spark.createDataFrame([], "id bigint, text string")
    assert B.learned_sentences(empty, "id", "text").count() == 0


def test_no_table_of_all_neighbours_is_kept_and_texts_stay(spark, corpus, monkeypatch):
    """What is written is counts of types and neighbours of abbreviations; few texts with an open end are broadcast to the texts."""
    kept = []
    real = B.cut_lineage
    monkeypatch.setattr(B, "cut_lineage", lambda df: kept.append(real(df)) or kept[-1])
    many = corpus.withColumn("text", F.concat("text", F.lit(" "), F.concat_ws(" ", *[F.concat(F.lit(f"w{i}"), F.lit("x"), (F.col("id") * (i + 1) % 7).cast("string")) for i in range(30)])))
    out = B.learned_sentences(many, "id", "text", ["lang"])
    words = {(r.lang, w.lower().rstrip(".")) for r in many.collect() for w in r.text.split()}
    assert max(k.count() for k in kept) <= len(words)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    want = rows(out)
    monkeypatch.setattr(B, "BROADCAST_ROWS", 0)
    assert rows(B.learned_sentences(many, "id", "text", ["lang"])) == want
