import gzip
import lzma
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quillon.functions import hashing as H
from quillon.functions import text as X
from quillon.functions import vectors as V
from quillon.operators import lexical as L
from quillon.operators import tabular as T
from quillon.sources import readers as R
from quillon.sources import sinks as K


def one(spark, col, value, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(col.alias("r")).head()["r"]


@pytest.mark.parametrize("text,want", [(None, []), ("  ", []), ("a b c\x1fd\n e", ["a", "b", "c", "d", "e"])])
def test_words(spark, text, want):
    assert one(spark, X.words("t"), text) == want


def test_search_tokens(spark):
    assert one(spark, X.search_tokens("t", ["the"]), "The 'quick' fox's -- $5.00! THE. (Ü)") == ["quick", "fox's", "5.00", "ü"]


def test_duplicate_key(spark):
    a = one(spark, X.duplicate_key("t", ["the", "do", "i"]), "How can you fix the [car]?")
    assert a == one(spark, X.duplicate_key("t", ["the", "do", "i"]), "how do we fix car") == "howfixcar"


def test_passages_do_not_cross_paragraphs(spark):
    text = "A one. B two! C three? D four.\n\nE five.\n \n\n"
    assert one(spark, X.passage_windows("t"), text) == ["A one. B two! C three?", "D four.", "E five."]
    assert one(spark, X.passage_windows("t"), None) == []


def test_delete_words_keeps_one(spark):
    df = spark.range(300).select("id", F.lit("a b c").alias("t"))
    out = [r[0].split() for r in df.select(X.delete_words("t", "id", .9)).collect()]
    assert min(map(len, out)) == 1 and all(w in {"a", "b", "c"} for o in out for w in o)
    share = sum(map(len, [r[0].split() for r in spark.range(300).select(X.delete_words(F.lit("a b c d e f g h"), F.col("id"), .6)).collect()])) / 2400
    assert .35 < share < .45
    assert one(spark, X.delete_words("t", F.lit(1)), None) == ""


def test_vocab_tokens_stages(spark):
    df = spark.createDataFrame([(1, "The (cat) Dog! dog?? Bird no")], "id bigint, t string")
    vocab = spark.createDataFrame([("cat", 1), ("dog", 2), ("Bird", 3), ("the", 9)], "word string, idx int")
    assert rows(X.vocab_tokens(df, "id", "t", vocab, ["the"]), "pos", "token", "idx") == [(1, "cat", 1), (2, "dog", 2), (3, "dog", 2), (4, "Bird", 3)]


def test_merge_phrases_longest_first(spark):
    df = spark.createDataFrame([(["New", "York", "City", "new", "york", "x"],), (None,)], "t array<string>")
    ph = spark.createDataFrame([("new_york",), ("new_york_city",), ("bad__one",), ("word",)], "phrase string")
    out = [r["merged"] for r in X.merge_phrases(df, "t", ph).collect()]
    assert out == [["new_york_city", "new_york", "x"], []]
    with pytest.raises(ValueError, match="id column"):
        X.merge_phrases(df, "t", ph, limit=1)


def test_merge_phrases_by_join_equals_the_broadcast_set(spark, rng):
    words = ["a", "B", "c", "D"]
    data = [(i, [words[j] for j in rng.integers(0, 4, rng.integers(0, 9))]) for i in range(80)]
    df = spark.createDataFrame(data, "id bigint, t array<string>")
    ph = spark.createDataFrame([(p,) for p in ("a_b", "a_B", "c_d_a", "B_c", "d_d_d_d", "a_b_C", "b_a_b", "d_a")], "phrase string")
    small = X.merge_phrases(df, "t", ph)
    joined = X.merge_phrases(df, "t", ph, id="id", limit=1)
    assert rows(small, "id", "merged") == rows(joined, "id", "merged")
    assert small.where("size(merged) < size(t)").count() > 20


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, b array<float>")
    r = df.select(V.l2_normalize("a").alias("u"), V.l2_normalize("b").alias("z"), V.cosine("a", "b").alias("c"), V.dot("a", "a").alias("d"),
                  V.pair_features("a", "b", mult=True).alias("f"), V.weighted_layers(F.array("a", "a", "b"), [1.0, 3.0], 1).alias("w")).head()
    assert r["u"] == pytest.approx([.6, .8]) and r["z"] == [0.0, 0.0] and r["c"] == 0.0 and r["d"] == 25.0
    assert r["f"] == [3, 4, 0, 0, 3, 4, 0, 0] and r["w"] == [.75, 1.0]


def test_pooling_modes(spark):
    df = spark.createDataFrame([(1, 0, [1.0, -5.0], 1.0), (1, 1, [3.0, -1.0], 3.0)], "id bigint, pos bigint, vector array<double>, w double")
    assert L.pool_tokens(df, modes=("cls", "max", "mean", "sqrt")).head()["embedding"] == pytest.approx([1, -5, 3, -1, 2, -3, 4 / 2 ** .5, -6 / 2 ** .5])
    assert L.pool_tokens(df, modes=("mean",), weight="w").head()["embedding"] == pytest.approx([2.5, -2.0])


def test_bow_and_idf(spark):
    t = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "id bigint, token string")
    w = spark.createDataFrame([("a", 2.0)], "token string, weight double")
    assert rows(L.bow(t, w)) == [(1, "a", 4.0), (1, "b", 1.0), (2, "a", 2.0)]
    assert rows(L.bow(t, w, cumulative=False, unknown=0.5)) == [(1, "a", 2.0), (1, "b", .5), (2, "a", 2.0)]
    assert dict((r["token"], r["idf"]) for r in L.idf(t).collect()) == pytest.approx({"a": 0.0, "b": 0.6931471805599453})


def test_hash_split_is_stable(spark):
    a = T.hash_split(spark.range(2000), "id", {"train": .7, "dev": .2, "test": .1}, 5)
    assert rows(a) == rows(T.hash_split(spark.range(2000).repartition(9), "id", {"train": .7, "dev": .2, "test": .1}, 5))
    n = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    assert abs(n["train"] - 1400) < 80 and abs(n["dev"] - 400) < 60
    assert spark.range(100).where(H.hash_unit("id").between(0, 1)).count() == 100


def test_label_id_of_unknown_label_is_null(spark):
    df = spark.createDataFrame([(" Entailment",), ("-",), (None,)], "l string")
    assert [r[0] for r in df.select(T.label_id("l", ["contradiction", "entailment"])).collect()] == [1, None, None]


def test_weights_follow_temperature(spark):
    s = spark.createDataFrame([("a", 1), ("b", 9999)], "dataset string, n bigint")
    assert dict(rows(T.dataset_weights(s, 1.0), "dataset", "weight")) == {"a": 1, "b": 999}
    assert dict(rows(T.dataset_weights(s, 0), "dataset", "weight")) == {"a": 100, "b": 100}


def test_lines_are_numbered_across_blocks_and_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(3000)))
    (tmp_path / "b.txt").write_text("x\ny\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = rows(R.ordered_lines(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [(i, f"line {i}") for i in range(3000)] + [(3000, "x"), (3001, "y")]


def test_compressed_files(spark, tmp_path):
    text = "".join(f"row {i}\n" for i in range(25))
    with gzip.open(tmp_path / "f.gz", "wt") as f:
        f.write(text)
    with lzma.open(tmp_path / "f.xz", "wt") as f:
        f.write(text)
    want = [(i, f"row {i}") for i in range(25)]
    assert rows(R.read_lines(spark, str(tmp_path / "f.gz")), "line", "value") == want
    assert rows(R.read_lines(spark, str(tmp_path / "f.xz")), "line", "value") == want


def test_paired_files_stop_at_the_shortest(spark, tmp_path):
    for name, n in (("a", 5), ("b", 3)):
        (tmp_path / name).write_text("".join(f"{name}{i}\n" for i in range(n)))
    out = R.read_paired_files(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert rows(out, "guid", "texts", "label") == [(str(i), [f"a{i}", f"b{i}"], 1) for i in range(3)]


def test_sts_reader_takes_quotes_as_text(spark, tmp_path):
    (tmp_path / "dev.tsv").write_text('g\tf\ty\t1\t2.5\t"a\tb"c\textra\n')
    r = R.read_sts_pairs(spark, str(tmp_path / "dev.tsv")).head()
    assert (r["guid"], r["texts"], r["label"]) == ("dev.tsv0", ['"a', 'b"c'], .5)


def test_labels_in_first_seen_order(spark, tmp_path):
    (tmp_path / "t").write_text("z\tone\na\ttwo\nz\tthree\n")
    assert rows(R.read_labelled_sentences(spark, str(tmp_path / "t"))) == [(0, "one", "z", 0), (1, "two", "a", 1), (2, "three", "z", 0)]


def test_word_vectors_skip_bad_lines(spark, tmp_path):
    (tmp_path / "v").write_text("a 1 2\nbad 1\nb 3 4\nc 5 6\n")
    got = [tuple(r) for r in R.read_word_vectors(spark, str(tmp_path / "v")).orderBy("idx").collect()]
    assert got == [(0, "PADDING_TOKEN", [0.0, 0.0]), (1, "a", [1.0, 2.0]), (2, "b", [3.0, 4.0]), (3, "c", [5.0, 6.0])]
    assert R.read_word_vectors(spark, str(tmp_path / "v"), max_vocab=1).count() == 2


def test_doc_frequencies(spark, tmp_path):
    (tmp_path / "f").write_text("100\nThe\t50\ncat\t10\ndog\t5\n")
    assert [r["token"] for r in R.read_doc_frequencies(spark, str(tmp_path / "f"), ["the"], 1).collect()] == ["cat"]


def test_parallel_rows_with_a_long_cell_are_left_out(spark, tmp_path):
    (tmp_path / "p").write_text("a\tb\naaaa\tb\nc\td\te\n")
    assert rows(R.read_parallel_tsv(spark, str(tmp_path / "p"), max_len=3), "texts") == [(["a", "b"],), (["c", "d", "e"],)]
    assert R.read_parallel_tsv(spark, str(tmp_path / "p"), max_len=None, max_rows=1).count() == 1


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\tb\nc", None)], "id bigint, t string, n string")
    K.write_tsv(df, str(tmp_path / "tsv"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "tsv")).collect()] == ["1\ta b c\t"]
    calls = []

    def encode(missing):
        calls.append(missing.count())
        return missing.select("id", F.array(F.col("id").cast("float")).alias("embedding"))

    K.cached_embeddings(spark.range(5), str(tmp_path / "c"), "id", encode)
    assert K.cached_embeddings(spark.range(8), str(tmp_path / "c"), "id", encode).count() == 8 and calls == [5, 3]


def test_row_rules_hold_on_a_stream(spark, tmp_path):
    spark.createDataFrame([(1, "A, b"), (2, "c")], "id bigint, t string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id bigint, t string").parquet(str(tmp_path / "in"))
    q = stream.select("id", X.search_tokens("t").alias("tokens")).writeStream.format("memory").queryName("tokens_out").start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(spark.table("tokens_out")) == [(1, ["a", "b"]), (2, ["c"])]


def _shuffled_rows(df):
    """Keys of the plan's exchanges by hash."""
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


def test_word_vectors_move_no_tokens_of_dealt_texts(spark):
    lists = spark.createDataFrame([(i, ["a", "b", "b", "c"][: 1 + i % 4]) for i in range(20)], "id bigint, tokens array<string>")
    t = lists.repartition("id").select("id", F.posexplode("tokens").alias("pos", "token"))
    v = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("c", [5.0, 5.0])], "word string, vector array<double>")
    w = spark.createDataFrame([("a", 3.0)], "token string, weight double")
    for modes in (("mean",), ("cls", "max", "mean", "sqrt")):
        out = L.average_word_vectors(t, v, w, modes)
        assert len(_shuffled_rows(out)) == 1 and "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
        joined = L.average_word_vectors(t, v, w, modes, broadcast_words=0)
        assert rows(out.select("id", F.transform("embedding", lambda x: F.round(x, 9)))) == rows(joined.select("id", F.transform("embedding", lambda x: F.round(x, 9))))


@pytest.mark.parametrize("most", [0, 1, 2, 9])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_only_rare_words_are_shuffled(spark, how, most):
    said = ["a"] * 9 + ["b"] * 5 + ["x"] * 4 + ["c", None, "y"]  # x and y are not in the table, d is in no row, c is twice
    df = spark.createDataFrame(list(enumerate(said)), "id bigint, token string")
    words = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("c", 4.0), ("d", 5.0), ("e", 6.0)], "token string, weight double")
    key = lambda r: tuple(str(x) for x in r)
    want = sorted(map(key, df.join(words, "token", how).collect()))
    got = L.join_words(df, words, how, most=most)
    assert sorted(map(key, got.collect())) == want
    if most in (1, 2):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("most", [0, 2, 9])
def test_both_bags_from_one_pass(spark, monkeypatch, most):
    """The weights say how frequent a word is, so that the texts are not counted again for the words to broadcast."""
    monkeypatch.setattr(L, "BROADCAST_WORDS", most)
    said = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "a"), (3, "b"), (3, "x"), (None, "x")]
    t = spark.createDataFrame(said, "id bigint, token string")
    w = spark.createDataFrame([("a", 2.0, 3), ("b", 3.0, 2), ("c", 5.0, 1)], "token string, weight double, df bigint")
    out = L.bow(t, w, cumulative={"sum": True, "once": False})
    assert out.columns == ["id", "token", "sum", "once"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, out.collect())) == sorted(map(key, [
        (1, "a", 4.0, 2.0), (1, "b", 3.0, 3.0), (2, "a", 2.0, 2.0), (2, "c", 5.0, 5.0), (3, "a", 2.0, 2.0), (3, "b", 3.0, 3.0), (3, "x", 1.0, 1.0), (None, "x", 1.0, 1.0)]))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == (1 if most == 9 else 2)  # one count of the rows for each branch, none for the words
