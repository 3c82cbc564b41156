"""Text rules as Column expressions (G). They work row by row, so they hold on streaming tables as well."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import hash_int

# The characters that count as white space and as (ASCII) punctuation at the edge of a token.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(text: Column | str) -> Column:
    """Whitespace tokens; null and blank texts give an empty array."""
    blanked = F.translate(F.coalesce(_c(text), F.lit("")), WHITE, " " * len(WHITE))
    return F.filter(F.split(blanked, " "), lambda w: w != "")


def strip(text: Column | str) -> Column:
    """The text without white space at its ends: tabs, line ends and the Unicode blanks as well as spaces."""
    return F.trim(_c(text), F.lit(WHITE))


def strip_punctuation(token: Column) -> Column:
    return F.trim(token, F.lit(PUNCTUATION))


def pooled_key(text: Column | str) -> Column:
    """Trimmed lower-case text: the key under which two texts count as the same."""
    return F.lower(strip(text))


def without(tokens: Column, stop: Sequence[str]) -> Column:
    if not stop:
        return tokens
    listed = F.array(*[F.lit(s) for s in stop])
    return F.filter(tokens, lambda w: ~F.array_contains(listed, w))


def search_tokens(text: Column | str, stop: Sequence[str] = ()) -> Column:
    """Tokens for lexical search: lower case, edge punctuation off, no empties, no stop words."""
    stripped = F.transform(words(F.lower(_c(text))), strip_punctuation)
    return without(F.filter(stripped, lambda w: w != ""), stop)


# Phrase rewrites in the order in which they apply, and the characters that become blanks.
PHRASES = [
    ("how do you", "how do i"),
    ("how do we", "how do i"),
    ("how can we", "how can i"),
    ("how can you", "how can i"),
    ("how can i", "how do i"),
    ("really true", "true"),
    ("what are the importance", "what is the importance"),
    ("what was", "what is"),
    ("so many", "many"),
    ("would it take", "will it take"),
]
BLANKED = ",!.?'\":;[]{}<>"


def duplicate_key(text: Column | str, stop: Sequence[str] = (), phrases: Sequence[tuple[str, str]] = PHRASES) -> Column:
    """Key under which near-equal questions collide: phrases rewritten, punctuation and stop words gone, no blanks."""
    col = F.lower(_c(text))
    for old, new in phrases:
        col = F.replace(col, F.lit(old), F.lit(new))
    col = F.translate(col, BLANKED, " " * len(BLANKED))
    return F.array_join(without(words(col), stop), "")


def sentences(text: Column | str) -> Column:
    """Sentences by rule: a break follows ``.``, ``!`` or ``?`` and white space."""
    marked = F.regexp_replace(F.coalesce(_c(text), F.lit("")), r"([.!?])\s+", "$1\u0001")
    parts = F.transform(F.split(marked, "\u0001"), strip)
    return F.filter(parts, lambda s: s != "")


def paragraphs(text: Column | str, separator: str = r"\n\s*\n") -> Column:
    parts = F.split(F.coalesce(_c(text), F.lit("")), separator)
    return F.filter(F.transform(parts, strip), lambda p: p != "")


def passage_windows(text: Column | str, n: int = 3, separator: str = r"\n\s*\n") -> Column:
    """Passages of ``n`` consecutive sentences that do not overlap and do not cross a paragraph break."""
    def windows(paragraph: Column) -> Column:
        sents = sentences(paragraph)
        groups = F.sequence(F.lit(0), F.floor((F.size(sents) - 1) / n).cast("int"))
        return F.when(F.size(sents) > 0, F.transform(
            groups, lambda i: F.array_join(F.slice(sents, i * n + 1, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))

    return F.flatten(F.transform(paragraphs(text, separator), windows))


def joined_fields(*cols: Column | str, marker: str = "[SEP]") -> Column:
    return F.concat_ws(marker, *[_c(c) for c in cols])


def delete_words(text: Column | str, id: Column | str, p: float = 0.6, seed: int = 0) -> Column:
    """Deletes each word with probability ``p``, seeded by row id and word position; keeps at least one word."""
    tokens = words(text)
    cut = int(round(p * 1000))

    def draw(i: Column) -> Column:
        return hash_int(F.concat_ws("-", _c(id).cast("string"), i.cast("string")), seed=seed)

    kept = F.filter(tokens, lambda w, i: F.pmod(draw(i), F.lit(1000)) >= cut)
    order = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: F.struct(draw(i).alias("h"), i.alias("i"))
    )
    lone = F.get(tokens, F.get(F.array_sort(order), F.lit(0))["i"])
    return F.when(F.size(tokens) == 0, F.lit("")).when(F.size(kept) == 0, lone).otherwise(F.array_join(kept, " "))


def vocab_tokens(
    df: DataFrame, id: str, text: str, vocab: DataFrame, stop: Sequence[str] = (), lower: bool = False
) -> DataFrame:
    """``(id, pos, token, idx)``: each token as it is, else without edge punctuation, else lower-cased, else dropped.

    A stop word at any of the three stages drops the token. ``vocab`` is ``(word, idx)``. The three stages are resolved
    once per distinct token, then joined back, so the vocabulary meets the distinct tokens and not the running text.
    """
    source = F.lower(F.col(text)) if lower else F.col(text)
    rows = df.select(id, F.posexplode(words(source)).alias("pos", "raw"))
    distinct = rows.select("raw").distinct()
    forms = distinct.withColumn("t1", strip_punctuation(F.col("raw"))).withColumn("t2", F.lower("t1"))
    listed = F.array(*[F.lit(s) for s in stop]) if stop else F.array().cast("array<string>")
    staged = forms.select("raw", F.posexplode(F.array("raw", "t1", "t2")).alias("stage", "token"))
    staged = staged.withColumn("stopped", F.array_contains(listed, F.col("token")))
    found = staged.join(vocab.select(F.col("word").alias("token"), "idx"), "token", "left")
    # The first stage that is a stop word or a vocabulary word decides.
    decided = found.where(F.col("stopped") | (F.col("idx").isNotNull() & (F.col("token") != "")))
    choice = decided.groupBy("raw").agg(F.min_by(F.struct("stopped", "token", "idx"), "stage").alias("c"))
    choice = choice.where(~F.col("c.stopped")).select("raw", "c.token", "c.idx")
    return rows.join(choice, "raw").select(id, F.col("pos").cast("bigint").alias("pos"), "token", "idx")


def merge_phrases(
    df: DataFrame, tokens: str, phrases: DataFrame, separator: str = "_", max_words: int = 5, output: str = "merged",
    id: str | None = None, limit: int = 1_000_000,
) -> DataFrame:
    """Joins neighbouring tokens that form a listed phrase, longest phrases first, exact case before lower case.

    ``phrases`` is ``(phrase)`` with words joined by ``separator``. Up to ``limit`` phrases (counted first) are broadcast
    as a set. Beyond it each row gets the phrases that its own word spans can form, by a join; that needs the ``id``.
    """
    size = F.size(F.split("phrase", "\\Q" + separator + "\\E"))
    known = phrases.where(
        F.col("phrase").contains(separator) & ~F.col("phrase").contains(separator * 2) & (size <= max_words)
    ).select("phrase").distinct()
    # Window lengths to try: those of the listed phrases, longest first (at most max_words numbers).
    lengths = sorted((r[0] for r in known.select(size).distinct().collect()), reverse=True)
    if known.limit(limit + 1).count() <= limit:
        shared = df.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in known.toLocalIterator()))

        @F.pandas_udf(T.ArrayType(T.StringType()))
        def merge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for series in batches:
                yield series.map(lambda row: _merged(row, shared.value, separator, lengths))

        return df.withColumn(output, merge(F.col(tokens)))
    if id is None:
        raise ValueError(f"more than {limit} phrases: name the id column, so that they can be joined")

    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.lit(max_words)), lambda n: F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.size(tokens), F.lit(1))), lambda i: i + n - 1 <= F.size(tokens)),
        lambda i: F.lower(F.array_join(F.slice(F.col(tokens), i, n), separator)))))
    found = df.select(id, F.explode(F.array_distinct(spans)).alias("__low")).join(known.withColumn("__low", F.lower("phrase")), "__low")
    own = found.groupBy(id).agg(F.collect_set("phrase").alias("__own"))  # at most the spans of one text

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def merge_own(rows: pd.Series, sets: pd.Series) -> pd.Series:
        return pd.Series([_merged(row, frozenset(p) if p is not None else frozenset(), separator, lengths) for row, p in zip(rows, sets)])

    return df.join(own, id, "left").withColumn(output, merge_own(F.col(tokens), F.col("__own"))).drop("__own")


def _merged(row, lookup: frozenset, separator: str, lengths: list[int]) -> list[str]:
    row = list(row) if row is not None else []
    for n in lengths:
        merged, at = [], 0
        while at < len(row):
            gram = separator.join(row[at : at + n]) if at + n <= len(row) else None
            hit = gram if gram in lookup else gram.lower() if gram and gram.lower() in lookup else None
            merged.append(hit or row[at])
            at += n if hit else 1
        row = merged
    return row
