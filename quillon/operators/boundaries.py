"""Sentence ends learned from the corpus: which full stops belong to abbreviations, and which of those end a sentence as well.

Nothing is listed in advance. Three tables are counted over all texts, per group (a language, say), and scored by log-likelihood:

* a type (lower-case word without its last full stop) is an *abbreviation* where it rarely stands without a full stop, the more
  so the shorter it is and the more full stops it has inside;
* a type is a *starter* where it stands after a sure sentence end far more often than its frequency says, and *ordinary*
  where it occurs in lower case and never in upper case inside a sentence;
* an abbreviation and the next type are a *collocation* where they meet far more often than their frequencies say and the type
  is no starter.

A full stop after an abbreviation ends a sentence only before an upper-case word that is a starter, or that is ordinary and no
collocation of it. Counts are
merged in each task before the shuffle; only counts of single types and pairs that begin with an abbreviation are kept. Only those pairs of neighbouring pieces of a text whose first one ends with a full stop meet
the learned tables; Catalyst broadcasts these tables where they are small and splits hot types where they are not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import cut_lineage

ABBREVIATION = 0.3  # least scores, as published for this kind of model
STARTER = 30.0
COLLOCATION = 7.88
BROADCAST_ROWS = 1_000_000  # rows of a table that may be shipped to every task
ENDS_WITH_STOP = 0.99  # share of its occurrences in which an abbreviation is expected to have its full stop


_OPENING = r"[\"'(\[]"
_END, _UPPER, _LOWER = r"[.!?]$", rf"^{_OPENING}*\p{{Lu}}", rf"^{_OPENING}*\p{{Ll}}"


def type_of(token: Column) -> Column:
    """Lower-case word without opening marks and without one last full stop."""
    return F.regexp_replace(F.lower(token), rf"^{_OPENING}+|\.$", "")


def _is_word(kind: Column) -> Column:
    return kind.rlike(r"\p{L}")


def association(both: Column, a: Column, b: Column, n: Column) -> Column:
    """Log-likelihood ratio of a two-by-two table from the counts of both, of either, and of all; 0 where they repel."""
    def cell(seen: Column, row: Column, col: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen * n / (row * col))).otherwise(0.0)

    ratio = 2 * (cell(both, a, b) + cell(a - both, a, n - b) + cell(b - both, n - a, b) + cell(n - a - b + both, n - a, n - b))
    return F.when(both * n > a * b, ratio).otherwise(0.0)


def _tokens(df: DataFrame, text: str, by: Sequence[str]) -> DataFrame:
    """``(by..., token, following)``: neighbours come from the text's own array, without a window or a shuffle."""
    w = X.words(text)
    # Zipped with its own tail: indexing it inside a lambda would split the text again for every word.
    pairs = F.arrays_zip(w.alias("token"), F.slice(w, 2, F.size(w)).alias("following"))
    return df.select(*by, F.explode(pairs).alias("p")).select(*by, "p.token", "p.following")


def _same(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys of which some may be null (a null group is a group)."""
    right = b.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in b.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return a.join(right, on, how).drop(*[f"__{k}" for k in keys])


def abbreviation_scores(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., kind, n_stop, n_plain, score)`` of every type that occurs with a full stop; from 0.3 on it is an abbreviation."""
    kinds = _tokens(df, text, by).select(*by, type_of(F.col("token")).alias("kind"), F.col("token").endswith(".").cast("bigint").alias("stop"))
    return _scored_kinds(kinds.groupBy(*by, "kind").agg(F.sum("stop").alias("n_stop"), F.count(F.lit(1)).alias("n")), by)


def _scored_kinds(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    sums = counts.groupBy(*by).agg(F.sum("n_stop").alias("stops"), F.sum("n").alias("tokens"))
    found = counts.where(F.col("n_stop") > 0).where(_is_word(F.col("kind")))
    found = _same(found, sums, by) if by else found.crossJoin(F.broadcast(sums))  # one row
    share = F.least(F.greatest(F.col("stops") / F.col("tokens"), F.lit(1e-9)), F.lit(1 - 1e-9))
    plain = F.col("n") - F.col("n_stop")
    gain = 2 * (F.col("n_stop") * F.ln(F.lit(ENDS_WITH_STOP) / share) + plain * F.ln(F.lit(1 - ENDS_WITH_STOP) / (1 - share)))
    letters = F.length(F.replace(F.col("kind"), F.lit("."), F.lit("")))
    inside = F.length("kind") - letters + 1
    score = gain * F.exp(-letters) * inside * F.pow(letters.cast("double"), -plain)
    return found.select(*by, "kind", "n_stop", plain.alias("n_plain"), score.alias("score"))


def _few(small: DataFrame) -> DataFrame:
    """A table written once, marked for broadcast if it is counted to be small enough, so that what meets it is not shuffled."""
    small = cut_lineage(small)
    return F.broadcast(small) if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else small


def boundary_tables(df: DataFrame, text: str, by: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``abbreviations (by..., kind)``, ``openers (by..., following, starts, ordinary)`` and ``collocations (by..., kind, following)``.

    Only counts of types are kept of the texts, and the neighbours of abbreviations; all neighbours would weigh as much as the texts.
    """
    t = _tokens(df, text, by)
    first = F.col("following").isNotNull()
    w = X.words(text)
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))))
    seen = df.select(*by, F.explode(F.arrays_zip(w.alias("token"), before.alias("before"))).alias("p")).select(*by, "p.token", "p.before")
    number = lambda c: F.count(F.when(c, 1))
    end, later = F.col("before").rlike(_END), F.col("before").isNotNull()
    counts = cut_lineage(seen.groupBy(*by, type_of(F.col("token")).alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), number(F.col("token").endswith(".")).alias("stop"), number(end).alias("after"),
        number(later & F.col("token").rlike(_LOWER)).alias("low"), number(later & F.col("token").rlike(_UPPER) & ~end).alias("inner")))
    kinds = counts.select(*by, "kind", F.col("stop").alias("n_stop"), "n")
    abbreviations = _few(_scored_kinds(kinds, by).where(F.col("score") >= ABBREVIATION).select(*by, "kind"))
    kinds = kinds.select(*by, "kind", F.col("n").alias("n_kind"))
    short = t.where(F.col("token").endswith(".")).where(first).select(*by, type_of(F.col("token")).alias("kind"), type_of(F.col("following")).alias("following"))
    short = cut_lineage(_same(short, abbreviations, [*by, "kind"]).groupBy(*by, "kind", "following").agg(F.count(F.lit(1)).alias("n")))
    # Every full stop is an end; it is a sure one unless an abbreviation stands before it.
    unsure = short.select(*by, F.col("following").alias("kind"), (-F.col("n")).alias("after"))
    none = [F.lit(0).cast("bigint").alias(c) for c in ("n", "low", "inner")]
    marked = counts.select(*by, "kind", "after", "n", "low", "inner").unionByName(unsure.select(*by, "kind", "after", *none))
    marked = marked.groupBy(*by, F.col("kind").alias("following")).agg(*[F.sum(c).alias(c) for c in ("after", "n", "low", "inner")])
    total = marked.groupBy(*by).agg(F.sum("n").alias("tokens"), F.sum("after").alias("ends"))

    def scored(rows: DataFrame) -> DataFrame:
        rows = _same(rows, kinds.select(*by, F.col("kind").alias("following"), F.col("n_kind").alias("n_following")), [*by, "following"])
        return _same(rows, total, by) if by else rows.crossJoin(F.broadcast(total))  # one row

    openers = marked.where(_is_word(F.col("following"))).select(*by, "following", F.col("after").alias("both"), "low", "inner")
    starts = association(F.col("both"), F.col("ends"), F.col("n_following"), F.col("tokens")) >= STARTER
    openers = scored(openers).select(*by, "following", starts.alias("starts"), ((F.col("low") > 0) & (F.col("inner") == 0)).alias("ordinary"))
    openers = openers.where(F.col("starts") | F.col("ordinary"))

    met = short.where(_is_word(F.col("following"))).withColumnRenamed("n", "both")
    met = scored(_same(met.where("both > 1"), kinds, [*by, "kind"]))
    met = met.where(association(F.col("both"), F.col("n_kind"), F.col("n_following"), F.col("tokens")) >= COLLOCATION)
    met = _same(met.select(*by, "kind", "following"), openers.where("starts"), [*by, "following"], "left_anti")
    return abbreviations, openers, met


def learned_sentences(df: DataFrame, id: str, text: str, by: Sequence[str] = (), learn_from: DataFrame | None = None) -> DataFrame:
    """``(id, pos, sentence)``: the sentences of the plain rule, joined again where the end belongs to an abbreviation.

    The tables are learned from ``learn_from`` (with the same columns), or from ``df`` itself. White space after an
    abbreviation becomes one blank. ``id`` must be unique and not null; null and blank texts have no sentences.
    """
    abbreviations, openers, collocations = boundary_tables(df if learn_from is None else learn_from, text, by)
    pieces = df.select(F.col(id).alias("id"), *[F.col(b) for b in by if b != id], X.sentences(text).alias("__p"))
    keys = [b for b in by if b != id]
    ends = F.arrays_zip(F.slice("__p", 1, F.greatest(F.size("__p") - 1, F.lit(0))).alias("piece"), F.slice("__p", 2, F.greatest(F.size("__p") - 1, F.lit(0))).alias("rest"))
    ends = pieces.select("id", *keys, F.posexplode(ends).alias("at", "e")).where(F.col("e.piece").endswith("."))
    following = F.element_at(X.words("e.rest"), 1)
    open_ends = ends.select("id", *keys, "at", type_of(F.element_at(X.words("e.piece"), -1)).alias("kind"), type_of(following).alias("following"),
                            following.rlike(_UPPER).alias("upper"))
    short = _same(open_ends, abbreviations, [*by, "kind"])
    short = _same(short, openers, [*by, "following"], "left")
    short = _same(short, collocations.withColumn("close", F.lit(True)), [*by, "kind", "following"], "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    is_end = yes(F.col("upper")) & (yes(F.col("starts")) | (yes(F.col("ordinary")) & ~yes(F.col("close"))))
    # Places in one text. The texts are not shuffled for them unless too many have one.
    joined = _few(short.where(~is_end).groupBy(F.col("id").alias("__id")).agg(F.collect_set("at").alias("__open")))
    out = pieces.select("id", "__p").join(joined, F.col("id") == F.col("__id"), "left")
    # An end that stays is marked, the pieces are joined by blanks, and the whole is cut at the marks.
    marked = F.transform("__p", lambda p, i: F.when(F.array_contains("__open", i), p).otherwise(F.concat(p, F.lit("\u0001"))))
    sentences = F.when(F.col("__open").isNull(), F.col("__p")).otherwise(
        F.filter(F.transform(F.split(F.array_join(marked, " "), "\u0001"), X.strip), lambda s: s != ""))
    return out.select("id", F.posexplode(sentences).alias("pos", "sentence")).select("id", F.col("pos").cast("bigint").alias("pos"), "sentence")
