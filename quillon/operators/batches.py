"""Batches in which no text occurs twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.hashing import hash_int, hash_key
from ..session import cut_lineage
from .prefix import first_n, global_row_number

STATE = ["__id", "__k", "__h", "__b"]


def no_duplicate_batches(
    df: DataFrame, texts: Sequence[str], size: int, seed: int = 0, id: str = "id", guid: str | None = None, patience: int = 12,
) -> DataFrame:
    """Adds ``batch``: exactly ``size`` rows each, no normalized text (or guid) twice in a batch.

    With one text column there are as many batches as the rule allows: ``floor(rows / size)``, or fewer where a text has
    more rows than that. Rows are numbered along their text, and the number modulo the count of batches is the batch, so
    the rows of a text never meet and a hot text is spread over all tasks. The result depends on the rows and the seed
    alone.

    With more columns the most frequent key of a row decides its number. Rows that meet in another key are taken out and
    placed again in rounds: each tries an open place, and where it does not fit it changes places with a row of some
    other batch in which it does. After ``patience`` rounds that fill nothing the smallest batches are dissolved to fill
    the others (the full optimum is a colouring problem). Left out are surplus rows of a text, the rest below one batch
    and what dissolved batches leave. ``id`` must be unique; null keys count as one text. No rows give no batches.
    """
    keys = [X.pooled_key(t) for t in texts] + ([F.concat(F.lit("\u0000"), F.col(guid).cast("string"))] if guid else [])
    rows = df.select(F.col(id).alias("__id"), F.array(*[F.xxhash64(k) for k in keys]).alias("__k"), hash_key(id, seed=seed).alias("__h"))
    rows, batches = _placeable(cut_lineage(rows), size)
    if not batches:
        return df.limit(0).withColumn("batch", F.lit(0).cast("bigint"))
    base = _dealt(rows, size, batches)
    if len(keys) > 1:
        base = _settled(cut_lineage(base), size, batches, seed, patience)
    placed = base.where("__b IS NOT NULL").select(F.col("__id").alias(id), F.col("__b").alias("batch"))
    return df.join(placed, id)


def _keyed(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns, F.explode(F.array_distinct("__k")).alias("__key"))


def _placeable(rows: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Rows without the surplus of keys that have more rows than there are batches, and the number of batches."""
    while True:
        total = rows.count()
        per_key = rows.select(F.posexplode("__k").alias("at", "__key")).groupBy("at", "__key").agg(F.count(F.lit(1)).alias("n"))
        # Counts of counts: at most sqrt(2 * rows) rows per column.
        histogram = per_key.groupBy("at", "n").agg(F.count(F.lit(1)).alias("keys")).collect()

        def fits(batches):
            held = {}
            for r in histogram:
                held[r["at"]] = held.get(r["at"], 0) + min(r["n"], batches) * r["keys"]
            return all(h >= batches * size for h in held.values())

        low, high = 0, total // size
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if fits(middle) else (low, middle - 1)
        keyed = _keyed(rows, "__id", "__h")
        hot = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > low)
        if not low or hot.isEmpty():
            return rows, low
        numbered = global_row_number(keyed.join(hot, "__key"), [F.col("__h").asc(), F.col("__id").asc()], "pos", by=["__key"])
        rows = cut_lineage(rows.join(numbered.where(F.col("pos") > low).select("__id").distinct(), "__id", "left_anti"))


def _dealt(rows: DataFrame, size: int, batches: int) -> DataFrame:
    """Adds ``__b``: the number along the most frequent key, modulo the batches; null for rows beyond the last batch."""
    counts = _keyed(rows).groupBy("__key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    lead = _keyed(rows, "__id").join(counts, "__key").groupBy("__id").agg(F.max(F.struct("n", "__key")).alias("m"))
    led = rows.join(lead, "__id", "left").select("__id", "__k", "__h", F.coalesce("m.n", F.lit(1)).alias("__n"), F.col("m.__key").alias("__key"))
    order = [F.col("__n").desc(), F.col("__key").asc(), F.col("__h").asc(), F.col("__id").asc()]
    numbered = global_row_number(led, order, "__pos")
    at = F.col("__pos") - 1
    return numbered.select("__id", "__k", "__h", F.when(at < batches * size, at % batches).alias("__b"))


def _second(rows: DataFrame) -> DataFrame:
    """Ids of rows that share a key with an earlier row of their batch."""
    turn = Window.partitionBy("__b", "__key").orderBy("__h", "__id")  # at most one batch of rows
    return _keyed(rows, "__id", "__h", "__b").withColumn("r", F.row_number().over(turn)).where("r > 1").select("__id").distinct()


def _clashing(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Ids of ``rows`` that share a key with one of ``others`` in the same batch."""
    held = _keyed(others.join(rows.select("__b").distinct(), "__b", "left_semi"), "__b").distinct()
    return _keyed(rows, "__id", "__b").join(held, ["__b", "__key"]).select("__id").distinct()


def _settled(base: DataFrame, size: int, batches: int, seed: int, patience: int) -> DataFrame:
    """Places the rows that meet again, in rounds. Only rows that ever move are written per round (``moved``)."""
    moved = base.join(_second(base.where("__b IS NOT NULL")), "__id", "left_semi").withColumn("__b", F.lit(None).cast("bigint"))
    moved = cut_lineage(moved.unionByName(base.where("__b IS NULL")))
    idle, dissolve, turn = 0, 1, 0
    while True:
        turn += 1
        now = base.join(moved.select("__id"), "__id", "left_anti").unionByName(moved).where("__b IS NOT NULL")
        open_ = cut_lineage(now.groupBy("__b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < size))
        gaps = open_.agg(F.sum(size - F.col("n"))).head()[0] or 0
        if not gaps:
            return now.select(*STATE)
        if idle >= patience:
            some = first_n(open_, [F.col("n").asc(), F.col("__b").asc()], max(dissolve, gaps // size))
            out = now.join(some.select("__b"), "__b", "left_semi").select("__id", "__k", "__h", F.lit(None).cast("bigint").alias("__b"))
            moved = cut_lineage(moved.join(out.select("__id"), "__id", "left_anti").unionByName(out))
            idle, dissolve = 0, 2 * dissolve
            continue
        mix = lambda c, salt: hash_key(c, seed=seed + 3 * turn + salt)
        places = open_.select("__b", F.explode(F.sequence(F.lit(1), size - F.col("n"))).alias("i")).withColumn("o", hash_key("__b", "i", seed=seed + 3 * turn))
        places = global_row_number(places, [F.col("o").asc(), F.col("__b").asc(), F.col("i").asc()], "p").select("p", "__b")
        waiting = moved.where("__b IS NULL").select("__id", "__k", "__h").withColumn("o", mix("__id", 1))
        tried = global_row_number(waiting, [F.col("o").asc(), F.col("__id").asc()], "p").join(places, "p").select(*STATE)
        tried = cut_lineage(tried)
        fitting = tried.join(_clashing(tried, now), "__id", "left_anti")
        fitting = cut_lineage(fitting.join(_second(fitting), "__id", "left_anti"))
        filled = fitting.count()
        changed = fitting
        if filled < tried.count():
            now = now.unionByName(fitting)
            # One waiting row per batch takes the place of a row there, if it meets none of the others.
            guest = tried.join(fitting, "__id", "left_anti").withColumn("__b", hash_int("__id", seed=seed + 3 * turn + 2) % batches)
            guest = guest.groupBy("__b").agg(F.min(F.struct("__id", "__k", "__h")).alias("g")).select("g.*", "__b").select(*STATE)
            there = now.join(guest.select("__b"), "__b", "left_semi")
            leaving = there.withColumn("o", mix("__id", 2)).groupBy("__b").agg(F.min(F.struct("o", "__id", "__k", "__h")).alias("g")).select("g.*", "__b").select(*STATE)
            there, leaving = cut_lineage(there), cut_lineage(leaving)
            guest = guest.join(_clashing(guest, there.join(leaving, "__id", "left_anti")), "__id", "left_anti").join(leaving, "__b", "left_semi").select(*STATE)
            guest = cut_lineage(guest)
            leaving = leaving.join(guest, "__b", "left_semi").withColumn("__b", F.lit(None).cast("bigint")).select(*STATE)
            changed = fitting.unionByName(guest).unionByName(leaving)
        moved = cut_lineage(moved.join(changed.select("__id"), "__id", "left_anti").unionByName(changed))
        idle = 0 if filled else idle + 1
