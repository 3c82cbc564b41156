"""Best cuts and average precision of scored rows, all from one ordered pass.

Rows are dealt by range on (group, falling score, id) once. A segment, the part of a group in one partition, is summed up by

* its counts, its first and last score, and the first and last run of equal scores;
* the upper hull of its points (rows so far, hits so far). Accuracy rises with ``2 hits - rows`` and F1 with
  ``hits / (rows + positives)``. Both grow with the hits and fall with the rows, and where either is constant is a straight line, so the first
  best cut of a group is a corner of a hull whatever came before it and however many positives there are.

A hull of whole-numbered points has far fewer corners than rows. What follows works on segments: a window over the segments of
a group gives offsets, the best corner gives the cut. Average precision needs the offsets inside its sum: a second pass over the
sorted rows, without a shuffle, sums the steps inside each segment; steps that touch a border of a segment come from the runs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .prefix import arrange, fold_segments, join_groups

_CUT = T.StructType([T.StructField("at", T.LongType())] + [T.StructField(c, T.DoubleType()) for c in ("hits", "s", "s_next")])
_FIELDS = [
    T.StructField("n", T.LongType()), T.StructField("h", T.DoubleType()), T.StructField("first_s", T.DoubleType()),
    T.StructField("end_s", T.DoubleType()), T.StructField("head_n", T.LongType()), T.StructField("head_h", T.DoubleType()),
    T.StructField("tail_h", T.DoubleType()), T.StructField("cuts", T.ArrayType(_CUT)),
]


def _hull(points: np.ndarray) -> np.ndarray:
    """Corners of the upper hull of rows ``(at, hits, ...)`` with rising ``at``.

    A point on or below the line between its neighbours is no corner, whichever others go with it, so whole sweeps are removed
    at once. The products are exact for segments up to 60 million rows.
    """
    while len(points) > 2:
        at, hits = points[:, 0], points[:, 1]
        above = (hits[1:-1] - hits[:-2]) * (at[2:] - at[1:-1]) > (hits[2:] - hits[1:-1]) * (at[1:-1] - at[:-2])
        if above.all():
            break
        points = points[np.concatenate([[True], above, [True]])]
    return points


class _Runs:
    """Rows and hits so far, and the runs of equal scores they end: the first run's end, where the open run began."""

    def __init__(self, n: int = 0, h: float = 0.0):
        self.n, self.h, self.open_h, self.last, self.head, self.begun = n, h, h, None, None, False

    def add(self, s: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Takes the next rows; returns their running rows and hits, and (rows, hits) at the end of each run that they end."""
        before = np.concatenate([[np.nan if self.last is None else self.last], s[:-1]])
        starts = np.flatnonzero((s != before) & ~(np.isnan(s) & np.isnan(before)))
        if not self.begun:
            starts = starts[starts > 0]
        at, hits = self.n + np.arange(1, len(s) + 1), self.h + np.cumsum(y)
        end_n, end_h = self.n + starts, np.where(starts > 0, hits[starts - 1], self.h)
        if len(starts):
            if self.head is None:
                self.head = int(end_n[0]), float(end_h[0])
        self.n, self.h, self.last, self.begun = int(at[-1]), float(hits[-1]), float(s[-1]), True
        return at, hits, end_n, end_h


def _values(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    return rows["s"].to_numpy(dtype=float, na_value=np.nan), rows["y"].fillna(0.0).to_numpy(dtype=float)


def _summary(state, rows: pd.DataFrame, part: int, opens: bool):
    runs, first, points = state or (_Runs(), None, np.empty((0, 4)))
    s, y = _values(rows)
    n, h, last, begun = runs.n, runs.h, runs.last, runs.begun
    at, hits, _, end_h = runs.add(s, y)
    if len(end_h):
        runs.open_h = float(end_h[-1])
    fresh = np.column_stack([at[:-1], hits[:-1], s[:-1], s[1:]])
    # The last row of the rows before has a successor now.
    waiting = np.array([[n, h, last, s[0]]]) if begun else np.empty((0, 4))
    return runs, s[0] if first is None else first, _hull(np.concatenate([points, waiting, fresh]))


def _summed(state) -> dict:
    runs, first, points = state
    head_n, head_h = runs.head or (runs.n, runs.h)
    number = lambda x: None if np.isnan(x) else float(x)
    return {"n": runs.n, "h": runs.h, "first_s": first, "end_s": runs.last, "head_n": head_n, "head_h": head_h,
            "tail_h": runs.h - runs.open_h if runs.head else None,
            "cuts": [{"at": int(a), "hits": float(h), "s": number(s), "s_next": number(t)} for a, h, s, t in points]}


def _inner_steps(segments: DataFrame, arranged: DataFrame, keys: list[str]) -> DataFrame:
    """Per segment, the sum of hits of a step times precision over the steps that neither begin nor end it."""
    # One row per partition; other segments than a partition's first begin their group.
    before = {r["part"]: (r["n0"], r["h0"]) for r in segments.where("opens").select("part", "n0", "h0").collect()}

    def step(state, rows: pd.DataFrame, part: int, opens: bool):
        runs, total = state or (_Runs(*(before[part] if opens else (0, 0.0))), 0.0)
        headed = runs.head is not None
        _, _, end_n, end_h = runs.add(*_values(rows))
        if len(end_h):
            own = np.diff(np.concatenate([[runs.open_h], end_h]))
            terms = own * end_h / end_n
            total += float(terms.sum() if headed else terms[1:].sum())
            runs.open_h = float(end_h[-1])
        return runs, total

    return fold_segments(arranged, keys, ["s", "y"], step, lambda state: {"term": state[1]}, [T.StructField("term", T.DoubleType())])


def _best(value: Column, name: str) -> Column:
    """First cut with the greatest value above zero, null without one."""
    return F.max(F.when(value > 0, F.struct(value.alias("v"), (-F.col("at")).alias("neg"), "hits", "positives",
                                            ((F.col("s") + F.col("s_next")) / 2).alias("t")))).alias(name)


def threshold_measures(
    df: DataFrame, score: str, label: str, order: str, by: Sequence[str] = (), measures: Sequence[str] = ("accuracy", "f1", "ap")
) -> DataFrame:
    """``(by..., accuracy, accuracy_threshold, f1, precision, recall, f1_threshold, ap)``, a higher score being more similar.

    Only the columns of the ``measures`` asked for. A cut lies midway between two rows, never after the last one; the first
    best cut wins (accuracy 0 with threshold -1, F1 with zeros, where there is none). Equal scores keep the order of ``order``
    in the cuts and are one step in the average precision, which is 0 without hits. A null label is no hit, null scores come
    last. ``order`` must make rows distinct inside a group. An empty table without ``by`` gives no row.
    """
    keys = list(by) or ["__g"]
    rows = df.select(*by, *([] if by else [F.lit(0).alias("__g")]), F.col(score).cast("double").alias("s"),
                     F.col(label).cast("double").alias("y"), F.col(order).alias("rid"))
    arranged = arrange(rows, [F.col("s").desc(), F.col("rid").asc()], keys)
    segments = fold_segments(arranged, keys, ["s", "y"], _summary, _summed, _FIELDS)
    # A window over the segments of a group: at most one row per partition.
    w = Window.partitionBy(*keys).orderBy("part")
    past, whole = w.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    zero = F.lit(0.0)
    segments = cut_lineage(segments.select(
        "*", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("n0"), F.coalesce(F.sum("h").over(past), zero).alias("h0"),
        F.lead("first_s").over(w).alias("after_s"), F.lead("part").over(w).isNull().alias("ends"),
        F.sum("n").over(whole).alias("total"), F.sum("h").over(whole).alias("positives")))

    end = F.struct(F.col("n").alias("at"), F.col("h").alias("hits"), F.col("end_s").alias("s"), F.col("after_s").alias("s_next"))
    cuts = F.when(F.col("ends"), F.col("cuts")).otherwise(F.concat("cuts", F.array(end)))
    cand = segments.select(*keys, "n0", "h0", "total", "positives", F.explode_outer(cuts).alias("c")).select(
        *keys, "total", "positives", (F.col("c.at") + F.col("n0")).alias("at"), (F.col("c.hits") + F.col("h0")).alias("hits"), "c.s", "c.s_next")
    accuracy = (2 * F.col("hits") - F.col("at") + F.col("total") - F.col("positives")) / F.col("total")
    f1 = F.try_divide(2 * F.col("hits"), F.col("at") + F.col("positives"))
    out = cand.groupBy(*keys).agg(_best(accuracy, "a"), _best(f1, "f"))
    columns: dict[str, list[Column]] = {
        "accuracy": [F.coalesce("a.v", zero).alias("accuracy"),
                     F.when(F.col("a").isNull(), F.lit(-1.0)).otherwise(F.col("a.t")).alias("accuracy_threshold")],
        "f1": [F.coalesce("f.v", zero).alias("f1"), F.coalesce(-F.col("f.hits") / F.col("f.neg"), zero).alias("precision"),
               F.coalesce(F.try_divide("f.hits", "f.positives"), zero).alias("recall"),
               F.when(F.col("f").isNull(), zero).otherwise(F.col("f.t")).alias("f1_threshold")],
        "ap": [F.col("ap")],
    }
    if "ap" in measures:
        # A step at the border of segments: its hits from all its runs, rows and hits so far from its last one.
        runs = segments.select(*keys, "positives", F.explode(F.array(
            F.struct(F.col("first_s").alias("s"), F.col("head_h").alias("own"), (F.col("n0") + F.col("head_n")).alias("at"), (F.col("h0") + F.col("head_h")).alias("hits")),
            F.struct(F.col("end_s").alias("s"), F.col("tail_h").alias("own"), (F.col("n0") + F.col("n")).alias("at"), (F.col("h0") + F.col("h")).alias("hits")),
        )).alias("r")).select(*keys, "positives", "r.*").where(F.col("own").isNotNull())
        borders = runs.groupBy(*keys, "s").agg(F.sum("own").alias("own"), F.max(F.struct("at", "hits")).alias("e"), F.max("positives").alias("positives"))
        borders = borders.select(*keys, (F.col("own") * F.col("e.hits") / F.col("e.at")).alias("term"), "positives")
        inner = _inner_steps(segments, arranged, keys).select(*keys, "term", F.lit(None).cast("double").alias("positives"))
        ap = borders.unionByName(inner).groupBy(*keys).agg(F.coalesce(F.try_divide(F.sum("term"), F.max("positives")), zero).alias("ap"))
        out = join_groups(out, ap, keys)
    return out.select(*by, *[c for m in measures for c in columns[m]])
