"""Running totals, row numbers and ranks over a global order, without moving all rows to one task.

A window without ``partitionBy`` (or with a hot key) sends its rows to a single task. Here the rows are range
partitioned on the full sort key, each partition is scanned once, and only one summary row per partition travels
through the driver. The full sort key includes the row id, so a value shared by a third of the rows is still split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

_PID = "__pid"
RANK_LIMIT = 1000  # rank filters up to this are trimmed before the shuffle (Spark's default threshold)


def _breaks(keys: pd.DataFrame, previous: tuple | None) -> np.ndarray:
    """True where a row belongs to another group than the row before it."""
    n = len(keys)
    if keys.shape[1] == 0:
        out = np.zeros(n, dtype=bool)
        out[0] = previous is None
        return out
    out = np.zeros(n, dtype=bool)
    for i, name in enumerate(keys.columns):
        col = keys[name]
        before = col.shift(1)
        same = (col == before) | (col.isna() & before.isna())
        flags = ~same.to_numpy(dtype=bool)
        if previous is None:
            flags[0] = True
        else:
            a, b = col.iloc[0], previous[i]
            flags[0] = not ((pd.isna(a) and pd.isna(b)) or a == b)
        out |= flags
    return out


def _segmented(x: np.ndarray, starts: np.ndarray, carry: float) -> np.ndarray:
    """Cumulative sum that restarts at ``starts``; rows before the first start continue from ``carry``."""
    total = np.cumsum(x, axis=0)
    segment = np.cumsum(starts)
    base = np.concatenate([[-carry], (total - x)[starts]]) if starts.any() else np.array([-carry])
    return total - base[segment]


def running(
    df: DataFrame,
    order: Sequence[Column],
    sums: dict[str, Column] | None = None,
    by: Sequence[str] = (),
    position: str = "position",
) -> DataFrame:
    """Adds ``position`` (1-based, bigint) and inclusive running ``sums`` (double), restarting per ``by`` group.

    ``order`` must be a strict total order inside a group: end it with the row id.
    """
    sums = sums or {}
    names = list(sums)
    by = list(by)
    staged = df.select("*", *[c.cast("double").alias(n) for n, c in sums.items()])
    keys = [F.col(b).asc() for b in by] + list(order)
    staged = staged.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_PID, F.spark_partition_id())
    staged = cut_lineage(staged)

    key_fields = [staged.schema[b] for b in by]
    summary_schema = T.StructType(
        [T.StructField(_PID, T.IntegerType()), T.StructField("pure", T.BooleanType())]
        + [T.StructField(f"first_{i}", f.dataType) for i, f in enumerate(key_fields)]
        + [T.StructField(f"last_{i}", f.dataType) for i, f in enumerate(key_fields)]
        + [T.StructField(f"total_{i}", T.DoubleType()) for i in range(len(names) + 1)]
    )

    def summarize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = last = pid = None
        pure, totals = True, np.zeros(len(names) + 1)
        for pdf in batches:
            if not len(pdf):
                continue
            starts = _breaks(pdf[by], last)
            if first is None:
                first, pid = tuple(pdf[by].iloc[0]), int(pdf[_PID].iloc[0])
                starts[0] = False
            cut = int(np.flatnonzero(starts)[-1]) if starts.any() else 0
            if starts.any():
                pure, totals = False, np.zeros(len(names) + 1)
            tail = pdf.iloc[cut:]
            totals = totals + np.array([len(tail)] + [float(tail[n].sum()) for n in names])
            last = tuple(pdf[by].iloc[-1])
        if first is not None:
            yield pd.DataFrame([[pid, pure, *first, *last, *totals]], columns=summary_schema.names)

    # One row per partition: bounded by the number of shuffle partitions, not by the data.
    parts = staged.select(_PID, *dict.fromkeys([*by, *names])).mapInPandas(summarize, summary_schema).collect()
    k = len(by)
    carries: dict[int, tuple[tuple, list[float]]] = {}
    state_key: tuple | None = None
    state = [0.0] * (len(names) + 1)
    for row in sorted(parts, key=lambda r: r[0]):
        first, last, totals = tuple(row[2 : 2 + k]), tuple(row[2 + k : 2 + 2 * k]), list(row[2 + 2 * k :])
        carries[row[0]] = (first, state if state_key == first else [0.0] * len(totals))
        joined = row[1] and state_key == first
        state = [a + b for a, b in zip(state, totals)] if joined else totals
        state_key = last

    fields = [f for f in staged.schema.fields if f.name != _PID and f.name not in names]
    out_schema = T.StructType(
        fields + [T.StructField(n, T.DoubleType()) for n in names] + [T.StructField(position, T.LongType())]
    )

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, carry = None, None
        for pdf in batches:
            if not len(pdf):
                continue
            if carry is None:
                last, carry = carries[int(pdf[_PID].iloc[0])]
                last = tuple(pdf[by].iloc[0])
            starts = _breaks(pdf[by], last)
            cols = [np.ones(len(pdf))] + [pdf[n].fillna(0.0).to_numpy(dtype=float) for n in names]
            run = [_segmented(c, starts, s) for c, s in zip(cols, carry)]
            carry = [float(r[-1]) for r in run]
            last = tuple(pdf[by].iloc[-1])
            out = pdf.drop(columns=[_PID])
            for n, r in zip(names, run[1:]):
                out[n] = r
            out[position] = run[0].astype("int64")
            yield out[out_schema.names]

    return staged.mapInPandas(scan, out_schema)


def arrange(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Rows dealt to partitions by range and sorted, written once, with the partition's number ``__pid``."""
    keys = [F.col(b).asc() for b in by] + list(order)
    return cut_lineage(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_PID, F.spark_partition_id()))


def fold_segments(
    arranged: DataFrame,
    by: Sequence[str],
    columns: Sequence[str],
    step: Callable[[object, pd.DataFrame, int, bool], object],
    emit: Callable[[object], dict],
    fields: Sequence[T.StructField],
) -> DataFrame:
    """One row ``(by..., part, opens, fields...)`` per segment, which is what one partition of :func:`arrange` holds of a group.

    ``step(state, rows, part, opens)`` folds the next rows of a segment into its state (None before the first), so a task
    holds one batch and one state. ``opens`` marks the first segment of a partition, the only one that can continue a group
    of the partition before. A group has at most as many segments as there are partitions.
    """
    by = list(by)
    schema = T.StructType(
        [arranged.schema[b] for b in by] + [T.StructField("part", T.IntegerType()), T.StructField("opens", T.BooleanType())] + list(fields)
    )

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, state, part, opens = None, None, -1, True

        def row() -> dict:
            return {**dict(zip(by, key)), "part": part, "opens": opens, **emit(state)}

        for pdf in batches:
            if not len(pdf):
                continue
            part, done = int(pdf[_PID].iloc[0]), []
            cuts = np.flatnonzero(_breaks(pdf[by], key))
            for a, b in zip(np.concatenate([[0], cuts]), np.concatenate([cuts, [len(pdf)]])):
                if a == b:
                    continue
                if a in cuts and state is not None:
                    done.append(row())
                    state, opens = None, False
                piece = pdf.iloc[a:b]
                key = tuple(piece[by].iloc[0])
                state = step(state, piece, part, opens)
            if done:
                yield pd.DataFrame(done, columns=schema.names)
        if state is not None:
            yield pd.DataFrame([row()], columns=schema.names)

    return arranged.select(_PID, *dict.fromkeys([*by, *columns])).mapInPandas(fold, schema)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group columns in which null is a value of its own, so that rows of a null group are not lost."""
    renamed = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__r_{k}" for k in keys])


def global_row_number(
    df: DataFrame, order: Sequence[Column], name: str = "position", by: Sequence[str] = ()
) -> DataFrame:
    return running(df, order, by=by, position=name)


def first_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a strict order. A large ``n`` is not gathered in one task as ``limit`` would."""
    if n <= 10_000:
        return df.orderBy(*order).limit(n)
    return global_row_number(df, order, "__n").where(F.col("__n") <= n).drop("__n")


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct value with its count ``n`` and its average rank (ties share the mean rank)."""
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running(counts, [F.col(value).asc()], {"__upto": F.col("n")}, by=by)
    return ranked.select(*by, value, "n", (F.col("__upto") - (F.col("n") - 1) / 2.0).alias("rank"))
