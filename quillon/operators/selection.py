"""Exact medians of many columns by narrowing histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _usable(column: str) -> Column:
    """The value as a double; NaN and infinite values count as missing."""
    x = F.col(column).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def exact_medians(df: DataFrame, columns: Sequence[str], bins: int = 1024) -> dict[str, float | None]:
    """The median of each column: the middle value, or the mean of the two middle ones. Null for a column without values.

    One pass counts each column's values and their range; each further pass counts the values of the range that still holds a
    middle rank in ``bins`` equal parts, and goes on with the part that holds it, until this part is one value. Passes are
    shared by all columns, a value held by a third of the rows is one counter, and a pass brings ``2 * bins`` counters a column
    to the driver at most. Equal parts narrow a range by ``bins`` a pass, so values spread over many magnitudes take more.

    Nulls, NaN and infinite values don't count. The table is read once a pass: keep it cached if it is costly to make.
    """
    names = list(dict.fromkeys(columns))
    if not names:
        return {}
    values = df.select(*[_usable(c).alias(f"x{i}") for i, c in enumerate(names)])
    first = values.agg(*[f(f"x{i}").alias(f"{n}{i}") for i in range(len(names)) for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    found: dict[tuple[int, int], float] = {}
    active: dict[tuple[int, int], tuple[int, float, float]] = {}  # (column, rank): rank within the range, the range
    for i in range(len(names)):
        n, lo, hi = (first[f"{c}{i}"] for c in ("n", "lo", "hi"))
        for rank in {(n - 1) // 2, n // 2} if n else ():
            active[i, rank] = (rank, lo, hi)
    while True:
        found |= {key: lo for key, (_, lo, hi) in active.items() if lo == hi}
        active = {key: x for key, x in active.items() if x[1] < x[2]}
        if not active:
            break
        targets = list(active)
        parts = []
        for t, key in enumerate(targets):
            _, lo, hi = active[key]
            x = F.col(f"x{key[0]}")
            # Halves, because the width of a range may be beyond the greatest double.
            at = F.floor((x / 2 - lo / 2) / (hi / 2 - lo / 2) * (bins - 1)) if hi / 2 > lo / 2 else F.when(x > lo, 1).otherwise(0)
            parts.append(F.when(x.between(lo, hi), F.struct(F.lit(t).alias("t"), at.cast("int").alias("bin"), x.alias("x"))))
        rows = values.select(F.explode(F.array_compact(F.array(*parts))).alias("r")).select("r.*")
        counts = rows.groupBy("t", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).toArrow().to_pylist()
        for t, key in enumerate(targets):
            rank = active[key][0]
            for row in sorted((r for r in counts if r["t"] == t), key=lambda r: r["bin"]):
                if rank < row["n"]:
                    active[key] = (rank, row["lo"], row["hi"])
                    break
                rank -= row["n"]
    out: dict[str, float | None] = {}
    for i, name in enumerate(names):
        n = first[f"n{i}"]
        a, b = (found[i, (n - 1) // 2], found[i, n // 2]) if n else (None, None)
        out[name] = None if a is None else a if a == b else a / 2 + b / 2
    return out


def fill_medians(df: DataFrame, columns: Sequence[str], bins: int = 1024) -> DataFrame:
    """``df`` with nulls and NaN of ``columns`` replaced by the exact median; the columns become double, the others stay.

    Infinite values stay as they are. A column without values stays null.
    """
    medians = exact_medians(df, columns, bins)
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")), F.lit(m).cast("double")) for c, m in medians.items()})
