"""Vector algebra on ``array<float|double>`` columns. Sums run in double whatever the stored type is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v: Column | str) -> Column:
    return _c(v).cast("array<double>")


def vsum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column | str, b: Column | str) -> Column:
    return vsum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(v: Column | str) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalize(v: Column | str, eps: float = 1e-12) -> Column:
    """Unit vector; the norm has a floor of ``eps`` so that a zero vector stays zero."""
    n = F.greatest(norm(v), F.lit(eps))
    # The norm is passed through a one-element array so that it is computed once per row, not once per element.
    return F.aggregate(
        F.array(n), F.array().cast("array<double>"), lambda _, s: F.transform(as_double(v), lambda x: x / s)
    )


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 if either vector is zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def euclidean(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(
        F.aggregate(
            F.zip_with(as_double(a), as_double(b), lambda x, y: x - y), F.lit(0.0), lambda s, d: s + d * d
        )
    )


def manhattan(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(
        F.zip_with(as_double(a), as_double(b), lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, d: s + d
    )


def pair_features(
    a: Column | str, b: Column | str, concat: bool = True, diff: bool = True, mult: bool = False
) -> Column:
    """``[a, b, |a-b|, a*b]`` with the parts chosen by flags."""
    x, y = as_double(a), as_double(b)
    parts = []
    if concat:
        parts += [x, y]
    if diff:
        parts.append(F.zip_with(x, y, lambda p, q: F.abs(p - q)))
    if mult:
        parts.append(F.zip_with(x, y, lambda p, q: p * q))
    if not parts:
        raise ValueError("choose at least one of concat, diff, mult")
    return F.concat(*parts)


def weighted_layers(layers: Column | str, weights: list[float], start: int = 4) -> Column:
    """Weighted mean of the layer vectors from ``start`` on; ``layers`` is ``array<array<double>>``."""
    used = F.slice(_c(layers), start + 1, len(weights)).cast("array<array<double>>")
    total = float(sum(weights))
    w = F.array(*[F.lit(float(x)) for x in weights])
    scaled = F.zip_with(used, w, lambda v, k: F.transform(v, lambda x: x * k / F.lit(total)))
    return F.aggregate(
        F.slice(scaled, 2, max(len(weights) - 1, 1)) if len(weights) > 1 else F.array().cast("array<array<double>>"),
        F.element_at(scaled, 1),
        lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y),
    )


SCORES = {"cos": cosine, "dot": dot}
