"""Seeded hashes that any SQL engine can reproduce, so that random picks do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*cols: Column | str, seed: int = 0) -> Column:
    """Hex digest that orders rows pseudo-randomly: ``md5('<seed>:' || c1 || ':' || c2 ...)``."""
    parts = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def hash_int(*cols: Column | str, seed: int = 0) -> Column:
    """The first 32 bits of :func:`hash_key` as a bigint in ``0 .. 2^32-1``."""
    return F.conv(F.substring(hash_key(*cols, seed=seed), 1, 8), 16, 10).cast("bigint")


def hash_unit(*cols: Column | str, seed: int = 0) -> Column:
    """Uniform double in ``[0, 1)``."""
    return hash_int(*cols, seed=seed) / F.lit(4294967296.0)
