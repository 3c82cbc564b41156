"""The registered queries: per family a dictionary of name -> (query, SQL or None)."""

from __future__ import annotations

import functools
import importlib

from ..session import ship_package

FAMILIES = ["sources", "tabular", "text", "features", "vectors", "search", "evaluate", "models", "datasets"]


def _shipped(query):
    """The workers may run in another folder than the driver and still need the package."""
    @functools.wraps(query)
    def run(spark, sf):
        ship_package(spark)
        return query(spark, sf)
    return run


def registry() -> dict:
    out = {}
    for name in FAMILIES:
        module = importlib.import_module(f"{__name__}.{name}")
        clash = out.keys() & module.QUERIES.keys()
        if clash:
            raise ValueError(f"query names used twice: {sorted(clash)}")
        out.update({key: (_shipped(query), sql) for key, (query, sql) in module.QUERIES.items()})
    return out
