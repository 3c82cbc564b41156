"""Connected components by alternating star operations on the edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _least_neighbour(edges: DataFrame, least) -> DataFrame:
    """``edges`` (``u, v``) with ``m``. The minimum is one row per ``u``, so the join may split a ``u`` with many edges."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), least.alias("m"))
    return edges.join(cut_lineage(low), F.col("u") == F.col("w")).drop("w")


def _stars(edges: DataFrame) -> bool:
    """Do the edges, ``u > v``, form separate stars around their smaller ends? Then a ``u`` occurs once in the table."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("child")), F.struct(F.col("v").alias("node"), F.lit(0).alias("child")))).alias("e")).select("e.*")
    seen = ends.groupBy("node").agg(F.sum("child").alias("child"), F.count(F.lit(1)).alias("n"))
    return seen.where("child > 0 and n > 1").isEmpty()


def star_components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of an edge table that is not its component's smallest (rows with ``a = b`` don't
    count as edges).

    A large-star step links the larger neighbours of every node to its smallest one, a small-star step the smaller ones;
    both keep the components, and their fixed point is a star around each component's smallest node. One grouping sees
    whether it is reached, so an edge table that holds stars already costs no round. Rounds grow with the logarithm of the
    largest distance, and no step makes more edges than there are.
    """
    edges = cut_lineage(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least_neighbour(both, F.least("u", "m")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.where("u <> v").distinct())
        small = _least_neighbour(large, F.col("m"))
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = cut_lineage(small.where("u <> v").distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
