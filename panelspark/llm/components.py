"""Connected components by alternating large-star and small-star.

Each half round points nodes at the smallest node they see. Minima are combined on the map side and written, and
the join that hands them out has a shuffle on both sides, so that adaptive execution splits the edges of a node
with very many of them. Rounds go on until no edge changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm.store import stored


def _smallest(edges: DataFrame, rows: int) -> DataFrame:
    """Per node ``u`` the smallest of itself and its neighbours ``v``."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("_v")).select("u", F.least("u", "_v").alias("m")), "smallest", rows)


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_smallest(both, 2 * rows), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """``edges`` go from a node to a smaller one."""
    out = edges.join(_smallest(edges, rows), "u")
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(out.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node reachable) for each node that has an edge. Edges with a null end and
    from a node to itself are ignored; repeated and opposite edges count once."""
    rows = edges.count()
    big, small = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = stored(edges.where(F.col(a) != F.col(b)).select(big, small).distinct(), "edges", rows)
    state = None
    while (now := _state(edges)) != state:
        state, n = now, now[0]
        edges = stored(_large_star(edges, n).where("u != v").distinct(), "large_star", n)
        edges = stored(_small_star(edges, n).where("u != v").distinct(), "small_star", 2 * n)
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
