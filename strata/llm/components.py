"""Connected components of an edge table by alternating stars.

Each round points every node at the smallest node next to it (large star: the
larger neighbours; small star: the smaller ones) until the edges are stars with
their smallest node in the middle. All steps are groupings and joins of edge
rows; no component is gathered anywhere. Every round is committed to the shared
folder, so the plan stays short and a lost executor costs one round at most; the
round before it is removed then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.join(least, "u").where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` has u > v throughout."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"),
                                                          F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).union(moved).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Component of every node of an edge: columns node, root (smallest node).

    ``edges`` has two columns of one ordered type. Self-loops, repeated edges
    and edges with a null end are passed over.
    """
    u, v = (F.col(f"`{c}`") for c in edges.columns)
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"),
                         (u.isNull() | v.isNull()).alias("open"))
    edges = materialize(edges.where("u <> v and not open").drop("open").distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        edges = materialize(_small_star(_large_star(edges)), "edges", instead_of=edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select("v", "v").distinct())
