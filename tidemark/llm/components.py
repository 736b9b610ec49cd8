"""Connected components of an edge table by alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import settled


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Every node's larger (smaller) neighbours are linked to its smallest neighbour, itself included."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    out = both.join(least, "a")
    if large:
        out = out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where("a <> b")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node of its component.

    Each round is two joins over the edges that are left; the number of rounds grows with the logarithm of the largest
    component. Nodes without an edge are not returned. Self-loops, repeats and either direction are allowed.
    """
    now = settled(edges.select("a", "b").where("a <> b").distinct())
    mark = lambda df: df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1000003)).first()
    seen = mark(now)
    while seen[0]:
        now = settled(_stars(_stars(now, True), False).distinct())
        if (new := mark(now)) == seen:
            break
        seen = new
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
