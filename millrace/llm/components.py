"""Connected components by alternating large and small stars, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected edges (u, v); the root is the least node reachable.

    Each round is stored in the shared folder, so a lost executor costs one round
    at most; the rounds grow with the logarithm of the longest chain.  Neighbours
    are never gathered: a node's neighbourhood is an aggregate and a join.
    Loops and repeated edges change nothing; no edges give no rows.
    """
    edges = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    while True:
        edges = staged(_small_star(_large_star(edges)).where("u <> v").distinct(), "edges")
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark == (seen["n"], seen["h"]):
            break
        mark = (seen["n"], seen["h"])
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
