"""Connected components of a graph given as pairs, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node of the pairs ``a``, ``b``.

    Nodes are of any ordered type. Each round stores its edges in the shared folder; the rounds end
    when both star steps leave the edges as they are, so each node hangs on its root. The minima are
    combined before the shuffle and the joins are ones that adaptive execution can split at hubs.
    Pairs of a node with itself and pairs with a null link nothing.
    """
    a, b = F.col("a"), F.col("b")
    edges = pairs.where("a <> b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = stored(edges, "edges")
    seen = None
    while True:
        total = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.sum(F.xxhash64("b", "a").cast("decimal(20,0)"))
        ).first()
        if tuple(total) == seen:
            break
        seen = tuple(total)
        edges = stored(_small_star(_large_star(edges)), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
