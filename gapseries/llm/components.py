"""Connected components by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014).
Every round is two aggregations with a partial (map-side) minimum and two
equi-joins that AQE may split on hot nodes; no group is collected. The edge
set is written to the shared folder after each round and never grows beyond
the number of edges plus nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapseries.llm.common import materialise


def _directed(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Connect every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = _directed(edges)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Connect a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``edges(a long, b long)`` -> ``(node, root)``: root is the smallest node reachable.

    Only nodes that have an edge to another node are returned, each once;
    self-loops and repeated edges are ignored, rows with a null end too.
    An empty edge table gives an empty result.
    """
    edges = materialise(edges.where("a <> b").distinct(), "edges")
    before = _print(edges)
    while before[0]:
        edges = materialise(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        now = _print(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
