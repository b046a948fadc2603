"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandlex.llm.shared import settle

MAX_ROUNDS = 60


def _least_neighbour(edges: DataFrame) -> DataFrame:
    """``a, b, least`` with the smallest of ``a`` and all its ``b``.  The aggregate is
    combined before its shuffle, and adaptive execution splits the join of a hot ``a``."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return edges.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return _least_neighbour(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    found = _least_neighbour(edges)
    ends = F.explode(F.array("a", "b")).alias("a")
    return found.select(ends, F.col("least").alias("b")).where("a != b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``node, component`` for every node with an edge; ``component`` is the smallest node
    that can be reached.

    ``edges`` has two long columns, each edge in either direction; loops and nulls are
    ignored.  Stars are contracted in alternating rounds, whose number grows with the
    logarithm of the graph's size.  Each round is settled in the shared folder, and the
    driver sees two numbers of it.
    """
    a, b = edges.columns
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges, before = settle(edges.distinct()), None
    for _ in range(max_rounds):
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = mark
        edges = settle(_small_star(_large_star(edges)))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
