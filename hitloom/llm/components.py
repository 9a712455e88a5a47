"""Connected components of a stored graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hitloom.llm.tables import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of ``edges`` (a, b); the component is its smallest id.

    Alternating large and small stars: each round hangs nodes on the smallest node
    known to them, first those above, then those below, until nothing changes. Chains
    halve in each round, and a round is two joins on stored tables, never a collect.
    """
    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    held = written(pairs.where("a <> b").distinct(), "edges")
    mark = _mark(held)
    while True:
        held = written(_small_star(_large_star(held)), "edges")
        new_mark = _mark(held)
        if new_mark == mark:
            break
        mark = new_mark
    # Every edge now goes from a node to the smallest of its component.
    members = held.select(F.col("a").alias("id"), F.col("b").alias("component"))
    heads = held.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return members.unionByName(heads)


def _mark(edges: DataFrame) -> tuple:
    """Changes whenever the distinct edges change, but for a chance of 1 in 2^64."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node are hung on the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are hung on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    below = (edges.join(least, "a").where("b <> least")
             .select(F.col("b").alias("a"), F.col("least").alias("b")))
    return below.unionByName(
        least.select("a", F.col("least").alias("b"))).distinct()
