"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverbrook.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select("a", F.least("a", "least").alias("least"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(mixed, 20)), F.bit_xor(mixed)).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node with an edge (a, b); the label is the component's smallest node.

    Rounds grow with the logarithm of the longest path; each is stored, so that
    a lost executor repeats tasks of one round.
    """
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = stored(edges.distinct(), "edges")
    before = _state(edges)
    while before[0]:
        edges = stored(_small_star(_large_star(edges)), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    # All edges now lead to the smallest node of their component.
    labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return labels.unionByName(roots)
