"""Connected components of pairs, contracting edges round by round through staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import staged


def _renamed(parents: DataFrame, key: str, value: str) -> DataFrame:
    return parents.select(F.col("x").alias(key), F.col("p").alias(value))


def _rooted(parents: DataFrame) -> DataFrame:
    """Parents ``p`` of ``x``, every node of a tree below its root, by doubling."""
    while True:
        up = _renamed(parents, "y", "q")
        further = staged(parents.join(up, F.col("p") == F.col("y")).select("x", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved")))
        parents = further.select("x", "p")
        if further.where("moved").isEmpty():
            return parents


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) of every node that has a pair.

    In each round every node hangs itself below its smallest neighbour and follows its parents, twice as far with each
    step, up to the root of its tree; pairs are renamed to roots, and those within one tree vanish. A tree has two nodes at
    least, so the number of nodes with pairs falls by half at least: rounds grow with the logarithm of the number of
    nodes, and steps in a round with that of the depth. All joins are between staged tables, so a node with very many
    pairs is split at run time. Order, repeats and direction of pairs don't matter; pairs with NULL are no pairs.
    """
    edges = staged(pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
                   .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = staged(both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("p")).select("x", F.least("x", "p").alias("p")))
        parents = _rooted(parents)
        left, right = _renamed(parents, "x1", "p1"), _renamed(parents, "x2", "p2")
        edges = staged(edges.join(left, F.col("a") == F.col("x1")).join(right, F.col("b") == F.col("x2"))
                       .where("p1 <> p2").select(F.greatest("p1", "p2").alias("a"), F.least("p1", "p2").alias("b")).distinct())
        if labels is None:
            labels = parents.select(F.col("x").alias("node"), F.col("p").alias("component"))
        else:
            up = _renamed(parents, "y", "q")
            labels = staged(labels.join(up, F.col("component") == F.col("y"), "left").select(
                "node", F.coalesce("q", "component").alias("component")))
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
