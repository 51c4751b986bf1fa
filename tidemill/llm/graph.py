"""Connected components of links between rows, by contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (``a, b``); a component is named by its smallest node.

    Each round, a node points to the smallest of itself and its neighbours, and links are drawn anew
    between the nodes pointed to. Nodes should be hashes: then their order has no long runs, and the
    number of rounds grows as the logarithm of the longest path. A hub is one row after the
    combining of its smallest neighbour, and its links are split by adaptive execution.
    """
    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    steps = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("to")), "parents")
        steps.append(parents)
        left, right = (parents.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        moved = edges.join(left, "a").join(right, "b").where("to_a <> to_b")
        edges = written(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    first = steps[0].withColumnRenamed("to", "component")
    return reduce(_follow, steps[1:], first)


def _follow(named: DataFrame, step: DataFrame) -> DataFrame:
    """Names moved on by one round; a name without links in it stays."""
    step = step.select(F.col("node").alias("component"), "to")
    return named.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
