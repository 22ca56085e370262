"""Connected components of a graph given as links, by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.scratch import Scratch


def _rank(node: str, seed: int) -> Column:
    """Order of the nodes in one round: random, so that chains of any numbering break into short pieces."""
    return F.struct(F.xxhash64(F.lit(seed), F.col(node)).alias("rank"), F.col(node).alias("node"))


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) of every node of `links` (a, b: longs, in either order, repeats allowed); root names the component.

    Each round lets every node follow the neighbour of lowest rank, up to three steps far, merges nodes that end at the
    same place, and drops the links inside merged nodes. The number of nodes falls by a constant factor at least, so the
    rounds are logarithmic whatever the shape; a star or clique of any size takes one. Neighbours are never gathered:
    the lowest is a minimum with partial aggregation, and all else are joins of which Spark splits the hot keys.
    """
    a, b = F.col("a"), F.col("b")
    edges = scratch.save(links.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links0")
    steps = []
    while not edges.isEmpty():
        k = len(steps)
        both = edges.select("a", "b").unionByName(edges.select(b.alias("a"), a.alias("b")))
        lowest = both.groupBy("a").agg(F.min(_rank("b", k)).alias("low")).select(
            F.col("a").alias("node"), F.least(F.col("low"), _rank("a", k))["node"].alias("root")
        )
        first = scratch.save(lowest, f"first{k}")
        pointer = first
        for _ in range(2):
            onward = first.select(F.col("node").alias("root"), F.col("root").alias("next"))
            pointer = pointer.join(onward, "root").select("node", F.col("next").alias("root"))
        pointer = scratch.save(pointer, f"step{k}")
        steps.append(pointer)
        for side in ("a", "b"):
            edges = edges.join(pointer.select(F.col("node").alias(side), F.col("root").alias(f"to_{side}")), side)
        to_a, to_b = F.col("to_a"), F.col("to_b")
        merged = edges.where(to_a != to_b).select(F.least(to_a, to_b).alias("a"), F.greatest(to_a, to_b).alias("b"))
        edges = scratch.save(merged.distinct(), f"links{k + 1}")
        scratch.drop(f"links{k}")
        scratch.drop(f"first{k}")
    if not steps:
        return edges.select(a.alias("node"), b.alias("root"))
    found = steps[0]
    for step in steps[1:]:
        onward = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return scratch.save(found, "components")
