"""Connected components of a large edge list, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkledger.llm.common import landed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: each node's greater neighbours point at the least node it sees; small: its lesser ones and itself do."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    seen = both if large else both.where("b < a")
    least = seen.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    moved = seen.join(least, "a")
    if large:
        moved = moved.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, land: Callable[[DataFrame, str], DataFrame] = landed) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node of the component.

    ``edges`` has two long columns a and b. A node's edges are never gathered: only its least
    neighbour is, combined before the shuffle. Rounds grow with the logarithm of the size. ``land`` writes and reads
    back what each round gives.
    """
    edges = land(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before, state = None, _state(edges)
    while state != before:
        edges = land(_star(_star(edges, True), False), "stars")
        before, state = state, _state(edges)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
