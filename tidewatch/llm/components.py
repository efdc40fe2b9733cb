"""Connected groups of a graph given by its edges, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _with_low(edges: DataFrame, least: DataFrame, crowd: int) -> DataFrame:
    """Edges (a, b) with the ``low`` of their a, from (a, low, n) where n counts a's edges.

    Nodes of more than ``crowd`` edges are joined by broadcast, so that the edges
    of a hub stay where they are; the others meet their node by shuffle.
    """
    hubs = stored(least.where(F.col("n") > crowd).select("a", "low"), "hubs")
    of_hubs = edges.join(F.broadcast(hubs), "a")
    others = edges.join(F.broadcast(hubs.select("a")), "a", "left_anti").join(least.select("a", "low"), "a")
    return of_hubs.select("a", "b", "low").union(others.select("a", "b", "low"))


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) for every node of edges (a, b); the label is the least node of its group.

    Nodes are hung below the least neighbour, larger ones first and then
    smaller ones, until nothing changes; the number of rounds grows with the
    logarithm of a group's longest path. Every round is written to the shared
    folder. Least neighbours are found by a partial aggregate, so a node with
    very many edges is no single task's work; such hubs are then told to their
    edges by broadcast. A hub has more than 1 in 10,000 of all edges (and more than
    64), so there are 20,000 at most. Loops and nulls are ignored; no
    edges give no rows.
    """
    pairs = edges.select("a", "b").where("a <> b")
    now = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _fingerprint(now)
    for _ in range(rounds):
        if not before[0]:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        crowd = max(64, before[0] // 10_000)
        least = both.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n")).select("a", F.least("a", "low").alias("low"), "n")
        # Every larger neighbour of a node is hung below the least of its neighbours and itself.
        large = _with_low(both.where("b > a"), least, crowd)
        large = stored(large.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "larger-neighbours")
        low = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        # Every node keeps its least smaller neighbour; the other smaller ones are hung below that.
        small = _with_low(large, low, crowd).select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b"))
        now = stored(small.where("a <> b").distinct(), "edges")
        after = _fingerprint(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"not settled after {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
