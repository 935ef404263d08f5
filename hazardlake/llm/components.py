"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import written

MAX_ROUNDS = 100


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 31))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(
        F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are hung on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), root being the smallest node reachable.

    Each step needs one minimum per node, combined before the shuffle, and one join that may
    be split at crowded nodes; no task holds a node's whole neighbourhood. The number of
    rounds grows with the logarithm of the longest chain. Roots themselves are not listed.
    """
    ends = edges.filter("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(ends.distinct(), "links")
    state = _state(now)
    for _ in range(MAX_ROUNDS if state[0] else 0):
        now = written(_small_star(_large_star(now)), "links")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    if state[0]:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
