"""Connected components of an edge table, by alternating star operations.

Each round hangs every node's larger neighbours on its smallest one, then every node and its smaller
neighbours on the smallest of those (Kiveris et al., "Connected Components in MapReduce and Beyond").
Rounds grow with the logarithm of the longest chain. A round is written to the shared folder, which cuts lineage; minima combine before
the shuffle, and joins on a hub with many edges can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import Staging


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """(node, component) for all nodes but the smallest of each component, from edges (a, b).

    Self-loops, repeated edges and nulls are ignored.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = staging.write(edges, "edges")
    state = _state(current)
    while state[0]:
        current = staging.write(_small_star(staging.write(_large_star(current), "large-star")), "small-star")
        before, state = state, _state(current)
        if state == before:
            break
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    hung = both.join(least, "a").where("b > a")
    return hung.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    hung = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionAll(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
