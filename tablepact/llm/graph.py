"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepact.llm.shared import cut


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node reachable, for each end of (a, b) rows.

    Each round joins a node's neighbours to the least of them; least neighbours are
    combined before the shuffle and stars are inner joins, which adaptive execution
    splits where a hub is large. Rounds are written to the checkpoint folder, so
    lineage stays short and a lost executor costs one round at most. Loops, repeated
    edges and no edges at all are fine; rows with a null end count for nothing.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs, mark = cut(pairs.distinct()), None
    while mark != (mark := _fingerprint(pairs)) and mark[0]:
        pairs = cut(_small_star(_large_star(pairs)))
    # now every node but the least points straight at the least one
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        pairs.select("b", "b").distinct()
    )


def _fingerprint(pairs: DataFrame) -> tuple[int, int]:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def _large_star(pairs: DataFrame) -> DataFrame:
    """Each neighbour above a node is tied to the least of the node and its neighbours."""
    both = pairs.union(pairs.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Each neighbour below a node, and the node, are tied to the least of them."""
    least = pairs.groupBy("a").agg(F.min("b").alias("m"))
    moved = pairs.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least).distinct()
