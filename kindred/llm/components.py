"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.skew import join_per_key
from kindred.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a``, ``b``).

    The component is the smallest node reachable. Rounds of two steps, both joins on a
    node: link every larger neighbour to the smallest one, then every smaller one. The
    number of rounds grows with the logarithm of the longest path; a round's links are
    written to the shared folder. A node with very many links is an aggregate and a join
    that can be split, never a group in one task.
    """
    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("least"))
        large = (
            join_per_key(both.where("b > a"), least, ["a"])
            .select(F.col("b").alias("a"), F.col("least").alias("b")).where("a <> b").distinct()
        )
        large = materialise(large)
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            join_per_key(large, least, ["a"])
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b"))
            .where("a <> b").distinct()
        )
        found = materialise(small)
        if _digest(found) == _digest(edges):
            break
        edges = found
    # now every node but the smallest of its component has exactly the link to that one
    return found.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        found.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    """Equal for equal sets of links."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed), F.bit_xor(F.xxhash64("b", "a"))).first())
