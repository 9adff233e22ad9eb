"""Joins in which one key may hold a large share of the rows, or both sides grow with the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_large(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join two sides that both grow with the data, by sort and merge.

    The planner takes a side's size from its files, where encoded and repeated values need a
    fraction of their rows, and does not count the rows that generators and Python steps add.
    Millions of rows would so pass for a side that the driver can gather and broadcast.
    """
    return left.join(right.hint("merge"), on, how)


def join_per_key(
    df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "inner", large: bool = False
) -> DataFrame:
    """Join a side with one row per key to rows among which a key may be very frequent.

    Such a side usually comes from an aggregation on the same keys. Spark would then
    reuse the aggregate's partitioning for the join, and the adaptive skew join only
    splits partitions of shuffles made for the join itself. A hash of the key as a
    further join key gives the join its own shuffles, so a hot key is split over many
    tasks. A side below the broadcast threshold is still broadcast by its size, unless
    ``large`` says that the keys grow with the data (see :func:`join_large`).
    """
    mixed = F.xxhash64(*keys)
    left, right = df.withColumn("_mixed", mixed), per_key.withColumn("_mixed", mixed)
    joined = join_large if large else DataFrame.join
    return joined(left, right, [*keys, "_mixed"], how).drop("_mixed")
