"""Row numbers for groups that are too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import materialise


def number_rows(
    df: DataFrame,
    order_by: Sequence[Column],
    partition_by: Sequence[str] = (),
    name: str = "row_number",
) -> DataFrame:
    """Number rows 1..n within ``partition_by`` in ``order_by`` order.

    A window would sort a whole group in one task. Here the rows are range
    partitioned on (group, order), so a large group spreads over many tasks; each
    run of a group inside a partition is numbered in place and shifted by the size
    of the group's earlier runs. There are at most (partitions + groups) runs. The
    sorted rows are materialised once so that numbering and run sizes agree.
    Pass only the columns needed; ``order_by`` must be a total order.
    """
    keys = [F.col(column) for column in partition_by] + list(order_by)
    placed = materialise(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_partition", F.spark_partition_id())
        .withColumn("_position", F.monotonically_increasing_id())
    )
    run = ["_partition", *partition_by]
    runs = placed.groupBy(*run).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_start")
    )
    earlier = (
        Window.partitionBy(*partition_by)
        .orderBy("_partition")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_start") + 1
    offsets = runs.select(*[F.col(column).alias(f"_run{column}") for column in run],
                          shift.alias("_shift"))
    same_run = [F.col(column).eqNullSafe(F.col(f"_run{column}")) for column in run]
    numbered = placed.join(offsets, same_run, "inner")
    return numbered.select(
        *df.columns, (F.col("_position") + F.col("_shift")).cast("bigint").alias(name)
    )
