"""Running aggregates within groups that are too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.session import materialise


def running(
    df: DataFrame, group: Sequence[str], order_by: Sequence[Column], columns: dict[str, str],
    xor: bool = False,
) -> DataFrame:
    """Add running sums (exclusive-or values with ``xor``) within ``group``.

    ``columns`` maps every new column to the one it adds up. Rows are range partitioned on
    (group, order) and written once, so a large group spreads over many tasks; each run of a
    group inside a partition is added up in place and raised by the totals of the group's
    earlier runs. There are at most (partitions + groups) runs, and only groups that span
    partitions are raised. ``group`` and values must not be null, and ``order_by`` must be a
    total order.
    """
    keys = [*map(F.col, group), *order_by]
    placed = materialise(df.repartitionByRange(*keys).withColumn("_run", F.spark_partition_id()))
    fold = F.bit_xor if xor else F.sum
    inside = (
        Window.partitionBy("_run", *group).orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    added = placed.withColumns({name: fold(value).over(inside) for name, value in columns.items()})
    earlier = (
        Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = placed.groupBy("_run", *group).agg(
        *(fold(value).alias(f"_{name}") for name, value in columns.items())
    )
    raised = (
        totals.withColumn("_first", F.min("_run").over(Window.partitionBy(*group)))
        .withColumns({f"_{name}": fold(f"_{name}").over(earlier) for name in columns})
        .where("_run > _first").drop("_first")
    )

    def total(name: str) -> Column:
        before = F.coalesce(F.col(f"_{name}"), F.lit(0))
        return F.col(name).bitwiseXOR(before) if xor else F.col(name) + before

    joined = added.join(raised, ["_run", *group], "left")
    return joined.select(*df.columns, *(total(name).alias(name) for name in columns))
