"""Parquet, managed tables and CSV."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parquet_sink(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), skip_empty: bool = False
) -> bool:
    """Overwrite parquet at ``path``; with ``skip_empty`` an empty frame writes nothing."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return True


def table_overwrite_sink(df: DataFrame, table: str, path: str | None = None) -> None:
    """Create or overwrite a catalogue table; ``path`` makes it external."""
    writer = df.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def append_or_create_sink(
    df: DataFrame,
    table: str,
    checker: Callable[[DataFrame], bool] | None = None,
    overwrite: bool = False,
    add_insert_time: bool = False,
    path: str | None = None,
) -> None:
    """Insert into a table, creating it first if needed.

    The columns must be those of the table, in any order; a missing or an additional one is
    an error, because nothing is dropped or made up. A failing ``checker`` stops before
    anything is written.
    """
    if checker is not None and not checker(df):
        raise ValueError(f"check failed for {table}")
    if add_insert_time:
        df = df.withColumn("InsertTime", F.date_trunc("second", F.current_timestamp()))
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        wanted = spark.table(table).columns  # inserts go by position
        if sorted(df.columns) != sorted(wanted):
            extra, missing = set(df.columns) - set(wanted), set(wanted) - set(df.columns)
            raise ValueError(f"{table}: additional {sorted(extra)}, missing {sorted(missing)}")
        df.select(*wanted).write.insertInto(table, overwrite=overwrite)
    else:
        table_overwrite_sink(df, table, path)


def csv_sink(df: DataFrame, path: str) -> None:
    """CSV with a header row in every file."""
    df.write.mode("overwrite").option("header", True).csv(path)
