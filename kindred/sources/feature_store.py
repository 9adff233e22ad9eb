"""Feature tables bucketed by product id, so that any number of them join without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from kindred.operators.tables import feature_table_join

# Buckets of a store; all tables that are joined must have the same number.
BUCKETS = 64


def write_feature_table(
    df: DataFrame, root: str, store: str, feature: str, id_col: str, buckets: int = BUCKETS
) -> str:
    """Write one feature table below ``root`` and register it as ``<store>_<feature>``.

    The rows are dealt to the buckets before they are written: one file per bucket, sorted by
    id. Returns the table's name; a table of that name is replaced.
    """
    name = f"{store}_{feature}"
    session = df.sparkSession
    session.sql(f"DROP TABLE IF EXISTS {name}")
    (
        df.repartition(buckets, id_col).write.mode("overwrite").format("parquet")
        .option("path", f"{root.rstrip('/')}/{feature}")
        .bucketBy(buckets, id_col).sortBy(id_col).saveAsTable(name)
    )
    return name


def bucket_layout(spark: SparkSession, table: str) -> tuple[str, str]:
    """Number of buckets and bucket columns of a table, as the catalog states them."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").collect()
    facts = {row["col_name"]: row["data_type"] for row in rows}
    return facts.get("Num Buckets", ""), facts.get("Bucket Columns", "")


def join_feature_tables(spark: SparkSession, tables: Sequence[str], id_col: str) -> DataFrame:
    """Inner join of stored feature tables on the product id, bucket by bucket.

    Tables with another layout would be shuffled; that is an error here.
    """
    layouts = {bucket_layout(spark, table) for table in tables}
    if len(layouts) > 1 or f"[`{id_col}`]" not in {columns for _, columns in layouts}:
        raise ValueError(f"tables are not bucketed alike on {id_col}: {sorted(layouts)}")
    return feature_table_join([spark.table(table) for table in tables], id_col)
