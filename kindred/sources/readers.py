"""Tables, parquet, JSON catalogues, CSV lists and feature stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators.tables import feature_table_join


def table_scan_project(spark: SparkSession, table: str, columns: Sequence[str]) -> DataFrame:
    """Chosen columns of a catalogue table."""
    return spark.read.table(table).select(*columns)


def parquet_scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A parquet table by path, all columns or the chosen ones."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


def csv_scan(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A CSV list with a header row and a declared schema."""
    return spark.read.option("header", True).schema(schema).csv(path)


def json_catalog_scan(
    spark: SparkSession, root: str, schema: str | T.StructType, multi_line: bool = True
) -> DataFrame:
    """Scraped products, one folder per brand below ``root``.

    Files hold one JSON object each (``multi_line``) or one per line. Only top-level
    keys become columns; nested values keep their type. A key that a file lacks is
    null. The folder is added as ``brand_folder``.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    files = reader.option("pathGlobFilter", "*.json").json(f"{root.rstrip('/')}/*")
    folder = F.try_element_at(F.split(F.col("_metadata.file_path"), "/"), F.lit(-2))
    return files.withColumn("brand_folder", F.url_decode(folder))


def feature_store_scan(
    spark: SparkSession, root: str, features: Sequence[str], on: str
) -> DataFrame:
    """Selected feature tables below ``root``, joined on the product id."""
    tables = [spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet") for name in features]
    return feature_table_join(tables, on)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Register a frame for SQL; returns it."""
    df.createOrReplaceTempView(name)
    return df
