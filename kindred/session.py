"""Session helpers: where materialised intermediates and scratch tables may live."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

_SETTING = "spark.checkpoint.dir"
_made: list[str] = []


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library is tuned for; ``conf`` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the one that the session names, else a folder in
    the warehouse, which executors share as well."""
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/kindred-stages"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_stages(spark: SparkSession) -> int:
    """Delete the folders that this process has written so far; returns their number.

    Call it when results have been written: frames that read a stage cannot be used afterwards.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    made, _made[:] = _made[:], []
    for name in made:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
    return len(made)


def local_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A short list as a table whose size the planner knows.

    Rows handed over as Arrow become a local relation, so that a join can broadcast
    it by its size; a plain Python list would count as unboundedly large.
    """
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    arrays = [
        pa.array(column, type=to_arrow_type(field.dataType))
        for column, field in zip(columns, fields, strict=True)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=fields.names), fields)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder as parquet and read it from there.

    Used where two branches of a plan must see the very same rows, to keep loops
    from re-running their input, and for results that several later steps read by
    different columns. Unlike a cache the files outlive lost executors, and their
    size is known to the planner.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
