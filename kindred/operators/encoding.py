"""Batch inference and the versioned encoding store.

Store rows are ``(id, encoding, part, pos, insert_time)`` in parquet, in a folder per append
and below it in folders of consecutive parts; a part holds at most ``part_size`` rows. The newest encoding of
an id is the one in the highest part, then at the highest position.
"""

from __future__ import annotations

import hashlib
import threading
import time
import uuid
from abc import ABC, abstractmethod
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.numbering import number_rows
from kindred.operators.tables import anti_join, nonblank_filter

# Batch and part sizes used when none are given.
BATCH_SIZE = 256
PART_SIZE = 2000
# Tokens whose place a task keeps; it bounds memory and changes no result.
TOKENS_KEPT = 500_000
# Writers of this process reserve parts one at a time.
_RESERVING = threading.Lock()
# Consecutive parts kept in one folder: folders stay few while parts stay small.
PARTS_PER_FOLDER = 256


class Encoder(ABC):
    """A model that turns a batch of inputs into vectors of one length."""

    @abstractmethod
    def init_model(self) -> Any:
        """Load the model; called once per task, on the executor."""

    @abstractmethod
    def batch_predict(self, model: Any, data: pd.Series) -> np.ndarray:
        """Vectors of a batch, shape (len(data), dimension)."""


@dataclass(frozen=True)
class HashingEncoder(Encoder):
    """Counts of a text's tokens, hashed to ``dimension`` places.

    Tokens stand between ``separator``; a token's place is the number in the first four
    hexadecimal digits of its MD5, modulo the dimension. Null is a text without tokens.
    """

    dimension: int = 64
    separator: str = " "

    def init_model(self) -> dict[str, int]:
        """Places of the tokens met so far."""
        return {}

    def batch_predict(self, model: dict[str, int], data: pd.Series) -> np.ndarray:
        # Arrow cuts and numbers the tokens; only a batch's distinct ones become strings
        texts = pc.fill_null(pa.array(data, pa.string(), from_pandas=True), "")
        parts = pc.split_pattern(texts, self.separator)
        tokens = parts.flatten().dictionary_encode()
        rows = pc.list_parent_indices(parts).to_numpy()
        names = tokens.dictionary.to_pylist()
        if len(model) > TOKENS_KEPT:
            model.clear()
        for name in set(names).difference(model):
            digest = hashlib.md5(name.encode(), usedforsecurity=False).digest()
            model[name] = int.from_bytes(digest[:2], "big") % self.dimension
        # the empty token counts nowhere: it goes to a place past the last one
        places = np.array([model[name] if name else self.dimension for name in names], np.int64)
        width = self.dimension + 1
        flat = np.bincount(rows * width + places[tokens.indices.to_numpy()], minlength=len(data) * width)
        return flat.reshape(len(data), width)[:, : self.dimension].astype(np.float64)


def batch_encode(
    df: DataFrame, id_col: str, data_col: str, encoder: Encoder, batch_size: int = BATCH_SIZE,
    partitions: int | None = None,
) -> DataFrame:
    """``(id, encoding)`` of every row, encoded in batches inside the tasks.

    ``partitions`` deals the rows to so many tasks first: a model's time per row is worth the
    shuffle where the input has few files.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder.init_model()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                piece = batch.slice(start, batch_size)
                vectors = np.asarray(encoder.batch_predict(model, piece.column(1).to_pandas()), np.float64)
                if len(vectors) != piece.num_rows:
                    raise ValueError("the encoder must return one vector per input")
                edges = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
                listed = pa.ListArray.from_arrays(pa.array(edges), pa.array(vectors.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column(0), listed], names=["id", "encoding"])

    inputs = df.select(F.col(id_col).alias("id"), F.col(data_col).alias("_data"))
    if partitions is not None:
        inputs = inputs.repartition(partitions)
    kind = inputs.schema["id"].dataType.simpleString()
    return inputs.mapInArrow(encode, f"id {kind}, encoding array<double>")


def even_chunk(row: Column, total: int | Column, size: int) -> Column:
    """Chunk of 0-based ``row`` when ``total`` rows are cut as evenly as possible
    into the fewest chunks of at most ``size`` rows; the first chunks are the longer ones."""
    total = total if isinstance(total, Column) else F.lit(total)
    chunks = F.greatest(F.ceil(total / size), F.lit(1))
    short = F.floor(total / chunks)
    long_rows = (total % chunks) * (short + 1)
    after = F.floor((row - long_rows) / F.greatest(short, F.lit(1)))
    early = F.floor(row / (short + 1))
    return F.when(row < long_rows, early).otherwise(total % chunks + after).cast("int")


def assign_parts(
    df: DataFrame, id_col: str, part_size: int, first_part: int = 0, more: Sequence[str] = ()
) -> DataFrame:
    """Add ``part`` and ``pos`` (position in the part) in the order of the id, then ``more``."""
    numbered = number_rows(df, [F.col(name).asc() for name in (id_col, *more)], (), "_row")
    total = numbered.count()
    row = F.col("_row") - 1
    chunk = even_chunk(row, total, part_size)
    chunks = max(1, -(-total // part_size))
    short, longer = divmod(total, chunks)
    start = F.col("_chunk") * short + F.least(F.col("_chunk"), F.lit(longer))
    return (
        numbered.withColumn("_chunk", chunk)
        .withColumn("part", (F.col("_chunk") + first_part).cast("int"))
        .withColumn("pos", (row - start).cast("int"))
        .drop("_row", "_chunk")
    )


def stored_encodings(df: DataFrame | None) -> int:
    """The next unused part number of a store."""
    if df is None:
        return 0
    top = df.agg(F.max("part")).first()[0]
    return 0 if top is None else top + 1


def reserve_parts(spark: SparkSession, path: str, count: int, first: int = 0) -> int:
    """Reserve ``count`` consecutive part numbers of the store at ``path``; returns the first.

    Optimistic: a reservation is a file ``_parts/<number>`` that states where its parts begin
    and end. A writer reads the last one and tries to create the next; where another writer was
    first, it reads again. Writers of one driver take turns; between drivers it takes a file
    system that creates a file once only, as HDFS does. Numbers start at ``first`` or after the
    last reservation. Readers do not see the files, and a writer that fails leaves a gap and
    nothing else.
    """
    with _RESERVING:
        return _reserve(spark, path, count, first)


def _reserve(spark: SparkSession, path: str, count: int, first: int) -> int:
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_parts")
    files = folder.getFileSystem(conf)
    files.mkdirs(folder)

    def content(number: int) -> list[str]:
        name = jvm.org.apache.hadoop.fs.Path(folder, f"{number:09d}")
        for _ in range(200):
            stream = files.open(name)
            try:
                return stream.readUTF().split(" ")
            except Py4JJavaError:  # created, but its writer has not filled it yet
                time.sleep(0.05)
            finally:
                stream.close()
        raise TimeoutError(f"{name} was never filled; delete it if its writer is gone")

    mark = uuid.uuid4().hex
    while True:
        taken = sorted(int(each.getPath().getName()) for each in files.listStatus(folder))
        start = max(first, int(content(taken[-1])[1])) if taken else first
        number = taken[-1] + 1 if taken else 0
        try:
            stream = files.create(jvm.org.apache.hadoop.fs.Path(folder, f"{number:09d}"), False)
            try:
                stream.writeUTF(f"{start} {start + count} {mark}")
            finally:
                stream.close()
        except Py4JJavaError as error:
            if files.exists(jvm.org.apache.hadoop.fs.Path(folder, f"{number:09d}")):
                continue  # another writer was first
            raise error
        if content(number)[2] == mark:
            return start


def encoding_sink(
    encoded: DataFrame, path: str, part_size: int = PART_SIZE, existing: DataFrame | None = None
) -> DataFrame:
    """Append ``(id, encoding)`` rows to the store at ``path``; returns ``(id, part, pos)``.

    Part numbers continue after the largest stored or reserved one, so writers at work at the
    same time get different parts. The rows arrive range partitioned by id, so each task
    writes consecutive parts.
    """
    placed = assign_parts(encoded, "id", part_size)
    last = placed.agg(F.max("part")).first()[0]
    parts = 0 if last is None else last + 1
    first = reserve_parts(encoded.sparkSession, path, parts, stored_encodings(existing))
    return _append(placed.withColumn("part", F.col("part") + first), path, first)


def _append(placed: DataFrame, path: str, first: int) -> DataFrame:
    """Append ``id, encoding, part, pos`` rows; returns the rows without their vectors.

    A writer has a folder of its own, named by its first part: Spark commits the files of one
    writer at a time below a folder.
    """
    placed.withColumns(
        {
            "insert_time": F.date_trunc("second", F.current_timestamp()),
            "folder": F.floor(F.col("part") / PARTS_PER_FOLDER).cast("int"),
        }
    ).write.mode("append").partitionBy("folder").parquet(f"{path.rstrip('/')}/batch={first}")
    return placed.select("id", "part", "pos")


def latest_encoding(store: DataFrame) -> DataFrame:
    """One row per id: highest part, then highest position. An aggregate, not a window."""
    rest = [name for name in store.columns if name != "id"]
    newest = store.groupBy("id").agg(
        F.max_by(F.struct(*rest), F.struct("part", "pos")).alias("_newest")
    )
    return newest.select("id", *[F.col(f"_newest.{name}").alias(name) for name in rest])


def encoding_scan(
    store: DataFrame,
    wanted: DataFrame | None = None,
    latest_only: bool = True,
    time_range: tuple[str, str] | None = None,
) -> DataFrame:
    """Stored encodings of the wanted ids.

    The newest part of each id is chosen on the narrow key columns. In a store with
    folders, those that hold a chosen part are found first (one number each, a folder has
    ``PARTS_PER_FOLDER`` parts) and stand in the scan as a filter on the partition column,
    so no other folder's vectors are read.
    """
    keys = [name for name in ("folder", "part", "pos", "id") if name in store.columns]
    catalogue = store
    if time_range is not None:
        catalogue = catalogue.where(F.col("insert_time").between(*map(F.lit, time_range)))
    catalogue = catalogue.select(*keys)
    if wanted is not None:
        catalogue = catalogue.join(wanted.select("id"), "id", "left_semi")
    if latest_only:
        catalogue = latest_encoding(catalogue)
    if "folder" in keys and (wanted is not None or time_range is not None):
        folders = [row[0] for row in catalogue.select("folder").distinct().collect()]
        store = store.where(F.col("folder").isin(folders))
    return store.join(catalogue, keys, "left_semi")


def pending_ids(df: DataFrame, id_col: str, catalogue: DataFrame | None) -> DataFrame:
    """Rows with a usable id that the catalogue does not hold yet."""
    usable = nonblank_filter(df, id_col)
    known = None if catalogue is None else catalogue.select(F.col("id").alias(id_col))
    return anti_join(usable, known, id_col)


def incremental_encode(
    df: DataFrame,
    id_col: str,
    data_col: str,
    encoder: Encoder,
    path: str,
    existing: DataFrame | None = None,
    batch_size: int = BATCH_SIZE,
    part_size: int = PART_SIZE,
) -> DataFrame:
    """Encode what the store lacks and append it; returns the new ``(id, part, pos)`` rows.

    Places are given to the ids before anything is encoded, and travel through the encoder with
    them: the model sees every row once, and a vector is written once, to its part. Equal
    (id, data) rows share a place.
    """
    todo = pending_ids(df, id_col, existing).select(
        F.col(id_col).alias("id"), F.col(data_col).alias("_data"),
        F.md5(F.coalesce(F.col(data_col).cast("string"), F.lit(""))).alias("_mark"),
    )
    # written narrow: later steps must see the same places
    places = assign_parts(todo.select("id", "_mark").distinct(), "id", part_size, 0, ["_mark"])
    last = places.agg(F.max("part")).first()[0]
    parts = 0 if last is None else last + 1
    first = reserve_parts(df.sparkSession, path, parts, stored_encodings(existing))
    places = places.withColumn("part", F.col("part") + first)
    inputs = (
        todo.join(places, ["id", "_mark"]).repartitionByRange("part", "pos")
        .select(F.struct("id", "part", "pos").alias("_key"), "_data")
    )
    encoded = batch_encode(inputs, "_key", "_data", encoder, batch_size)
    _append(encoded.select("id.*", "encoding"), path, first)
    return places.select("id", "part", "pos")
