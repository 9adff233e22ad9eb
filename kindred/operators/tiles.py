"""Comparing every left row of a key with every right row without emitting pairs.

Both sides of a key are cut into chunks of bounded size. A task holds one left and
one right chunk (a tile) and returns only a reduction of it, so a key that holds a
large share of all rows becomes many tiles, and no pair leaves a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators.skew import join_per_key
from kindred.session import materialise

DEFAULT_CHUNK_ROWS = 4096


def reduce_tiles(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    reducer: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Apply ``reducer`` to every tile of every key that both sides have.

    Rows are placed in chunks by a hash of their id, which must be unique within a
    key: a repeated or lost task rebuilds the same chunks. ``sizes`` (keys,
    ``lefts``, ``rights``) saves counting the rows per key when they are known.
    """
    if sizes is None:
        # Counting the id keeps an aggregated side identical in both uses, so that
        # Spark shuffles it once.
        sizes = left.groupBy(*keys).agg(F.count(left_id).alias("lefts")).join(
            right.groupBy(*keys).agg(F.count(right_id).alias("rights")), list(keys)
        )
    grid = sizes.select(
        *keys,
        F.ceil(F.col("lefts") / chunk_rows).cast("int").alias("_lefts"),
        F.ceil(F.col("rights") / chunk_rows).cast("int").alias("_rights"),
    )

    def spread(side: DataFrame, own: str, own_count: str, other: str, other_count: str, id_col: str):
        return (
            join_per_key(side, grid, keys)
            .withColumn(own, F.pmod(F.xxhash64(id_col), F.col(own_count)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1)))
            .drop(own_count, other_count)
        )

    tile = [*keys, "_left", "_right"]
    lefts = spread(left, "_left", "_lefts", "_right", "_rights", left_id)
    rights = spread(right, "_right", "_rights", "_left", "_lefts", right_id)
    return lefts.groupBy(*tile).cogroup(rights.groupBy(*tile)).applyInPandas(reducer, schema)


# Pivots that vectors are placed by, and what rounding may take from an angle.
PIVOTS = 8
_SLACK = 1e-6


def pivot_vectors(rows: DataFrame, id_col: str, vector: str, count: int = PIVOTS) -> np.ndarray:
    """``count`` vectors of unit length, those with the smallest MD5 of their ids; zero ones left out."""
    usable = rows.where(F.exists(vector, lambda x: x != 0)).select(
        F.md5(F.col(id_col).cast("string")).alias("order"), vector
    )
    found = usable.orderBy("order", vector).limit(count).collect()
    matrix = np.array([row[vector] for row in found], dtype=np.float64)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True) if len(found) else matrix


def with_angles(rows: DataFrame, vector: str, pivots: np.ndarray) -> DataFrame:
    """Add ``_cell``, the nearest pivot, and ``_angles`` to all pivots."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(batch.schema.get_field_index(vector))
            matrix = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            matrix = matrix.reshape(batch.num_rows, -1)
            lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
            unit = np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)
            angles = np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0))
            listed = pa.FixedSizeListArray.from_arrays(pa.array(angles.ravel()), len(pivots))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(angles.argmin(axis=1), pa.int32()),
                 listed.cast(pa.list_(pa.float64()))],
                names=[*batch.schema.names, "_cell", "_angles"],
            )

    fields = T.StructType([
        *rows.schema.fields, T.StructField("_cell", T.IntegerType()),
        T.StructField("_angles", T.ArrayType(T.DoubleType())),
    ])
    return rows.mapInArrow(place, fields)


def near_cells(
    left: DataFrame, right: DataFrame, keys: Sequence[str], threshold: float | None, pivots: int,
    chunk_rows: int,
) -> DataFrame:
    """Pairs of cells of a key that can hold a pair of vectors with cosine ``threshold``.

    An angle between two vectors is at least the difference of their angles to a pivot. Where
    for some pivot the ranges of two cells lie farther apart than the threshold's angle, no
    pair can reach it. Returns ``keys, _lcell, _rcell, _lefts, _rights`` (numbers of chunks).
    """

    def extents(side: DataFrame, cell: str, chunks: str, name: str) -> DataFrame:
        ends = [
            bound.alias(f"{name}{way}{at}")
            for at in range(pivots)
            for way, bound in (("min", F.min(F.col("_angles")[at])), ("max", F.max(F.col("_angles")[at])))
        ]
        count = F.ceil(F.count(F.lit(1)) / chunk_rows).cast("int").alias(chunks)
        return side.groupBy(*keys, F.col("_cell").alias(cell)).agg(count, *ends)

    lefts, rights = extents(left, "_lcell", "_lefts", "l"), extents(right, "_rcell", "_rights", "r")
    pairs = lefts.join(rights, list(keys))
    if threshold is not None and threshold > 0:
        reach = float(np.arccos(min(threshold, 1.0))) + _SLACK
        for at in range(pivots):
            pairs = pairs.where(
                (F.col(f"lmin{at}") - F.col(f"rmax{at}") <= reach)
                & (F.col(f"rmin{at}") - F.col(f"lmax{at}") <= reach)
            )
    return pairs.select(*keys, "_lcell", "_rcell", "_lefts", "_rights")


def reduce_near_tiles(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    id_col: str,
    vector: str,
    reducer: Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame],
    schema: str,
    threshold: float | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """:func:`reduce_tiles` for vectors: tiles that cannot reach ``threshold`` are never built.

    A vector belongs to the cell of its nearest pivot; a tile is a chunk of a left cell and a
    chunk of a right cell. A row is sent to the tiles of its cell alone, once each.
    """
    pivots = pivot_vectors(right, id_col, vector)
    if not len(pivots):  # zero vectors alone: one cell
        pivots = np.zeros((1, 1))
        left, right = (side.withColumns({"_cell": F.lit(0), "_angles": F.array(F.lit(0.0))})
                       for side in (left, right))
    else:
        left, right = (with_angles(side, vector, pivots) for side in (left, right))
    grid = materialise(near_cells(left, right, keys, threshold, len(pivots), chunk_rows))

    def spread(side: DataFrame, own: str, other: str, cells: tuple[str, str], chunks: tuple[str, str]):
        placed = side.drop("_angles").withColumnRenamed("_cell", cells[0])
        return (
            join_per_key(placed, grid, [*keys, cells[0]])
            .withColumn(own, F.pmod(F.xxhash64(id_col), F.col(chunks[0])).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(chunks[1]) - 1)))
            .drop(*chunks)
        )

    tile = [*keys, "_lcell", "_rcell", "_left", "_right"]
    lefts = spread(left, "_left", "_right", ("_lcell", "_rcell"), ("_lefts", "_rights"))
    rights = spread(right, "_right", "_left", ("_rcell", "_lcell"), ("_rights", "_lefts"))
    return lefts.groupBy(*tile).cogroup(rights.groupBy(*tile)).applyInPandas(reducer, schema)
