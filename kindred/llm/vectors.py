"""Rows of an embedding table as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.slices import with_small_batches


def usable(vector: str) -> Column:
    """Whether a vector is not null, not empty, not zero, and all its components are finite.

    Components so large that the sum of squares overflows count as usable.
    """
    value = F.col(vector)
    finite = F.forall(
        value,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return F.coalesce(value.isNotNull() & finite & F.exists(value, lambda x: x != 0), F.lit(False))


def packed(df: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """``id, *more, dim, packed``: usable vectors as little-endian doubles."""
    rows = df.where(usable(vector_col)).select(
        id_col, *more, F.col(vector_col).cast("array<double>").alias("vector")
    )
    names = [id_col, *more]
    fields = ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)

    def task(batches):
        for batch in batches:
            column = batch.column(len(names))
            edges = column.offsets.to_numpy()
            values = column.values.to_numpy(zero_copy_only=False).astype("<f8").tobytes()
            yield pa.record_batch({
                **{name: batch.column(at) for at, name in enumerate(names)},
                "dim": pa.array(np.diff(edges).astype(np.int32)),
                "packed": pa.array(
                    [values[8 * a : 8 * b] for a, b in zip(edges, edges[1:], strict=False)], pa.binary()
                ),
            })

    return with_small_batches(rows).mapInArrow(task, f"{fields}, dim int, packed binary")


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Packed vectors of one dimension, one per row."""
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)
