"""Bounded slices of Arrow batches, and the plumbing of functions that map them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from kindred.llm import stores

#: Bytes of text that a slice holds, unless a single text is longer.
SLICE_BYTES = 1_000_000
#: Bytes of an Arrow batch that Spark hands to a worker.
BATCH_BYTES = 4_000_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut ``batch`` so that the texts of a slice have about ``most`` bytes together."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    yield batch.slice(start)


def with_small_batches(df: DataFrame) -> DataFrame:
    """``df``, its session's Arrow batches bounded to ``BATCH_BYTES``.

    A batch of Spark's default size holds up to 64 MB in the JVM and several times that in
    a worker. The setting changes no result; a smaller one is left as it is.
    """
    conf = df.sparkSession.conf
    given = conf.get(_BATCH_SETTING, None)
    digits = given[:-1] if given and given.endswith("b") else given
    if digits is None or not digits.isdigit() or int(digits) > BATCH_BYTES or int(digits) <= 0:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def map_slices(
    df: DataFrame, text: str, run: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
    most: int = SLICE_BYTES, keeps: bool = False,
) -> DataFrame:
    """Apply ``run`` to every slice of ``df``; a slice may hold no row after filtering.

    Unless ``run`` keeps an object of its own in the worker (``stores.resident``), what an
    earlier task has left there is let go.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            stores.release()
        for batch in batches:
            for part in slices(batch, text, most):
                yield run(part)
        stores.trim()

    return with_small_batches(df).mapInArrow(task, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, null as the empty text."""
    return [value or "" for value in column.to_pylist()]
