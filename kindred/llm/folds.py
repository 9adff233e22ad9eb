"""Held-out documents, and labels joined to documents for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from training: CRC-32 of the id as text leaves remainder 0.

    A null id counts as the empty text, whose remainder is 0.
    """
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def training_labels(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """``id, label`` of the training rows, one per id: the largest label, nulls left out."""
    return (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
        .groupBy(id_col).agg(F.max(label).cast("int").alias("label"))
    )


def smallest_hashes(ids: DataFrame, most: int, id_col: str = "doc_id") -> list:
    """At most ``most`` ids, chosen by a hash of the id: a sample that does not depend on order."""
    rows = (
        ids.select(id_col).where(F.col(id_col).isNotNull())
        .orderBy(F.xxhash64(F.col(id_col)), id_col).limit(most).collect()
    )
    return [row[0] for row in rows]
