"""Arithmetic on ``array<float|double>`` columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    """Inner product of two arrays of equal length."""
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, value: total + value)


def norm(vector: Column) -> Column:
    """Euclidean length."""
    total = F.aggregate(
        vector, F.lit(0.0), lambda acc, value: acc + value.cast("double") * value.cast("double")
    )
    return F.sqrt(total)


def cosine_similarity(left: Column, right: Column) -> Column:
    """Cosine of two vectors; 0 when either is the zero vector or missing."""
    return F.coalesce(F.try_divide(dot(left, right), norm(left) * norm(right)), F.lit(0.0))
