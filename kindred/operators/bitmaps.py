"""Label sets as bitmaps over dense product numbers.

A set of products is one bitmap of 32,768 bits per bucket of consecutive numbers, so a label's
set costs at most an eighth of a byte per product and sets combine bit by bit. Bitmaps are
built before the shuffle, which then moves bitmaps and not one row per label and product.
Indexes over the same numbers can be merged, so new rows need no rebuild.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.numbering import number_rows
from kindred.operators.skew import join_large, join_per_key
from kindred.session import materialise

# Fixed value: bits of a bitmap of the built-in functions.
BUCKET_BITS = 32_768


def number_products(df: DataFrame, id_col: str) -> DataFrame:
    """``id, number``: the distinct ids, numbered from 1 in id order; null has no number."""
    ids = df.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    return materialise(number_rows(ids, [F.col("id")], (), "number"))


def distinct_counts(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``keys, n``: distinct product numbers per key; null keys are keys, null numbers no products."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits")
    bucket = F.bitmap_bucket_number(number).alias("_bucket")
    buckets = df.where(F.col(number).isNotNull()).groupBy(*keys, bucket).agg(bits)
    counted = buckets.groupBy(*keys).agg(F.sum(F.bitmap_count("_bits")).alias("n"))
    missing = df.where(F.col(number).isNull()).select(*keys).distinct().withColumn(
        "n", F.lit(0).cast("bigint")
    )
    return counted.unionByName(missing).groupBy(*keys).agg(F.max("n").alias("n"))


@dataclass(frozen=True)
class LabelIndex:
    """``numbers`` (``id, number``) and ``bitmaps`` (``dimension, label, bucket, bits``)."""

    numbers: DataFrame
    bitmaps: DataFrame

    def merge(self, other: LabelIndex) -> LabelIndex:
        """Both indexes' sets; they must be built over the same numbers."""
        both = self.bitmaps.unionByName(other.bitmaps)
        return LabelIndex(self.numbers, both.groupBy("dimension", "label", "bucket").agg(
            F.bitmap_or_agg("bits").alias("bits")
        ))

    def counts(self) -> DataFrame:
        """``dimension, label, n``: products per label."""
        return self.bitmaps.groupBy("dimension", "label").agg(
            F.sum(F.bitmap_count("bits")).alias("n")
        )

    def intersection(self, wanted: Mapping[str, str]) -> DataFrame:
        """``id`` of the products that carry the wanted label in every dimension."""
        matches = [
            (F.col("dimension") == dimension) & (F.col("label") == label)
            for dimension, label in wanted.items()
        ]
        hits = self.bitmaps.where(reduce(lambda a, b: a | b, matches, F.lit(False)))
        common = hits.groupBy("bucket").agg(
            F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("met")
        ).where(F.col("met") == len(wanted))
        found = _set_numbers(common.select("bucket", "bits"))
        return join_large(found, self.numbers, ["number"]).select("id")

    def memberships(self) -> DataFrame:
        """``dimension, label, id``: the sets as rows."""
        rows = _set_numbers(self.bitmaps)
        joined = join_per_key(rows, self.numbers, ["number"], large=True)
        return joined.select("dimension", "label", "id")

    def cross_counts(self, first: str, second: str) -> DataFrame:
        """``first, second, n``: products that carry a label of one dimension and of the other.

        One task holds the bitmaps of both dimensions for one bucket, 4 kB for each label.
        """
        sides = self.bitmaps.where(F.col("dimension").isin(first, second))

        def cross(table: pa.Table) -> pa.Table:
            dims = np.array(table["dimension"].to_pylist(), object)
            labels = table["label"].to_pylist()
            rows = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint8).reshape(len(labels), -1)
            ours, theirs = (np.flatnonzero(dims == name) for name in (first, second))
            found: list[tuple] = []
            for at in ours.tolist():
                shared = np.bitwise_count(rows[theirs] & rows[at]).sum(axis=1, dtype=np.int64)
                found += [
                    (labels[at], labels[theirs[k]], int(shared[k])) for k in np.flatnonzero(shared)
                ]
            columns = list(zip(*found, strict=True)) or [(), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.table(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["a", "b", "n"]
            )

        parts = sides.groupBy("bucket").applyInArrow(cross, "a string, b string, n bigint")
        return parts.groupBy(F.col("a").alias(first), F.col("b").alias(second)).agg(
            F.sum("n").alias("n")
        )


def label_index(memberships: DataFrame, numbers: DataFrame | None = None) -> LabelIndex:
    """Index of ``dimension, label, id`` rows; repeats and null ids do no harm, null labels stay.

    ``numbers`` (``id, number``) may come from an earlier index or a product table that has
    dense numbers already; otherwise the ids are numbered here.
    """
    if numbers is None:
        numbers = number_products(memberships, "id")
    rows = join_per_key(memberships, numbers, ["id"], large=True)
    bitmaps = rows.groupBy(
        "dimension", "label", F.bitmap_bucket_number("number").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    return LabelIndex(numbers, materialise(bitmaps))


def _set_numbers(bitmaps: DataFrame) -> DataFrame:
    """The columns of ``bitmaps`` without ``bucket`` and ``bits``, a row per set bit's ``number``."""
    rest = [name for name in bitmaps.columns if name not in ("bucket", "bits")]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                bits = np.frombuffer(batch.column("bits")[row].as_py(), np.uint8)
                set_bits = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
                start = (batch.column("bucket")[row].as_py() - 1) * BUCKET_BITS + 1
                same = pa.array(np.full(len(set_bits), row))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(name).take(same) for name in rest), pa.array(set_bits + start)],
                    names=[*rest, "number"],
                )

    fields = "".join(f"`{n}` {bitmaps.schema[n].dataType.simpleString()}, " for n in rest)
    return bitmaps.select(*rest, "bucket", "bits").mapInArrow(unpack, f"{fields}number bigint")
