import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from kindred.llm.hilbert_blocks import (
    Settings,
    hard_negatives,
    hilbert_index,
    inner_products,
    product_bounds,
)

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def plain(rows, scale=256):
    """Every anchor with every row, integer arithmetic."""
    usable = [
        (i, label, [math.floor(scale * x) for x in vector]) for i, vector, label in dict.fromkeys(
            (i, None if v is None else tuple(v), label) for i, v, label in rows)
        if i is not None and label is not None and vector is not None
        and all(x is not None and math.isfinite(x) for x in vector)
    ]
    usable = [row for row in usable if sum(x * x for x in row[2]) < 2**62]
    result = []
    for anchor, label, vector in sorted(usable):
        if anchor % 10:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(vector, other, strict=True)), i, theirs)
            for i, theirs, other in usable if i != anchor and len(other) == len(vector)
        )
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            near = [
                s for s in scored if s[2] != label and 30 * -score <= 100 * -s[0] <= 90 * -score
            ][:10]
            result += [
                (anchor, positive, rank + 1, i, -score, -negative)
                for rank, (negative, i, _) in enumerate(near)
            ]
    return sorted(result)


def found(df, **sizes):
    result = hard_negatives(df, F.col("vec_id") % 10 == 0, Settings(**sizes))
    return sorted(tuple(row) for row in result.select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_curve_visits_neighbours():
    for axes, bits in ((2, 3), (3, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        place = hilbert_index(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold():
    chance = np.random.default_rng(4)
    anchors, rows = chance.integers(-300, 300, (20, 6)), chance.integers(-300, 300, (40, 6))
    least, greatest = product_bounds(anchors, rows.min(axis=0)[None], rows.max(axis=0)[None])
    products = inner_products(anchors, rows)
    assert (products >= least).all() and (products <= greatest).all()
    assert (inner_products(anchors << 24, rows << 24) == products << 48).all()


def test_groups_of_near_vectors(spark):
    chance = random.Random(6)
    centres = [[chance.gauss(0, 1) for _ in range(5)] for _ in range(6)]
    rows = [
        (i, [c + chance.gauss(0, 0.1) for c in centres[i % 6]], chance.choice([i % 3, i % 3, 2]))
        for i in range(300)
    ]
    rows += [(400 + i, centres[0], 1) for i in range(60)]  # equal vectors, ties by id
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = plain(rows)
    assert len(expected) > 500
    assert found(df, block_rows=16, slice_blocks=2, tile_rows=8) == expected
    assert found(df) == expected


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.5, 0.5], 2),
        (3, [0.7, 0.1], 2), (4, None, 2), (5, [nan, 1.0], 2), (6, [inf, 1.0], 2), (7, [0.5, None], 2),
        (8, [0.6, 0.6], None), (None, [0.6, 0.6], 2), (10, [0.0, 0.0], 1), (11, [], 2), (20, [], 1),
        (12, [], 1), (13, [0.5, 0.5, 0.5], 2), (30, [-1.0, -1.0], 3), (31, [-1.0, 0.5], 3),
        (32, [1e30, 1.0], 2), (3, [0.7, 0.1], 2), (2, [0.6, 0.1], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "tile": F.lit(1)})
    assert found(df) == plain(rows)


def test_empty_and_anchorless(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(empty) == []
    assert found(spark.createDataFrame([(1, [1.0], 1), (2, [1.0], 2)], SCHEMA)) == []
