import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import bitmaps as B
from kindred.operators import profiles as P
from kindred.operators import sparse as SP
from kindred.operators import tables as T


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_label_index_equals_sets(spark):
    chance = np.random.default_rng(1)
    data = [
        (name, [None, "x", "y", "z"][chance.integers(4)], int(i))
        for name in ("a", "b") for i in chance.integers(0, 90_000, 3000)
    ]
    data += data[:50] + [("a", "x", None)]
    sets = spark.createDataFrame(data, "dimension string, label string, id bigint").repartition(5)
    index = B.label_index(sets)
    members = {}
    for name, label, i in data:
        if i is not None:
            members.setdefault((name, label), set()).add(i)
    assert rows(index.counts(), "dimension", "label", "n") == sorted(
        ((*key, len(ids)) for key, ids in members.items()), key=repr)
    assert len(rows(index.memberships(), "dimension", "label", "id")) == sum(map(len, members.values()))
    both = members["a", "x"] & members["b", "y"]
    assert both and {r[0] for r in rows(index.intersection({"a": "x", "b": "y"}), "id")} == both
    assert index.intersection({"a": "x", "b": "none"}).count() == 0
    crossed = {(a, b): n for a, b, n in rows(index.cross_counts("a", "b"), "a", "b", "n")}
    for (name, label), ids in members.items():
        for (other, theirs), more in members.items():
            if (name, other) == ("a", "b"):
                assert crossed.get((label, theirs), 0) == len(ids & more)


def test_indexes_over_the_same_numbers_merge(spark):
    schema = "dimension string, label string, id string"
    first = spark.createDataFrame([("s", "x", "p"), ("s", "y", "q")], schema)
    second = spark.createDataFrame([("s", "x", "q"), ("s", None, "p")], schema)
    numbers = B.number_products(first.unionByName(second), "id")
    merged = B.label_index(first, numbers).merge(B.label_index(second, numbers))
    assert rows(merged.memberships(), "label", "id") == rows(
        first.unionByName(second), "label", "id")


def test_dense_counts_keep_nulls(spark):
    data = [("a", "c", 1), ("a", "c", 1), ("a", "c", 40_000), (None, "c", 3), ("b", None, 4), ("z", "c", None)]
    df = spark.createDataFrame(data, "label string, cluster string, id bigint")
    assert rows(P.count_long(df, "label", "cluster", "id", dense=True), "label", "cluster", "n") == rows(
        P.count_long(df, "label", "cluster", "id"), "label", "cluster", "n")


def test_a_hundred_thousand_labels(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("l"), F.col("id") % 99_991).alias("label"))
    entries = SP.one_hot_entries(df, "id", "label")
    dictionary = SP.feature_dictionary(entries)
    assert dictionary.agg(F.count("*"), F.max("index")).first() == (99_991, 99_990)
    vectors = SP.sparse_vectors(entries, "id", dictionary)
    assert vectors.where("size(indices) = 1 AND values[0] = 1.0").count() == 100_000


def test_moments_and_scores_equal_numpy(spark):
    chance = np.random.default_rng(2)
    matrix = chance.integers(0, 3, (60, 5)) * (chance.random((60, 5)) < [0.9, 0.5, 0.1, 0.0, 1.0])
    matrix[:, 4] = 2
    entries = spark.createDataFrame(
        [(i, f"f{j}", float(x)) for (i, j), x in np.ndenumerate(matrix) if x]
        + [(0, "f3", 0.0), (0, None, 1.0)], "id int, feature string, value double",
    )
    products = spark.createDataFrame([(i,) for i in range(60)], "id int")
    dictionary = SP.feature_dictionary(entries)
    vectors = SP.sparse_vectors(entries, "id", dictionary)
    moments = SP.feature_moments(vectors, dictionary, 60)
    for row in moments.collect():
        column = matrix[:, int(row.feature[1:])]
        assert row.zero_ratio == pytest.approx((column == 0).mean())
        assert row.mean == pytest.approx(column.mean())
        assert row.deviation == pytest.approx(column.std(), abs=1e-7)
    kept = [j for j in range(5) if (matrix[:, j] == 0).mean() < 0.85]
    scores = SP.dense_z_scores(vectors, "id", moments, products, 0.85)
    spread = matrix.std(axis=0)
    for row in scores.collect():
        wanted = [(matrix[row.point_id, j] - matrix[:, j].mean()) / spread[j] if spread[j] else 0.0
                  for j in kept]
        assert row.vector == pytest.approx(wanted, abs=1e-6)


def test_fractions_are_cut_not_rounded(spark):
    texts = ["0.9999999999", "-7.99999999999", ".5", "-.5", " 12.7 ", "1e3", "2.5e1", "x", "1.2.3", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(T.safe_int_cast(F.col("t"))).collect()] == [
        0, -7, 0, 0, 12, 1000, 25, 0, 0, 0, 0]
