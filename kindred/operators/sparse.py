"""Sparse feature vectors with a dictionary table of features.

Features of a product are ``(id, feature, value)`` rows; a dictionary numbers the features.
A vector is ``id, indices, values`` with ascending indices, zeros left out. No list of labels
reaches the driver, so their number may grow with the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.histograms import argmax_key, as_histogram, merge_all
from kindred.operators.features import SPARSE_SHARE, one_hot_explode_long, one_hot_long
from kindred.operators.numbering import number_rows
from kindred.operators.skew import join_per_key
from kindred.operators.taxonomy import taxonomy_lookup
from kindred.session import materialise


def one_hot_entries(df: DataFrame, id_col: str, column: str) -> DataFrame:
    """``id, feature, value``: the label of every row that has one."""
    return one_hot_long(df, id_col, column)


def one_hot_explode_entries(df: DataFrame, id_col: str, array: str) -> DataFrame:
    """``id, feature, value``: every distinct term of an array column."""
    return one_hot_explode_long(df, id_col, array)


def argmax_entries(
    df: DataFrame, id_col: str, histogram: str, merges: Sequence[tuple[Sequence[str], str]] = (),
    taxonomy: DataFrame | None = None,
) -> DataFrame:
    """``id, feature, value``: the winning vote after merges, or its taxonomy group."""
    winner = argmax_key(merge_all(as_histogram(df, histogram), merges))
    won = df.select(id_col, winner.alias(histogram))
    if taxonomy is not None:
        won = taxonomy_lookup(won, taxonomy, histogram, histogram)
    return one_hot_long(won, id_col, histogram)


def stacked_entries(blocks: Mapping[str, DataFrame]) -> DataFrame:
    """Entries of several feature blocks in one table, features prefixed by their block's name."""
    parts = [
        entries.withColumn("feature", F.concat(F.lit(f"{name}_"), F.col("feature").cast("string")))
        .withColumn("value", F.col("value").cast("double"))
        for name, entries in blocks.items()
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked


def feature_dictionary(entries: DataFrame) -> DataFrame:
    """``feature, index``: the distinct features, numbered from 0 in order."""
    features = entries.select("feature").where("feature IS NOT NULL").distinct()
    numbered = number_rows(features, [F.col("feature")], (), "_row")
    return materialise(numbered.select("feature", (F.col("_row") - 1).cast("int").alias("index")))


def sparse_vectors(entries: DataFrame, id_col: str, dictionary: DataFrame) -> DataFrame:
    """``id, indices, values`` per product with an entry; repeated entries add up, zeros go."""
    found = join_per_key(entries, dictionary, ["feature"])
    summed = found.groupBy(id_col, "index").agg(F.sum(F.col("value").cast("double")).alias("value"))
    pairs = F.sort_array(F.collect_list(F.struct("index", "value"))).alias("_pairs")
    listed = summed.where("value <> 0").groupBy(id_col).agg(pairs)
    return listed.select(
        id_col, F.col("_pairs.index").alias("indices"), F.col("_pairs.value").alias("values")
    )


def entries_of(vectors: DataFrame, id_col: str, dictionary: DataFrame) -> DataFrame:
    """``id, feature, index, value`` rows of sparse vectors."""
    pairs = F.explode(F.arrays_zip("indices", "values")).alias("_pair")
    rows = vectors.select(id_col, pairs).select(
        id_col, F.col("_pair.indices").alias("index"), F.col("_pair.values").alias("value")
    )
    named = join_per_key(rows, dictionary, ["index"])
    return named.select(id_col, "feature", "index", "value")


def feature_moments(vectors: DataFrame, dictionary: DataFrame, products: int) -> DataFrame:
    """``feature, index, zero_ratio, mean, deviation`` over ``products`` products.

    Products without an entry count as zeros. One pass over the entries, combined before
    the shuffle.
    """
    values = vectors.select(F.explode(F.arrays_zip("indices", "values")).alias("_pair")).select(
        F.col("_pair.indices").alias("index"), F.col("_pair.values").alias("value")
    )
    sums = values.groupBy("index").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("value").alias("_total"),
        F.stddev_pop("value").alias("_spread"), F.avg("value").alias("_mean"),
    )
    n, share = F.coalesce("_n", F.lit(0)), F.coalesce("_n", F.lit(0)) / products
    # the zeros lie apart from the entries' mean: variance within both parts and between them
    within = share * F.pow(F.coalesce("_spread", F.lit(0.0)), 2)
    between = share * (1 - share) * F.pow(F.coalesce("_mean", F.lit(0.0)), 2)
    return dictionary.join(sums, "index", "left").select(
        "feature", "index", (1 - n / products).alias("zero_ratio"),
        (F.coalesce("_total", F.lit(0.0)) / products).alias("mean"),
        F.sqrt(within + between).alias("deviation"),
    )


def dense_z_scores(
    vectors: DataFrame, id_col: str, moments: DataFrame, products: DataFrame,
    sparse_share: float | None = SPARSE_SHARE,
) -> DataFrame:
    """``point_id, vector``: z-scores of the features that are not sparse, for every product.

    A feature is kept where its share of zeros is below ``sparse_share``; a product has so
    many entries on average that at most their number over ``1 - sparse_share`` features can
    stay, however many the dictionary has. Only these reach the driver (all with None, which
    is for few features). A constant feature gives 0.
    """
    kept = moments if sparse_share is None else moments.where(F.col("zero_ratio") < sparse_share)
    scales = sorted(tuple(row) for row in kept.select("index", "mean", "deviation").collect())
    given = F.map_from_arrays(
        F.coalesce("indices", F.array().cast("array<int>")),
        F.coalesce("values", F.array().cast("array<double>")),
    )
    rows = products.select(id_col).distinct().join(vectors, id_col, "left").select(
        F.col(id_col).alias("point_id"), given.alias("_given")
    )

    def score(index: int, mean: float, deviation: float):
        if not deviation > 0:
            return F.lit(0.0)
        value = F.coalesce(F.try_element_at("_given", F.lit(index)), F.lit(0.0))
        return (value - F.lit(mean)) / F.lit(deviation)

    scores = [score(*scale) for scale in scales] or [F.lit(0.0)]
    return rows.select("point_id", F.array(*scores).alias("vector"))
