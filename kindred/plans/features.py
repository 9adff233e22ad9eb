"""Feature tables -> one feature matrix; feature matrix -> k-medoids clusters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.histograms import LONGEVITY_MERGES, SILLAGE_MERGES, rename_map_keys
from kindred.operators.clustering import (
    FINAL_K,
    feature_vectors,
    kmedoids_assign,
    kmedoids_fit,
    weighted_points,
)
from kindred.operators.features import (
    SPARSE_SHARE,
    argmax_one_hot,
    drop_sparse,
    multi_hot_grouped,
    one_hot,
    price_value_features,
    season_features,
    standardize,
)
from kindred.operators.segments import NOTE_LISTS
from kindred.operators.sparse import (
    dense_z_scores,
    feature_dictionary,
    feature_moments,
    sparse_vectors,
    stacked_entries,
)
from kindred.operators.tables import feature_table_join, fill_nulls, id_in_list, literal_replace
from kindred.session import materialise
from kindred.sources.feature_store import BUCKETS, join_feature_tables, write_feature_table


@dataclass(frozen=True)
class FeatureLabels:
    """Labels that become columns, per kind of feature, and the taxonomies behind groups."""

    brands: Sequence[str]
    note_groups: Sequence[str]
    accord_groups: Sequence[str]
    longevity: Sequence[str]
    sillage: Sequence[str]
    genders: Sequence[str]
    prices: Sequence[str]
    seasons: Sequence[str]
    notes: DataFrame
    accords: DataFrame


def product_feature_tables(
    items: DataFrame, labels: FeatureLabels, id_col: str = "id"
) -> dict[str, DataFrame]:
    """The ten feature tables of a product: brand, three note lists, five votes, season.

    ``items`` has one row per product with ``brand``, the lists ``top_notes, middle_notes,
    base_notes`` and the histograms ``main_accords, longevity, sillage, gender_vote,
    price_value, season_rating``. Each table has the id and its own columns.
    """
    tables = {"brand": one_hot(items, id_col, "brand", labels.brands, prefix="brand_")}
    for notes in NOTE_LISTS:
        tables[notes] = multi_hot_grouped(items, id_col, notes, labels.notes, labels.note_groups)
    tables["main_accords"] = argmax_one_hot(
        items, id_col, "main_accords", labels.accord_groups, taxonomy=labels.accords
    )
    tables["longevity"] = argmax_one_hot(
        items, id_col, "longevity", labels.longevity, LONGEVITY_MERGES
    )
    tables["sillage"] = argmax_one_hot(items, id_col, "sillage", labels.sillage, SILLAGE_MERGES)
    tables["gender_vote"] = argmax_one_hot(items, id_col, "gender_vote", labels.genders)
    renamed = items.select(id_col, rename_map_keys(F.col("price_value")).alias("price_value"))
    prices = [price.replace(" ", "_") for price in labels.prices]
    tables["price_value"] = price_value_features(renamed, id_col, "price_value", prices)
    tables["season"] = season_features(items, id_col, "season_rating", labels.seasons)
    return tables


def feature_pipeline(items: DataFrame, labels: FeatureLabels, id_col: str = "id") -> DataFrame:
    """All ten feature tables of the products, joined on the id."""
    return feature_table_join(list(product_feature_tables(items, labels, id_col).values()), id_col)


def stored_feature_pipeline(
    items: DataFrame, labels: FeatureLabels, root: str, store: str, id_col: str = "id",
    buckets: int = BUCKETS,
) -> DataFrame:
    """:func:`feature_pipeline` through a store of bucketed tables, joined without a shuffle."""
    names = [
        write_feature_table(table, root, store, name, id_col, buckets)
        for name, table in product_feature_tables(items, labels, id_col).items()
    ]
    return join_feature_tables(items.sparkSession, names, id_col)


def scaled_features(
    features: DataFrame,
    id_col: str,
    wanted: DataFrame | None = None,
    sparse_share: float | None = None,
) -> DataFrame:
    """Features of the wanted products: nulls as 0, sparse features dropped, z-scores."""
    if wanted is not None:
        features = id_in_list(features, wanted, id_col)
    columns = [name for name in features.columns if name != id_col]
    filled = fill_nulls(features, columns)
    kept = drop_sparse(filled, columns, sparse_share)
    texts = [field.name for field in filled.schema
             if field.name in kept and field.dataType.typeName() == "string"]
    numbers = literal_replace(filled, texts) if texts else filled
    doubles = [F.col(f"`{name}`").cast("double").alias(name) for name in kept]
    return standardize(numbers.select(id_col, *doubles), kept)


def cluster_pipeline(
    features: DataFrame,
    id_col: str,
    k: int = FINAL_K,
    wanted: DataFrame | None = None,
    sparse_share: float | None = None,
) -> DataFrame:
    """``(point_id, medoid_id, label, distance)`` per product from a k-medoids fit.

    Labels stay with the id they were computed for.
    """
    scaled = scaled_features(features, id_col, wanted, sparse_share)
    columns = [name for name in scaled.columns if name != id_col]
    vectors = feature_vectors(scaled, id_col, columns)
    return _clustered(vectors, k)


def sparse_cluster_pipeline(
    blocks: Mapping[str, DataFrame], products: DataFrame, id_col: str, k: int = FINAL_K,
    sparse_share: float | None = SPARSE_SHARE,
) -> DataFrame:
    """:func:`cluster_pipeline` from feature entries, for any number of labels.

    ``blocks`` are ``id, feature, value`` rows per kind of feature. Features that are 0 for
    ``sparse_share`` of the products or more are left out before scaling.
    """
    entries = materialise(stacked_entries(blocks))
    dictionary = feature_dictionary(entries)
    vectors = materialise(sparse_vectors(entries, id_col, dictionary))
    ids = products.select(id_col).distinct()
    moments = feature_moments(vectors, dictionary, ids.count())
    return _clustered(
        materialise(dense_z_scores(vectors, id_col, moments, ids, sparse_share)), k
    )


def _clustered(vectors: DataFrame, k: int) -> DataFrame:
    fit = kmedoids_fit(weighted_points(vectors), (k,))[k]
    return kmedoids_assign(vectors, fit.medoids)
