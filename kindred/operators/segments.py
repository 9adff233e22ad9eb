"""Rule-based segments: accord family, season, note family, then brand category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.histograms import (
    LONGEVITY_MERGES,
    SILLAGE_MERGES,
    argmax_key,
    as_histogram,
    day_night,
    merge_all,
    season_bucket,
)
from kindred.functions.text import cluster_label, cluster_relabel, fold_accents
from kindred.operators.skew import join_large
from kindred.operators.tables import notnull_filter
from kindred.operators.taxonomy import labelled_array, note_levels, taxonomy_lookup

# The note lists a product may have.
NOTE_LISTS = ("top_notes", "middle_notes", "base_notes")


def item_labels(
    items: DataFrame,
    accords: DataFrame,
    accord_families: DataFrame,
    notes: DataFrame,
    note_families: DataFrame,
    merge_votes: bool = True,
) -> DataFrame:
    """One row per product with every label the later steps use.

    ``items`` has ``id, brand, for_gender, middle_notes`` and the histograms
    ``main_accords, season_rating, sillage, longevity``. Adds ``top_accord,
    accord_group, family, day_night, season, sillage_label, longevity_label,
    note_groups`` and ``note_families`` (arrays, see ``note_levels``); the note lists
    themselves are passed on.
    ``merge_votes=False`` takes the winning sillage and longevity votes unmerged.
    """
    season = as_histogram(items, "season_rating")
    sillage = as_histogram(items, "sillage")
    longevity = as_histogram(items, "longevity")
    if merge_votes:
        sillage = merge_all(sillage, SILLAGE_MERGES)
        longevity = merge_all(longevity, LONGEVITY_MERGES)
    voted = items.select(
        "id",
        "brand",
        "for_gender",
        *[name for name in NOTE_LISTS if name in items.columns],
        argmax_key(as_histogram(items, "main_accords")).alias("top_accord"),
        day_night(season).alias("day_night"),
        season_bucket(season).alias("season"),
        argmax_key(sillage).alias("sillage_label"),
        argmax_key(longevity).alias("longevity_label"),
    )
    grouped = taxonomy_lookup(voted, accords, "top_accord", "accord_group")
    grouped = taxonomy_lookup(grouped, accord_families, "accord_group", "family")
    levels = note_levels(items, notes, note_families, "id", "middle_notes")
    return join_large(grouped, levels, ["id"], "left")


def label_sets(labels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(dimension, label, id)`` for single-valued and array label columns; nulls are dropped."""
    arrays = {field.name for field in labels.schema if field.dataType.typeName() == "array"}
    pairs = []
    for name in columns:
        values = F.col(name) if name in arrays else F.array(name)
        pairs.append(labelled_array(F.coalesce(values, F.array().cast("array<string>")), name))
    exploded = labels.select("id", F.explode(F.concat(*pairs)).alias("_pair"))
    sets = exploded.select(F.col("_pair.feature").alias("dimension"), "_pair.label", "id")
    return notnull_filter(sets, "label").distinct()


def segment_combinations(labels: DataFrame) -> DataFrame:
    """All season x note-family pairs that occur apart, including pairs no product has.

    The two label sets are gathered as arrays: both are bounded by their taxonomy.
    """
    sets = labels.select("season", F.explode_outer("note_families").alias("note_family")).agg(
        F.array_sort(F.collect_set("season")).alias("seasons"),
        F.array_sort(F.collect_set("note_family")).alias("families"),
    )
    seasons = sets.select(F.explode("seasons").alias("season"), "families")
    return seasons.select("season", F.explode("families").alias("note_family"))


def rule_segments(labels: DataFrame) -> DataFrame:
    """``(id, family, season, note_family, cluster)``: a product joins one segment per note family.

    One row per product comes in, so the memberships need no shuffle.
    """
    members = labels.select(
        "id", "family", "season", F.explode(F.array_distinct("note_families")).alias("note_family")
    ).where(F.col("family").isNotNull() & F.col("season").isNotNull())
    name = cluster_label(F.col("family"), F.col("season"), F.col("note_family"))
    return members.withColumn("cluster", name)


def left_join_category(
    df: DataFrame, brand: str, categories: DataFrame, category_brand: str = "brand"
) -> DataFrame:
    """Replace ``brand`` by its folded spelling and add ``category``, null when unlisted.

    A null category in the list itself counts as blank.
    """
    lookup = categories.select(
        fold_accents(F.col(category_brand)).alias("_brand"),
        F.coalesce("category", F.lit("")).alias("category"),
    )
    folded = df.withColumn(brand, fold_accents(F.col(brand)))
    return folded.join(lookup, F.col(brand) == F.col("_brand"), "left").drop("_brand")


def segment_with_category(
    segments: DataFrame, labels: DataFrame, categories: DataFrame
) -> DataFrame:
    """``(id, brand, cluster, category)`` for segment members whose brand has a category.

    The category is appended to the cluster as it stands and trimmed afterwards;
    a blank category leaves a trailing underscore.
    """
    branded = join_large(segments.select("id", "cluster"), labels.select("id", "brand"), ["id"], "left")
    listed = notnull_filter(left_join_category(branded, "brand", categories), "category")
    return listed.select(
        "id",
        "brand",
        cluster_label(F.col("cluster"), F.col("category")).alias("cluster"),
        F.trim("category").alias("category"),
    )


def relabel_members(members: DataFrame, distinct: bool = True) -> DataFrame:
    """Drop the note family from the cluster name, which may repeat a membership."""
    relabelled = members.withColumn("cluster", cluster_relabel(F.col("cluster")))
    return relabelled.distinct() if distinct else relabelled


def null_ratio(df: DataFrame, column: str) -> DataFrame:
    """``nulls, total, percent`` of one column as one row."""
    counted = df.agg(
        F.count_if(F.col(column).isNull()).alias("nulls"), F.count(F.lit(1)).alias("total")
    )
    share = F.try_divide(F.col("nulls") * 100.0, F.col("total"))
    return counted.withColumn("percent", share)
