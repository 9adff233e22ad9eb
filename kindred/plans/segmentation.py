"""Products -> segments -> profiles -> representatives -> ranks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.profiles import (
    modal_label,
    profile_long,
    representative_flag,
    representative_items,
)
from kindred.operators.ranking import multi_segment_rank, rank_join_back, sort_report
from kindred.operators.segments import (
    NOTE_LISTS,
    item_labels,
    relabel_members,
    rule_segments,
    segment_with_category,
)
from kindred.operators.skew import join_large


@dataclass(frozen=True)
class Taxonomies:
    """The lookups a segmentation needs, each a taxonomy table."""

    accords: DataFrame
    accord_families: DataFrame
    notes: DataFrame
    note_families: DataFrame


def label_items(items: DataFrame, taxonomies: Taxonomies, merge_votes: bool = True) -> DataFrame:
    """Labels of every product, see ``item_labels``."""
    return item_labels(
        items,
        taxonomies.accords,
        taxonomies.accord_families,
        taxonomies.notes,
        taxonomies.note_families,
        merge_votes,
    )


def segment_pipeline(labels: DataFrame, categories: DataFrame, relabel: bool = True) -> DataFrame:
    """``(id, brand, cluster, category)``: rule segments with the brand's category.

    ``labels`` comes from :func:`label_items`. All steps from here on read it, so
    materialise it first, as a table or with ``session.materialise``.
    """
    members = segment_with_category(rule_segments(labels), labels, categories)
    return relabel_members(members) if relabel else members


def profile_pipeline(members: DataFrame, labels: DataFrame) -> DataFrame:
    """All profiles of all segments, as ``(feature, label, cluster, n)``."""
    return profile_long(members, labels)


def representative_pipeline(
    members: DataFrame,
    labels: DataFrame,
    profile: DataFrame,
    global_flag: bool = False,
    required: DataFrame | None = None,
) -> DataFrame:
    """Segment members with their labels and ``rank`` = 1 on representatives.

    ``required`` names the features that a representative must share with its segment.

    Pass labels made with ``merge_votes=False`` and a profile of merged labels to
    look members up by their unmerged sillage and longevity.
    """
    modal = modal_label(profile)
    chosen = representative_items(members, labels, modal, required)
    flagged = representative_flag(members, chosen, global_flag)
    lists = [name for name in NOTE_LISTS if name in labels.columns]
    described = labels.select(
        "id", "family", "sillage_label", "longevity_label", "day_night", *lists
    )
    return join_large(flagged, described, ["id"], "left").select(
        "id",
        "brand",
        "cluster",
        "category",
        F.col("family").alias("main_accords"),
        F.col("sillage_label").alias("sillage"),
        F.col("longevity_label").alias("longevity"),
        "day_night",
        *lists,
        "rank",
    )


def rank_pipeline(
    output: DataFrame, edges: DataFrame, seed: int | None = 0, on_id_only: bool = False
) -> DataFrame:
    """Members ranked by similarity to their segment's representative, in report order."""
    ranks = multi_segment_rank(output, edges, seed)
    ranked = rank_join_back(output, ranks, on_id_only)
    return sort_report(ranked, [*[name for name in output.columns if name != "rank"], "rank"])
