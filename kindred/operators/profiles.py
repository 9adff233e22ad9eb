"""Segment profiles: distinct products per label and cluster."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.bitmaps import distinct_counts
from kindred.operators.features import distinct_labels
from kindred.operators.skew import join_large, join_per_key
from kindred.operators.taxonomy import labelled, labelled_array
from kindred.session import local_table

# The profile sections, in order, and the label column behind each.
PROFILE_FEATURES = {
    "for_gender": "for_gender",
    "group": "note_groups",
    "main_accords": "accord_group",
    "day_night": "day_night",
    "season": "season",
    "sillage": "sillage_label",
    "longevity": "longevity_label",
}
TOTAL_FEATURE = "dummy"
# The features that a product given as a profile is looked up by.
SIMILAR_FEATURES = ("for_gender", "day_night", "season", "sillage", "longevity")


def count_long(
    df: DataFrame, label: str, cluster: str, id_col: str, dense: bool = False
) -> DataFrame:
    """``(label, cluster, n)``: distinct ids. Spark first removes repeats on the full
    key, so a frequent label is spread over all tasks. With ``dense`` the ids are numbers
    from 1 without wide gaps, and one bitmap per label, cluster and 32,768 ids is shuffled."""
    if dense:
        return distinct_counts(df, [label, cluster], id_col)
    return df.groupBy(label, cluster).agg(F.countDistinct(id_col).alias("n"))


def _spread(counts: DataFrame, label: str, cluster: str, value: str, clusters: Sequence[str] | None):
    """Without given clusters every cluster is a column; the null one is called ``null``."""
    names: list = list(clusters) if clusters is not None else distinct_labels(counts, cluster)
    if clusters is None and not counts.where(F.col(cluster).isNull()).isEmpty():
        names.append(None)
    return counts.groupBy(label).pivot(cluster, names).agg(F.sum(value)).fillna(0)


def count_pivot(
    df: DataFrame, label: str, cluster: str, id_col: str, clusters: Sequence[str] | None = None,
    dense: bool = False,
) -> DataFrame:
    """Label x cluster table of distinct ids, gaps 0; the null label is a row.

    Counted long first: a pivot of distinct counts would expand every input row
    once per cluster.
    """
    return _spread(count_long(df, label, cluster, id_col, dense), label, cluster, "n", clusters)


def sum_pivot(
    df: DataFrame, label: str, cluster: str, value: str, clusters: Sequence[str] | None = None
) -> DataFrame:
    """Label x cluster table of sums, gaps 0."""
    sums = df.groupBy(label, cluster).agg(F.sum(value).alias("n"))
    return _spread(sums, label, cluster, "n", clusters)


def _stack(members: DataFrame, labels: DataFrame, features: Mapping[str, str | Column]) -> DataFrame:
    """``(feature, label, cluster)`` rows, one per member and label, without repeats."""
    arrays = {field.name for field in labels.schema if field.dataType.typeName() == "array"}
    pairs = []
    for feature, source in features.items():
        if isinstance(source, str) and source in arrays:
            pairs.append(labelled_array(F.col(source), feature))
        else:
            column = F.col(source) if isinstance(source, str) else source
            pairs.append(F.array(labelled(column, feature)))
    empty = F.array().cast("array<struct<feature:string,label:string>>")
    stacked = F.concat(*[F.coalesce(pair, empty) for pair in pairs])
    joined = join_large(members.select("id", "cluster").distinct(), labels, ["id"])
    return joined.select("cluster", F.explode(stacked).alias("_pair")).select("_pair.*", "cluster")


def _counted(stacked: DataFrame) -> DataFrame:
    return stacked.groupBy("feature", "label", "cluster").agg(F.count(F.lit(1)).alias("n"))


def profile_long(members: DataFrame, labels: DataFrame) -> DataFrame:
    """All eight profiles as ``(feature, label, cluster, n)``.

    Memberships are made distinct once on their narrow key; with one label row per
    product the distinct counts are then plain counts that combine before the
    shuffle. A product without notes has no row in the note profile; terms and
    accords without a group count under the null label.
    """
    features = {TOTAL_FEATURE: F.lit("1"), **PROFILE_FEATURES}
    return _counted(_stack(members, labels, features))


def profile_raw_terms(members: DataFrame, items: DataFrame) -> DataFrame:
    """Profiles on raw terms: every note, every accord voted for, the leading accord.

    ``items`` has ``id`` and the columns ``middle_notes``, ``present_accords``
    (arrays) and ``top_accord``.
    """
    terms = items.select(
        "id",
        F.array_distinct("middle_notes").alias("middle_notes"),
        F.array_distinct("present_accords").alias("present_accords"),
        "top_accord",
    )
    features = {
        "middle_notes": "middle_notes",
        "present_accords": "present_accords",
        "top_accord": "top_accord",
    }
    return _counted(_stack(members, terms, features))


def drop_null_labels(profile: DataFrame) -> DataFrame:
    """A profile without the null label."""
    return profile.where(F.col("label").isNotNull())


def modal_label(profile: DataFrame) -> DataFrame:
    """``(feature, cluster, label)``: the label with most products; ties to the smaller label."""
    known = drop_null_labels(profile)
    return known.groupBy("feature", "cluster").agg(
        F.min_by("label", F.struct((-F.col("n")).alias("order"), "label")).alias("label")
    )


def representative_items(
    members: DataFrame, labels: DataFrame, modal: DataFrame, required: DataFrame | None = None
) -> DataFrame:
    """``(id, cluster)`` of members that carry the modal label of every required feature.

    ``required`` lists them as rows (``feature``); without it they are all seven of a profile.
    A division: members are joined to the wanted (cluster, feature, label) rows, and those stay
    that meet as many features as are required. A cluster may have none, for one when it lacks
    a modal label of a required feature.
    """
    if required is None:
        rows = [(feature,) for feature in PROFILE_FEATURES]
        required = local_table(members.sparkSession, rows, "feature string")
    names = required.select("feature").distinct()
    needed = names.count()
    wanted = modal.join(names, "feature").select("cluster", "feature", "label")
    arrays = {field.name for field in labels.schema if field.dataType.typeName() == "array"}
    empty = F.array().cast("array<struct<feature:string,label:string>>")
    pairs = [
        F.coalesce(labelled_array(F.col(source), feature), empty) if source in arrays
        else F.array(labelled(F.col(source), feature))
        for feature, source in PROFILE_FEATURES.items()
    ]
    # a label counts once for a product, however often a list repeats it
    described = labels.select("id", F.array_distinct(F.concat(*pairs)).alias("_pairs"))
    candidates = join_large(members.select("id", "cluster").distinct(), described, ["id"])
    carried = candidates.select("id", "cluster", F.explode("_pairs").alias("_pair")).select(
        "id", "cluster", "_pair.feature", "_pair.label"
    )
    # a semi join: only the wanted rows, a few per cluster, can be broadcast
    met = join_per_key(carried, wanted, ["cluster", "feature", "label"], "left_semi")
    counted = met.groupBy("id", "cluster").agg(F.count(F.lit(1)).alias("_met"))
    return counted.where(F.col("_met") == needed).select("id", "cluster")


def representative_flag(
    members: DataFrame, representatives: DataFrame, global_flag: bool = False
) -> DataFrame:
    """Add ``rank`` = 1 for representatives, else null.

    ``global_flag`` marks a product in all its clusters when it represents any.
    """
    keys = ["id"] if global_flag else ["id", "cluster"]
    flags = representatives.select(*keys).distinct().withColumn("rank", F.lit(1))
    return join_large(members, flags, keys, "left")
