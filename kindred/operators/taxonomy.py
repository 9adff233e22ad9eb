"""Taxonomies: ordered groups of terms, kept as a table.

Columns: ``taxonomy`` (name), ``group``, ``group_pos`` (declaration order) and
``term``. A term belongs to the first group that lists it; matching is exact.
Joins carry no broadcast hint: Spark broadcasts a taxonomy when its known size is
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.skew import join_per_key
from kindred.session import local_table

SCHEMA = "taxonomy string, group string, group_pos int, term string"

# The families that accord groups are gathered into.
ACCORD_FAMILIES = {
    "floral": ["floral"],
    "spicy": ["spicy"],
    "sweet": ["vanilla", "sweet"],
    "earthy": ["earthy", "musky", "powdery", "woody"],
    "citrus": ["citrus", "fresh"],
    "mineral": ["mineral"],
}


def taxonomy_table(
    spark: SparkSession, name: str, groups: Mapping[str, Sequence[str]]
) -> DataFrame:
    """A taxonomy from a mapping of group to terms, in the mapping's order."""
    rows = [
        (name, group, position, term)
        for position, (group, terms) in enumerate(groups.items())
        for term in terms
    ]
    return local_table(spark, rows, SCHEMA)


def first_groups(taxonomy: DataFrame) -> DataFrame:
    """``(term, group)`` with one row per term: its first group, of equal places the smaller name."""
    return taxonomy.groupBy("term").agg(F.min_by("group", F.struct("group_pos", "group")).alias("group"))


def taxonomy_lookup(df: DataFrame, taxonomy: DataFrame, term: str, out: str) -> DataFrame:
    """Add the group of column ``term`` as ``out``; null when no group lists it."""
    lookup = first_groups(taxonomy).select(
        F.col("term").alias("_lookup_term"), F.col("group").alias("_lookup_group")
    )
    joined = join_per_key(
        df.withColumn("_lookup_term", F.col(term)), lookup, ["_lookup_term"], "left"
    )
    found = joined.withColumn(out, F.col("_lookup_group"))
    return found.drop("_lookup_term", "_lookup_group")


def compose(terms: DataFrame, families: DataFrame) -> DataFrame:
    """One taxonomy for term -> group -> family, to look up in a single join."""
    inner = first_groups(terms).withColumnRenamed("group", "_group")
    outer = families.groupBy("term").agg(
        F.min(F.struct("group_pos", "taxonomy", "group")).alias("family")
    )
    return inner.join(outer.withColumnRenamed("term", "_group"), "_group").select(
        "family.taxonomy", "family.group", "family.group_pos", "term"
    )


def two_level_lookup(
    df: DataFrame, terms: DataFrame, families: DataFrame, term: str, out: str
) -> DataFrame:
    """Add the family of column ``term``: the family of its group."""
    return taxonomy_lookup(df, compose(terms, families), term, out)


def taxonomy_merge(first: DataFrame, second: DataFrame, name: str) -> DataFrame:
    """Concatenate two taxonomies: groups of ``first`` keep their place, new ones follow."""
    after = first.agg(F.coalesce(F.max("group_pos") + 1, F.lit(0))).scalar()
    both = first.withColumn("_place", F.col("group_pos")).unionByName(
        second.withColumn("_place", F.col("group_pos") + after)
    )
    places = both.groupBy("group").agg(F.min("_place").alias("group_pos"))
    return both.select("group", "term").join(places, "group").select(
        F.lit(name).alias("taxonomy"), "group", "group_pos", "term"
    )


def unmapped_terms(df: DataFrame, taxonomy: DataFrame, term: str) -> DataFrame:
    """Distinct terms of a column that no group lists; a null term counts as ``''``."""
    missing = df.select(F.col(term).alias("term")).join(
        taxonomy.select("term"), "term", "left_anti"
    )
    return missing.select(F.coalesce("term", F.lit("")).alias("term")).distinct()


def groups_seen(df: DataFrame, taxonomy: DataFrame, term: str) -> DataFrame:
    """Distinct groups that a column's terms fall into; unmapped terms give ``''``."""
    terms = df.select(F.col(term).alias("_seen")).distinct()
    looked_up = taxonomy_lookup(terms, taxonomy, "_seen", "group")
    return looked_up.select(F.coalesce("group", F.lit("")).alias("group")).distinct()


def replicate_membership(taxonomy: DataFrame, apply_to_all: Sequence[str]) -> DataFrame:
    """Add the terms of the ``apply_to_all`` groups to every other group, then drop those groups."""
    special = F.col("group").isin(*apply_to_all)
    kept = taxonomy.where(~special)
    groups = F.array_sort(F.collect_set(F.struct("group_pos", "taxonomy", "group")))
    targets = kept.agg(groups.alias("_groups")).scalar()
    added = (
        taxonomy.where(special)
        .select("term")
        .distinct()
        .withColumn("_target", F.explode(targets))
        .select("_target.taxonomy", "_target.group", "_target.group_pos", "term")
    )
    return kept.unionByName(added).distinct()


def cluster_merge(df: DataFrame, merges: DataFrame, cluster: str, out: str) -> DataFrame:
    """Rename clusters listed in a taxonomy to their merged name; others stay."""
    looked_up = taxonomy_lookup(df, merges, cluster, "_merged")
    return looked_up.withColumn(out, F.coalesce("_merged", cluster)).drop("_merged")


def note_levels(
    df: DataFrame, notes: DataFrame, note_families: DataFrame, id_col: str, terms: str
) -> DataFrame:
    """``(id, note_groups, note_families)``: distinct groups and families of a term array, sorted.

    A null at the end of ``note_groups`` stands for terms without a group. The rows
    of one id combine before the shuffle, and an id gathers at most as many values
    as the taxonomy has groups.
    """
    exploded = df.select(id_col, F.explode_outer(terms).alias("_term"))
    grouped = taxonomy_lookup(exploded, notes, "_term", "_group")
    levels = taxonomy_lookup(grouped, note_families, "_group", "_family")
    unmapped = F.max(F.col("_term").isNotNull() & F.col("_group").isNull())
    gap = F.when(unmapped, F.array(F.lit(None).cast("string"))).otherwise(
        F.array().cast("array<string>")
    )
    return levels.groupBy(id_col).agg(
        F.concat(F.sort_array(F.collect_set("_group")), gap).alias("note_groups"),
        F.sort_array(F.collect_set("_family")).alias("note_families"),
    )


def labelled(column: Column, name: str) -> Column:
    """A ``(feature, label)`` struct, for stacking features into one long table."""
    return F.struct(F.lit(name).alias("feature"), column.cast("string").alias("label"))


def labelled_array(values: Column, name: str) -> Column:
    """Each element of an array as a ``(feature, label)`` struct."""
    return F.transform(values, lambda value: labelled(value, name))
