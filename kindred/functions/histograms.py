"""Vote histograms as ``map<string, bigint>``.

Entry order is meaningful: the first key wins a tie. A missing or null count is 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The votes that are merged before a winner is taken.
LONGEVITY_MERGES = ((("eternal", "long_lasting"), "long_lasting"), (("very_weak", "weak"), "weak"))
SILLAGE_MERGES = ((("strong", "enormous"), "strong"),)
# Season votes that are not seasons, and the cold seasons.
DAY_PART_KEYS = ("day", "night")
COLD_SEASONS = ("fall", "winter")


def as_histogram(df: DataFrame, name: str) -> Column:
    """Column ``name`` as a map; a struct of counts becomes a map that keeps its nulls."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.MapType):
        return F.col(name)
    if isinstance(dtype, T.StructType):
        keys = F.array(*[F.lit(field) for field in dtype.fieldNames()])
        values = F.array(*[F.col(name)[field].cast("bigint") for field in dtype.fieldNames()])
        return F.when(F.col(name).isNotNull(), F.map_from_arrays(keys, values))
    raise TypeError(f"{name} is {dtype.simpleString()}, not a histogram")


def votes_of(histogram: Column, key: str) -> Column:
    """Count of one key, 0 when missing or null."""
    return F.coalesce(F.element_at(histogram, F.lit(key)), F.lit(0))


def argmax_key(histogram: Column) -> Column:
    """Key with the most votes; the first such key on a tie; null for an empty map."""
    ranked = F.transform(
        F.map_entries(histogram),
        lambda entry, position: F.struct(
            F.coalesce(entry["value"], F.lit(0)).alias("votes"),
            (-position).alias("earliness"),
            entry["key"].alias("label"),
        ),
    )
    return F.array_max(ranked)["label"]


def merge_keys(
    histogram: Column, keys: Sequence[str], merged: str, strict: bool = False
) -> Column:
    """Replace ``keys`` by their total under ``merged``, placed last.

    ``strict`` fails the query when one of the keys is missing; otherwise a
    missing key counts 0.
    """
    total = sum((votes_of(histogram, key) for key in keys[1:]), votes_of(histogram, keys[0]))
    rest = drop_keys(histogram, [*keys, merged])
    result = F.map_concat(rest, F.create_map(F.lit(merged), total.cast("bigint")))
    if not strict:
        return result
    complete = F.size(F.array_intersect(F.map_keys(histogram), F.array(*map(F.lit, keys))))
    missing = F.raise_error(F.lit(f"histogram lacks one of {', '.join(keys)}"))
    return F.when(histogram.isNull() | (complete == len(set(keys))), result).otherwise(missing)


def merge_all(histogram: Column, merges: Iterable[tuple[Sequence[str], str]]) -> Column:
    """Apply several merges in order."""
    for keys, merged in merges:
        histogram = merge_keys(histogram, keys, merged)
    return histogram


def drop_keys(histogram: Column, keys: Sequence[str]) -> Column:
    """The histogram without ``keys``."""
    return F.map_filter(histogram, lambda key, _: ~key.isin(*keys))


def day_night(histogram: Column) -> Column:
    """``day`` when day votes outnumber night votes, else ``night``."""
    wins = votes_of(histogram, "day") > votes_of(histogram, "night")
    return F.when(histogram.isNotNull(), F.when(wins, "day").otherwise("night"))


def season_bucket(histogram: Column) -> Column:
    """``AW`` when a cold season leads, else ``SS``; null when no season has an entry."""
    leader = argmax_key(drop_keys(histogram, DAY_PART_KEYS))
    return F.when(leader.isin(*COLD_SEASONS), "AW").when(leader.isNotNull(), "SS")


def rename_map_keys(histogram: Column, old: str = " ", new: str = "_") -> Column:
    """Replace ``old`` by ``new`` in every key; on collision the last count stays."""

    def renamed(key: Column) -> Column:
        return F.replace(key, F.lit(old), F.lit(new))

    entries = F.transform(
        F.map_entries(histogram),
        lambda entry: F.struct(renamed(entry["key"]).alias("key"), entry["value"].alias("value")),
    )
    names = F.array_distinct(F.transform(F.map_keys(histogram), renamed))
    resolved = F.map_from_entries(
        F.transform(
            names,
            lambda name: F.element_at(F.filter(entries, lambda entry: entry["key"] == name), -1),
        )
    )
    simple = F.transform_keys(histogram, lambda key, _: renamed(key))
    return F.when(F.size(names) == F.size(histogram), simple).otherwise(resolved)


def present_keys(histogram: Column) -> Column:
    """Keys that carry a count, as an array."""
    return F.map_keys(F.map_filter(histogram, lambda _, votes: votes.isNotNull()))


def count_histogram(df: DataFrame, ids: Sequence[str], label: str, name: str) -> DataFrame:
    """One histogram per id from one row per vote, keys in alphabetical order.

    Votes are counted before they are gathered, so what one id gathers is bounded
    by the number of different labels.
    """
    counts = df.groupBy(*ids, label).agg(F.count(F.lit(1)).alias("_votes"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(label), F.col("_votes"))))
    return counts.groupBy(*ids).agg(F.map_from_entries(entries).alias(name))


def map_to_columns(
    df: DataFrame, id_col: str, histogram: str, keys: Sequence[str], prefix: str = ""
) -> DataFrame:
    """One count column per key, 0 where the histogram lacks it."""
    counts = as_histogram(df, histogram)
    return df.select(id_col, *[votes_of(counts, key).alias(f"{prefix}{key}") for key in keys])


def row_percentage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column as a share of the row's total; null where the total is 0."""
    total = sum((F.col(f"`{name}`") for name in columns[1:]), F.col(f"`{columns[0]}`"))
    shares = {name: F.try_divide(F.col(f"`{name}`"), total).cast("double") for name in columns}
    return df.withColumns(shares)
