"""Feature tables: indicators, shares and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.histograms import (
    argmax_key,
    as_histogram,
    map_to_columns,
    merge_all,
    row_percentage,
)
from kindred.functions.text import sanitize_name
from kindred.operators.tables import boolean_flag, nonblank_filter
from kindred.operators.taxonomy import taxonomy_lookup

# Fixed value: a feature that is 0 for this share of products is sparse.
SPARSE_SHARE = 0.85


def distinct_labels(df: DataFrame, column: str) -> list[str]:
    """The labels of a column, sorted, to become columns.

    All of them: they are the schema of a wide result. Where labels grow with the data,
    use the long form (``one_hot_long``, ``one_hot_explode_long``), which needs no list.
    """
    labels = df.select(column).where(F.col(column).isNotNull()).distinct()
    return sorted(row[0] for row in labels.collect())


def one_hot_long(df: DataFrame, id_col: str, column: str) -> DataFrame:
    """``(id, feature, value)``: the ones of :func:`one_hot`, one row each, for any number
    of labels; features are the raw labels."""
    rows = nonblank_filter(df, column)
    return rows.select(id_col, F.col(column).alias("feature"), F.lit(1).alias("value"))


def one_hot_explode_long(df: DataFrame, id_col: str, array: str) -> DataFrame:
    """``(id, feature, value)``: the ones of :func:`one_hot_explode`, one row each."""
    terms = df.select(id_col, F.explode(F.array_distinct(array)).alias("feature"))
    return terms.where(F.col("feature").isNotNull()).withColumn("value", F.lit(1))


def one_hot(
    df: DataFrame,
    id_col: str,
    column: str,
    labels: Sequence[str] | None = None,
    prefix: str = "",
    postfix: str = "",
) -> DataFrame:
    """A 0/1 column per label; rows with a null or blank label are left out."""
    rows = nonblank_filter(df, column)
    names = labels if labels is not None else distinct_labels(rows, column)
    flags = [
        boolean_flag(F.col(column) == F.lit(label)).alias(
            f"{prefix}{sanitize_name(label)}{postfix}"
        )
        for label in names
    ]
    return rows.select(id_col, *flags)


def one_hot_explode(
    df: DataFrame,
    id_col: str,
    array: str,
    labels: Sequence[str] | None = None,
    prefix: str = "",
    postfix: str = "",
) -> DataFrame:
    """A 0/1 column per raw term of an array column; ids without terms are left out."""
    rows = df.where(F.size(array) > 0)
    if labels is None:
        labels = distinct_labels(rows.select(F.explode(array).alias(array)), array)
    flags = [
        boolean_flag(F.array_contains(array, F.lit(label))).alias(
            f"{prefix}{sanitize_name(label, 'words')}{postfix}"
        )
        for label in labels
    ]
    return rows.select(id_col, *flags)


def multi_hot_grouped(
    df: DataFrame,
    id_col: str,
    array: str,
    taxonomy: DataFrame,
    groups: Sequence[str],
    strict: bool = False,
) -> DataFrame:
    """A 0/1 column per taxonomy group that the array's terms fall into.

    By default 1 means that a term falls into the group. ``strict``
    multiplies the number of such terms by the length of the list and asks for
    more than 1, so that the only term of a product does not count.
    """
    exploded = df.select(id_col, F.explode_outer(array).alias("_term"))
    grouped = taxonomy_lookup(exploded, taxonomy, "_term", "_group")
    counts = [F.count_if(F.col("_group") == group) for group in groups]
    if strict:
        flags = [boolean_flag(F.count(F.lit(1)) * count > 1) for count in counts]
    else:
        flags = [boolean_flag(count > 0) for count in counts]
    names = [f"{array}_{sanitize_name(group, 'compact')}" for group in groups]
    return grouped.groupBy(id_col).agg(
        *[flag.alias(name) for flag, name in zip(flags, names, strict=True)]
    )


def indicator_columns(
    df: DataFrame, id_col: str, column: str, labels: Sequence[str], prefix: str
) -> DataFrame:
    """Indicators that keep every id: a null label is 0 everywhere."""
    flags = [
        boolean_flag(F.col(column) == F.lit(label)).alias(f"{prefix}{label}") for label in labels
    ]
    return df.select(id_col, *flags)


def argmax_one_hot(
    df: DataFrame,
    id_col: str,
    histogram: str,
    labels: Sequence[str] | None = None,
    merges: Sequence[tuple[Sequence[str], str]] = (),
    taxonomy: DataFrame | None = None,
) -> DataFrame:
    """Indicators of the winning vote after merges, or of its taxonomy group."""
    winner = argmax_key(merge_all(as_histogram(df, histogram), merges))
    won = df.select(id_col, winner.alias(histogram))
    if taxonomy is not None:
        won = taxonomy_lookup(won, taxonomy, histogram, histogram)
    names = labels if labels is not None else distinct_labels(won, histogram)
    return indicator_columns(won, id_col, histogram, names, f"{histogram}_")


def nunique_desc(df: DataFrame, label: str, id_col: str) -> DataFrame:
    """Distinct ids per label, most frequent first."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(
        F.countDistinct(id_col).alias("count")
    )
    return counts.orderBy(F.desc("count"), label)


def price_value_features(
    df: DataFrame, id_col: str, histogram: str, keys: Sequence[str]
) -> DataFrame:
    """A histogram as shares of its total, one column per key."""
    prefix = f"{histogram}_"
    counts = map_to_columns(df, id_col, histogram, keys, prefix)
    return row_percentage(counts, [f"{prefix}{key}" for key in keys])


def season_features(df: DataFrame, id_col: str, histogram: str, keys: Sequence[str]) -> DataFrame:
    """A season histogram as count columns, day and night included."""
    return map_to_columns(df, id_col, histogram, keys, "season_")


def zero_ratio(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of zeros (or nulls) per feature, as ``feature, zero_ratio``; one aggregation.

    Text that is no number is not a zero.
    """

    def is_zero(name: str) -> Column:
        value = F.col(f"`{name}`")
        return boolean_flag(value.isNull() | (value.try_cast("double") == 0))

    shares = [F.avg(is_zero(name)).alias(name) for name in columns]
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.col(f"`{name}`").alias("zero_ratio"))
            for name in columns
        ]
    )
    return df.agg(*shares).select(F.explode(pairs).alias("_pair")).select("_pair.*")


def drop_sparse(
    df: DataFrame, columns: Sequence[str], threshold: float | None = SPARSE_SHARE
) -> list[str]:
    """The feature columns whose share of zeros is below ``threshold`` (all if None)."""
    if threshold is None:
        return list(columns)
    sparse = zero_ratio(df, columns).where(F.col("zero_ratio") >= threshold)
    dropped = {row["feature"] for row in sparse.collect()}
    return [name for name in columns if name not in dropped]


def standardize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Z-scores with the population deviation; a constant feature or a null gives 0.

    Mean and deviation of each column are read once as two numbers and become
    literals, so the scaling itself is a projection without a join.
    """
    moments = df.agg(
        *[F.avg(f"`{name}`").alias(f"m{i}") for i, name in enumerate(columns)],
        *[F.stddev_pop(f"`{name}`").alias(f"s{i}") for i, name in enumerate(columns)],
    ).first()

    def scaled(index: int, name: str) -> Column:
        mean, deviation = moments[f"m{index}"], moments[f"s{index}"]
        if not deviation:
            return F.lit(0.0)
        score = (F.col(f"`{name}`").cast("double") - F.lit(mean)) / F.lit(deviation)
        return F.coalesce(F.nanvl(score, F.lit(0.0)), F.lit(0.0))

    return df.withColumns({name: scaled(index, name) for index, name in enumerate(columns)})
