"""Plain table steps: projections, filters, joins and row choice by id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.operators.skew import join_large, join_per_key


def normalize_columns(df: DataFrame) -> DataFrame:
    """Spaces in column names become underscores."""
    return df.toDF(*[name.replace(" ", "_") for name in df.columns])


def ensure_column(df: DataFrame, name: str, dtype: str = "string") -> DataFrame:
    """Add ``name`` as a null column unless the frame has it."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(dtype))


def fill_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null strings become blank, null numbers 0."""
    chosen = list(columns) if columns is not None else df.columns
    return df.fillna("", subset=chosen).fillna(0, subset=chosen)


def literal_replace(
    df: DataFrame, columns: Sequence[str], old: str = "NA", new: str = "0"
) -> DataFrame:
    """Replace a whole value in string columns."""
    return df.replace(old, new, subset=list(columns))


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str]) -> DataFrame:
    """Prefix every column but ``keep``."""
    return df.toDF(*[name if name in keep else prefix + name for name in df.columns])


def safe_int_cast(value: Column) -> Column:
    """Truncating integer, 0 for null, for text that is no number, and beyond 32 bits.

    A plain fraction is cut from the text first: a decimal would round its last digit.
    """
    whole = F.regexp_replace(value.cast("string"), r"^(\s*[+-]?\d*)\.\d*(\s*)$", "$1$2")
    cut = whole.try_cast("decimal(38,9)").try_cast("int")
    return F.coalesce(cut, value.try_cast("decimal(38,9)").try_cast("int"), F.lit(0))


def tidy_projection(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Select columns in order, renaming where a mapping says so."""
    names = columns if isinstance(columns, Mapping) else {name: name for name in columns}
    return df.select(*[F.col(source).alias(target) for source, target in names.items()])


def latest_snapshot(df: DataFrame, load_date: str) -> DataFrame:
    """Rows of the newest load."""
    newest = df.agg(F.max(load_date)).scalar()
    return df.where(F.col(load_date) == newest)


def nonblank_filter(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is neither null nor blank."""
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def notnull_filter(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is not null."""
    return df.where(F.col(column).isNotNull())


def class_filter(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows with one value, for a product class or a brand."""
    return df.where(F.col(column) == F.lit(value))


def id_in_list(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose id is in a table of ids."""
    return df.join(ids.select(on), on, "left_semi")


def anti_join(df: DataFrame, stored: DataFrame | None, on: str) -> DataFrame:
    """Rows whose id is not stored yet; all of them when nothing is stored."""
    return df if stored is None else df.join(stored.select(on), on, "left_anti")


def fetch_manifest(wanted: DataFrame, stored: DataFrame, asset: str, size: str) -> DataFrame:
    """Assets still to fetch: those not stored with a size above 0."""
    return anti_join(wanted, stored.where(F.col(size) > 0), asset)


def left_join_alias(
    df: DataFrame, aliases: DataFrame, company: str, alias: str, brand: str
) -> DataFrame:
    """Add the internal brand of an external company name; several aliases give several rows."""
    lookup = aliases.select(F.col(alias).alias("_alias"), F.col(brand).alias(brand))
    return df.join(lookup, F.col(company) == F.col("_alias"), "left").drop("_alias")


def feature_table_join(tables: Sequence[DataFrame], on: str) -> DataFrame:
    """Inner join of feature tables on the product id."""
    return reduce(lambda left, right: join_large(left, right, [on]), tables)


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables by column name; a missing column is null."""
    return reduce(lambda top, bottom: top.unionByName(bottom, allowMissingColumns=True), tables)


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    An aggregate, not a window: copies of a key collapse before the shuffle.
    """
    order = F.struct(*[part.alias(f"_o{index}") for index, part in enumerate(order_by)])
    rest = [name for name in df.columns if name not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"))
    return first.select(*[F.col(n) if n in keys else F.col(f"_row.`{n}`").alias(n)
                          for n in df.columns])


def group_max_filter(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows that reach the largest value of their group; ties stay.

    The maxima are aggregated map-side and joined back, so a hot group is never
    gathered or sorted in one task.
    """
    best = df.groupBy(*keys).agg(F.max(value).alias("_best"))
    tied = join_per_key(df, best, keys).where(F.col(value) == F.col("_best"))
    return tied.select(*df.columns)


def set_intersection_join(
    memberships: DataFrame, wanted: Mapping[str, str], id_col: str
) -> DataFrame:
    """Ids that carry the wanted label in every dimension.

    ``memberships`` has columns ``dimension``, ``label`` and the id.
    """
    matches = [
        (F.col("dimension") == dimension) & (F.col("label") == label)
        for dimension, label in wanted.items()
    ]
    hits = memberships.where(reduce(lambda a, b: a | b, matches))
    met = F.countDistinct("dimension")
    return hits.groupBy(id_col).agg(met.alias("_met")).where(
        F.col("_met") == len(wanted)
    ).select(id_col)


def review_sample(df: DataFrame, id_col: str, draws: int = 30, seed: int = 0) -> DataFrame:
    """``draws`` rows drawn uniformly with replacement, as ``draw`` plus the row.

    Draw *i* takes the id with the smallest hash of (id, seed, i): one aggregate
    over the data whose result is ``draws`` ids. Ids must be unique.
    """
    def ticket(draw: int) -> Column:
        mixed = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(f"{seed}:{draw}")))
        return F.min(F.struct(mixed.alias("hash"), F.col(id_col).alias("id")))["id"]

    winners = df.agg(F.array(*[ticket(draw) for draw in range(draws)]).alias("_ids"))
    drawn = winners.select(F.posexplode("_ids").alias("draw", id_col))
    return drawn.join(df, id_col).select("draw", *df.columns)


def boolean_flag(condition: Column) -> Column:
    """0/1 indicator of a condition; null counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast(T.IntegerType())
