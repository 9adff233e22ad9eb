"""Product feed and attributes -> internal catalogue; two catalogues -> matches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.catalog import REGIONS, region_pivot
from kindred.operators.matching import MATCH_THRESHOLD, catalogue_side, match_catalogues
from kindred.operators.tables import class_filter, latest_snapshot, left_join_alias


def catalog_pipeline(
    feed: DataFrame,
    attributes: DataFrame,
    id_col: str,
    load_date: str,
    region: str,
    measures: Mapping[str, str],
    order_by: Sequence[str],
    class_column: str,
    class_value: str,
    regions: Sequence[str] = REGIONS,
) -> DataFrame:
    """Newest stock and price per region, joined to the attributes of one product class.

    The class filter sits on the attribute side; the join is on the pivot's key, so
    the pivoted feed is not shuffled again.
    """
    newest = latest_snapshot(feed, load_date)
    pivoted = region_pivot(newest, id_col, region, measures, order_by, regions)
    return class_filter(attributes, class_column, class_value).join(pivoted, id_col, "inner")


def match_pipeline(
    internal: DataFrame,
    external: DataFrame,
    aliases: DataFrame | None = None,
    threshold: float = MATCH_THRESHOLD,
    match_blank: bool = True,
) -> DataFrame:
    """Best external product per internal product.

    ``internal`` has ``id, brand, name, vector``; ``external`` has ``id, company,
    name, vector``. External companies become internal brands through ``aliases``
    (``company, brand``); without it the company is the brand.
    """
    if aliases is None:
        branded = external.withColumn("brand", F.col("company"))
    else:
        branded = left_join_alias(
            external, aliases.select(F.col("company").alias("alias"), "brand"),
            "company", "alias", "brand",
        )
    left = catalogue_side(internal, "id", "brand", "name", "vector", True, match_blank)
    right = catalogue_side(branded, "id", "brand", "name", "vector", False, match_blank)
    return match_catalogues(left, right, threshold).select(
        F.col("left_id").alias("id"),
        F.col("left_brand").alias("brand"),
        F.col("left_name").alias("name_cleaned"),
        F.col("right_id").alias("match_id"),
        F.col("right_name").alias("match_name_cleaned"),
        "vector_sim",
        "name_sim",
    )
