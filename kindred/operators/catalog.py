"""Building the internal catalogue from a product feed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.tables import safe_int_cast

# The regions of the product feed.
REGIONS = ("cn", "hk", "row")


def region_pivot(
    feed: DataFrame,
    id_col: str,
    region: str,
    measures: Mapping[str, str],
    order_by: Sequence[str],
    regions: Sequence[str] = REGIONS,
) -> DataFrame:
    """One row per product with ``{name}_{region}`` integer columns, 0 where absent.

    ``measures`` maps the output name to the feed column. Of several rows for one
    product and region the first in ``order_by`` (then the smallest value) counts.
    All measures come from a single aggregation, so no join of pivots is needed.
    """
    cells = []
    for name, measure in measures.items():
        for value in regions:
            pick = F.struct(*order_by, F.col(measure).alias("_value"))
            first = F.min(F.when(F.col(region) == value, pick))["_value"]
            cells.append(safe_int_cast(first).alias(f"{name}_{value.lower()}"))
    return feed.groupBy(id_col).agg(*cells)
