"""Matching two catalogues: same brand, a shared name token, nearest vector.

A product's vector is sent to the tiles of its brand and its cell (the nearest pivot), once
each and not once per token. Names are compared inside the tile, as bit masks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions.text import (
    brand_key,
    clean_product_name,
    jaccard_similarity,
    token_set,
)
from kindred.operators.tiles import DEFAULT_CHUNK_ROWS, reduce_near_tiles

# Fixed value: smallest cosine of a match.
MATCH_THRESHOLD = 0.9
# Cosines are compared and reported at this many decimals, so that the order in
# which a task adds products cannot decide a tie.
DECIMALS = 12
_BLOCK_ROWS = 512


def catalogue_side(
    df: DataFrame,
    id_col: str,
    brand: str,
    name: str,
    vector: str,
    drop_sizes: bool = False,
    match_blank: bool = True,
) -> DataFrame:
    """The narrow view of a catalogue that matching needs: id, brand and its key, name, vector."""
    cleaned = F.coalesce(clean_product_name(F.col(name), drop_sizes), F.lit(""))
    side = df.select(
        F.col(id_col).alias("id"),
        F.col(brand).alias("brand"),
        brand_key(F.col(brand)).alias("brand_key"),
        cleaned.alias("name_cleaned"),
        F.col(vector).alias("vector"),
    ).where(F.col("vector").isNotNull())
    return side if match_blank else side.where(F.col("brand_key") != "")


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    """Vectors as rows of length one; the zero vector stays zero."""
    rows = np.array(vectors.tolist(), dtype=np.float64)
    lengths = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, lengths, out=np.zeros_like(rows), where=lengths > 0)


def _token_masks(left: pd.Series, right: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """A bit per token that both sides of a tile have, packed in 64-bit words, per row."""
    sides = [[set(tokens) for tokens in side] for side in (left, right)]
    both = set().union(*sides[0]) & set().union(*sides[1])
    place = {token: at for at, token in enumerate(sorted(both))}
    masks = []
    for side in sides:
        mask = np.zeros((len(side), -(-len(place) // 64) or 1), np.uint64)
        for row, tokens in enumerate(side):
            for token in tokens & both:
                at = place[token]
                mask[row, at >> 6] |= np.uint64(1 << (at & 63))
        masks.append(mask)
    return masks[0], masks[1]


def _nearest(threshold: float | None, share_token: bool):
    """Tile reducer: the best partner of each left row, if it reaches the threshold."""

    def reducer(_key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["left_id", "right_id", "sim", "left_brand", "left_name", "right_name"]
        if left.empty or right.empty:
            return pd.DataFrame({name: [] for name in names})
        right = right.sort_values(["id", "name_cleaned"], ignore_index=True)
        partners = _unit_rows(right["vector"])
        own, theirs = _token_masks(left["tokens"], right["tokens"]) if share_token else (None, None)
        found = []
        for start in range(0, len(left), _BLOCK_ROWS):
            block = left.iloc[start : start + _BLOCK_ROWS]
            sims = np.round(_unit_rows(block["vector"]) @ partners.T, DECIMALS)
            if share_token:
                share = np.zeros(sims.shape, bool)
                for word in range(own.shape[1]):
                    share |= (own[start : start + len(block), word, None] & theirs[None, :, word]) != 0
                sims[~share] = -np.inf
            best = sims.argmax(axis=1)  # first of equals, so the smallest id, then name
            chosen = right.iloc[best]
            found.append(pd.DataFrame(dict(zip(names, (
                block["id"].to_numpy(), chosen["id"].to_numpy(), sims[np.arange(len(block)), best],
                block["brand"].to_numpy(), block["name_cleaned"].to_numpy(),
                chosen["name_cleaned"].to_numpy(),
            ), strict=True))))
        result = pd.concat(found)
        return result[result["sim"] >= (-2.0 if threshold is None else threshold)]

    return reducer


def nearest_in_block(
    left: DataFrame,
    right: DataFrame,
    threshold: float | None = None,
    share_token: bool = True,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """For each left product, its nearest right product of the same brand.

    Sides come from :func:`catalogue_side`. With ``share_token`` the two names must share a
    token, which is the same as a name similarity above 0; bit masks of the tile's tokens tell.
    Tiles of a brand whose angles to common pivots rule out the threshold are never built. A
    product may have several rows (names, vectors, brands); the best pair of rows counts, ties
    go to the smaller right id, then left name, right name and left brand. Returns
    ``left_id, right_id, sim, left_brand, left_name, right_name`` of that pair.

    Keeping the maximum and then applying the threshold equals applying the threshold
    first, so a tile returns at most one row per left row.
    """
    columns = ["id", "brand", "brand_key", "name_cleaned", "vector"]
    sides = [side.select(*columns) for side in (left, right)]
    if share_token:
        sides = [side.withColumn("tokens", token_set(F.col("name_cleaned"))) for side in sides]
    ids = f"left_id {left.schema['id'].dataType.simpleString()}, " \
          f"right_id {right.schema['id'].dataType.simpleString()}"
    brand = left.schema["brand"].dataType.simpleString()
    tiles = reduce_near_tiles(
        *sides, ["brand_key"], "id", "vector", _nearest(threshold, share_token),
        f"{ids}, sim double, left_brand {brand}, left_name string, right_name string",
        threshold, chunk_rows,
    )
    order = ["right_id", "left_name", "right_name", "left_brand"]
    best = F.min(F.struct((-F.col("sim")).alias("cost"), *order, "sim")).alias("_best")
    return tiles.groupBy("left_id").agg(best).select(
        "left_id", "_best.right_id", "_best.sim", "_best.left_brand", "_best.left_name",
        "_best.right_name",
    )


def match_catalogues(
    left: DataFrame,
    right: DataFrame,
    threshold: float = MATCH_THRESHOLD,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Best match per left product, with vector and name similarity of the rows that matched.

    One row per product, however often it stands in ``left`` or its match in ``right``.
    Returns ``left_id, right_id, vector_sim, name_sim, left_brand, left_name, right_name``.
    """
    best = nearest_in_block(left, right, threshold, True, chunk_rows)
    return best.select(
        "left_id",
        "right_id",
        F.col("sim").alias("vector_sim"),
        name_similarity(F.col("left_name"), F.col("right_name")).alias("name_sim"),
        "left_brand",
        "left_name",
        "right_name",
    )


def name_similarity(left: Column, right: Column) -> Column:
    """Token Jaccard of two cleaned names."""
    return jaccard_similarity(token_set(left), token_set(right))


def brand_intersect(left: DataFrame, right: DataFrame) -> DataFrame:
    """Brand keys both catalogues have."""
    return left.select("brand_key").intersect(right.select("brand_key"))


def brand_except(left: DataFrame, right: DataFrame) -> DataFrame:
    """Brand keys of the left catalogue that the right one lacks."""
    return left.select("brand_key").subtract(right.select("brand_key"))


def distinct_count_stats(left: DataFrame, right: DataFrame) -> DataFrame:
    """Number of brands on the left and number both have, as one row."""
    brands = left.select("brand_key").distinct()
    common = right.select("brand_key").distinct().withColumn("_both", F.lit(1))
    return brands.join(common, "brand_key", "left").agg(
        F.count(F.lit(1)).alias("left_brands"), F.count("_both").alias("common_brands")
    )
