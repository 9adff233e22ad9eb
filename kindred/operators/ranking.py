"""Ranking segment members by weighted similarity to a representative."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.numbering import number_rows
from kindred.operators.skew import join_per_key

# The similarity columns of an edge and their weights.
SCORE_WEIGHTS = {"bert_sim": 0.4, "accord_sim": 0.3, "season_sim": 0.1, "note_sim": 0.2}


def weighted_score(weights: dict[str, float] = SCORE_WEIGHTS) -> Column:
    """Weighted sum of an edge's similarities, summed in double and kept as float."""
    terms = [F.col(name).cast("double") * F.lit(weight) for name, weight in weights.items()]
    return sum(terms[1:], terms[0]).cast("float")


def weighted_score_udf(weights: dict[str, float] = SCORE_WEIGHTS) -> Callable[..., Column]:
    """The same score as an Arrow-batched Python function, for comparison."""
    factors = list(weights.values())

    @F.pandas_udf("float")
    def score(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        columns = (a, b, c, d)
        return sum(column.astype("float64") * factor
                   for column, factor in zip(columns, factors, strict=True)).astype("float32")

    return score


def pick_representative(members: DataFrame, seed: int | None = 0) -> DataFrame:
    """``(cluster, representative)``: one flagged member per cluster, or any member.

    ``members`` has ``id, cluster, rank``. The choice is the smallest hash of
    (seed, id); with ``seed=None`` it is the smallest id.
    """
    unflagged = F.coalesce((F.col("rank") != 1).cast("int"), F.lit(1)).alias("unflagged")
    order = [unflagged]
    if seed is not None:
        mixed = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")))
        order.append(mixed.alias("hash"))
    order.append(F.col("id"))
    return members.groupBy("cluster").agg(
        F.min(F.struct(*order))["id"].alias("representative")
    )


def two_key_edge_join(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges of the wanted ``(source, sim)`` pairs; pairs without an edge vanish."""
    return pairs.join(edges, ["source", "sim"], "inner")


def rank_in_cluster(scored: DataFrame, score: str = "weighted_score") -> DataFrame:
    """Add ``rank`` 1..n per cluster by falling score, then id.

    ``scored`` has ``id, cluster`` and the score. Unlike a window, the numbering
    splits a large cluster over many tasks.
    """
    order = [F.col(score).desc_nulls_last(), F.col("id").asc()]
    return number_rows(scored, order, ["cluster"], "rank")


def multi_segment_rank(
    members: DataFrame, edges: DataFrame, seed: int | None = 0
) -> DataFrame:
    """``(id, cluster, representative, weighted_score, rank)`` for all clusters at once.

    A member without an edge to the representative has no row; the representative
    has one only if it has an edge to itself. Repeated edges count once.
    """
    chosen = pick_representative(members, seed)
    pairs = (
        join_per_key(members.select("id", "cluster").distinct(), chosen, ["cluster"])
        .select(F.col("id").alias("source"), F.col("representative").alias("sim"), "cluster")
    )
    scores = edges.select("source", "sim", weighted_score().alias("weighted_score"))
    linked = two_key_edge_join(pairs, scores).distinct()
    return rank_in_cluster(
        linked.select(
            F.col("source").alias("id"), "cluster", F.col("sim").alias("representative"),
            "weighted_score",
        )
    )


def rank_join_back(
    output: DataFrame, ranks: DataFrame, on_id_only: bool = False
) -> DataFrame:
    """Replace the flag ``rank`` of the output rows by the rank; unranked rows vanish.

    ``on_id_only`` joins on the id alone, so that a product in m clusters gets
    every rank in each of them.
    """
    keys = ["id"] if on_id_only else ["id", "cluster"]
    return output.drop("rank").join(ranks.select(*keys, "rank"), keys, "inner").distinct()


def sort_report(ranked: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Members in report order: by cluster, then rank, then id. A range sort, not one task."""
    return ranked.select(*columns).orderBy("cluster", "rank", "id")
