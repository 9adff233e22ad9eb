"""Sharding by balanced label propagation.

Documents are linked through groups. Every linked document starts in a shard of its own
choice by hash; then rounds of Spark joins count each group's members per shard and let every
document wish for the shard that holds most of its neighbours. A round moves only as many as
the shards have room for: wishes are counted per shard in bins, and a shard admits the bins
that fit its quota, small groups whole. Full shards are no longer wished for, so what is left
of a large group gathers in the next best one. Documents without a link fill the shards up at
the end, which makes their row counts even to one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.operators.numbering import number_rows
from kindred.operators.skew import join_per_key
from kindred.session import local_table, materialise


@dataclass(frozen=True)
class Settings:
    """Shards, the most rounds, and the bins in which a shard admits wishes."""

    shards: int = 8
    rounds: int = 12
    bins: int = 512


def _per_shard(shards: int, value: Column) -> list[Column]:
    return [F.sum(F.when(F.col("shard") == s, value).otherwise(0)).alias(f"in_{s}") for s in range(shards)]


def propagate(members: DataFrame, capacity: int, settings: Settings) -> DataFrame:
    """``row, shard``: linked rows after label propagation.

    ``members`` are ``row, group, crowd`` (rows in the group); a row may stand in many groups.
    Rounds alternate between moves to higher and to lower shards, so two rows cannot swap
    places for ever. Propagation ends when neither kind of round moves a row, or after
    ``rounds``. No round takes a shard above ``capacity`` rows; a start above it is left to
    the caller.
    """
    shards, bins = settings.shards, settings.bins
    spark = members.sparkSession
    # a row's bin: small groups stay together in it, large ones may be admitted in part
    small = F.col("crowd") <= max(1, capacity // 16)
    lead = F.max_by(F.when(small, F.xxhash64("group")).otherwise(F.xxhash64("row")),
                    F.struct("crowd", "group"))
    state = materialise(
        members.groupBy("row").agg(F.pmod(lead, F.lit(bins)).cast("int").alias("bin"))
        .withColumn("shard", F.pmod(F.xxhash64(F.lit(13), "row"), F.lit(shards)).cast("int"))
    )
    idle = 0
    for number in range(settings.rounds):
        held = {row["shard"]: row["n"] for row in
                state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
        room = [max(0, capacity - held.get(s, 0)) for s in range(shards)]
        if not held or not any(room):
            break
        placed = members.select("row", "group").join(state, "row")
        counts = placed.groupBy("group").agg(*_per_shard(shards, F.lit(1)))
        around = join_per_key(placed, counts, ["group"]).groupBy("row").agg(
            F.any_value("shard").alias("shard"), F.any_value("bin").alias("bin"),
            *(F.sum(f"in_{s}").alias(f"in_{s}") for s in range(shards)),
        )
        # the own shard's count holds the row itself, so an equal number elsewhere is one more
        own = F.coalesce(*(F.when(F.col("shard") == s, F.col(f"in_{s}")) for s in range(shards)))
        up = number % 2 == 0
        options = F.array_compact(F.array(*(
            F.when(F.col("shard") < s if up else F.col("shard") > s,
                   F.struct(F.col(f"in_{s}").alias("gain"), F.pmod(F.col("bin") + s, F.lit(shards)),
                            F.lit(s).alias("to")))
            for s in range(shards) if room[s]
        )))
        wishing = materialise(
            around.select("row", "bin", own.alias("own"), F.array_max(options).alias("wish"))
            .where("wish.gain >= own").select("row", F.col("wish.to").alias("to"), "bin")
        )
        wanted = wishing.groupBy("to", "bin").agg(F.count(F.lit(1)).alias("n")).collect()
        admitted = []
        for row in sorted(wanted, key=lambda row: (row["to"], row["bin"])):
            if row["n"] <= room[row["to"]]:
                room[row["to"]] -= row["n"]
                admitted.append((row["to"], row["bin"]))
        idle = 0 if admitted else idle + 1
        if idle == 2:
            break
        if admitted:
            gates = local_table(spark, admitted, "to int, bin int")
            moving = wishing.join(gates, ["to", "bin"]).select("row", "to")
            state = materialise(
                state.join(moving, "row", "left")
                .select("row", "bin", F.coalesce("to", "shard").alias("shard"))
            )
    return state.select("row", "shard")


def balanced_shards(rows: DataFrame, members: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``row, shard, slot``: every row of ``rows`` in a shard, row counts at most one apart.

    ``rows`` are ``row`` (unique, bigint); ``members`` are ``row, group``. Groups of one row
    link nothing. Rows of a group are kept in one shard as far as the quotas let them. A slot
    numbers the rows of a shard from 0 without gap.
    """
    settings = settings or Settings()
    shards = settings.shards
    total = rows.count()
    quotas = [total // shards + (s < total % shards) for s in range(shards)]
    crowds = members.groupBy("group").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    linked = materialise(join_per_key(members, crowds, ["group"]).select("row", "group", "crowd"))
    moved = propagate(linked, total // shards, settings)
    lead = linked.groupBy("row").agg(F.max(F.struct("crowd", "group")).alias("lead"))
    ordered = moved.join(lead, "row").select("row", "shard", "lead")
    # largest groups first: where a shard starts too full, the last and smallest leave it
    order = [F.col("lead").desc(), F.col("row")]
    ranked = materialise(number_rows(ordered, order, ["shard"], "_rank"))
    held = {row["shard"]: row["n"] for row in
            ranked.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    quota = F.element_at(F.array(*map(F.lit, quotas)), F.col("shard") + 1)
    kept = ranked.where(F.col("_rank") <= quota).select("row", "shard", (F.col("_rank") - 1).alias("slot"))
    kept = materialise(kept)
    free = number_rows(rows.select("row").join(kept, "row", "left_anti"), [F.col("row")], (), "_rank")
    filled = [min(held.get(s, 0), quotas[s]) for s in range(shards)]
    ends, begun = [], 0
    for s in range(shards):
        ends.append((begun, begun + quotas[s] - filled[s], s, filled[s]))
        begun += quotas[s] - filled[s]
    at = F.col("_rank") - 1
    place = F.coalesce(*(
        F.when((at >= a) & (at < b), F.struct(F.lit(s).alias("shard"), (at - a + used).alias("slot")))
        for a, b, s, used in ends
    ))
    fill = free.select("row", place.alias("_place")).select("row", "_place.shard", "_place.slot")
    return kept.unionByName(fill)


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None
) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard`` of every document.

    Documents of equal text are linked; a null text counts as an empty one. ``size`` is the
    text's bytes in UTF-8 plus 1. The law is ``rows``: the shards' row counts are at most one
    apart, so an added shard deals all documents anew and ``grown_shard`` is null. Repeated
    rows are documents of their own, a null id is kept, other columns are ignored, and an
    empty table gives an empty result. Texts are not shuffled; a digest of 128 bits names them.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    narrow = materialise(docs.select(
        F.col(id_col), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("group"),
        F.monotonically_increasing_id().alias("row"),
    ))
    placed = balanced_shards(narrow.select("row"), narrow.select("row", "group"), settings)
    return narrow.join(placed, "row").select(
        id_col, "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
