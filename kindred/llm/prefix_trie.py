"""Prefix trie of conversations by fixed-length block hashing.

Turns are numbered and cut into blocks of a fixed number of turns. A running exclusive-or of
position-bound block digests identifies every block prefix, so conversations are first
grouped by whole blocks, many turns at a time. Only where the blocks after one prefix differ
are they refined: the distinct blocks there, not the conversations, are compared turn by
turn. Elsewhere all members share the block and its turns need no comparison.

A node's smallest member names it together with its depth. The nodes that a conversation
names are one chain at the end of its path, so sums over subtrees need no walk over depths:
whole chains are added up by pointer doubling, in rounds that grow with the logarithm of the
number of chains above each other, then running sums give every node of a chain its part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm.running import running
from kindred.llm.slices import with_small_batches
from kindred.operators.numbering import number_rows
from kindred.operators.skew import join_per_key
from kindred.session import materialise

#: Turns of a block.
BLOCK_TURNS = 4
#: Conversation ids that one row carries on the way to a node's digest.
IDS_AT_ONCE = 512
#: Fixed pattern: a word.
WORD = r"[^\x20\x09-\x0D]+"

_NODE = ["depth", "q1", "q2"]


def numbered_turns(
    conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str
) -> DataFrame:
    """``conv, pos, digest, words``: turns of each conversation from 1, texts left behind."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv"), F.col(turn_col).alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    return materialise(
        number_rows(turns, order, ["conv"], "pos").select("conv", "pos", "digest", "words")
    )


def with_shared_heads(turns: DataFrame, spacing: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on shared beginnings: the ids, and ``conv, pos, digest, words``.

    A conversation c takes the first h turns of conversation ``c - c % spacing`` (as SQL
    divides, towards zero) in place of its own first h; h is CRC-32 of its decimal id modulo
    ``most``. An id without a turn left stays, as a conversation without turns.
    """
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = materialise(
        turns.groupBy("conv").agg(F.max("pos").alias("turns"))
        .withColumns({"head": head, "base": F.col("conv") - F.col("conv") % spacing})
    )
    heads = turns.where((F.col("conv") % spacing == 0) & (F.col("pos") < most))
    heads = heads.withColumnRenamed("conv", "base")
    taken = convs.select("conv", "base", "head").join(heads, "base").where("pos <= head")
    # a base that is absent or short moves the own turns forward
    found = convs.select(F.col("conv").alias("base"), F.col("turns").alias("there"))
    missing = F.col("head") - F.coalesce("there", F.lit(0))
    short = (
        convs.join(found, "base", "left").where(missing > 0).select("conv", missing.alias("missing"))
    )
    own = join_per_key(turns.where(F.col("pos") > head), short, ["conv"], "left")
    own = own.withColumn("pos", F.col("pos") - F.coalesce("missing", F.lit(0)))
    columns = ["conv", "pos", "digest", "words"]
    return convs.select("conv"), taken.select(*columns).unionByName(own.select(*columns))


def _term(seed: int, block: Column, turns: Column, count: Column) -> Column:
    """64 bits that stand for the first ``count`` turns of a block at its place."""
    digests = F.array_join(F.transform(F.slice(turns, 1, count), lambda t: t["digest"]), "")
    return F.xxhash64(F.lit(seed), block, count, digests)


def block_rows(turns: DataFrame, block_turns: int) -> DataFrame:
    """``conv, block, turns, q1, q2, p1, p2``: blocks with the prefix up to and before them."""
    block = F.floor((F.col("pos") - 1) / block_turns)
    blocks = (
        turns.groupBy("conv", block.alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns"))
        .withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"], t["words"])))
    )
    terms = {f"t{n}": _term(n, F.col("block"), F.col("turns"), F.size("turns")) for n in (1, 2)}
    summed = running(
        blocks.withColumns(terms), ["conv"], [F.col("block")], {"q1": "t1", "q2": "t2"}, xor=True
    )
    before = {f"p{n}": F.col(f"q{n}").bitwiseXOR(F.col(f"t{n}")) for n in (1, 2)}
    return materialise(summed.withColumns(before).drop("t1", "t2"))


def _nodes(convs: DataFrame, blocks: DataFrame, block_turns: int) -> DataFrame:
    """``depth, q1, q2, u1, u2, n_convs, conv_id, words``: every node, its parent's name in u."""
    distinct = blocks.groupBy("block", "p1", "p2", "turns").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")
    )
    distinct = materialise(distinct)
    siblings = distinct.groupBy("block", "p1", "p2").agg(F.count(F.lit(1)).alias("siblings"))
    placed = join_per_key(distinct, siblings, ["block", "p1", "p2"])

    def turn_rows(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("turns"))))
        k, turns = F.col("k"), F.col("turns")
        columns = {}
        for n in (1, 2):
            start = F.col(f"p{n}")
            columns[f"q{n}"] = start.bitwiseXOR(_term(n, F.col("block"), turns, k))
            columns[f"u{n}"] = F.when(k == 1, start).otherwise(
                start.bitwiseXOR(_term(n, F.col("block"), turns, k - 1))
            )
        columns["depth"] = F.col("block") * block_turns + k
        columns["words"] = F.element_at(turns, k)["words"]
        return rows.withColumns(columns).select(*_NODE, "u1", "u2", "words", "n_convs", "conv_id")

    whole = turn_rows(placed.where("siblings = 1"))
    refined = turn_rows(placed.where("siblings > 1")).groupBy(*_NODE, "u1", "u2", "words").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("bigint")
    root = (
        convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"))
        .where("n_convs > 0")
        .select(zero.alias("depth"), zero.alias("q1"), zero.alias("q2"), none.alias("u1"),
                none.alias("u2"), zero.alias("words"), "n_convs", "conv_id")
    )
    return materialise(root.unionByName(whole).unionByName(refined))


def _end_digests(ends: DataFrame) -> DataFrame:
    """``depth, q1, q2, ends_sha256`` of the sorted, comma-joined ids per node.

    Range partitions join ids to rows of many; one task then digests a node's rows as they
    stream by, so a node of any size needs no memory.
    """
    order = [*_NODE, "conv"]
    node_type = "depth bigint, q1 bigint, q2 bigint"

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            ids: list[str] = []
            last = None
            for *node, conv in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if node != last or len(ids) == IDS_AT_ONCE:
                    if ids:
                        rows[-1] += (",".join(ids),)
                    rows.append((*node, conv))
                    ids, last = [], node
                ids.append(str(conv))
            if rows:
                rows[-1] += (",".join(ids),)
                yield pa.record_batch(
                    [pa.array(column) for column in zip(*rows, strict=True)], names=[*order, "ids"]
                )

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(node, digest) -> pa.RecordBatch:
            return pa.record_batch(
                [*([value] for value in node), [digest.hexdigest()]], names=[*_NODE, "ends_sha256"]
            )

        last, digest = None, None
        for batch in batches:
            for *node, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if node != last:
                    if last is not None:
                        yield result(last, digest)
                    last, digest = node, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
        if last is not None:
            yield result(last, digest)

    runs = with_small_batches(
        ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    ).mapInArrow(joined, f"{node_type}, conv bigint, ids string")
    streams = runs.repartition(*_NODE).sortWithinPartitions(*order).select(*_NODE, "ids")
    return streams.mapInArrow(digested, f"{node_type}, ends_sha256 string")


def _chain_totals(chains: DataFrame, sums: list[str]) -> DataFrame:
    """``conv_id`` and ``sums`` over all chains below, by pointer doubling from ``jump``."""
    state = materialise(chains.select("conv_id", "jump", *sums))
    while state.where("jump IS NOT NULL").limit(1).count():
        given = state.where("jump IS NOT NULL").groupBy(F.col("jump").alias("conv_id")).agg(
            *(F.sum(name).alias(f"_{name}") for name in sums)
        )
        hops = state.select(F.col("conv_id").alias("jump"), F.col("jump").alias("next"))
        hopped = join_per_key(state, hops, ["jump"], "left")
        state = materialise(
            hopped.join(given, "conv_id", "left").select(
                "conv_id", F.col("next").alias("jump"),
                *((F.col(name) + F.coalesce(f"_{name}", F.lit(0))).alias(name) for name in sums),
            )
        )
    return state.drop("jump")


def build_trie(convs: DataFrame, turns: DataFrame, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """The trie of conversations ``convs`` (``conv``) with ``turns`` (``conv, pos, digest, words``).

    Positions count from 1 without gap. Returns per node ``conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    blocks = block_rows(turns, block_turns)
    nodes = _nodes(convs, blocks, block_turns)
    above = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("q1").alias("u1"), F.col("q2").alias("u2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    children = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("u1").alias("q1"), F.col("u2").alias("q2")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    last = F.max(F.struct("block", F.size("turns").alias("turns"), "q1", "q2"))
    ends = blocks.groupBy("conv").agg(last.alias("_last")).select(
        "conv", (F.col("_last.block") * block_turns + F.col("_last.turns")).alias("depth"),
        "_last.q1", "_last.q2",
    )
    zero = F.lit(0).cast("bigint")
    turnless = convs.join(ends, "conv", "left_anti").select(
        "conv", zero.alias("depth"), zero.alias("q1"), zero.alias("q2")
    )
    tree = join_per_key(nodes, above, ["depth", "u1", "u2"], "left")
    tree = (
        tree.join(children, _NODE, "left")
        .join(_end_digests(ends.unionByName(turnless)), _NODE, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", zero).alias("n_children"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint").alias("leaves"),
        )
    )
    tree = materialise(tree)
    sums = ["saved", "leaves"]
    chains = materialise(
        tree.groupBy("conv_id").agg(
            F.min("depth").alias("top"), F.min_by("parent_conv_id", "depth").alias("jump"),
            *(F.sum(name).alias(name) for name in sums),
        )
    )
    hung = (
        chains.where("jump IS NOT NULL").select("conv_id", "top", "jump")
        .join(_chain_totals(chains, sums), "conv_id")
        .groupBy(F.col("jump").alias("conv_id"), (F.col("top") - 1).alias("depth"))
        .agg(*(F.sum(name).alias(f"_{name}") for name in sums))
    )
    parts = tree.join(hung, ["conv_id", "depth"], "left").withColumns(
        {name: F.col(name) + F.coalesce(f"_{name}", zero) for name in sums}
    ).drop(*(f"_{name}" for name in sums))
    summed = running(
        parts, ["conv_id"], [F.col("depth").desc()], {"saved_tokens": "saved", "n_leaves": "leaves"}
    )
    return summed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    )


def conversation_trie(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text", block_turns: int = BLOCK_TURNS,
    shared_heads: bool = False,
) -> DataFrame:
    """One row per distinct sequence of first turns, the empty one included.

    Turns are ordered by ``turn``, null first; equal ones by a digest of role and text. Null
    roles and texts are empty. Rows without conversation id take no part; repeated rows are
    turns of their own; other columns are ignored; an empty table has no root. With
    ``shared_heads`` conversations are rebuilt first (:func:`with_shared_heads`). Columns
    are those of :func:`build_trie`: the smallest member, the depth, the parent's smallest
    member (null for the root), the numbers of members, children and childless nodes below
    (itself included), the words that members beyond the first repeat in the subtree, and
    the digest of the members that end here. Digests of 128 bits name the prefixes.
    """
    turns = numbered_turns(conversations, id_col, turn_col, role_col, text_col)
    if shared_heads:
        convs, turns = with_shared_heads(turns)
    else:
        convs = turns.select("conv").distinct()
    return build_trie(convs, turns, block_turns)
