"""N-gram Jaccard join by a token-group matrix.

Documents are sets of distinct word shingles. Two sets link when 100 times their
intersection is at least 75 times their union. The stages:

1. Every text becomes (set id, size); equal sets share an id and are one from here on.
2. Tokens are dealt to buckets. A bucket counts in how many sets each token occurs and
   hands back only tokens that occur in two sets or more, with that count.
3. Per set, the returned tokens are ordered by rising count. A partner must share one of
   the first ``size - needed + 1`` tokens of this order, of which the tokens that occur in
   no other set come first; most sets have no other token among these and leave.
4. Sets that share such a token are compared with the set that leads it: the one whose
   tokens are the most frequent. The links found give the groups: sets similar to each
   other. Here and below the places of the shared token must leave room for the overlap
   that the two sizes need.
5. The matrix stores, for blocks of each group, the union of the tokens of its members.
   A set whose first tokens meet a block of a larger group is a query to it. The number of
   its tokens in the block's union bounds its overlap with every member, and only if
   that reaches what the threshold needs, the block is opened and members are compared.
   One link to a group is enough, since a group is linked already.

No pairs within a group are emitted: a set is compared with one leader per token, and
with blocks of groups it is not yet linked to. The intersection is counted on the returned
tokens, which hold every token that two sets can share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.components import connected_components
from kindred.llm.features import Words, mix, words_of
from kindred.llm.slices import map_slices
from kindred.operators.skew import join_per_key
from kindred.session import materialise

#: Tokens of a bucket, members of a block and queries to a block that meet in a task.
BUCKET_TOKENS, BLOCK_MEMBERS, BLOCK_QUERIES = 2_000_000, 128, 1024
#: Bytes of text whose tokens are dealt to the buckets together.
DEAL_BYTES = 3_000_000
_LOW_BITS = 40


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of the distinct shingles of every text, sorted by row and hash.

    A text with fewer words than ``width`` has its whole sequence as one shingle, a text
    without words none.
    """
    hashes, counts = words.hashes(), words.per_text()
    first = np.cumsum(counts) - counts
    per_row = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    rows = np.repeat(np.arange(len(counts)), per_row)
    start = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    start += np.repeat(first, per_row)
    end = (first + counts)[rows]
    values = np.zeros(len(rows), np.uint64)
    for step in range(width):
        # past the end of a short text nothing is added, so its length is part of the hash
        here = start + step < end
        add = hashes[np.minimum(start + step, max(len(hashes) - 1, 0))] if len(hashes) else values
        values = np.where(here, values * np.uint64(0x9E3779B97F4A7C15) + add, values)
    values = mix(values)
    order = np.lexsort((values, rows))
    rows, values = rows[order], values[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (values[1:] != values[:-1])
    return rows[fresh], values[fresh]


def set_ids(rows: np.ndarray, values: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Id (hash of the set, as a signed 64-bit number) and size of each text's set."""
    sizes = np.bincount(rows, minlength=texts)
    total = np.zeros(texts, np.uint64)
    np.add.at(total, rows, mix(values ^ np.uint64(0xA0761D6478BD642F)))
    return mix(total + sizes.astype(np.uint64)).view(np.int64), sizes


def _needed(size, similarity: int):
    """Tokens that a set of ``size`` must share with any partner: ceil(similarity * size)."""
    return -(-similarity * size // 100)


def _signatures(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id, set_id, n`` of every row of ``docs``."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows, values = shingle_sets(words_of(part.column(1)), width)
        ids, sizes = set_ids(rows, values, part.num_rows)
        return pa.record_batch({
            id_col: part.column(0), "set_id": pa.array(ids), "n": pa.array(sizes, pa.int64()),
        })

    kind = docs.schema[id_col].dataType.simpleString()
    return map_slices(
        docs.select(id_col, text_col), text_col, run, f"`{id_col}` {kind}, set_id bigint, n bigint"
    )


def _dealt(docs: DataFrame, text_col: str, width: int, buckets: int) -> DataFrame:
    """The tokens of all sets by bucket, packed: a row per bucket and slice of texts.

    ``sets, sizes, counts`` have an entry per set with tokens in the bucket; ``low, high``
    are the tokens' lower 32 and next 8 bits, in the order of the sets.
    """

    def run(part: pa.RecordBatch) -> pa.RecordBatch:
        rows, values = shingle_sets(words_of(part.column(0)), width)
        ids, sizes = set_ids(rows, values, part.num_rows)
        first = np.zeros(part.num_rows, bool)  # of equal sets one is enough
        first[np.unique(ids, return_index=True)[1]] = True
        keep = first[rows]
        rows, values = rows[keep], values[keep]
        bucket = ((values >> np.uint64(_LOW_BITS)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")  # rows stay in order within a bucket
        rows, values, bucket = rows[order], values[order], bucket[order]
        low = (values & np.uint64(0xFFFFFFFF)).astype("<u4")
        high = ((values >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8)
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (bucket[1:] != bucket[:-1])
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(rows))).astype("<u4")
        owners = ids[rows[at]].astype("<i8")
        owner_sizes = sizes[rows[at]].astype("<u4")
        used, entry = np.unique(bucket[at], return_index=True)
        entry = np.append(entry, len(at)).tolist()
        token = np.append(at, len(rows))[entry].tolist()
        spans = list(zip(entry, entry[1:], strict=False))
        token_spans = list(zip(token, token[1:], strict=False))
        return pa.record_batch({
            "bucket": pa.array(used, pa.int64()),
            "sets": pa.array([owners[a:b].tobytes() for a, b in spans], pa.binary()),
            "sizes": pa.array([owner_sizes[a:b].tobytes() for a, b in spans], pa.binary()),
            "counts": pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
            "low": pa.array([low[a:b].tobytes() for a, b in token_spans], pa.binary()),
            "high": pa.array([high[a:b].tobytes() for a, b in token_spans], pa.binary()),
        })

    return map_slices(
        docs.select(text_col), text_col, run,
        "bucket bigint, sets binary, sizes binary, counts binary, low binary, high binary",
        DEAL_BYTES,
    )


def _unpack(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _shared_tokens(dealt: DataFrame) -> DataFrame:
    """``set_id, n, token, df`` for the tokens that occur in two sets or more."""

    def run(table: pa.Table) -> pa.Table:
        token = _unpack(table["high"], np.uint8).astype(np.int64) << 32
        token |= _unpack(table["low"], "<u4")
        counts = _unpack(table["counts"], "<u4")
        owner = np.repeat(_unpack(table["sets"], "<i8"), counts)
        size = np.repeat(_unpack(table["sizes"], "<u4"), counts)
        order = np.lexsort((owner, token))
        token, owner, size = token[order], owner[order], size[order]
        # the same set dealt from two slices counts once
        place = np.ones(len(token), bool)
        place[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
        token, owner, size = token[place], owner[place], size[place]
        start = np.ones(len(token), bool)
        start[1:] = token[1:] != token[:-1]
        df = np.diff(np.append(np.flatnonzero(start), len(token)))
        df = np.repeat(df, df)
        keep = df > 1
        bucket = table["bucket"][0].as_py()
        return pa.table({
            "set_id": owner[keep], "n": size[keep].astype(np.int64),
            "token": token[keep] | (bucket << _LOW_BITS), "df": df[keep].astype(np.int64),
        })

    return dealt.groupBy("bucket").applyInArrow(
        run, "set_id bigint, n bigint, token bigint, df bigint"
    )


def _lists(shared: DataFrame, similarity: int, parts: int) -> DataFrame:
    """``set_id, n, single, weight, tokens, first`` of the sets that may have a partner.

    ``tokens`` are all shared tokens, sorted; ``first`` those that any partner must meet,
    in order after the ``single`` ones; ``weight`` grows with the counts of the tokens.
    """

    def run(table: pa.Table) -> pa.Table:
        owner, token, df, size = (
            table[name].to_numpy() for name in ("set_id", "token", "df", "n")
        )
        order = np.lexsort((token, df, owner))
        owner, token, size, df = owner[order], token[order], size[order], df[order]
        start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else owner
        count = np.diff(np.append(start, len(owner)))
        single = size[start] - count  # tokens of no other set come first in the order
        first = size[start] - _needed(size[start], similarity) + 1 - single
        weight = (1000 * np.add.reduceat(np.log2(df), start) / size[start]).astype(np.int64)
        ids, sizes, tokens, firsts = [], [], [], []
        left = np.flatnonzero(first > 0)
        for at in left.tolist():
            own = token[start[at] : start[at] + count[at]]
            ids.append(owner[start[at]])
            sizes.append(size[start[at]])
            tokens.append(np.sort(own))
            firsts.append(own[: first[at]])
        longs = pa.list_(pa.int64())
        return pa.table({
            "set_id": pa.array(ids, pa.int64()), "n": pa.array(sizes, pa.int64()),
            "single": pa.array(single[left], pa.int64()), "weight": pa.array(weight[left]),
            "tokens": pa.array(tokens, longs), "first": pa.array(firsts, longs),
        })

    return (
        shared.withColumn("part", F.pmod(F.xxhash64("set_id"), F.lit(parts)))
        .groupBy("part").applyInArrow(
            run, "set_id bigint, n bigint, single bigint, weight bigint, tokens array<bigint>,"
                 " first array<bigint>",
        )
    )


def _linked(similarity: int, own: str, other: str, shared) -> F.Column:
    return 100 * shared >= similarity * (F.col(own) + F.col(other) - shared)


def _reach(similarity: int, place: str, n: str) -> F.Column:
    """How far a token's place leaves room for an overlap; see ``_may_share``."""
    return (100 + similarity) * F.col(place) - 100 * F.col(n)


def _may_share(similarity: int, reach: str, partner_n) -> F.Column:
    """Whether a token at this reach can be the first that two linked sets share.

    Linked sets of sizes n and m share ceil(s (n + m) / (100 + s)) tokens or more. The first
    shared one, at place p of the n, leaves n - p + 1 tokens, which must suffice.
    """
    return F.col(reach) <= (100 + similarity) - similarity * partner_n


def _leader_links(lists: DataFrame, first: DataFrame, similarity: int) -> DataFrame:
    """Links ``a, b`` of sets to the weightiest set that shares one of their first tokens.

    A heavy set has tokens that many sets have: it is likely to be what others were made of.
    """
    leaders = first.groupBy("token").agg(
        F.max(F.struct("weight", "set_id", "n", "reach")).alias("leader"), F.count("*").alias("held")
    ).where("held > 1").select(
        "token", F.col("leader.set_id").alias("leader"), F.col("leader.n").alias("leader_n"),
        F.col("leader.reach").alias("leader_reach"),
    )
    pairs = (
        join_per_key(first, leaders, ["token"])
        .where("set_id <> leader")
        .where(100 * F.least("n", "leader_n") >= similarity * F.greatest("n", "leader_n"))
        .where(_may_share(similarity, "reach", F.col("leader_n")))
        .where(_may_share(similarity, "leader_reach", F.col("n")))
        .select("set_id", "leader").distinct()
    )
    own = lists.select("set_id", "n", "tokens")
    other = lists.select(
        F.col("set_id").alias("leader"), F.col("n").alias("leader_n"),
        F.col("tokens").alias("leader_tokens"),
    )
    shared = F.size(F.array_intersect("tokens", "leader_tokens"))
    both = join_per_key(join_per_key(pairs, own, ["set_id"]), other, ["leader"])
    return both.where(_linked(similarity, "n", "leader_n", shared)).select(
        F.col("set_id").alias("a"), F.col("leader").alias("b")
    )


def _open(table: pa.Table, similarity: int) -> Iterator[tuple[int, int]]:
    """Links between the queries and the members of one block of a group."""
    member = np.asarray(table["member"].to_numpy(zero_copy_only=False), bool)
    ids, sizes = table["set_id"].to_numpy(), table["n"].to_numpy()
    lists = table["tokens"].combine_chunks()
    values, edges = lists.values.to_numpy(), lists.offsets.to_numpy().tolist()
    tokens = [values[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    members = np.flatnonzero(member)
    if not len(members):
        return
    lengths = [len(tokens[at]) for at in members]
    held = np.concatenate([tokens[at] for at in members])
    who = np.repeat(np.arange(len(members)), lengths)
    order = np.argsort(held, kind="stable")
    held, who = held[order], who[order]
    member_sizes = sizes[members]
    for query in np.flatnonzero(~member).tolist():
        own, size = tokens[query], sizes[query]
        left, right = np.searchsorted(held, own, "left"), np.searchsorted(held, own, "right")
        # the row of the matrix: which of the query's tokens are in the block's union
        if (right > left).sum() < _needed(size, similarity):
            continue
        count = right - left
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        shared = np.bincount(who[at + np.repeat(left, count)], minlength=len(members))
        good = 100 * shared >= similarity * (size + member_sizes - shared)
        if good.any():
            yield int(ids[query]), int(ids[members[good]].min())


def _group_links(
    lists: DataFrame, first: DataFrame, groups: DataFrame, similarity: int
) -> DataFrame:
    """Links ``a, b`` between sets of different groups; one for a set and a block at most."""
    # a set without link is a group of its own
    grouped = materialise(
        lists.select("set_id", "n").join(groups.withColumnRenamed("node", "set_id"), "set_id", "left")
        .select("set_id", "n", F.coalesce("component", "set_id").alias("group"))
    )
    sizes = grouped.groupBy("group").agg(F.count("*").alias("members"))
    placed = materialise(join_per_key(grouped, sizes, ["group"]).select(
        "set_id", "n", "group", "members",
        F.pmod(F.xxhash64("set_id"), F.ceil(F.col("members") / BLOCK_MEMBERS)).alias("block"),
    ))
    tokens = join_per_key(first.select("set_id", "token", "reach"), placed, ["set_id"])
    # a token whose sets are all in one group leads nowhere new
    spread = tokens.groupBy("token").agg(
        F.min("group").alias("lowest"), F.max("group").alias("highest")
    ).where("lowest <> highest").select("token")
    tokens = materialise(join_per_key(tokens, spread, ["token"]))
    matrix = tokens.groupBy("token", "group", "members", "block").agg(
        F.min("n").alias("least_n"), F.max("n").alias("most_n"), F.min("reach").alias("least_reach")
    )
    # of two groups the smaller one asks the larger one
    least_partner = F.greatest(F.col("least_n"), F.ceil(similarity * F.col("n") / 100))
    queries = materialise(
        tokens.select(
            "token", "set_id", "n", "reach", F.struct("members", "group").alias("own")
        )
        .join(matrix, "token")
        .where(F.col("own") < F.struct("members", "group"))
        .where((100 * F.col("most_n") >= similarity * F.col("n"))
               & (100 * F.col("n") >= similarity * F.col("least_n")))
        .where(_may_share(similarity, "reach", least_partner))
        .where(_may_share(similarity, "least_reach", F.col("n")))
        .select("set_id", "group", "block").distinct()
    )
    chunks = queries.groupBy("group", "block").agg(
        F.ceil(F.count("*") / BLOCK_QUERIES).alias("chunks")
    )
    key = ["group", "block", "chunk"]
    asked = join_per_key(queries, chunks, ["group", "block"]).select(
        "set_id", "group", "block", F.pmod(F.xxhash64("set_id"), "chunks").alias("chunk"),
        F.lit(False).alias("member"),
    )
    held = join_per_key(placed, chunks, ["group", "block"]).select(
        "set_id", "group", "block",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).alias("chunk"),
        F.lit(True).alias("member"),
    )
    rows = join_per_key(
        asked.unionByName(held), lists.select("set_id", "n", "tokens"), ["set_id"]
    )

    def run(table: pa.Table) -> pa.Table:
        links = list(_open(table, similarity))
        return pa.table({
            "a": pa.array([a for a, _ in links], pa.int64()),
            "b": pa.array([b for _, b in links], pa.int64()),
        })

    return rows.groupBy(*key).applyInArrow(run, "a bigint, b bigint")


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
    similarity: int = 75,
) -> DataFrame:
    """``id, n_shingles, component_id`` of every row of ``docs``.

    Words are runs of bytes other than space and tab to carriage return, A-Z lower-cased.
    Two rows link when the intersection of their shingle sets reaches ``similarity``
    percent of the union; the component is the smallest id reachable. A null or empty text
    has an empty set, links with nothing and is its own component. Repeated rows stay and
    share a component; a null id is returned with the smallest id of its component, if
    there is one. Other columns are ignored; an empty table gives an empty result.

    Shingles and sets are compared by 64-bit hashes and tokens within buckets by at least
    40 bits; a bucket's task holds five bytes for each of its tokens and sets.
    """
    spark = docs.sparkSession
    rows = materialise(_signatures(docs, id_col, text_col, width))
    total = rows.agg(F.sum("n")).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(partitions, total // BUCKET_TOKENS + 1)
    shared = _shared_tokens(_dealt(docs, text_col, width, buckets))
    lists = materialise(_lists(shared, similarity, buckets))
    first = lists.select("set_id", "n", "single", "weight", F.posexplode("first").alias("at", "token"))
    first = materialise(
        first.withColumn("place", F.col("single") + F.col("at") + 1)
        .select("set_id", "n", "weight", "token", _reach(similarity, "place", "n").alias("reach"))
    )
    leader_links = materialise(_leader_links(lists, first, similarity))
    groups = materialise(connected_components(leader_links))
    links = leader_links.unionByName(_group_links(lists, first, groups, similarity))
    classes = connected_components(links)
    # back to rows: a class of sets, or the set alone, or the row alone without any token
    classes = classes.withColumnRenamed("node", "set_id")
    named = join_per_key(rows, classes, ["set_id"], "left").withColumn(
        "class", F.coalesce("component", "set_id")
    )
    smallest = named.where("n > 0").groupBy("class").agg(F.min(id_col).alias("smallest"))
    return join_per_key(named, smallest, ["class"], "left").select(
        id_col, F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("smallest")).otherwise(F.col(id_col)).alias("component_id"),
    )
