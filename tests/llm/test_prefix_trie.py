import hashlib
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from kindred.llm.prefix_trie import conversation_trie
from kindred.llm.queries import ORACLES, QUERIES
from kindred.llm.running import running

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def plain(rows, shared_heads):
    """The trie by nested dictionaries of whole turn sequences."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[:2], hashlib.md5(
            f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()))
    own = {conv: [t[2:] for t in turns] for conv, turns in own.items()}
    rebuilt = own
    if shared_heads:
        rebuilt = {}
        for conv, turns in own.items():
            head = zlib.crc32(str(conv).encode()) % 4
            rebuilt[conv] = own.get(conv - conv % 20, [])[:head] + turns[head:]
    members = {}
    for conv, turns in rebuilt.items():
        for depth in range(len(turns) + 1):
            members.setdefault(tuple(turns[:depth]), []).append(conv)
    kids, leaves, saved = {}, {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves.get(node, 0) or 1
        if node:
            saved[node] = saved.get(node, 0) + (len(members[node]) - 1) * words(node[-1][1])
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
            leaves[node[:-1]] = leaves.get(node[:-1], 0) + leaves[node]
            saved[node[:-1]] = saved.get(node[:-1], 0) + saved[node]
    return sorted(
        (
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            kids.get(node, 0), leaves[node], saved.get(node, 0),
            hashlib.sha256(",".join(
                str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node)).encode()).hexdigest(),
        )
        for node, convs in members.items()
    )


def found(df):
    return sorted(tuple(row) for row in df.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256").collect())


def key(rows):
    return sorted(rows, key=lambda row: row[:2])


@pytest.mark.parametrize(("seed", "block", "shared"), [(1, 1, True), (2, 3, True), (3, 4, False)])
def test_random_conversations(spark, seed, block, shared):
    chance = random.Random(seed)
    rows = []
    for conv in range(0, 150, 1):
        if chance.random() < 0.1:
            continue
        for turn in range(chance.choice([0, 1, 2, 3, 5, 9])):
            rows.append((conv, chance.choice([turn, turn, None]), chance.choice(["user", None]),
                         chance.choice(["a b", "a  c", "", None])))
    rows += [(7, 1, "user", "a b"), (7, 1, "user", "a b"), (None, 1, "user", "x"), (2**40, 5, "u", "é a")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    result = conversation_trie(df, block_turns=block, shared_heads=shared)
    assert key(found(result)) == key(plain(rows, shared))


def test_long_history_and_copies(spark):
    """Every prefix logged as a conversation of its own, and many copies of one of them."""
    rows = [(conv, turn, "u", f"t{turn}") for conv in range(1, 31) for turn in range(conv)]
    rows += [(conv, turn, "u", f"t{turn}") for conv in range(100, 800) for turn in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert key(found(conversation_trie(df))) == key(plain(rows, False))


def test_empty_table_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_trie(empty, shared_heads=True).count() == 0
    odd = spark.createDataFrame([(1, 0, "u", "x", "d", 5)], SCHEMA + ", depth string, q1 int")
    assert found(conversation_trie(odd)) == found(conversation_trie(odd.select("conv_id", "turn", "role", "text")))


def test_running_totals_over_split_groups(spark):
    rows = [(g, i, (i * 7 + g) % 11) for g, n in ((1, 400), (2, 1), (3, 50)) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, i int, x bigint").repartition(5)
    sums = running(df, ["g"], [F.col("i").desc()], {"s": "x"})
    for row in sums.collect():
        assert row.s == sum(x for g, i, x in rows if g == row.g and i >= row.i)
    mixed = running(df, ["g"], [F.col("i").asc()], {"s": "x"}, xor=True)
    for row in mixed.collect():
        value = 0
        for g, i, x in rows:
            if g == row.g and i <= row.i:
                value ^= x
        assert row.s == value


def test_query_and_sql(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    expected = key(plain(rows, True))
    assert key(found(QUERIES["op11_prefix_trie"](spark, folder))) == expected
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{folder}/conversations.parquet')"
    )
    columns = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    assert key(connection.execute(
        f"SELECT {columns} FROM ({ORACLES['op11_prefix_trie']})").fetchall()) == expected
