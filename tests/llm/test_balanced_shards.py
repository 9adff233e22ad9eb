import random
import zlib
from collections import Counter

import pytest

from kindred.llm.balanced_shards import Settings, balanced_shards, propagate, shard_documents
from kindred.llm.queries import QUERIES


def check(rows, texts, shards=8):
    """Sizes, checksums, even counts and gapless slots; returns the shards of each text."""
    assert Counter(row.doc_id for row in rows) == Counter(i for i, _ in texts)
    counts = Counter(row.shard for row in rows)
    assert set(counts) <= set(range(shards))
    assert max(counts.values(), default=0) - min((counts.get(s, 0) for s in range(shards))) <= 1
    for shard in counts:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(counts[shard]))
    sizes = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == sizes
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)
    found = {}
    for row in rows:
        found.setdefault((row.size, row.text_crc32), Counter())[row.shard] += 1
    return found


def test_groups_stay_together(spark):
    chance = random.Random(2)
    texts = [(i, f"own {i}") for i in range(600)]
    for group in range(60):
        texts += [(1000 + 10 * group + k, f"copy {group}") for k in range(chance.randint(2, 9))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    found = check(shard_documents(docs).collect(), texts)
    assert all(len(shards) == 1 for shards in found.values())


@pytest.mark.parametrize("share", [0.4, 1.0])
def test_a_group_larger_than_a_shard_fills_whole_shards(spark, share):
    texts = [(i, "same" if i < 800 * share else f"own {i}") for i in range(800)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(4)
    found = check(shard_documents(docs).collect(), texts)
    held = sorted(found[5, zlib.crc32(b"same")].values())
    # no more shards than the rows need, and one for what a bin leaves over
    assert len(held) <= -(-sum(held) // 100) + 1


def test_odd_rows(spark):
    texts = [(1, None), (1, None), (2, ""), (None, "x"), (None, "x"), (3, "é" * 50_000), (4, "x")]
    docs = spark.createDataFrame([(*t, 1, "r") for t in texts],
                                 "doc_id bigint, text string, shard int, law string")
    check(shard_documents(docs).collect(), texts)
    assert shard_documents(docs.limit(0)).count() == 0


def test_links_through_several_groups(spark):
    """A chain of overlapping pairs ends with fewer cut pairs than a deal by hash."""
    members = [(row, group) for group in range(199) for row in (group, group + 1)]
    rows = spark.createDataFrame([(i,) for i in range(400)], "row bigint")
    links = spark.createDataFrame(members, "row bigint, group bigint")
    placed = {r.row: (r.shard, r.slot) for r in balanced_shards(rows, links, Settings(shards=4)).collect()}
    assert Counter(s for s, _ in placed.values()) == {s: 100 for s in range(4)}
    cut = sum(placed[g][0] != placed[g + 1][0] for g in range(199))
    assert cut < 0.6 * 199


def test_no_shard_above_its_quota(spark):
    members = spark.createDataFrame([(i, i // 40, 40) for i in range(400)],
                                    "row bigint, group bigint, crowd bigint")
    held = Counter(r.shard for r in propagate(members, 110, Settings(shards=4)).collect())
    assert sum(held.values()) == 400 and max(held.values()) <= 135  # the start by hash aside


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = check(QUERIES["op13_sharding"](spark, folder).collect(), texts)
    assert all(len(shards) == 1 for shards in found.values())
