import random

import pytest

from kindred.llm import token_groups
from kindred.llm.components import connected_components
from kindred.llm.queries import QUERIES
from kindred.llm.token_groups import jaccard_components
from tests_llm_helpers import Union, brute_force


def compare(found, texts):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_force(texts)


def made_texts(seed, families=25, size=12):
    """Families of copies with growing changes, passages shared by many, odd texts."""
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    passage = chance.choices(words, k=40)
    texts = {}
    for _ in range(families):
        base = chance.choices(words, k=chance.randint(8, 90))
        if chance.random() < 0.6:
            base[5:5] = passage[: chance.randint(10, 40)]
        for _ in range(chance.randint(1, size)):
            copy = list(base)
            for _ in range(chance.randint(0, max(1, len(copy) // 25))):
                copy[chance.randrange(len(copy))] = chance.choice(words)
            if chance.random() < 0.3:
                copy = copy[chance.randint(0, 6) :]
            base = copy if chance.random() < 0.5 else base
            texts[len(texts)] = chance.choice([" ", "\n", "  "]).join(copy)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_made_texts(spark, monkeypatch, seed):
    if seed == 2:  # many buckets, blocks and chunks
        monkeypatch.setattr(token_groups, "BUCKET_TOKENS", 300)
        monkeypatch.setattr(token_groups, "BLOCK_MEMBERS", 3)
        monkeypatch.setattr(token_groups, "BLOCK_QUERIES", 2)
        monkeypatch.setattr(token_groups, "DEAL_BYTES", 2000)
    texts = made_texts(seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    compare(jaccard_components(docs).collect(), texts)


def test_exact_boundary(spark):
    # 7 of 9 shingles shared is 0.777.., 6 of 8 is 0.75, 5 of 7 is below
    base = [f"a{i}" for i in range(11)]
    texts = {
        1: " ".join(base), 2: " ".join([*base[:10], "x"]), 3: " ".join(base[1:]),
        10: " ".join(f"b{i}" for i in range(12)), 11: " ".join(f"b{i}" for i in range(10)),
        20: " ".join(f"c{i}" for i in range(11)), 21: " ".join(f"c{i}" for i in range(9)),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = jaccard_components(docs).collect()
    compare(found, texts)
    component = {r.doc_id: r.component_id for r in found}
    assert component[11] == 10 and component[21] == 21


def test_odd_rows(spark):
    long = " ".join(f"word{i % 5000}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one"), (7, "É x"),
            (8, "é x"), (9, "one two three four five six"), (9, "one two three four five six"),
            (12, long), (11, long + " end"), (13, "two words"), (None, "one two")]
    docs = spark.createDataFrame(
        [(i, t, "x", 0) for i, t in rows], "doc_id bigint, text string, n string, set_id int"
    )
    found = jaccard_components(docs).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert by_id[None] == (1, 4)
    wanted = brute_force({i: t for i, t in rows if i is not None})
    assert {i: v for i, v in by_id.items() if i is not None} == wanted
    assert wanted[12][1] == 11 and wanted[5][1] == 4 and wanted[3] == (0, 3)
    assert jaccard_components(docs.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    compare(QUERIES["op1_jaccard_join"](spark, folder).collect(), texts)


def test_components(spark):
    chance, union = random.Random(3), Union()
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)]
    links += [(chance.randrange(200, 400), chance.randrange(200, 400)) for _ in range(90)] + [(7, 7)]
    for a, b in links:
        union.join(a, b)
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.component for r in connected_components(frame).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert found == {n: union.find(n) for n in nodes}
    assert connected_components(frame.limit(0)).count() == 0
