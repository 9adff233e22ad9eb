import numpy as np
import pytest

from kindred.llm import grid_order
from kindred.llm.grid_order import join_blocks, near_duplicates
from kindred.llm.queries import QUERIES
from tests_llm_helpers import Union


def brute_force(rows, least=0.93):
    """``id -> (links, component, kept)`` for rows of distinct ids."""
    union, links = Union(), {i: 0 for i, _, _ in rows}
    good = [
        (i, label, np.array(v, float)) for i, v, label in rows
        if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    for k, (i, label, v) in enumerate(good):
        for j, other, w in good[:k]:
            if label == other and len(v) == len(w):
                if np.dot(v, w) / (np.linalg.norm(v) * np.linalg.norm(w)) >= least:
                    links[i], links[j] = links[i] + 1, links[j] + 1
                    union.join(i, j)
    return {i: (n, union.find(i), union.find(i) == i) for i, n in links.items()}


def compare(frame, rows):
    found = near_duplicates(frame).collect()
    assert len(found) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == brute_force(rows)


@pytest.mark.parametrize("block", [1024, 40])
def test_made_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(grid_order, "BLOCK", block)
    monkeypatch.setattr(grid_order, "LEAF", 8)
    chance = np.random.default_rng(block)
    centres = chance.normal(size=(60, 10))
    rows = []
    for i in range(700):
        v = centres[chance.integers(60)] + chance.normal(size=10) * chance.choice([0, 0.1, 0.25, 0.5])
        rows.append((i, (v * chance.choice([0.01, 1, 7])).tolist(), int(chance.integers(3))))
    rows += [(i, [1.0] * 10, 1) for i in range(1000, 1200)]  # one vector many times
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    compare(frame.repartition(6), rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1),
            (6, [None, 1.0], 1), (7, [1.0, 1.0], None), (8, [1.0, 1.0], 1), (9, [2.0, 2.0], 1),
            (10, [1.0, 1.0], 2), (11, [1.0, 1.0, 1.0], 1), (12, [1e-300, 1e-300], 1),
            (13, [1e300, 1e300], 1), (14, [-1.0, -1.0], 1), (15, [0.0, 1.0], 2), (16, [-0.0, 1.0], 2)]
    frame = spark.createDataFrame(
        [(*r, "x", 0) for r in rows],
        "vec_id bigint, embedding array<double>, label int, dim string, weight int",
    )
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(frame).collect()}
    wanted = {i: (0, i, True) for i, _, _ in rows}
    wanted |= {i: (3, 8, i == 8) for i in (8, 9, 12, 13)} | {15: (1, 15, True), 16: (1, 15, False)}
    assert found == wanted
    again = near_duplicates(frame.unionByName(frame.where("vec_id = 8"))).where("vec_id = 8").collect()
    assert [(r.n_links, r.component_id) for r in again] == [(4, 8)] * 2
    nameless = frame.selectExpr("if(vec_id = 9, null, vec_id) vec_id", "embedding", "label")
    row = near_duplicates(nameless).where("vec_id IS NULL").collect()
    assert [(r.n_links, r.component_id, r.kept) for r in row] == [(3, 8, False)]
    assert near_duplicates(frame.limit(0)).collect() == []


def test_blocks_far_apart_are_not_compared(monkeypatch):
    calls = []
    monkeypatch.setattr(grid_order._Forest, "join", lambda *a: calls.append(a))
    left = np.tile([1.0, 0.0], (300, 1))
    right = np.tile([0.0, 1.0], (300, 1))
    linked, _ = join_blocks(left, right, np.eye(2), 0.93, np.ones(300, int), np.ones(300, int))
    assert not linked.any() and not calls


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in
            spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = QUERIES["op6_near_duplicates"](spark, folder).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == brute_force(rows)
