import numpy as np
import pytest

from kindred.llm import posting_lists
from kindred.llm.posting_lists import Settings, balanced_centroids, nearest, neighbour_graph
from kindred.llm.queries import QUERIES


def brute_force(rows, k=20, every=20):
    """``query -> [(id, score)]`` over all usable rows; ties to the smaller id."""
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], float)
    found = {}
    for query in np.flatnonzero(ids % every == 0):
        scores = (vectors * vectors[query]).sum(axis=1)
        scores[ids == ids[query]] = -np.inf
        best = {}
        for at in np.lexsort((ids, -scores)):
            if scores[at] > -np.inf and len(best) < k:
                best.setdefault(int(ids[at]), float(scores[at]))
        found[int(ids[query])] = list(best.items())
    return found


def by_query(rows):
    found = {}
    for row in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(row.query_id, []).append(row)
    for own in found.values():
        assert [r.rank for r in own] == list(range(1, len(own) + 1))
        order = [(-r.score, r.vec_id) for r in own]
        assert order == sorted(order) and len({r.vec_id for r in own}) == len(own)
    return found


def recall(found, truth):
    return np.mean([
        len({r.vec_id for r in found[q]} & {i for i, _ in best}) / len(best)
        for q, best in truth.items() if best
    ])


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_query(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    rows = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found, truth = by_query(QUERIES["op5_nearest"](spark, folder).collect()), brute_force(rows)
    assert found.keys() == truth.keys()
    vectors = dict(rows)
    for query, own in found.items():
        assert len(own) == len(truth[query])
        for row in own:
            assert row.score == pytest.approx(np.dot(vectors[query], vectors[row.vec_id]), abs=1e-12)
    assert recall(found, truth) >= 0.93


def test_different_norms_and_many_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "CHUNK_VECTORS", 50)
    monkeypatch.setattr(posting_lists, "CHUNK_QUERIES", 7)
    chance = np.random.default_rng(3)
    vectors = chance.normal(size=(1500, 8)) * chance.lognormal(0, 0.3, size=(1500, 1))
    vectors[chance.random(1500) < 0.33] = vectors[0]  # a third of the rows is one vector
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found, truth = by_query(nearest(frame).collect()), brute_force(rows)
    assert recall(found, truth) >= 0.93
    for query, own in found.items():  # exact ties go to the smaller ids
        if truth[query][0][1] == truth[query][19][1]:
            assert [r.vec_id for r in own] == [i for i, _ in truth[query]]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (40, [1.0, 1.0]), (41, [3.0, -1.0]), (41, [3.0, -1.0])]
    odd = [(60, None), (61, []), (62, [0.0, 0.0]), (63, [nan, 1.0]), (80, [inf, 1.0]),
           (65, [None, 1.0]), (66, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    schema = "vec_id bigint, embedding array<double>, score string, list int"
    frame = spark.createDataFrame([(*row, "x", 1) for row in good + odd], schema)
    found = by_query(nearest(frame).collect())
    truth = brute_force(good)
    assert {q: [(r.vec_id, r.score) for r in own] for q, own in found.items()} == truth
    assert [r.vec_id for r in found[0]] == [41, 40, 20]
    for given in (odd, [], good[:1]):
        frame = spark.createDataFrame([(*row, "x", 1) for row in given], schema)
        assert nearest(frame.where("vec_id <> 66 OR vec_id IS NULL")).count() == 0


def test_walk_finds_every_list_within_the_ratio():
    chance = np.random.default_rng(1)
    points = chance.normal(size=(3000, 6))
    centroids = balanced_centroids(points, 60, 0)
    sizes = np.full(60, 50)
    index = posting_lists.Index(
        centroids, neighbour_graph(centroids, 16), np.array([0, 20, 40]), sizes, 1.0, 1.5
    )
    missed = total = 0
    for point in chance.normal(size=(50, 6)):
        distance = np.sqrt(((centroids - point) ** 2).sum(axis=1))
        wanted = set(np.flatnonzero(distance <= 1.5 * distance.min()).tolist())
        opened = index.open(point, 10)
        missed, total = missed + len(wanted - set(opened)), total + len(wanted)
        assert sum(sizes[opened]) >= 10
    assert missed <= 0.02 * total


def test_clusters_are_balanced():
    chance = np.random.default_rng(2)
    points = np.concatenate([chance.normal(size=(2500, 4)) * 0.3, chance.normal(5, 1, size=(500, 4))])
    centroids = balanced_centroids(points, 30, 0, rounds=20)
    nearest_one = ((points[:, None] - centroids) ** 2).sum(axis=2).argmin(axis=1)
    assert np.bincount(nearest_one, minlength=30).max() <= 5 * 100


def test_settings_bound_the_lists():
    assert Settings().lists * 65 * 8 < 1_000_000
