"""Approximate nearest neighbours by balanced posting lists.

Centroids come from k-means on a bounded sample, with a penalty on large clusters. Every
vector enters the list of its nearest centroid and, near a boundary, those of further
centroids whose distance is within a ratio of the nearest. A query finds its centroids by
a best-first walk on a neighbour graph of the centroids and opens each list whose distance
is within another ratio of the nearest one. That ratio is measured: for a bounded sample
of queries the true neighbours are searched over all rows, and it is chosen so that the
wanted share of them lies in open lists.

Inner products become distances by one more component that gives all vectors the same
norm. Lists are cut into chunks of bounded size, each a group of its own with its share of
the queries; a group returns at most ``k`` rows per query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.vectors import matrix, packed
from kindred.operators.skew import join_per_key
from kindred.session import materialise

#: Vectors of a chunk of a list and queries to it that meet in a group.
CHUNK_VECTORS, CHUNK_QUERIES = 16_384, 1_024


@dataclass(frozen=True)
class Settings:
    """Parameters of the index; the sample sizes bound what the driver holds."""

    lists: int = 256
    vectors_per_list: int = 64  # smaller tables have fewer lists
    sample: int = 16_384
    copies: int = 4
    boundary: float = 0.12
    tuning_queries: int = 64
    recall: float = 0.97
    neighbours: int = 16
    seed: int = 7


@dataclass(frozen=True)
class Index:
    """Centroids (with the added component), their graph and sizes, and the opening ratio."""

    centroids: np.ndarray
    graph: np.ndarray
    entries: np.ndarray
    sizes: np.ndarray
    longest: float
    ratio: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the component that brings their norm to the longest one."""
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest])

    def distances(self, points: np.ndarray) -> np.ndarray:
        squares = (points**2).sum(axis=1)[:, None] + (self.centroids**2).sum(axis=1)
        return np.sqrt(np.maximum(squares - 2 * points @ self.centroids.T, 0))

    def homes(self, points: np.ndarray, settings: Settings) -> np.ndarray:
        """Which lists (columns, at most ``copies`` of them) each point enters."""
        distance = self.distances(points)
        count = min(settings.copies, len(self.centroids))
        near = np.argpartition(distance, count - 1, axis=1)[:, :count]
        found = np.take_along_axis(distance, near, axis=1)
        chosen = found <= (1 + settings.boundary) * found.min(axis=1, keepdims=True)
        result = np.zeros(distance.shape, bool)
        rows, at = np.nonzero(chosen)
        result[rows, near[rows, at]] = True
        return result

    def open(self, point: np.ndarray, enough: int) -> list[int]:
        """Lists to search for one query: those within the ratio, and as many more as hold
        ``enough`` vectors. The walk expands centroids nearest first."""
        def distance(nodes):
            return np.sqrt(((self.centroids[nodes] - point) ** 2).sum(axis=1))

        seen = np.zeros(len(self.centroids), bool)
        seen[self.entries] = True
        frontier = [(d, n) for d, n in zip(distance(self.entries), self.entries.tolist(), strict=True)]
        heapq.heapify(frontier)
        nearest, held, opened = np.inf, 0, []
        found: list[tuple[float, int]] = []
        while frontier:
            d, node = heapq.heappop(frontier)
            nearest = min(nearest, d)
            # the graph is connected; farther centroids may hide nearer ones only briefly
            if d > 1.1 * self.ratio * nearest and sum(self.sizes[n] for _, n in found) >= enough:
                break
            found.append((d, node))
            fresh = self.graph[node][~seen[self.graph[node]]]
            if len(fresh):
                seen[fresh] = True
                for item in zip(distance(fresh), fresh.tolist(), strict=True):
                    heapq.heappush(frontier, item)
        for d, node in sorted(found):
            if d > self.ratio * nearest and held >= enough:
                break
            opened.append(node)
            held += int(self.sizes[node])
        return opened


def balanced_centroids(points: np.ndarray, count: int, seed: int, rounds: int = 10) -> np.ndarray:
    """k-means centroids; a cluster's size adds to its distance, so sizes stay close."""
    chance = np.random.default_rng(seed)
    centroids = points[chance.choice(len(points), count, replace=False)].copy()
    penalty = np.zeros(count)
    for _ in range(rounds):
        nearest, total = [], 0.0
        for part in np.array_split(points, max(1, len(points) // 4096)):
            distance = (centroids**2).sum(axis=1) - 2 * part @ centroids.T + penalty
            nearest.append(distance.argmin(axis=1))
            total += float((distance.min(axis=1) + (part**2).sum(axis=1)).sum())
        nearest = np.concatenate(nearest)
        sizes = np.bincount(nearest, minlength=count)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        filled = sizes > 0
        centroids[filled] = sums[filled] / sizes[filled, None]
        spread = max(total / len(points), 1e-12)
        penalty += 0.1 * spread * (sizes / (len(points) / count) - 1)
    return centroids


def neighbour_graph(centroids: np.ndarray, neighbours: int) -> np.ndarray:
    """Each centroid's nearest centroids, and the next in a ring so that all are connected."""
    count = len(centroids)
    near = min(neighbours, count - 1)
    if near <= 0:
        return np.zeros((count, 1), np.int64)
    links = []
    squares = (centroids**2).sum(axis=1)
    for part in np.array_split(centroids, max(1, count // 512)):
        distance = squares - 2 * part @ centroids.T
        links.append(np.argsort(distance, axis=1, kind="stable")[:, : near + 1])
    ring = (np.arange(count) + 1) % count
    return np.column_stack([np.concatenate(links), ring])


def _best(
    query: np.ndarray, own: object, vectors: np.ndarray, ids: np.ndarray, rough: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` best, ties to the smaller id.

    Rough scores choose candidates with some slack; the final scores add each row's
    products in the same order wherever the row stands, so equal vectors tie exactly.
    """
    allowed = ids != own
    if allowed.sum() > k:
        kth = np.partition(rough[allowed], -k)[-k]
        allowed &= rough >= kth - 1e-9 * max(1.0, abs(kth))
    at = np.flatnonzero(allowed)
    scores = (vectors[at] * query).sum(axis=1)
    order = np.lexsort((ids[at], -scores))[:k]
    return ids[at][order], scores[order]


def _searched(table: pa.Table, dim: int, k: int) -> Iterator[tuple]:
    """``(query ids, ids, scores)`` of each query of a group against its vectors."""
    member = np.asarray(table["member"].to_numpy(zero_copy_only=False), bool)
    ids, all_rows = table["vec_id"].to_numpy(), matrix(table["packed"], dim)
    vectors, vector_ids = all_rows[member], ids[member]
    if not len(vectors):
        return
    queries = np.flatnonzero(~member)
    for part in np.array_split(queries, max(1, len(queries) // 64)):
        rough = all_rows[part] @ vectors.T
        for at, scores in zip(part.tolist(), rough, strict=True):
            found, exact = _best(all_rows[at], ids[at], vectors, vector_ids, scores, k)
            yield np.full(len(found), ids[at]), found, exact


_FOUND = "query_id bigint, vec_id bigint, score double"


def _table(results: list[tuple]) -> pa.Table:
    queries, ids, scores = zip(*results, strict=True) if results else ((), (), ())
    return pa.table({
        "query_id": pa.array(np.concatenate([np.empty(0, np.int64), *queries])),
        "vec_id": pa.array(np.concatenate([np.empty(0, np.int64), *ids])),
        "score": pa.array(np.concatenate([np.empty(0), *scores])),
    })


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best distinct neighbours of each query, with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    )


def _brute_force(rows: DataFrame, queries: list[tuple], dim: int, k: int) -> DataFrame:
    """True neighbours of a bounded list of (id, packed) queries over all rows, in blocks."""
    ids = [number for number, _ in queries]
    points = np.frombuffer(b"".join(bytes(value) for _, value in queries), "<f8").reshape(-1, dim)

    def task(batches):
        for batch in batches:
            vectors, vector_ids = matrix(batch.column(1), dim), batch.column(0).to_numpy()
            rough = points @ vectors.T
            found = [
                (np.full(len(best[0]), number), *best)
                for number, point, scores in zip(ids, points, rough, strict=True)
                for best in [_best(point, number, vectors, vector_ids, scores, k)]
            ]
            yield from _table(found).to_batches()

    return _top(rows.select("vec_id", "packed").mapInArrow(task, _FOUND), k)


def build(rows: DataFrame, dim: int, k: int, settings: Settings, is_query) -> Index:
    """Fit centroids, graph and ratio; ``rows`` has ``vec_id, packed`` of dimension ``dim``."""
    def norms(batches):
        for batch in batches:
            values = matrix(batch.column(0), dim)
            longest = float(np.sqrt((values**2).sum(axis=1).max())) if len(values) else 0.0
            yield pa.record_batch({"longest": [longest], "rows": [len(values)]})

    stats = rows.select("packed").mapInArrow(norms, "longest double, rows bigint").agg(
        F.max("longest"), F.sum("rows")
    ).first()
    longest, total = stats[0] or 0.0, stats[1] or 0
    order = (F.xxhash64("vec_id", F.lit(settings.seed)), "vec_id")
    # the share of rows that makes the sample, chosen by a hash of the id
    share = min(1.0, 1.2 * settings.sample / max(total, 1))
    near = (F.pmod(F.xxhash64("vec_id", F.lit(settings.seed)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = rows.where(near).select("packed").limit(settings.sample).toArrow()
    index = Index(np.empty((0, dim + 1)), np.empty((0, 1)), np.empty(0), np.empty(0), longest, 1.0)
    points = index.lifted(matrix(sample["packed"], dim))
    count = max(1, min(settings.lists, total // settings.vectors_per_list, len(points)))
    centroids = balanced_centroids(points, count, settings.seed)
    entries = np.unique(np.linspace(0, count - 1, min(8, count)).astype(np.int64))
    index = Index(
        centroids, neighbour_graph(centroids, settings.neighbours), entries, np.zeros(count, int),
        longest, 1.0,
    )
    # the ratio: how far the lists of true neighbours are, against each query's nearest list
    queries = [tuple(r) for r in rows.where(is_query).orderBy(*order).limit(settings.tuning_queries)
               .select("vec_id", "packed").collect()]
    needed = []
    if queries:
        truth = _brute_force(rows, queries, dim, k).select("query_id", "vec_id")
        near_rows = truth.join(rows.select("vec_id", "packed"), "vec_id").toArrow()
        lists = index.homes(index.lifted(matrix(near_rows["packed"], dim)), settings)
        plain = np.frombuffer(b"".join(bytes(v) for _, v in queries), "<f8").reshape(-1, dim)
        distance = index.distances(np.column_stack([plain, np.zeros(len(plain))]))
        row_of = {number: at for at, (number, _) in enumerate(queries)}
        for query, homes in zip(near_rows["query_id"].to_pylist(), lists, strict=True):
            own = distance[row_of[query]]
            needed.append(own[homes].min() / max(own.min(), 1e-12))
    ratio = float(np.quantile(needed, settings.recall)) if needed else 1.0
    return Index(centroids, index.graph, entries, index.sizes, longest, max(1.0, ratio) + 1e-9)


def nearest(
    vectors: DataFrame, k: int = 20, query_every: int = 20, settings: Settings = Settings(),
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found of each query, as ``query_id, rank, vec_id, score``.

    Queries are the rows whose id is divisible by ``query_every``; candidates all rows but
    those with the query's own id. Score is the inner product in double precision; ties go
    to the smaller id; ranks start at 1. Rows with a null id, or with a vector that is null,
    empty, zero or not finite, or of another length than most, take no part. Rows that
    repeat an id count once, with their best score. A query gets fewer than ``k`` rows only
    if there are fewer candidates.
    """
    named = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), vector_col)
    rows = materialise(packed(named.where("vec_id IS NOT NULL"), "vec_id", vector_col))
    dims = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    spark = vectors.sparkSession
    if dims is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim = dims["dim"]
    rows = rows.where(F.col("dim") == dim)
    is_query = F.col("vec_id") % query_every == 0
    index = build(rows, dim, k, settings, is_query)

    def place(batches):
        for batch in batches:
            homes = index.homes(index.lifted(matrix(batch.column(1), dim)), settings)
            at, lists = np.nonzero(homes)
            taken = batch.take(pa.array(at))
            yield pa.record_batch({
                "list": pa.array(lists, pa.int32()), "vec_id": taken.column(0),
                "packed": taken.column(1),
            })

    fields = "list int, vec_id bigint, packed binary"
    held = materialise(rows.select("vec_id", "packed").mapInArrow(place, fields))
    counts = {r["list"]: r["count"] for r in held.groupBy("list").count().collect()}
    sizes = np.array([counts.get(number, 0) for number in range(len(index.centroids))])
    index = Index(index.centroids, index.graph, index.entries, sizes, index.longest, index.ratio)
    enough = settings.copies * (k + 1)  # a vector is in that many lists at most

    def route(batches):
        for batch in batches:
            plain = matrix(batch.column(1), dim)
            points = np.column_stack([plain, np.zeros(len(plain))])
            opened = [index.open(point, enough) for point in points]
            at = np.repeat(np.arange(len(opened)), [len(lists) for lists in opened])
            taken = batch.take(pa.array(at))
            yield pa.record_batch({
                "list": pa.array([number for lists in opened for number in lists], pa.int32()),
                "vec_id": taken.column(0), "packed": taken.column(1),
            })

    asked = materialise(
        rows.where(is_query).select("vec_id", "packed").distinct().mapInArrow(route, fields)
    )
    # chunks of lists and of their queries; both counts have one row per list
    chunks = (
        held.groupBy("list").agg(F.ceil(F.count("*") / CHUNK_VECTORS).alias("chunks"))
        .join(asked.groupBy("list").agg(F.ceil(F.count("*") / CHUNK_QUERIES).alias("parts")), "list")
    )
    both = join_per_key(
        held.withColumn("member", F.lit(True)).unionByName(asked.withColumn("member", F.lit(False))),
        chunks, ["list"],
    )
    own_chunk = F.pmod(F.xxhash64("vec_id"), "chunks")
    own_part = F.pmod(F.xxhash64("vec_id"), "parts")
    every = {name: F.sequence(F.lit(0).cast("bigint"), F.col(name) - 1) for name in ("chunks", "parts")}
    grid = both.select(
        "list", "vec_id", "packed", "member", "parts",
        F.explode(F.when(F.col("member"), F.array(own_chunk)).otherwise(every["chunks"])).alias("chunk"),
        own_part.alias("own_part"),
    ).select(
        "list", "vec_id", "packed", "member", "chunk",
        F.explode(
            F.when(F.col("member"), every["parts"]).otherwise(F.array("own_part"))
        ).alias("part"),
    )
    found = grid.groupBy("list", "chunk", "part").applyInArrow(
        lambda table: _table(list(_searched(table, dim, k))), _FOUND
    )
    return _top(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
