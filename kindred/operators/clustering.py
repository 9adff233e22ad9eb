"""k-medoids on weighted distinct vectors, euclidean distance, deterministic.

A fit alternates two linear steps and one exact medoid search. Spark holds the
points; the driver holds only the medoids (at most the sum of the wanted ks) and a
bounded number of tried members, so no lineage builds up over iterations. Several ks
are fitted in the same passes.

The medoid search rests on the triangle inequality: a member at distance d from a member
whose summed distance over weight W is s has a summed distance of at least ``|s - W d|``.
A few members of the lowest bounds are tried in linear passes, their sums bound all others,
and only members whose bound stays below the best sum are compared with their cluster. Where
distances hardly differ, as with many axes, a second bound decides: by Hölder's inequality the
sum of distances is at least ``A ** 1.5 / Q ** 0.5``, A and Q being the sums of their second and
fourth powers, which follow for every member from the moments of its cluster.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators.tiles import DEFAULT_CHUNK_ROWS, reduce_tiles
from kindred.session import local_table, materialise

# The k sweep of the elbow curve and the final k.
ELBOW_KS = tuple(range(1, 21))
FINAL_K = 5
# Distances are compared at this many decimals, so that summation order cannot decide a tie.
DECIMALS = 9
# Members of a cluster that a pass tries, and pairs that are compared without trying any first.
TRIES = 8
PAIRS_AT_ONCE = 20_000_000
# Numbers that the moments of all clusters may take together; beyond, the other bounds are left.
MOMENT_NUMBERS = 1_000_000


@dataclass(frozen=True)
class Medoids:
    """Medoids of one clustering, ordered by point id; a label is an index into them."""

    ids: tuple
    vectors: np.ndarray

    @classmethod
    def of(cls, rows: Sequence[tuple]) -> Medoids:
        ordered = sorted(rows, key=lambda row: row[0])
        return cls(
            tuple(row[0] for row in ordered),
            np.array([row[1] for row in ordered], dtype=np.float64),
        )

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label and distance per point; the smaller medoid id wins a tie."""
        distances = np.round(_distances(points, self.vectors), DECIMALS)
        labels = distances.argmin(axis=1)
        return labels, distances[np.arange(len(points)), labels]


def _distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pairwise euclidean distances; few left rows at a time bound the memory."""
    out = np.empty((len(left), len(right)))
    step = max(1, 2_000_000 // max(1, right.size))
    for start in range(0, len(left), step):
        gaps = left[start : start + step, None, :] - right[None, :, :]
        out[start : start + step] = np.sqrt((gaps * gaps).sum(axis=2))
    return out


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=np.float64)


def feature_vectors(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """``(point_id, vector)`` from feature columns."""
    features = F.array(*[F.col(f"`{name}`").cast("double") for name in columns])
    return df.select(F.col(id_col).alias("point_id"), features.alias("vector"))


def weighted_points(vectors: DataFrame) -> DataFrame:
    """Distinct vectors with their number of products; the smallest id names a vector."""
    return vectors.groupBy("vector").agg(
        F.min("point_id").alias("point_id"), F.count(F.lit(1)).cast("double").alias("weight")
    )


def kmedoids_assign(vectors: DataFrame, medoids: Medoids) -> DataFrame:
    """``(point_id, medoid_id, label, distance)``: the nearest medoid of every row."""
    names = np.array(medoids.ids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                labels, distances = medoids.nearest(_matrix(batch["vector"]))
                yield pd.DataFrame(
                    {
                        "point_id": batch["point_id"],
                        "medoid_id": names[labels],
                        "label": labels,
                        "distance": distances,
                    }
                )

    kind = vectors.schema["point_id"].dataType.simpleString()
    schema = f"point_id {kind}, medoid_id {kind}, label int, distance double"
    return vectors.select("point_id", "vector").mapInPandas(assign, schema)


@dataclass(frozen=True)
class Summary:
    """Rows, weight, summed distance to the medoid and mean vector of one cluster."""

    members: int
    weight: float
    cost: float
    mean: list[float]


def _summaries(points: DataFrame, fits: Mapping[int, Medoids]) -> dict[tuple[int, int], Summary]:
    """Per (k, label): weight, cost, mean vector, rows. Batches are summed where they are read."""

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            matrix, weights = _matrix(batch["vector"]), batch["weight"].to_numpy()
            for k, medoids in fits.items():
                labels, distances = medoids.nearest(matrix)
                for label in np.unique(labels):
                    mine = labels == label
                    share = weights[mine]
                    yield pd.DataFrame(
                        {
                            "k": [k],
                            "label": [label],
                            "members": [mine.sum()],
                            "weight": [share.sum()],
                            "cost": [share @ distances[mine]],
                            "total": [share @ matrix[mine]],
                        }
                    )

    schema = "k int, label int, members bigint, weight double, cost double, total array<double>"
    sums = points.select("vector", "weight").mapInPandas(summarise, schema)
    scalars = ("members", "weight", "cost")
    rows = (
        sums.select("k", "label", *scalars, F.posexplode_outer("total").alias("axis", "x"))
        .groupBy("k", "label", "axis")
        .agg(*[F.sum(name).alias(name) for name in scalars], F.sum("x").alias("x"))
        .groupBy("k", "label")
        .agg(
            *[F.max(name).alias(name) for name in scalars],
            F.sort_array(F.collect_list(F.struct("axis", "x"))).alias("total"),
        )
        .collect()
    )
    return {
        (row["k"], row["label"]): Summary(
            row["members"], row["weight"], row["cost"],
            [axis["x"] / row["weight"] for axis in row["total"] if axis["axis"] is not None],
        )
        for row in rows
    }


@dataclass(frozen=True)
class Moments:
    """Weighted sums over a cluster's members, as seen from ``center``: of the vectors y, of
    |y|^2, |y|^4 and |y|^2 y, and of the products of any two axes."""

    center: np.ndarray
    weight: float
    first: np.ndarray
    square: float
    fourth: float
    third: np.ndarray
    products: np.ndarray

    @staticmethod
    def sums(vectors: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The sums of ``vectors``, already centered, as one row that adds up."""
        squares = (vectors * vectors).sum(axis=1)
        shares = weights * squares
        return np.concatenate([
            [weights.sum(), shares.sum(), shares @ squares], weights @ vectors, shares @ vectors,
            (vectors.T @ (weights[:, None] * vectors)).ravel(),
        ])

    @classmethod
    def of(cls, center: np.ndarray, row: np.ndarray) -> Moments:
        n = len(center)
        return cls(
            center, float(row[0]), row[3 : 3 + n], float(row[1]), float(row[2]),
            row[3 + n : 3 + 2 * n], row[3 + 2 * n :].reshape(n, n),
        )

    def bounds(self, points: np.ndarray) -> np.ndarray:
        """Least summed distance of ``points``; 0 where numbers are too large to tell."""
        y = points - self.center
        with np.errstate(all="ignore"):
            a = (y * y).sum(axis=1)
            second = self.weight * a + self.square - 2 * (y @ self.first)
            spread = 4 * ((y @ self.products) * y).sum(axis=1)
            plain = self.weight * a * a + self.fourth + spread + 2 * a * self.square
            mixed = 4 * a * (y @ self.first) + 4 * (y @ self.third)
            # what rounding may have taken from the fourth powers
            fourth = plain - mixed + 1e-9 * (np.abs(plain) + np.abs(mixed))
            least = np.maximum(second, 0) ** 1.5 / np.sqrt(fourth) * (1 - 1e-9)
        return np.where(np.isfinite(least), least, 0.0)


@dataclass
class Search:
    """What is known about one cluster's medoid: tried members, their sums, and the best one.

    ``left`` is the number of members that could still be the medoid when last counted.
    """

    summary: Summary
    vectors: np.ndarray
    sums: np.ndarray
    moments: Moments | None = None
    left: int | None = None

    @property
    def limit(self) -> float:
        """The best sum so far, and what rounding may add to it: a tie must stay open."""
        return float(self.sums.min()) * (1 + 1e-9) + 2 * 10.0 ** -(DECIMALS - 3)

    def bounds(self, points: np.ndarray) -> np.ndarray:
        """Least summed distance that each of ``points`` can have."""
        weight = self.summary.weight
        away = weight * _distances(points, np.array([self.summary.mean]))[:, 0]
        for vector, total in zip(self.vectors, self.sums, strict=True):
            gap = weight * _distances(points, vector[None])[:, 0]
            away = np.maximum(away, np.abs(total - gap))
        return away if self.moments is None else np.maximum(away, self.moments.bounds(points))

    def tried(self, vectors: Sequence, sums: Sequence[float]) -> None:
        self.vectors = np.vstack([self.vectors, np.array(vectors, dtype=np.float64)])
        self.sums = np.append(self.sums, sums)


def _lowest_bounds(
    points: DataFrame, fits: Mapping[int, Medoids], searches: Mapping[tuple[int, int], Search]
) -> tuple[dict[tuple[int, int], int], dict[tuple[int, int], list]]:
    """Per cluster, how many members can still be the medoid, and ``TRIES`` of low bounds."""
    frozen = dict(searches)

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch["vector"])
            for k, medoids in fits.items():
                labels, _ = medoids.nearest(matrix)
                for label in np.unique(labels):
                    search = frozen[k, int(label)]
                    mine = np.flatnonzero(labels == label)
                    bounds = search.bounds(matrix[mine])
                    still = bounds <= search.limit
                    order = np.argsort(bounds[still], kind="stable")[:TRIES]
                    chosen = mine[still][order]
                    if not len(chosen):
                        continue
                    yield pd.DataFrame({
                        "k": k, "label": label, "left": still.sum(), "place": np.arange(len(chosen)),
                        "bound": bounds[still][order], "vector": list(batch["vector"].iloc[chosen]),
                    })

    schema = "k int, label int, left bigint, place int, bound double, vector array<double>"
    # per place in a batch, the lowest bound of all batches: TRIES rows a cluster, combined
    # before the shuffle; a batch tells how many members it has left in its first row
    rows = points.select("vector").mapInPandas(bound, schema).groupBy("k", "label", "place").agg(
        F.sum("left").alias("left"), F.min(F.struct("bound", "vector")).alias("lowest")
    ).collect()
    left: dict[tuple[int, int], int] = {}
    tries: dict[tuple[int, int], list] = {}
    for row in rows:
        key = row["k"], row["label"]
        left[key] = left.get(key, 0) + (row["left"] if row["place"] == 0 else 0)
        tries.setdefault(key, []).append(row["lowest"]["vector"])
    return left, tries


def _add_moments(
    points: DataFrame, fits: Mapping[int, Medoids], searches: Mapping[tuple[int, int], Search]
) -> bool:
    """Add the moments of every cluster to ``searches``; one linear pass, a row per task and cluster.

    Returns False, and adds none, where they would take more than ``MOMENT_NUMBERS``.
    """
    axes = max(len(search.summary.mean) for search in searches.values())
    if len(searches) * (axes + 2) ** 2 > MOMENT_NUMBERS:
        return False
    centers = {key: np.array(search.summary.mean) for key, search in searches.items()}

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            matrix, weights = _matrix(batch["vector"]), batch["weight"].to_numpy()
            for k, medoids in fits.items():
                labels, _ = medoids.nearest(matrix)
                for label in np.unique(labels):
                    key, mine = (k, int(label)), labels == label
                    row = Moments.sums(matrix[mine] - centers[key], weights[mine])
                    sums[key] = sums[key] + row if key in sums else row
        for (k, label), row in sums.items():
            yield pd.DataFrame({"k": [k], "label": [label], "sums": [row]})

    rows = points.select("vector", "weight").mapInPandas(add_up, "k int, label int, sums array<double>")
    placed = rows.select("k", "label", F.posexplode("sums").alias("place", "x"))
    added = placed.groupBy("k", "label", "place").agg(F.sum("x").alias("x"))
    lists = added.groupBy("k", "label").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("sums"))
    for row in lists.collect():
        key = row["k"], row["label"]
        searches[key].moments = Moments.of(centers[key], np.array([each["x"] for each in row["sums"]]))
    return True


def _try(
    points: DataFrame, fits: Mapping[int, Medoids], searches: Mapping[tuple[int, int], Search],
    tries: Mapping[tuple[int, int], list],
) -> None:
    """Add the summed distances of ``tries`` to ``searches``; one linear pass."""
    chosen = {key: np.array(vectors, dtype=np.float64) for key, vectors in tries.items() if vectors}

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            matrix, weights = _matrix(batch["vector"]), batch["weight"].to_numpy()
            for k, medoids in fits.items():
                labels, _ = medoids.nearest(matrix)
                for label in np.unique(labels):
                    vectors = chosen.get((k, int(label)))
                    if vectors is not None:
                        mine = labels == label
                        sums = weights[mine] @ _distances(matrix[mine], vectors)
                        yield pd.DataFrame({
                            "k": k, "label": label, "place": np.arange(len(sums)), "total": sums,
                        })

    sums = points.select("vector", "weight").mapInPandas(
        add_up, "k int, label int, place int, total double"
    )
    for row in sums.groupBy("k", "label", "place").agg(F.sum("total").alias("total")).collect():
        key = row["k"], row["label"]
        searches[key].tried([chosen[key][row["place"]]], [row["total"]])


def _members(
    points: DataFrame,
    fits: Mapping[int, Medoids],
    searches: Mapping[tuple[int, int], Search] | None = None,
) -> DataFrame:
    """Points with their (k, label). With ``searches``, only those that can be a medoid."""
    frozen = None if searches is None else dict(searches)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch["vector"])
            for k, medoids in fits.items():
                labels, _ = medoids.nearest(matrix)
                possible = np.ones(len(batch), dtype=bool)
                for label in np.unique(labels) if frozen is not None else ():
                    search = frozen[k, int(label)]
                    mine = labels == label
                    possible[mine] = search.bounds(matrix[mine]) <= search.limit
                yield batch.assign(k=k, label=labels)[possible]

    kind = points.schema["point_id"].dataType.simpleString()
    schema = f"point_id {kind}, vector array<double>, weight double, k int, label int"
    return points.select("point_id", "vector", "weight").mapInPandas(place, schema)


def _tile_costs(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """Each candidate's weighted distance to the members in this tile."""
    if left.empty or right.empty:
        costs = np.zeros(len(left))
    else:
        costs = _distances(_matrix(left["vector"]), _matrix(right["vector"])) @ right["weight"]
    return pd.DataFrame(
        {"k": key[0], "label": key[1], "point_id": left["point_id"], "cost": costs}
    )


def candidate_costs(
    candidates: DataFrame,
    members: DataFrame,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """``(k, label, point_id, cost)``: summed distance of each candidate to its cluster."""
    kind = candidates.schema["point_id"].dataType.simpleString()
    partial = reduce_tiles(
        candidates, members, ["k", "label"], "point_id", "point_id", _tile_costs,
        f"k int, label int, point_id {kind}, cost double", chunk_rows, sizes,
    )
    return partial.groupBy("k", "label", "point_id").agg(
        F.round(F.sum("cost"), DECIMALS - 3).alias("cost")
    )


def kmedoids_update(
    points: DataFrame, fits: Mapping[int, Medoids], chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """``(k, label, point_id, cost)``: the member with the least summed distance per cluster.

    ``points`` are weighted points. Members are ruled out by the bounds of :class:`Search`,
    at first those of the current medoid and of the mean; while more pairs than
    ``PAIRS_AT_ONCE`` are left and trying members still rules out more pairs than it compares,
    ``TRIES`` more of a cluster are tried, and when it no longer does, the clusters' moments
    bound them as well. The rest are compared with all members in tiles, so
    the result is exact whatever the bounds do. Ties go to the smaller id.
    """
    searches = open_searches(points, fits)
    narrow(points, fits, searches)
    sizes = local_table(
        points.sparkSession,
        [
            (k, label, each.summary.members if each.left is None else max(1, each.left), each.summary.members)
            for (k, label), each in searches.items()
        ],
        "k int, label int, lefts bigint, rights bigint",
    )
    candidates, members = _members(points, fits, searches), _members(points, fits)
    costs = candidate_costs(candidates, members, chunk_rows, sizes)
    best = F.min(F.struct("cost", "point_id")).alias("_best")
    return costs.groupBy("k", "label").agg(best).select(
        "k", "label", "_best.point_id", "_best.cost"
    )


def open_searches(
    points: DataFrame, fits: Mapping[int, Medoids]
) -> dict[tuple[int, int], Search]:
    """One search per cluster; the current medoid counts as tried."""
    return {
        (k, label): Search(summary, fits[k].vectors[[label]], np.array([summary.cost]))
        for (k, label), summary in _summaries(points, fits).items()
    }


def narrow(
    points: DataFrame, fits: Mapping[int, Medoids], searches: Mapping[tuple[int, int], Search],
    pairs_at_once: int | None = None,
) -> list[int]:
    """Try members while it pays, then use the moments; returns the pairs left before each round."""
    most = PAIRS_AT_ONCE if pairs_at_once is None else pairs_at_once
    pairs: list[int] = []
    if sum(each.summary.members ** 2 for each in searches.values()) <= most:
        return pairs
    asked = False
    while True:
        left, tries = _lowest_bounds(points, fits, searches)
        for key, n in left.items():
            searches[key].left = n
        pairs.append(sum(n * searches[key].summary.members for key, n in left.items()))
        # distances that another round takes, to the tried members and to the new ones
        cost = sum(each.summary.members * (len(each.sums) + TRIES) for each in searches.values())
        if pairs[-1] <= most:
            return pairs
        if len(pairs) == 1 or pairs[-2] - pairs[-1] >= cost:
            _try(points, fits, searches, tries)
        elif asked or not _add_moments(points, fits, searches):
            return pairs
        else:
            asked = True


def farthest_first(points: DataFrame, count: int) -> list[tuple]:
    """``count`` seed points: the one with the smallest MD5 of its id, then always the farthest one.

    One pass per seed; a batch returns only its farthest point. Fewer seeds come
    back when there are fewer distinct points.
    """
    first = points.agg(
        F.min(F.struct(F.md5(F.col("point_id").cast("string")).alias("hash"), "point_id", "vector"))
        .alias("seed")
    ).first()["seed"]
    if first is None:
        raise ValueError("no points to cluster")
    seeds = [(first["point_id"], first["vector"])]
    kind = points.schema["point_id"].dataType.simpleString()
    while len(seeds) < count:
        chosen = np.array([vector for _, vector in seeds], dtype=np.float64)

        def farthest(batches: Iterator[pd.DataFrame], chosen=chosen) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    ordered = batch.sort_values("point_id", ignore_index=True)
                    gaps = np.round(_distances(_matrix(ordered["vector"]), chosen), DECIMALS)
                    yield ordered.assign(gap=gaps.min(axis=1)).nlargest(1, "gap", keep="first")

        far = points.select("point_id", "vector").mapInPandas(
            farthest, f"point_id {kind}, vector array<double>, gap double"
        )
        pick = far.agg(
            F.min(F.struct((-F.col("gap")).alias("order"), "point_id", "vector")).alias("pick")
        ).first()["pick"]
        if pick["order"] == 0:
            break
        seeds.append((pick["point_id"], pick["vector"]))
    return seeds


@dataclass(frozen=True)
class Fit:
    """A fitted clustering: its medoids and the summed distance to them."""

    medoids: Medoids
    inertia: float
    history: tuple[float, ...]
    converged: bool = True


def kmedoids_fit(
    points: DataFrame,
    ks: Sequence[int] = (FINAL_K,),
    max_iterations: int | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> dict[int, Fit]:
    """Alternate assignment and medoid search for every k until no medoid moves.

    ``points`` are weighted points; they are materialised once. Seeds of a smaller
    k are the first seeds of the largest. A k above the number of distinct points
    takes them all. A fit also ends when its cost no longer falls, so equal costs cannot
    make it alternate for ever. ``max_iterations`` is for callers who accept a fit that has
    not converged; ``Fit.converged`` tells.
    """
    stored = materialise(points)
    seeds = farthest_first(stored, max(ks))
    fits = {k: Medoids.of(seeds[:k]) for k in ks}
    history: dict[int, list[float]] = {k: [] for k in ks}
    active = dict(fits)
    done = 0
    while active and (max_iterations is None or done < max_iterations):
        done += 1
        rows = kmedoids_update(stored, active, chunk_rows).collect()
        chosen = stored.where(F.col("point_id").isin({row["point_id"] for row in rows}))
        vectors = {row["point_id"]: row["vector"] for row in chosen.collect()}
        moved = {}
        for k, medoids in active.items():
            found = [(row["point_id"], vectors[row["point_id"]]) for row in rows if row["k"] == k]
            history[k].append(round(sum(row["cost"] for row in rows if row["k"] == k), 6))
            fits[k] = Medoids.of(found)
            falls = len(history[k]) < 2 or history[k][-1] < history[k][-2]
            if fits[k].ids != medoids.ids and falls:
                moved[k] = fits[k]
        active = moved
    costs: dict[int, float] = dict.fromkeys(ks, 0.0)
    for (k, _label), summary in _summaries(stored, fits).items():
        costs[k] += summary.cost
    return {k: Fit(fits[k], costs[k], tuple(history[k]), k not in active) for k in ks}


def elbow_inertia(points: DataFrame, ks: Sequence[int] = ELBOW_KS) -> DataFrame:
    """``(k, inertia)`` of a fit for every k."""
    fits = kmedoids_fit(points, ks)
    curve = [(k, float(fit.inertia)) for k, fit in sorted(fits.items())]
    return local_table(points.sparkSession, curve, "k bigint, inertia double")


def cluster_sizes(df: DataFrame, label: str) -> DataFrame:
    """Number of rows per label."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
