"""Steps that split hot groups, against brute force on small data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kindred.operators import clustering as C
from kindred.operators import matching as M
from kindred.operators import tiles
from kindred.operators import ranking as R
from kindred.operators.numbering import number_rows
from kindred.operators.tiles import reduce_tiles
from kindred.plans.catalogue import match_pipeline


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- numbering ------------------------------------------------------------------------


@pytest.mark.parametrize("groups", [1, 7])
def test_number_rows_equals_a_window(spark, groups):
    df = spark.range(5000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % groups).alias("g"),
        (F.col("id") % 11).alias("s"),
    )
    numbered = number_rows(df, [F.col("s").desc(), F.col("id")], ["g"], "n").toPandas()
    expected = df.toPandas().sort_values(["g", "s", "id"], ascending=[True, False, True])
    expected["n"] = expected.groupby("g").cumcount() + 1
    merged = numbered.merge(expected, on=["id", "g", "s"])
    assert len(merged) == 5000 and (merged["n_x"] == merged["n_y"]).all()


def test_number_rows_without_groups_and_with_null_group(spark):
    df = spark.createDataFrame([(3, None), (1, None), (2, "a")], "id int, g string")
    assert rows(number_rows(df, [F.col("id")], (), "n"), "id", "n") == [(1, 1), (2, 2), (3, 3)]
    assert rows(number_rows(df, [F.col("id")], ["g"], "n"), "id", "n") == [(1, 1), (2, 1), (3, 2)]


# --- tiles ------------------------------------------------------------------------------


def test_tiles_visit_every_pair_once_in_bounded_chunks(spark):
    left = spark.range(300).select("id", F.when(F.col("id") < 200, 1).otherwise(2).alias("k"))
    right = spark.range(250).select("id", F.when(F.col("id") < 240, 1).otherwise(3).alias("k"))

    def count(key, a, b):
        return pd.DataFrame({"k": [key[0]], "pairs": [len(a) * len(b)], "big": [max(len(a), len(b))]})

    tiles = reduce_tiles(left, right, ["k"], "id", "id", count, "k int, pairs bigint, big int", 50)
    result = tiles.groupBy("k").agg(F.sum("pairs"), F.max("big"), F.count("*")).collect()
    totals = {r[0]: r for r in result}
    assert totals[1][1] == 200 * 240 and totals[1][2] < 100 and totals[1][3] == 4 * 5
    assert sum(r[1] for r in result if r[0] != 1) == 0


# --- matching ---------------------------------------------------------------------------


def catalogue(spark, seed, count, brands, copies=0):
    rng = np.random.default_rng(seed)
    words = ["rose", "musk", "oud", "iris", "amber"]
    data = []
    for i in range(count):
        vector = [1.0, 1.0, 0.0, 0.0] if i < copies else rng.integers(-2, 3, 4).astype(float).tolist()
        name = " ".join(rng.choice(words, 2)) + " Eau de Parfum 50ml"
        # brand 0 is hot
        brand = brands[0] if i % 3 == 0 else brands[int(rng.integers(len(brands)))]
        data.append((f"p{i:04d}", brand, name, vector))
    return spark.createDataFrame(data, "id string, brand string, name string, vector array<double>")


def brute_force(internal, external, threshold):
    def cleaned(name, sizes):
        tokens = set((name or "").lower().replace("eau de parfum", "").split(" ")) - {""}
        return {t for t in tokens if not (sizes and t == "50ml")}

    def cosine(a, b):
        lengths = np.linalg.norm(a) * np.linalg.norm(b)
        return round(float(np.dot(a, b) / lengths), 12) if lengths else 0.0

    best = {}
    for left in internal:
        found = []
        for right in external:
            if (left["brand"] or "").upper() != (right["company"] or "").upper():
                continue
            if cleaned(left["name"], True) & cleaned(right["name"], False):
                found.append((-cosine(left["vector"], right["vector"]), right["id"]))
        if found and -min(found)[0] >= threshold:
            best[left["id"]] = (min(found)[1], round(-min(found)[0], 9))
    return best


@pytest.mark.parametrize("chunk_rows", [16, 4096])
def test_matching_equals_brute_force(spark, chunk_rows):
    brands = ["Hot", "cold", "", None]
    internal = catalogue(spark, 1, 120, brands)
    external = catalogue(spark, 2, 150, [b and b.upper() for b in brands], copies=60)
    external = external.withColumnRenamed("brand", "company")
    left = M.catalogue_side(internal, "id", "brand", "name", "vector", True)
    right = M.catalogue_side(external, "id", "company", "name", "vector")
    matched = M.match_catalogues(left, right, 0.9, chunk_rows)
    ours = {r["left_id"]: (r["right_id"], round(r["vector_sim"], 9)) for r in matched.collect()}
    theirs = brute_force(internal.collect(), external.collect(), 0.9)
    # sides keep '50ml' only outside, so the shared size never counts as a name token
    assert ours == theirs and len(ours) > 30


def side(spark, data, brand):
    schema = f"id string, {brand} string, name string, vector array<double>"
    return spark.createDataFrame(data, schema)


def test_match_rules(spark):
    internal = side(spark, [
        ("a", "b1", "rose night", [1.0, 0.0]), ("c", "B1", "oud", [1.0, 0.0]),
        ("d", None, "rose", [1.0, 0.0]), ("e", "b1", "musk", [0.0, 0.0]),
        ("f", "b1", "iris", [1.0, 0.0]), ("g", "none", "rose", [1.0, 0.0]),
    ], "brand")
    external = side(spark, [
        ("1", "B1", "tulip", [1.0, 0.0]),        # best vector, no shared token
        ("2", "B1", "rose", [0.9, 0.1]), ("3", "b1", "Rose", [0.9, 0.1]),  # tie
        ("4", "B1", "oud", [0.9, float(np.sqrt(1 - 0.81))]),  # exactly the threshold
        ("5", "", "rose", [2.0, 0.0]), ("6", "B1", "musk", [1.0, 0.0]),
        ("7", "B1", "iris", [0.5, 0.8]),
    ], "company")
    matched = {r["id"]: r["match_id"] for r in match_pipeline(internal, external).collect()}
    assert matched == {"a": "2", "c": "4", "d": "5"}
    without_blank = match_pipeline(internal, external, match_blank=False)
    assert rows(without_blank, "id") == [("a",), ("c",)]
    aliases = spark.createDataFrame([("B1", "none"), ("B1", "other")], "company string, brand string")
    aliased = match_pipeline(internal, external, aliases)
    assert ("g", "none", "2") in rows(aliased, "id", "brand", "match_id")
    # aliases that fan out, repeated aliases and repeated products: still one row per product
    fanned = spark.createDataFrame(
        [("B1", "b1"), ("B1", "none"), ("B1", "none"), ("b1", "b1")], "company string, brand string"
    )
    found = match_pipeline(internal.unionByName(internal), external, fanned).select("id", "match_id")
    ids = [r["id"] for r in found.collect()]
    assert "a" in ids and "g" in ids and len(ids) == len(set(ids))


def test_nearest_without_name_or_threshold(spark):
    internal = side(spark, [("a", "x", "p", [1.0, 0.0])], "brand")
    external = side(spark, [("1", "x", "q", [-1.0, 0.0]), ("2", "x", "q", [0.0, 1.0])], "company")
    best = M.nearest_in_block(
        M.catalogue_side(internal, "id", "brand", "name", "vector"),
        M.catalogue_side(external, "id", "company", "name", "vector"), share_token=False,
    )
    assert rows(best, "*") == [("a", "2", 0.0)]


def test_names_are_those_of_the_rows_that_matched(spark):
    schema = "id string, brand string, name string, vector array<double>"
    internal = spark.createDataFrame(
        [("p", "b", "rose water", [1.0, 0.0]), ("p", "b", "plum", [1.0, 0.0])], schema
    )
    external = spark.createDataFrame(
        [("x", "b", "amber oil", [1.0, 0.0]), ("x", "b", "rose water", [1.0, 0.0]),
         ("y", "b", "rose", [0.9, 0.1])], schema.replace("brand", "company"),
    )
    found = match_pipeline(internal, external).collect()
    assert [tuple(row) for row in found] == [
        ("p", "b", "rose water", "x", "rose water", 1.0, 1.0)
    ]


def test_tiles_below_the_threshold_are_not_built(spark):
    """Four tight directions: only cells of one direction can hold a match."""
    rng = np.random.default_rng(3)
    data = [np.eye(4)[i % 4] + rng.normal(0, 0.02, 4) for i in range(400)]
    schema = "id int, brand_key string, vector array<double>"
    both = [
        spark.createDataFrame([(i, "hot", v.tolist()) for i, v in enumerate(data) if i % 2 == odd], schema)
        for odd in (0, 1)
    ]
    pivots = tiles.pivot_vectors(both[1].unionByName(both[0]), "id", "vector")
    placed = [tiles.with_angles(side, "vector", pivots) for side in both]
    every = tiles.near_cells(*placed, ["brand_key"], None, len(pivots), 64).count()
    near = tiles.near_cells(*placed, ["brand_key"], 0.9, len(pivots), 64).collect()
    assert len(near) < every / 2
    allowed = {(row["_lcell"], row["_rcell"]) for row in near}
    cells = [{r["id"]: r["_cell"] for r in side.collect()} for side in placed]
    unit = np.array(data) / np.linalg.norm(data, axis=1, keepdims=True)
    for a, left in cells[0].items():
        for b, right in cells[1].items():
            assert unit[a] @ unit[b] < 0.9 or (left, right) in allowed


def test_hot_and_blank_brands_equal_brute_force(spark):
    rng = np.random.default_rng(12)
    words = ["oud", "rose", "musk", "amber", "sea", "salt"]

    def side(start, count):
        return [
            (start + i, ["hot", "hot", "", None, "Rare"][i % 5],
             " ".join(rng.choice(words, rng.integers(0, 3), replace=False)),
             rng.integers(-2, 3, 3).astype(float).tolist())
            for i in range(count)
        ]

    left, right = side(0, 160), side(1000, 170)
    schema = "id int, brand string, name string, vector array<double>"
    sides = [
        M.catalogue_side(spark.createDataFrame(rows_, schema).repartition(3), "id", "brand", "name", "vector")
        for rows_ in (left, right)
    ]
    found = {r["left_id"]: (r["right_id"], round(r["sim"], 9))
             for r in M.nearest_in_block(*sides, 0.5, True, 16).collect()}
    expected = {}
    for i, brand, name, vector in left:
        options = []
        for j, other, theirs, partner in right:
            lengths = np.linalg.norm(vector) * np.linalg.norm(partner)
            sim = np.dot(vector, partner) / lengths if lengths else 0.0
            if (brand or "").lower() == (other or "").lower() and set(name.split()) & set(theirs.split()):
                if round(sim, 12) >= 0.5:
                    options.append((-round(sim, 12), j))
        if options:
            sim, j = min(options)
            expected[i] = (j, round(-sim, 9))
    assert found == expected


def test_matching_plan_has_no_pairs(spark):
    internal = catalogue(spark, 1, 30, ["A", "B"])
    external = internal.withColumnRenamed("brand", "company")
    plan = match_pipeline(internal, external)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# --- ranking ----------------------------------------------------------------------------

EDGES = "source int, sim int, bert_sim double, accord_sim double, season_sim double, note_sim double"


def test_ranks(spark):
    members = spark.createDataFrame(
        [(1, "c", 1), (2, "c", None), (3, "c", None), (4, "c", None), (1, "d", None), (9, "d", None)],
        "id int, cluster string, rank int",
    )
    edges = spark.createDataFrame([
        (1, 1, 1.0, 1.0, 1.0, 1.0), (2, 1, 0.5, 0.5, 0.5, 0.5), (2, 1, 0.5, 0.5, 0.5, 0.5),
        (3, 1, 0.5, 0.5, 0.5, 0.5), (9, 1, None, 0.1, 0.1, 0.1),
    ], EDGES)
    ranks = R.multi_segment_rank(members, edges, None)
    assert rows(ranks, "cluster", "rank", "id") == [
        ("c", 1, 1), ("c", 2, 2), ("c", 3, 3), ("d", 1, 1), ("d", 2, 9),
    ]
    output = members.withColumn("x", F.lit("y"))
    assert rows(R.rank_join_back(output, ranks), "id", "cluster", "rank") == [
        (1, "c", 1), (1, "d", 1), (2, "c", 2), (3, "c", 3), (9, "d", 2),
    ]
    assert R.rank_join_back(output, ranks, on_id_only=True).columns == ["id", "cluster", "x", "rank"]
    report = R.sort_report(ranks, ["cluster", "rank", "id"]).collect()
    assert [r["id"] for r in report] == [1, 2, 3, 1, 9]


def test_id_only_join_fans_out(spark):
    output = spark.createDataFrame([(1, "c", None), (1, "d", None)], "id int, cluster string, rank int")
    ranks = spark.createDataFrame([(1, "c", 1), (1, "d", 2)], "id int, cluster string, rank int")
    assert R.rank_join_back(output, ranks, on_id_only=True).count() == 4
    assert R.rank_join_back(output, ranks).count() == 2


def test_representative_prefers_flagged_members(spark):
    members = spark.createDataFrame(
        [(i, "c", 1 if i in (5, 6) else None) for i in range(10)] + [(i, "d", None) for i in range(10)],
        "id int, cluster string, rank int",
    )
    picks = [
        {r["cluster"]: r["representative"] for r in R.pick_representative(members, seed).collect()}
        for seed in range(8)
    ]
    assert {p["c"] for p in picks} == {5, 6} and len({p["d"] for p in picks}) > 2


def test_native_score_equals_the_batched_function(spark):
    edges = spark.range(50).select(
        *[F.rand(seed).alias(name) for seed, name in enumerate(R.SCORE_WEIGHTS)]
    )
    both = edges.select(
        R.weighted_score().alias("a"), R.weighted_score_udf()(*R.SCORE_WEIGHTS).alias("b")
    ).collect()
    assert all(r["a"] == r["b"] for r in both)
    plan = edges.select(R.weighted_score())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


# --- k-medoids ---------------------------------------------------------------------------


def points_of(spark, data):
    return spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(data)],
        "point_id int, vector array<double>",
    )


def test_two_groups_and_an_outlier(spark):
    data = [(0, 0), (0, 1), (1, 0), (0, 0), (10, 10), (10, 11), (11, 10), (40, 40)]
    vectors = points_of(spark, data)
    points = C.weighted_points(vectors)
    fits = C.kmedoids_fit(points, (1, 2, 3, 7))
    assert fits[3].inertia == pytest.approx(4.0)
    assert set(fits[3].medoids.ids) == {0, 4, 7}
    assert fits[7].inertia == 0
    assert fits[1].inertia >= fits[2].inertia >= fits[3].inertia
    for fit in fits.values():
        assert list(fit.history) == sorted(fit.history, reverse=True)
    assigned = C.kmedoids_assign(vectors, fits[3].medoids)
    assert rows(assigned.where("point_id in (3, 7)"), "point_id", "medoid_id") == [(3, 0), (7, 7)]


def test_more_clusters_than_points(spark):
    points = C.weighted_points(points_of(spark, [(0, 0), (1, 1), (1, 1)]))
    fits = C.kmedoids_fit(points, (1, 4))
    assert fits[4].inertia == 0 and len(fits[4].medoids.ids) == 2
    assert rows(C.elbow_inertia(points, (1, 2)), "k") == [(1,), (2,)]


@pytest.mark.parametrize("chunk_rows", [13, 4096])
def test_update_equals_brute_force(spark, chunk_rows):
    rng = np.random.default_rng(5)
    data = np.concatenate([rng.integers(0, 12, (150, 3)), rng.integers(0, 3, (60, 3))])
    vectors = points_of(spark, data.tolist())
    points = C.weighted_points(vectors)
    stored = points.orderBy("point_id").collect()
    medoids = C.Medoids.of([(r["point_id"], r["vector"]) for r in stored[:3]])
    result = C.kmedoids_update(points, {3: medoids}, chunk_rows).collect()
    matrix = np.array([r["vector"] for r in stored])
    weights = np.array([r["weight"] for r in stored])
    ids = np.array([r["point_id"] for r in stored])
    labels, _ = medoids.nearest(matrix)
    assert len(result) == len(set(labels))
    for row in result:
        mine = np.flatnonzero(labels == row["label"])
        gaps = np.sqrt(((matrix[mine, None] - matrix[None, mine]) ** 2).sum(axis=2))
        costs = np.round(gaps @ weights[mine], 6)
        winner = min(zip(costs, ids[mine], strict=True))
        assert (row["cost"], row["point_id"]) == (pytest.approx(winner[0]), winner[1])


def test_bounds_leave_few_members_and_the_right_one(spark, monkeypatch):
    """Two dimensions: a few tried members rule out nearly all others; the medoid is exact."""
    rng = np.random.default_rng(9)
    data = np.concatenate([rng.normal(size=(1500, 2)), rng.normal(6, 2, size=(500, 2))])
    points = C.weighted_points(points_of(spark, data.tolist())).repartition(6)
    medoids = C.Medoids.of([(0, data[0].tolist()), (1999, data[1999].tolist())])
    fits = {2: medoids}
    searches = C.open_searches(points, fits)
    pairs = C.narrow(points, fits, searches, pairs_at_once=0)
    assert len(pairs) > 2 and pairs[-1] < pairs[0] / 2
    labels, _ = medoids.nearest(data)
    possible = {row["point_id"] for row in C._members(points, fits, searches).collect()}
    for label in (0, 1):
        mine = np.flatnonzero(labels == label)
        costs = C._distances(data[mine], data[mine]).sum(axis=1)
        search = searches[2, label]
        assert (search.bounds(data[mine]) <= costs + 1e-6).all()
        assert mine[costs.argmin()] in possible
        assert len(possible & set(mine.tolist())) < len(mine) / 2
    monkeypatch.setattr(C, "PAIRS_AT_ONCE", 0)
    found = {row["label"]: row["point_id"] for row in C.kmedoids_update(points, fits).collect()}
    for label, point in found.items():
        mine = np.flatnonzero(labels == label)
        assert point == mine[C._distances(data[mine], data[mine]).sum(axis=1).argmin()]


def test_fit_is_repeatable(spark):
    rng = np.random.default_rng(6)
    points = C.weighted_points(points_of(spark, rng.normal(size=(200, 4)).tolist()))
    one = C.kmedoids_fit(points, (4,))[4]
    two = C.kmedoids_fit(points.repartition(7), (4,), chunk_rows=32)[4]
    assert one.medoids.ids == two.medoids.ids and one.inertia == pytest.approx(two.inertia)


def test_moments_rule_out_members_when_distances_hardly_differ(spark, monkeypatch):
    """Many axes: distances concentrate and tried members bound nothing; moments do."""
    rng = np.random.default_rng(11)
    data = rng.normal(size=(600, 40))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    data[:4] = rng.normal(size=(4, 40)) * 0.05  # near the middle
    vectors = points_of(spark, data.tolist()).unionByName(points_of(spark, data[:200].tolist()))
    points = C.weighted_points(vectors).repartition(5)
    fits = {1: C.Medoids.of([(9, data[9].tolist())])}
    searches = C.open_searches(points, fits)
    pairs = C.narrow(points, fits, searches, pairs_at_once=0)
    weights = np.where(np.arange(600) < 200, 2.0, 1.0)
    costs = C._distances(data, data) @ weights
    assert (searches[1, 0].bounds(data) <= costs + 1e-6).all()
    assert pairs[0] == 600 * 600 and pairs[-1] <= 600 * 6 and searches[1, 0].left <= 6
    monkeypatch.setattr(C, "PAIRS_AT_ONCE", 0)
    found = C.kmedoids_update(points, fits).collect()
    assert [(row["label"], row["point_id"]) for row in found] == [(0, costs.argmin())]
    assert found[0]["cost"] == pytest.approx(costs.min())


def test_moments_never_exceed_the_sums():
    rng = np.random.default_rng(3)
    for data in (rng.normal(size=(80, 3)), np.zeros((5, 2)), rng.normal(size=(50, 4)) ** 9,
                 rng.normal(size=(40, 2)) + 1e6, rng.normal(size=(30, 2)) * 1e90):
        weights = rng.integers(1, 9, len(data)).astype(float)
        center = weights @ data / weights.sum()
        moments = C.Moments.of(center, C.Moments.sums(data - center, weights))
        with np.errstate(all="ignore"):
            sums = C._distances(data, data) @ weights
        assert (moments.bounds(data) <= sums * (1 + 1e-9)).all()
