"""Edge cases of taxonomy, table, feature, segment and profile steps."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from kindred.operators import features as FE
from kindred.operators import profiles as P
from kindred.operators import segments as S
from kindred.operators import tables as T
from kindred.operators import taxonomy as X
from kindred.operators.catalog import region_pivot

GROUPS = {"light": ["citrus", "mint"], "warm": ["amber", "mint"]}


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def taxonomy(spark):
    return X.taxonomy_table(spark, "t", GROUPS)


def test_lookup_takes_the_first_group_and_is_exact(spark, taxonomy):
    df = spark.createDataFrame(
        [(1, "mint"), (2, "Mint"), (3, None), (4, "amber")], "id int, t string"
    )
    found = X.taxonomy_lookup(df, taxonomy, "t", "g")
    assert rows(found, "id", "g") == [(1, "light"), (2, None), (3, None), (4, "warm")]
    assert rows(X.taxonomy_lookup(df, taxonomy, "t", "t"), "id", "t")[0] == (1, "light")


def test_unreachable_family_needs_no_special_case(spark, taxonomy):
    families = X.taxonomy_table(spark, "f", {"one": ["light", "citrus"], "two": ["light"]})
    df = spark.createDataFrame([(1, "citrus"), (2, "amber")], "id int, t string")
    assert rows(X.two_level_lookup(df, taxonomy, families, "t", "f"), "id", "f") == [
        (1, "one"), (2, None),
    ]


def test_merge_keeps_places_and_does_not_alias(spark, taxonomy):
    more = X.taxonomy_table(spark, "m", {"new": ["citrus"], "light": ["rose"]})
    merged = X.taxonomy_merge(taxonomy, more, "both")
    assert rows(merged.select("group", "group_pos").distinct(), "group_pos", "group") == [
        (0, "light"), (1, "warm"), (2, "new"),
    ]
    assert merged.where("group = 'light'").count() == 3
    assert taxonomy.count() == 4
    assert rows(X.first_groups(merged).where("term = 'citrus'"), "group") == [("light",)]


def test_unmapped_terms_and_groups(spark, taxonomy):
    df = spark.createDataFrame([("mint",), ("x",), ("x",), (None,)], "t string")
    assert rows(X.unmapped_terms(df, taxonomy, "t"), "term") == [("",), ("x",)]
    assert rows(X.groups_seen(df, taxonomy, "t"), "group") == [("",), ("light",)]


def test_replicate_membership(spark, taxonomy):
    spread = X.replicate_membership(taxonomy, ["warm"])
    assert rows(spread, "group", "term") == [
        ("light", "amber"), ("light", "citrus"), ("light", "mint"),
    ]


def test_cluster_merge_leaves_others(spark):
    df = spark.createDataFrame([("a_1",), ("b",), (None,)], "c string")
    merges = X.taxonomy_table(spark, "m", {"a": ["a_1", "a_2"]})
    assert rows(X.cluster_merge(df, merges, "c", "n"), "c", "n") == [
        ("a_1", "a"), ("b", "b"), (None, None),
    ]


NOTES = [
    (1, []), (2, None), (3, ["citrus"]), (4, ["x"]), (5, ["citrus", "citrus"]),
    (6, ["citrus", "x"]), (7, ["mint", "amber"]), (8, ["Citrus"]),
]


def test_multi_hot_plain_and_strict(spark, taxonomy):
    df = spark.createDataFrame(NOTES, "id int, n array<string>")
    plain = FE.multi_hot_grouped(df, "id", "n", taxonomy, ["light", "warm"])
    assert rows(plain, "id", "n_light", "n_warm") == [
        (1, 0, 0), (2, 0, 0), (3, 1, 0), (4, 0, 0), (5, 1, 0), (6, 1, 0), (7, 1, 1), (8, 0, 0),
    ]
    strict = FE.multi_hot_grouped(df, "id", "n", taxonomy, ["light", "warm"], strict=True)
    assert rows(strict, "id", "n_light", "n_warm") == [
        (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 0, 0), (5, 1, 0), (6, 1, 0), (7, 1, 1), (8, 0, 0),
    ]


def test_note_levels_mark_unmapped_terms(spark, taxonomy):
    families = X.taxonomy_table(spark, "f", {"L": ["light"]})
    df = spark.createDataFrame(NOTES, "id int, n array<string>")
    levels = {r["id"]: r for r in X.note_levels(df, taxonomy, families, "id", "n").collect()}
    assert levels[6]["note_groups"] == ["light", None]
    assert levels[7]["note_groups"] == ["light", "warm"] and levels[7]["note_families"] == ["L"]
    assert levels[1]["note_groups"] == [] and levels[2]["note_families"] == []


def test_one_hot_labels_with_odd_characters(spark):
    df = spark.createDataFrame(
        [(1, 'a "b" \'c\''), (2, "d-e (f)"), (3, ""), (4, None)], "id int, b string"
    )
    hot = FE.one_hot(df, "id", "b", prefix="brand_")
    assert hot.columns == ["id", 'brand_a_"b"_\'c\'', "brand_d-e_(f)"]
    assert rows(hot, "*") == [(1, 1, 0), (2, 0, 1)]


def test_one_hot_explode(spark):
    df = spark.createDataFrame(NOTES, "id int, n array<string>")
    hot = FE.one_hot_explode(df, "id", "n", prefix="n_")
    assert hot.columns == ["id", "n_Citrus", "n_amber", "n_citrus", "n_mint", "n_x"]
    assert rows(hot.where("id = 6"), "*") == [(6, 0, 0, 1, 0, 1)]


def test_scaling(spark):
    df = spark.createDataFrame([(1, 1.0, 0, None), (2, 3.0, 0, 4), (3, 5.0, 0, 6)],
                               "id int, a double, b int, c int")
    scaled = {r["id"]: r for r in FE.standardize(df, ["a", "b", "c"]).collect()}
    assert scaled[1]["a"] == pytest.approx(-1.224744871) and scaled[2]["a"] == 0
    assert {r["b"] for r in scaled.values()} == {0.0}
    assert scaled[1]["c"] == 0 and scaled[2]["c"] == pytest.approx(-1)
    ratios = {r["feature"]: r["zero_ratio"] for r in FE.zero_ratio(df, ["a", "b", "c"]).collect()}
    assert ratios == {"a": 0.0, "b": 1.0, "c": pytest.approx(1 / 3)}
    assert FE.drop_sparse(df, ["a", "b", "c"], 0.9) == ["a", "c"]
    assert FE.drop_sparse(df, ["a", "b"], None) == ["a", "b"]


def test_table_steps(spark):
    df = spark.createDataFrame(
        [(1, 5.0, "b"), (1, 5.0, "a"), (1, 4.0, "c"), (2, 1.0, "d")], "id int, s double, k string"
    )
    assert rows(T.group_max_filter(df, ["id"], "s"), "k") == [("a",), ("b",), ("d",)]
    first = T.dedupe_first(df, ["id"], [-F.col("s"), F.col("k")])
    assert rows(first, "id", "k") == [(1, "a"), (2, "d")]
    assert T.normalize_columns(df.toDF("a b", "c", "d e f")).columns == ["a_b", "c", "d_e_f"]
    assert T.prefix_columns(df, "p_", ["id"]).columns == ["id", "p_s", "p_k"]
    assert T.ensure_column(df, "k").columns == df.columns
    assert T.anti_join(df, None, "id").count() == 4


def test_safe_int_cast(spark):
    df = spark.createDataFrame([("12.99",), ("-12.99",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(T.safe_int_cast(F.col("t"))).collect()] == [12, -12, 0, 0]


def test_alias_join_may_fan_out(spark):
    products = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "id int, company string")
    aliases = spark.createDataFrame([("A", "x"), ("A", "y")], "a string, brand string")
    joined = T.left_join_alias(products, aliases, "company", "a", "brand")
    assert rows(joined, "id", "brand") == [(1, "x"), (1, "y"), (2, None), (3, None)]


def test_region_pivot(spark):
    feed = spark.createDataFrame(
        [("p", "cn", 1, 7.9), ("p", "cn", 0, 5.5), ("p", "hk", 0, None), ("q", "zz", 0, 1.0)],
        "sku string, region string, o int, stock double",
    )
    pivoted = region_pivot(feed, "sku", "region", {"stock": "stock"}, ["o"])
    assert rows(pivoted, "sku", "stock_cn", "stock_hk", "stock_row") == [
        ("p", 5, 0, 0), ("q", 0, 0, 0),
    ]


def test_review_sample_is_exact_and_repeatable(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    one, two = (T.review_sample(df, "k", 30, seed=4).orderBy("draw").collect() for _ in range(2))
    assert one == two and [r["draw"] for r in one] == list(range(30))
    assert len({r["k"] for r in one}) > 15


def test_set_intersection(spark):
    sets = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 1), ("b", "y", 1), ("a", "x", 2), ("b", "z", 2)],
        "dimension string, label string, id int",
    )
    assert rows(T.set_intersection_join(sets, {"a": "x", "b": "y"}, "id"), "id") == [(1,)]


# --- segments and profiles ------------------------------------------------------------

LABELS = "id int, brand string, family string, season string, note_families array<string>"


def test_segments_need_all_three_labels(spark):
    labels = spark.createDataFrame(
        [
            (1, "A", "floral", "SS", ["n1", "n2"]), (2, "A", None, "SS", ["n1"]),
            (3, "B", "floral", "AW", []), (4, "B", "citrus", "AW", None),
        ],
        LABELS,
    )
    assert rows(S.rule_segments(labels), "id", "cluster") == [
        (1, "floral_SS_n1"), (1, "floral_SS_n2"),
    ]
    assert len(rows(S.segment_combinations(labels), "season", "note_family")) == 4


def test_categories(spark):
    labels = spark.createDataFrame(
        [(i, brand, "f", "SS", ["n"]) for i, brand in enumerate(["Á", "b", "c", "d", "e", "zz"])],
        LABELS,
    )
    categories = spark.createDataFrame(
        [("a", "niche "), ("B", ""), ("c", None), ("D", "x_y"), ("é", "q")],
        "brand string, category string",
    )
    tagged = S.segment_with_category(S.rule_segments(labels), labels, categories)
    assert rows(tagged, "id", "cluster", "category") == [
        (0, "f_SS_n_niche ", "niche"), (1, "f_SS_n_", ""), (2, "f_SS_n_", ""),
        (3, "f_SS_n_x_y", "x_y"), (4, "f_SS_n_q", "q"),
    ]
    assert rows(S.relabel_members(tagged), "id", "cluster")[3] == (3, "f_SS_x")
    ratio = S.null_ratio(S.left_join_category(labels, "brand", categories), "category").first()
    assert (ratio["nulls"], ratio["total"]) == (1, 6) and ratio["percent"] == pytest.approx(100 / 6)
    assert S.null_ratio(labels.limit(0), "brand").first()["percent"] is None


PROFILE_LABELS = (
    "id int, for_gender string, note_groups array<string>, accord_group string, day_night string,"
    " season string, sillage_label string, longevity_label string"
)


@pytest.fixture(scope="module")
def profiled(spark):
    labels = spark.createDataFrame(
        [
            (1, "f", ["g", None], "a", "day", "SS", "s", "l"),
            (2, "m", ["g"], None, "day", "SS", "s", "l"),
            (3, "m", ["h"], None, "night", "AW", "s", "l"),
            (4, "f", [], None, "day", "SS", "s", "l"),
        ],
        PROFILE_LABELS,
    )
    members = spark.createDataFrame(
        [(1, "c"), (1, "c"), (2, "c"), (3, "c"), (4, "c"), (1, "d")], "id int, cluster string"
    )
    return members, labels


def test_profile_counts_nulls_and_modal_ties(profiled):
    members, labels = profiled
    profile = P.profile_long(members, labels)
    counts = {(r["feature"], r["label"], r["cluster"]): r["n"] for r in profile.collect()}
    assert counts["dummy", "1", "c"] == 4
    assert counts["for_gender", "f", "c"] == counts["for_gender", "m", "c"] == 2
    assert counts["group", "g", "c"] == 2 and counts["group", None, "c"] == 1
    assert counts["main_accords", None, "c"] == 3
    modal = {(r["feature"], r["cluster"]): r["label"] for r in P.modal_label(profile).collect()}
    assert modal["for_gender", "c"] == "f"
    assert modal["main_accords", "c"] == "a"
    assert P.drop_null_labels(profile).where("label is null").count() == 0


def test_representatives_and_flags(profiled):
    members, labels = profiled
    chosen = P.representative_items(members, labels, P.modal_label(P.profile_long(members, labels)))
    assert rows(chosen, "id", "cluster") == [(1, "c"), (1, "d")]
    only_c = chosen.where("cluster = 'c'")
    per_cluster = P.representative_flag(members.distinct(), only_c)
    assert (1, "d", None) in rows(per_cluster, "id", "cluster", "rank")
    overall = P.representative_flag(members.distinct(), only_c, global_flag=True)
    assert (1, "d", 1) in rows(overall, "id", "cluster", "rank")


def test_pivots_fill_gaps_and_keep_the_null_label(spark):
    df = spark.createDataFrame(
        [(1, "a", "x", 2.0), (1, "a", "x", 3.0), (2, None, "y", 1.0)],
        "id int, l string, c string, v double",
    )
    assert rows(P.count_pivot(df, "l", "c", "id"), "l", "x", "y") == [("a", 1, 0), (None, 0, 1)]
    assert rows(P.sum_pivot(df, "l", "c", "v", ["x", "y"]), "l", "x") == [("a", 5.0), (None, 0.0)]


def test_label_sets_drop_nulls(spark):
    df = spark.createDataFrame([Row(id=1, a="x", b=["p", None]), Row(id=2, a=None, b=None)],
                               "id int, a string, b array<string>")
    assert rows(S.label_sets(df, ["a", "b"]), "dimension", "label", "id") == [
        ("a", "x", 1), ("b", "p", 1),
    ]


def test_more_than_five_thousand_labels(spark):
    df = spark.range(5002).select("id", F.concat(F.lit("b"), F.col("id").cast("string")).alias("brand"))
    assert len(FE.one_hot(df, "id", "brand").columns) == 5003
    long = FE.one_hot_long(df, "id", "brand")
    assert long.count() == 5002 and long.columns == ["id", "feature", "value"]
    terms = spark.createDataFrame([(1, ["a", "b", "a", None]), (2, [])], "id int, t array<string>")
    assert rows(FE.one_hot_explode_long(terms, "id", "t"), "id", "feature") == [(1, "a"), (1, "b")]


def test_null_cluster_stays_in_pivots(spark):
    df = spark.createDataFrame(
        [("a", "x", 1, 2.0), ("a", None, 2, 3.0)], "l string, c string, id int, v double"
    )
    assert P.count_pivot(df, "l", "c", "id").collect()[0].asDict() == {"l": "a", "x": 1, "null": 1}
    assert P.sum_pivot(df, "l", "c", "v").collect()[0].asDict() == {"l": "a", "x": 2.0, "null": 3.0}


def test_safe_int_cast_beyond_the_range(spark):
    df = spark.createDataFrame([("3000000000",), ("NaN",), ("2147483647",), ("1e3",)], "t string")
    assert [r[0] for r in df.select(T.safe_int_cast(F.col("t"))).collect()] == [0, 0, 2147483647, 1000]


def test_samples_of_neighbouring_seeds_differ(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    one, two = ([r["k"] for r in T.review_sample(df, "k", 30, s).orderBy("draw").collect()]
                for s in (0, 1))
    assert len(set(one) & set(two)) < 10


def test_equal_places_take_the_smaller_group(spark):
    both = spark.createDataFrame(
        [("t", "zeta", 0, "x"), ("t", "alpha", 0, "x")],
        "taxonomy string, group string, group_pos int, term string",
    )
    assert rows(X.first_groups(both), "group") == [("alpha",)]


@pytest.mark.parametrize("features", [P.SIMILAR_FEATURES, tuple(P.PROFILE_FEATURES)])
def test_representatives_meet_all_required_features(spark, features):
    """Five or seven features given as rows, against plain loops."""
    import random

    chance = random.Random(len(features))
    sources = [source for source in P.PROFILE_FEATURES.values() if source != "note_groups"]
    data = []
    for i in range(120):
        row = {name: chance.choice(["x", "x", "y", None]) for name in sources}
        row["note_groups"] = chance.choice([["x", "x"], ["x", "y"], ["y"], [], None])
        data.append({"id": i, **row})
    schema = "id int, note_groups array<string>, " + ", ".join(f"{name} string" for name in sources)
    labels = spark.createDataFrame(data, schema)
    clusters = {i: chance.choice(["a", "b", "c"]) for i in range(120)}
    members = spark.createDataFrame([*clusters.items(), (0, clusters[0])], "id int, cluster string")
    modal_rows = [
        (feature, cluster, chance.choice(["x", "x", "y"])) for feature in P.PROFILE_FEATURES
        for cluster in "abc" if (feature, cluster) != ("season", "c")
    ]
    modal = spark.createDataFrame(modal_rows, "feature string, cluster string, label string")
    required = spark.createDataFrame([(name,) for name in features], "feature string")
    found = P.representative_items(members, labels, modal, required).collect()
    wanted = {(feature, cluster): label for feature, cluster, label in modal_rows}
    expected = set()
    for row in data:
        cluster = clusters[row["id"]]
        carried = [
            (feature, cluster) in wanted and wanted[feature, cluster] in (
                row[source] or [] if isinstance(row[source], list) or source == "note_groups"
                else [row[source]])
            for feature, source in P.PROFILE_FEATURES.items() if feature in features
        ]
        if all(carried):
            expected.add((row["id"], cluster))
    assert sorted(map(tuple, found)) == sorted(expected)
    assert len(features) > 5 or expected
