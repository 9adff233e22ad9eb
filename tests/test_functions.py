"""Edge cases of the column expressions."""

import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from kindred.functions import histograms as H
from kindred.functions import text as X
from kindred.functions import vectors as V

VOTES = "id int, m map<string, bigint>"


def values(df, expression):
    return {row["id"]: row["x"] for row in df.select("id", expression.alias("x")).collect()}


@pytest.fixture(scope="module")
def votes(spark):
    return spark.createDataFrame(
        [
            (1, {"a": 2, "b": 2}),
            (2, {"a": None, "b": None}),
            (3, {"a": None, "b": 3}),
            (4, {"a": -1, "b": None}),
            (5, {}),
            (6, None),
        ],
        VOTES,
    )


def test_argmax_ties_nulls_and_empty(votes):
    assert values(votes, H.argmax_key(F.col("m"))) == {
        1: "a", 2: "a", 3: "b", 4: "b", 5: None, 6: None,
    }


def test_present_keys(votes):
    assert values(votes, H.present_keys(F.col("m")))[3] == ["b"]


def test_struct_histograms_keep_their_nulls(spark):
    df = spark.createDataFrame(
        [Row(id=1, m=Row(day=1, night=None)), Row(id=2, m=None)],
        "id int, m struct<day: bigint, night: bigint>",
    )
    histogram = H.as_histogram(df, "m")
    entries = df.select("id", F.map_entries(histogram).alias("x")).orderBy("id").collect()
    assert [(e["key"], e["value"]) for e in entries[0]["x"]] == [("day", 1), ("night", None)]
    assert entries[1]["x"] is None
    with pytest.raises(TypeError):
        H.as_histogram(df, "id")


def test_merged_keys_come_last_and_lose_ties(spark):
    df = spark.createDataFrame(
        [(1, {"moderate": 3, "very_weak": 1, "weak": 2}), (2, {"weak": 2})], VOTES
    )
    merged = H.merge_keys(F.col("m"), ["very_weak", "weak"], "weak")
    keys = values(df, F.transform(F.map_entries(merged), lambda e: e["key"]))
    assert keys == {1: ["moderate", "weak"], 2: ["weak"]}
    assert values(df, H.argmax_key(merged)) == {1: "moderate", 2: "weak"}
    assert values(df, H.votes_of(merged, "weak")) == {1: 3, 2: 2}


def test_strict_merge_fails_on_a_missing_key(spark):
    df = spark.createDataFrame([(1, {"strong": 1, "enormous": 2})], VOTES)
    merged = H.merge_keys(F.col("m"), ["strong", "enormous"], "strong", strict=True)
    assert values(df, H.votes_of(merged, "strong")) == {1: 3}
    lacking = spark.createDataFrame([(1, {"strong": 1})], VOTES)
    with pytest.raises(Exception, match="lacks"):
        lacking.select(merged.alias("x")).collect()


def test_default_merges_order(spark):
    df = spark.createDataFrame(
        [(1, dict.fromkeys(["eternal", "long_lasting", "moderate", "very_weak", "weak"], 1))],
        VOTES,
    )
    merged = H.merge_all(F.col("m"), H.LONGEVITY_MERGES)
    keys = F.transform(F.map_entries(merged), lambda e: e["key"])
    assert values(df, keys)[1] == ["moderate", "long_lasting", "weak"]


def test_day_night_and_season(spark):
    df = spark.createDataFrame(
        [
            (1, {"day": 2, "night": 2, "winter": 1, "summer": 1}),
            (2, {"day": 2, "night": None, "fall": 1, "summer": 1}),
            (3, {"day": 9, "night": 1}),
            (4, {"spring": 1, "winter": 2}),
            (5, None),
        ],
        VOTES,
    )
    assert values(df, H.day_night(F.col("m"))) == {
        1: "night", 2: "day", 3: "day", 4: "night", 5: None,
    }
    seasons = values(df, H.season_bucket(F.col("m")))
    assert seasons[2] == "AW" and seasons[3] is None and seasons[4] == "AW" and seasons[5] is None


def test_rename_keeps_the_last_value_of_a_collision(spark):
    df = spark.createDataFrame([(1, {"a b": 1, "c": 2, "a_b": 3}), (2, {"a b": 1}), (3, None)], VOTES)
    assert values(df, H.rename_map_keys(F.col("m"))) == {
        1: {"a_b": 3, "c": 2}, 2: {"a_b": 1}, 3: None,
    }


def test_row_percentage_of_zeros_is_null(spark):
    df = spark.createDataFrame([(1, 0, 0), (2, 1, 3)], "id int, a int, b int")
    rows = {r["id"]: (r["a"], r["b"]) for r in H.row_percentage(df, ["a", "b"]).collect()}
    assert rows == {1: (None, None), 2: (0.25, 0.75)}


def test_clean_product_name(spark):
    df = spark.createDataFrame(
        [
            (1, "Rose Eau de Parfum 50ml"), (2, "Neau de cologner"), (3, "x100mlx 100g"),
            (4, ""), (5, None),
        ],
        "id int, n string",
    )
    assert values(df, X.clean_product_name(F.col("n"), True)) == {
        1: "rose  ", 2: "nr", 3: "x100mlx ", 4: "", 5: None,
    }
    assert values(df, X.clean_product_name(F.col("n")))[1] == "rose  50ml"


def test_tokens_and_jaccard(spark):
    df = spark.createDataFrame(
        [(1, "a  b a", "b c"), (2, "", "b"), (3, None, "b"), (4, "a", "b")],
        "id int, l string, r string",
    )
    left, right = X.token_set(F.col("l")), X.token_set(F.col("r"))
    assert values(df, left)[1] == ["a", "b"]
    sims = values(df, X.jaccard_similarity(left, right))
    assert sims == {1: pytest.approx(1 / 3), 2: 0.0, 3: 0.0, 4: 0.0}


def test_cosine(spark):
    df = spark.createDataFrame(
        [
            (1, [0.0, 0.0], [1.0, 0.0]), (2, [1.0, 2.0], [2.0, 4.0]), (3, [1.0, 0.0], [-1.0, 0.0]),
            (4, None, [1.0, 0.0]),
        ],
        "id int, l array<double>, r array<double>",
    )
    sims = values(df, V.cosine_similarity(F.col("l"), F.col("r")))
    assert sims[1] == 0 and sims[4] == 0
    assert math.isclose(sims[2], 1) and math.isclose(sims[3], -1)


def test_fold_accents(spark):
    df = spark.createDataFrame(
        [(1, "Lancôme"), (2, "Æsop STRAßE"), (3, "Ørsted Łódź"), (4, "é")], "id int, t string"
    )
    assert values(df, X.fold_accents(F.col("t"))) == {
        1: "lancome", 2: "aesop strasse", 3: "orsted lodz", 4: "e",
    }


def test_assets(spark):
    df = spark.createDataFrame(
        [(1, "Eau/Sauvage 66", "https://img.site/375x500.123.jpg", "ABC123"), (2, "x", "y", "ABC")],
        "id int, n string, u string, c string",
    )
    assert values(df, X.asset_name(F.col("n"), F.col("u"))) == {1: "Eau_Sauvage_66__123.jpg", 2: None}
    assert values(df, X.id_of_asset(X.asset_of_id(F.col("c"))))[1] == "ABC123"
    longer = df.sparkSession.createDataFrame([(7,), (12345678,)], "id bigint")
    code = X.padded_code(F.col("id"))
    assert values(longer, X.id_of_asset(X.asset_of_id(code))) == {7: "000007", 12345678: "12345678"}
    assert values(df, X.asset_path(F.col("c"), "/r"))[1] == "/r/xl/A/B/C/ABC123_in_xl.jpg"


@pytest.mark.parametrize(
    ("variant", "expected"),
    [("words", "a_b_c_d/e"), ("spaces", "a-b_(c)_d/e"), ("compact", "ab_c_d/e")],
)
def test_sanitizers_agree(spark, variant, expected):
    label = "a-b (c) d/e"
    df = spark.createDataFrame([(1, label)], "id int, t string")
    assert X.sanitize_name(label, variant) == expected
    assert values(df, X.sanitize_label(F.col("t"), variant))[1] == expected


def test_cluster_names(spark):
    df = spark.createDataFrame([(1, "a_AW_n_cat_x"), (2, "a_AW_n_")], "id int, c string")
    assert values(df, X.cluster_relabel(F.col("c"))) == {1: "a_AW_cat", 2: "a_AW_"}
    assert values(df, X.cluster_label(F.col("c"), F.lit(None)))[1] is None
