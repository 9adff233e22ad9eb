"""Features, segments, profiles, representatives, ranks, clusters and whole pipelines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions import histograms as H
from kindred.functions.text import sanitize_name
from kindred.operators import bitmaps as B
from kindred.operators import clustering as C
from kindred.operators import features as FE
from kindred.operators import profiles as P
from kindred.operators import ranking as R
from kindred.operators import segments as S
from kindred.operators import sparse as SP
from kindred.operators.features import zero_ratio as zero_shares
from kindred.plans import segmentation as plans
from kindred.plans.catalogue import catalog_pipeline as build_catalog
from kindred.plans.catalogue import match_pipeline as match
from kindred.plans.features import cluster_pipeline as cluster
from kindred.plans.features import feature_pipeline as join_features
from kindred.plans.features import FeatureLabels
from kindred.plans.features import sparse_cluster_pipeline as cluster_sparse
from kindred.plans.features import stored_feature_pipeline as store_features
from kindred.session import materialise, scratch_path
from workload.registry import query
from workload.relational import REGION_PIVOT_SQL, region_cells_as_long
from workload.views import (
    ACCORD_GROUPS,
    CLASSES,
    GENDERS,
    PRICES,
    SEASONS,
    VOTE_KEYS,
    Views,
    sql_argmax,
)

# Largest within-brand cosines of the given vectors are near 0.4.
MATCH_THRESHOLD = 0.2
_CLASS_NAMES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def as_long(df: DataFrame, keep: list[str]) -> DataFrame:
    """Integer columns as bigint, for comparison."""
    return df.select(*[
        F.col(f"`{name}`") if name in keep else F.col(f"`{name}`").cast("bigint").alias(name)
        for name in df.columns
    ])


# --- features -----------------------------------------------------------------------


@query(
    "one_hot",
    "SELECT product_id, " + ", ".join(
        f"CAST(class = '{c}' AS BIGINT) AS \"class_{c}\"" for c in _CLASS_NAMES
    ) + " FROM v_catalog",
)
def one_hot(v: Views) -> DataFrame:
    return as_long(FE.one_hot(v.catalog, "product_id", "class", prefix="class_"), ["product_id"])


@query(
    "one_hot_explode",
    "SELECT product_id, " + ", ".join(
        f"CAST(bool_or(note = '{c}') AS BIGINT) AS \"note_{c}\"" for c in _CLASS_NAMES
    ) + " FROM v_notes GROUP BY product_id",
)
def one_hot_explode(v: Views) -> DataFrame:
    return as_long(FE.one_hot_explode(v.notes, "product_id", "notes", prefix="note_"), ["product_id"])


def _entry_rows(entries: DataFrame, id_col: str) -> DataFrame:
    """Entries on their way through dictionary and vectors, as rows again."""
    stored = materialise(entries)
    dictionary = SP.feature_dictionary(stored)
    return SP.entries_of(SP.sparse_vectors(stored, id_col, dictionary), id_col, dictionary)


_RANKED = "CAST(dense_rank() OVER (ORDER BY feature) - 1 AS INTEGER) AS \"index\", 1.0::DOUBLE AS value"


@query(
    "one_hot_sparse",
    f"SELECT product_id, feature, {_RANKED} FROM (SELECT product_id, class AS feature FROM v_catalog)",
)
def one_hot_sparse(v: Views) -> DataFrame:
    return _entry_rows(SP.one_hot_entries(v.catalog, "product_id", "class"), "product_id")


@query(
    "one_hot_explode_sparse",
    f"SELECT product_id, feature, {_RANKED} FROM (SELECT DISTINCT product_id, note AS feature FROM v_notes)",
)
def one_hot_explode_sparse(v: Views) -> DataFrame:
    return _entry_rows(SP.one_hot_explode_entries(v.notes, "product_id", "notes"), "product_id")


@query(
    "argmax_one_hot_sparse",
    f"SELECT id, feature, {_RANKED} FROM (SELECT id, longevity_label AS feature FROM v_labels"
    " WHERE longevity_label IS NOT NULL)",
)
def argmax_one_hot_sparse(v: Views) -> DataFrame:
    return _entry_rows(SP.argmax_entries(v.items, "id", "longevity", H.LONGEVITY_MERGES), "id")


@query(
    "sparse_moments",
    "SELECT p_type AS feature, round(1 - count(*) / any_value(n), 6) AS zero_ratio,"
    " round(sum(v) / any_value(n), 6) AS mean, round(sqrt(sum(v * v) / any_value(n)"
    " - (sum(v) / any_value(n)) ** 2), 6) AS deviation FROM (SELECT l_orderkey, p_type,"
    " count(*)::DOUBLE AS v FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL),"
    " (SELECT count(DISTINCT l_orderkey)::DOUBLE AS n FROM lineitem) GROUP BY p_type",
)
def sparse_moments(v: Views) -> DataFrame:
    parts = v.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("feature"))
    lines = v.table("lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey")
    entries = materialise(lines.select("l_orderkey", "feature", F.lit(1.0).alias("value")))
    dictionary = SP.feature_dictionary(entries)
    vectors = SP.sparse_vectors(entries, "l_orderkey", dictionary)
    orders = entries.select("l_orderkey").distinct().count()
    moments = SP.feature_moments(vectors, dictionary, orders)
    return moments.select(
        "feature", *[F.round(name, 6).alias(name) for name in ("zero_ratio", "mean", "deviation")]
    )


_MULTI_HOT = (
    "SELECT product_id, " + ", ".join(
        f"CAST({{count}} AS BIGINT) AS notes_{g}".replace("{g}", g).replace(
            "{count}", f"{{left}}count(*) FILTER (WHERE grp = '{g}'){{right}}"
        ) for g in CLASSES
    ) + " FROM v_notes LEFT JOIN v_first ON term = note GROUP BY product_id"
)


@query("multi_hot_grouped", _MULTI_HOT.format(left="", right=" > 0"))
def multi_hot_grouped(v: Views) -> DataFrame:
    hot = FE.multi_hot_grouped(v.notes, "product_id", "notes", v.classes, list(CLASSES))
    return as_long(hot, ["product_id"])


@query("multi_hot_grouped_strict", _MULTI_HOT.format(left="count(*) * ", right=" > 1"))
def multi_hot_grouped_strict(v: Views) -> DataFrame:
    hot = FE.multi_hot_grouped(
        v.notes, "product_id", "notes", v.classes, list(CLASSES), strict=True
    )
    return as_long(hot, ["product_id"])


_ARGMAX_LABELS = ["moderate", "long_lasting", "weak"]


@query(
    "argmax_one_hot",
    "SELECT id, " + ", ".join(
        [f"CAST(longevity_label = '{k}' AS BIGINT) AS longevity_{k}" for k in _ARGMAX_LABELS]
        + [f"CAST(coalesce(accord_group = '{g}', false) AS BIGINT) AS main_accords_{g}"
           for g in ACCORD_GROUPS]
    ) + " FROM v_labels",
)
def argmax_one_hot(v: Views) -> DataFrame:
    votes = FE.argmax_one_hot(v.items, "id", "longevity", _ARGMAX_LABELS, H.LONGEVITY_MERGES)
    accords = FE.argmax_one_hot(
        v.items, "id", "main_accords", list(ACCORD_GROUPS), taxonomy=v.taxonomies.accords
    )
    return as_long(votes.join(accords, "id"), ["id"])


_PRICE_TOTAL = "(price_n[1] + price_n[2] + price_n[3] + price_n[4])"
_PRICE_COLUMNS = ", ".join(
    f"round(price_n[{i}] / {_PRICE_TOTAL}, 6) AS price_value_{k.replace(' ', '_')}"
    for i, k in enumerate(PRICES, 1)
)
_PRICE_NAMES = [key.replace(" ", "_") for key in PRICES]


def _price_values(items: DataFrame) -> DataFrame:
    renamed = items.select("id", H.rename_map_keys(F.col("price_value")).alias("price_value"))
    return FE.price_value_features(renamed, "id", "price_value", _PRICE_NAMES)


@query("price_value_features", f"SELECT id, {_PRICE_COLUMNS} FROM v_items")
def price_value_features(v: Views) -> DataFrame:
    return _rounded(_price_values(v.items))


def _rounded(shares: DataFrame) -> DataFrame:
    return shares.select("id", *[F.round(n, 6).alias(n) for n in shares.columns if n != "id"])


_SEASON_COLUMNS = ", ".join(f"season_n[{i}] AS season_{k}" for i, k in enumerate(SEASONS, 1))


@query("season_features", f"SELECT id, {_SEASON_COLUMNS} FROM v_items")
def season_features(v: Views) -> DataFrame:
    return FE.season_features(v.items, "id", "season_rating", SEASONS)


@query(
    "zero_ratio",
    " UNION ALL ".join(
        f"SELECT 'votes_{k}' AS feature, round(avg(CASE WHEN {k} = 0 THEN 1.0 ELSE 0.0 END), 6)"
        " AS zero_ratio FROM v_daily" for k in VOTE_KEYS
    ),
)
def zero_ratio(v: Views) -> DataFrame:
    counts = H.map_to_columns(v.daily, "product_id", "votes", VOTE_KEYS, "votes_")
    shares = zero_shares(counts, [f"votes_{key}" for key in VOTE_KEYS])
    return shares.select("feature", F.round("zero_ratio", 6).alias("zero_ratio"))


@query(
    "standardize",
    "SELECT product_id, " + ", ".join(
        f"round(coalesce(({k} - avg({k}) OVER ()) / nullif(stddev_pop({k}) OVER (), 0), 0), 6)"
        f" AS {k}" for k in VOTE_KEYS
    ) + " FROM v_votes_wide",
)
def standardize(v: Views) -> DataFrame:
    counts = H.map_to_columns(v.votes, "product_id", "votes", VOTE_KEYS)
    scaled = FE.standardize(counts, VOTE_KEYS)
    return scaled.select("product_id", *[F.round(key, 6).alias(key) for key in VOTE_KEYS])


_BRANDS = [f"Brand#{m}{n}" for m in range(1, 6) for n in range(1, 6)]
_NOTE_GROUPS = ("AFRICA", "AMERICA", "ASIA", "EUROPE")
_SILLAGE_LABELS = ["intimate", "moderate", "strong"]
_TEN_TABLES = (
    f"SELECT id, {_SEASON_COLUMNS}, {_PRICE_COLUMNS}, " + ", ".join(
        [f"CAST(longevity_label = '{k}' AS BIGINT) AS longevity_{k}" for k in _ARGMAX_LABELS]
        + [f"CAST(sillage_label = '{k}' AS BIGINT) AS sillage_{k}" for k in _SILLAGE_LABELS]
        + [f"CAST({sql_argmax(GENDERS, 'gender_n')} = '{k}' AS BIGINT) AS gender_vote_{k}" for k in GENDERS]
        + [f"CAST(coalesce(accord_group = '{g}', false) AS BIGINT) AS main_accords_{g}"
           for g in ACCORD_GROUPS]
        + [f"CAST(brand = '{brand}' AS BIGINT) AS \"brand_{sanitize_name(brand)}\"" for brand in _BRANDS]
        + [f"CAST(coalesce({kind}_{g.lower()}, false) AS BIGINT) AS {kind}_notes_{g}"
           for kind in ("top", "middle", "base") for g in _NOTE_GROUPS]
    ) + " FROM v_items JOIN v_labels USING (id, for_gender, brand) JOIN (SELECT id, " + ", ".join(
        f"bool_or({test}grp = '{g}') AS {kind}_{g.lower()}"
        for kind, test in (("top", "top AND "), ("middle", ""), ("base", "base AND "))
        for g in _NOTE_GROUPS
    ) + " FROM v_listed_notes GROUP BY id) USING (id)"
)


def _feature_labels(v: Views) -> FeatureLabels:
    return FeatureLabels(
        _BRANDS, _NOTE_GROUPS, list(ACCORD_GROUPS), _ARGMAX_LABELS, _SILLAGE_LABELS, GENDERS, PRICES,
        SEASONS, v.taxonomies.notes, v.taxonomies.accords,
    )


def _as_checked(features: DataFrame) -> DataFrame:
    prices = [name for name in features.columns if name.startswith("price_value_")]
    rounded = features.withColumns({name: F.round(name, 6) for name in prices})
    return as_long(rounded, ["id", *prices])


@query("feature_pipeline", _TEN_TABLES)
def feature_pipeline(v: Views) -> DataFrame:
    return _as_checked(join_features(v.feature_items, _feature_labels(v)))


@query("feature_pipeline_stored", _TEN_TABLES)
def feature_pipeline_stored(v: Views) -> DataFrame:
    root = scratch_path(v.spark, "features")
    store = "kindred_" + root.rsplit("-", 1)[-1]
    stored = store_features(v.feature_items, _feature_labels(v), root, store, buckets=8)
    return _as_checked(stored)


# --- segments -----------------------------------------------------------------------


@query(
    "label_sets",
    "SELECT 'season' AS dimension, season AS label, id FROM v_labels WHERE season IS NOT NULL"
    " UNION SELECT 'family', family, id FROM v_labels WHERE family IS NOT NULL"
    " UNION SELECT 'note_groups', grp, id FROM v_note_groups WHERE grp IS NOT NULL",
)
def label_sets(v: Views) -> DataFrame:
    sets = S.label_sets(v.stored_labels, ["season", "family", "note_groups"])
    return B.label_index(sets).memberships()


@query(
    "segment_combinations",
    "SELECT season, family_note AS note_family FROM (SELECT DISTINCT season FROM v_labels), "
    "(SELECT DISTINCT family_note FROM v_note_families WHERE family_note IS NOT NULL)",
)
def segment_combinations(v: Views) -> DataFrame:
    return S.segment_combinations(v.labels)


@query("rule_segments", "SELECT id, family, season, note_family, cluster FROM v_segments")
def rule_segments(v: Views) -> DataFrame:
    return S.rule_segments(v.labels)


@query("segment_with_category", "SELECT id, brand, cluster, category FROM v_categorised")
def segment_with_category(v: Views) -> DataFrame:
    labels = v.stored_labels
    return S.segment_with_category(S.rule_segments(labels), labels, v.categories)


@query("segment_pipeline", "SELECT id, brand, cluster, category FROM v_members")
def segment_pipeline(v: Views) -> DataFrame:
    return plans.segment_pipeline(v.stored_labels, v.categories)


@query(
    "null_ratio",
    "SELECT kind, nulls, total, round(nulls * 100.0::DOUBLE / total, 6) AS percent FROM (SELECT"
    " 'rows' AS kind, count(*) FILTER (WHERE category IS NULL) AS nulls, count(*) AS total FROM"
    " part LEFT JOIN v_folded_categories c ON c.brand = lower(p_brand) UNION ALL SELECT 'brands',"
    " count(*) FILTER (WHERE category IS NULL), count(*) FROM (SELECT DISTINCT lower(p_brand),"
    " category FROM part LEFT JOIN v_folded_categories c ON c.brand = lower(p_brand)))",
)
def null_ratio(v: Views) -> DataFrame:
    parts = v.table("part").select(F.col("p_brand").alias("brand"))
    joined = S.left_join_category(parts, "brand", v.categories).select("brand", "category")
    kinds = {"rows": joined, "brands": joined.dropDuplicates()}
    ratios = [
        S.null_ratio(df, "category").select(
            F.lit(kind).alias("kind"), "nulls", "total", F.round("percent", 6).alias("percent")
        )
        for kind, df in kinds.items()
    ]
    return ratios[0].unionByName(ratios[1])


# --- profiles and representatives ---------------------------------------------------


_SEGMENTS = ["O", "F"]


@query(
    "count_pivot",
    "SELECT p_type AS label, count(DISTINCT l_partkey) FILTER (WHERE l_linestatus = 'O') AS \"O\","
    " count(DISTINCT l_partkey) FILTER (WHERE l_linestatus = 'F') AS \"F\" FROM lineitem"
    " JOIN part ON p_partkey = l_partkey GROUP BY p_type",
)
def count_pivot(v: Views) -> DataFrame:
    parts = v.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("label"))
    lines = v.table("lineitem").select("l_partkey", "l_linestatus").join(parts, "l_partkey")
    return P.count_pivot(lines, "label", "l_linestatus", "l_partkey", _SEGMENTS, dense=True)


@query(
    "sum_pivot",
    "SELECT p_type AS label, coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0) AS \"O\","
    " coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) AS \"F\" FROM lineitem"
    " JOIN part ON p_partkey = l_partkey GROUP BY p_type",
)
def sum_pivot(v: Views) -> DataFrame:
    parts = v.table("part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("label"))
    lines = v.table("lineitem").select("l_partkey", "l_linestatus", "l_quantity").join(
        parts, "l_partkey"
    )
    return P.sum_pivot(lines, "label", "l_linestatus", "l_quantity")


@query("profile_long", "SELECT feature, label, cluster, n FROM v_profile")
def profile_long(v: Views) -> DataFrame:
    return P.profile_long(v.members, v.stored_labels)


@query(
    "profile_raw_terms",
    "SELECT feature, label, cluster, count(DISTINCT id) AS n FROM (SELECT DISTINCT id, cluster FROM"
    " v_members) JOIN (SELECT id, 'middle_notes' AS feature, note AS label FROM v_item_notes UNION ALL"
    " SELECT id, 'top_accord', top_accord FROM v_labels UNION ALL SELECT id, 'present_accords',"
    " UNNEST(list_filter([" + ", ".join(
        f"CASE WHEN accord_n[{i}] > 0 THEN '{k}' END" for i, k in enumerate(
            ["citrus", "leather", "musky", "oud", "rose", "vanilla", "zest"], 1)
    ) + "], lambda x: x IS NOT NULL)) FROM v_items) USING (id) GROUP BY ALL",
)
def profile_raw_terms(v: Views) -> DataFrame:
    terms = v.items.select(
        "id", "middle_notes", H.present_keys(F.col("main_accords")).alias("present_accords"),
        H.argmax_key(F.col("main_accords")).alias("top_accord"),
    )
    return P.profile_raw_terms(v.members, terms)


@query("drop_null_labels", "SELECT feature, label, cluster, n FROM v_profile WHERE label IS NOT NULL")
def drop_null_labels(v: Views) -> DataFrame:
    return P.drop_null_labels(P.profile_long(v.members, v.stored_labels))


@query("modal_label", "SELECT feature, cluster, label FROM v_modal")
def modal_label(v: Views) -> DataFrame:
    return P.modal_label(P.profile_long(v.members, v.stored_labels))


@query("profile_pipeline", "SELECT feature, label, cluster, n FROM v_profile")
def profile_pipeline(v: Views) -> DataFrame:
    return plans.profile_pipeline(v.members, v.stored_labels)


@query("representative_items", "SELECT id, cluster FROM v_representatives")
def representative_items(v: Views) -> DataFrame:
    modal = P.modal_label(P.profile_long(v.members, v.stored_labels))
    return P.representative_items(v.members, v.stored_labels, modal)


@query(
    "representative_items_similar",
    "SELECT m.id, m.cluster FROM (SELECT DISTINCT id, cluster FROM v_members) m JOIN v_modal o"
    " USING (cluster) JOIN v_feature_labels f ON f.id = m.id AND f.feature = o.feature"
    f" AND f.label = o.label WHERE o.feature IN {P.SIMILAR_FEATURES} GROUP BY ALL"
    f" HAVING count(*) = {len(P.SIMILAR_FEATURES)}",
)
def representative_items_similar(v: Views) -> DataFrame:
    modal = P.modal_label(P.profile_long(v.members, v.stored_labels))
    required = v.spark.createDataFrame([(name,) for name in P.SIMILAR_FEATURES], "feature string")
    return P.representative_items(v.members, v.stored_labels, modal, required)


def _flag_sql(condition: str) -> str:
    return (
        "SELECT id, cluster, CAST(CASE WHEN " + condition + " THEN 1 END AS BIGINT) AS rank"
        " FROM (SELECT p_partkey AS id, p_brand AS cluster, p_type FROM part UNION ALL"
        " SELECT p_partkey, p_type, p_type FROM part)"
    )


@query("representative_flag", _flag_sql("p_type = 'PROMO' AND cluster <> 'PROMO'"))
def representative_flag(v: Views) -> DataFrame:
    return _flagged(v, False)


@query("representative_flag_global", _flag_sql("p_type = 'PROMO'"))
def representative_flag_global(v: Views) -> DataFrame:
    return _flagged(v, True)


def _flagged(v: Views, global_flag: bool) -> DataFrame:
    parts = v.table("part")
    by_brand = parts.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("cluster"))
    by_type = parts.select(F.col("p_partkey").alias("id"), F.col("p_type").alias("cluster"))
    chosen = v.brand_members.where("rank = 1").select("id", "cluster")
    flagged = P.representative_flag(by_brand.unionByName(by_type), chosen, global_flag)
    return flagged.withColumn("rank", F.col("rank").cast("bigint"))


_OUTPUT = (
    "SELECT o.*, n.middle_notes FROM v_output o JOIN (SELECT id, string_agg(note, ', ' ORDER BY note)"
    " AS middle_notes FROM v_item_notes GROUP BY id) n USING (id)"
)


@query("representative_pipeline", _OUTPUT)
def representative_pipeline(v: Views) -> DataFrame:
    return _output(v)


def _output(v: Views) -> DataFrame:
    profile = plans.profile_pipeline(v.members, v.stored_labels)
    output = plans.representative_pipeline(v.members, v.stored_labels, profile)
    return output.withColumns({
        "middle_notes": F.array_join("middle_notes", ", "), "rank": F.col("rank").cast("bigint"),
    })


# --- ranking ------------------------------------------------------------------------


@query(
    "two_key_edge_join",
    "SELECT s.source, s.sim, round(CAST(score AS DOUBLE), 6) AS score FROM v_scores s"
    " JOIN v_brand_members m ON m.id = s.source JOIN v_brand_reps r ON r.cluster = m.cluster"
    " AND r.representative = s.sim",
)
def two_key_edge_join(v: Views) -> DataFrame:
    chosen = R.pick_representative(v.brand_members, None)
    pairs = v.brand_members.join(chosen, "cluster").select(
        F.col("id").alias("source"), F.col("representative").alias("sim")
    )
    linked = R.two_key_edge_join(pairs, v.edges)
    score = F.round(R.weighted_score().cast("double"), 6)
    return linked.select("source", "sim", score.alias("score"))


@query(
    "rank_in_cluster",
    "SELECT id, cluster, round(score, 6) AS score, row_number() OVER (PARTITION BY cluster ORDER BY"
    " score DESC, id) AS rank FROM (SELECT o_orderkey AS id, o_orderpriority AS cluster,"
    " o_totalprice AS score FROM orders)",
)
def rank_in_cluster(v: Views) -> DataFrame:
    orders = v.table("orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("cluster"),
        F.col("o_totalprice").alias("score"),
    )
    return R.rank_in_cluster(orders, "score").withColumn("score", F.round("score", 6))


@query(
    "pick_representative",
    "SELECT cluster, arg_min(id, (CASE WHEN rank = 1 THEN 0 ELSE 1 END, md5('7:' || id), id))"
    " AS representative FROM v_brand_members GROUP BY cluster",
)
def pick_representative(v: Views) -> DataFrame:
    return R.pick_representative(v.brand_members, 7)


_RANKS_SQL = (
    "SELECT id, cluster, representative, round(CAST(score AS DOUBLE), 6) AS score, rank"
    " FROM v_brand_ranks"
)


def _brand_ranks(v: Views) -> DataFrame:
    return R.multi_segment_rank(v.brand_members, v.edges, None)


@query("multi_segment_rank", _RANKS_SQL)
def multi_segment_rank(v: Views) -> DataFrame:
    score = F.round(F.col("weighted_score").cast("double"), 6).alias("score")
    return _brand_ranks(v).select("id", "cluster", "representative", score, "rank")


@query(
    "rank_join_back",
    "SELECT DISTINCT p.id, p.cluster, r.rank FROM (SELECT id, cluster FROM v_brand_members UNION ALL"
    " SELECT p_partkey, p_type FROM part) p JOIN v_brand_ranks r ON r.id = p.id"
    " AND r.cluster = p.cluster",
)
def rank_join_back(v: Views) -> DataFrame:
    return R.rank_join_back(_two_clusters(v), _brand_ranks(v))


@query(
    "rank_join_back_by_id",
    "SELECT DISTINCT p.id, p.cluster, r.rank FROM (SELECT id, cluster FROM v_brand_members UNION ALL"
    " SELECT p_partkey, p_type FROM part) p JOIN v_brand_ranks r ON r.id = p.id",
)
def rank_join_back_by_id(v: Views) -> DataFrame:
    return R.rank_join_back(_two_clusters(v), _brand_ranks(v), on_id_only=True)


def _two_clusters(v: Views) -> DataFrame:
    types = v.table("part").select(
        F.col("p_partkey").alias("id"), F.col("p_type").alias("cluster"),
        F.lit(None).cast("int").alias("rank"),
    )
    return v.brand_members.unionByName(types)


@query("sort_report", "SELECT cluster, rank, id FROM v_brand_ranks ORDER BY cluster, rank, id")
def sort_report(v: Views) -> DataFrame:
    return R.sort_report(_brand_ranks(v), ["cluster", "rank", "id"])


@query(
    "rank_pipeline",
    "WITH reps AS (SELECT cluster, arg_min(id, (CASE WHEN rank = 1 THEN 0 ELSE 1 END, id)) AS rep"
    " FROM v_output GROUP BY cluster), scored AS (SELECT source, sim, CAST(bert_sim * 0.4::DOUBLE +"
    " accord_sim * 0.3::DOUBLE + season_sim * 0.1::DOUBLE + note_sim * 0.2::DOUBLE AS FLOAT) AS score"
    " FROM v_item_edges), ranks AS (SELECT id, cluster, row_number() OVER (PARTITION BY cluster"
    " ORDER BY score DESC, id) AS rank FROM (SELECT DISTINCT o.id, o.cluster, rep, score FROM v_output o"
    " JOIN reps USING (cluster) JOIN scored s ON s.source = o.id AND s.sim = rep))"
    " SELECT DISTINCT o.id, o.brand, o.cluster, o.category, o.main_accords, o.sillage, o.longevity,"
    " o.day_night, r.rank FROM v_output o JOIN ranks r USING (id, cluster)",
)
def rank_pipeline(v: Views) -> DataFrame:
    output = materialise(_output(v).drop("middle_notes"))
    return plans.rank_pipeline(output, v.item_edges, None)


# --- catalogue and matching ---------------------------------------------------------


@query(
    "catalog_pipeline",
    "SELECT product_id, name, brand, class, f.* EXCLUDE (product_id) FROM v_catalog JOIN ("
    + REGION_PIVOT_SQL
    + "v_feed WHERE load_date = (SELECT max(load_date) FROM v_feed) GROUP BY product_id) f"
    " USING (product_id) WHERE class = 'PROMO'",
)
def catalog_pipeline(v: Views) -> DataFrame:
    attributes = v.catalog.select("product_id", "name", "brand", "class")
    built = build_catalog(
        v.feed, attributes, "product_id", "load_date", "region",
        {"stock": "stock", "price": "price"}, ["l_orderkey", "l_linenumber"], "class", "PROMO",
        ["A", "N", "R"],
    )
    return region_cells_as_long(built)


@query(
    "match_pipeline",
    "SELECT left_id AS id, b.brand, left_name AS name_cleaned, right_id AS match_id,"
    " right_name AS match_name_cleaned, round(sim, 6) AS vector_sim, round(shared /"
    " len(list_distinct(list_concat(left_tokens, right_tokens))), 6) AS name_sim FROM (SELECT * FROM"
    " v_pairs WHERE shared > 0 QUALIFY rank() OVER (PARTITION BY left_id ORDER BY sim DESC) = 1)"
    f" JOIN v_left b ON b.id = left_id WHERE sim >= {MATCH_THRESHOLD}"
    " QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY right_id) = 1",
)
def match_pipeline(v: Views) -> DataFrame:
    matched = match(v.left, v.right, threshold=MATCH_THRESHOLD)
    return matched.withColumns({
        "vector_sim": F.round("vector_sim", 6), "name_sim": F.round("name_sim", 6),
    })


# --- clustering ---------------------------------------------------------------------


def _scaled_votes(v: Views) -> DataFrame:
    counts = H.map_to_columns(v.daily, "product_id", "votes", VOTE_KEYS)
    return C.feature_vectors(FE.standardize(counts, VOTE_KEYS), "product_id", VOTE_KEYS)


def _fixed_medoids(v: Views) -> C.Medoids:
    """The three vectors with the smallest ids, as given medoids."""
    rows = v.table("embeddings").orderBy("vec_id").limit(3).collect()
    return C.Medoids.of([(row["vec_id"], row["embedding"]) for row in rows])


_ASSIGNED = (
    "SELECT e.vec_id AS point_id, arg_min(m.vec_id, (round(list_distance(CAST(e.embedding AS DOUBLE[]),"
    " CAST(m.embedding AS DOUBLE[])), 9), m.vec_id)) AS medoid_id, min(list_distance("
    "CAST(e.embedding AS DOUBLE[]), CAST(m.embedding AS DOUBLE[]))) AS distance FROM embeddings e,"
    " (SELECT * FROM embeddings ORDER BY vec_id LIMIT 3) m GROUP BY e.vec_id"
)


@query(
    "kmedoids_assign",
    f"SELECT point_id, medoid_id, round(distance, 6) AS distance FROM ({_ASSIGNED})",
)
def kmedoids_assign(v: Views) -> DataFrame:
    points = v.table("embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").alias("vector")
    )
    assigned = C.kmedoids_assign(points, _fixed_medoids(v))
    return assigned.select("point_id", "medoid_id", F.round("distance", 6).alias("distance"))


@query(
    "kmedoids_update",
    f"WITH a AS ({_ASSIGNED}), p AS (SELECT point_id, medoid_id, CAST(embedding AS DOUBLE[]) AS x"
    " FROM a JOIN embeddings ON vec_id = point_id), c AS (SELECT l.medoid_id, l.point_id,"
    " round(sum(list_distance(l.x, r.x)), 6) AS cost FROM p l JOIN p r USING (medoid_id)"
    " GROUP BY ALL) SELECT medoid_id, arg_min(point_id, (cost, point_id)) AS point_id,"
    " round(min(cost), 4) AS cost FROM c GROUP BY medoid_id",
)
def kmedoids_update(v: Views) -> DataFrame:
    points = v.table("embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    medoids = _fixed_medoids(v)
    names = F.array(*[F.lit(name) for name in medoids.ids])
    weighted = materialise(C.weighted_points(points))  # read once for every pass
    moved = C.kmedoids_update(weighted, {len(medoids.ids): medoids})
    return moved.select(
        F.element_at(names, F.col("label") + 1).alias("medoid_id"), "point_id",
        F.round("cost", 4).alias("cost"),
    )


def fit_sql(scaled: str, ks: str, rest: str) -> str:
    """SQL of whole fits for every k of the list ``ks``, then ``rest`` over their results.

    ``scaled`` gives ``id, x`` per product. ``fitted`` has ``k, medoids``; ``d`` the distances
    between distinct vectors ``a`` and ``b``, ``w`` the products behind ``b``.
    """
    return f"""WITH RECURSIVE z AS ({scaled}),
p AS MATERIALIZED (SELECT min(id) AS id, x, count(*) AS w FROM z GROUP BY x),
d AS MATERIALIZED (
    SELECT a.id AS a, b.id AS b, b.w, list_distance(a.x, b.x) AS raw, round(raw, 9) AS dist FROM p a, p b
),
seeds(n, ids) AS (
    SELECT 1, [arg_min(id, (md5(CAST(id AS VARCHAR)), id))] FROM p
    UNION ALL
    SELECT n + 1, list_append(ids, pick) FROM (
        SELECT n, ids, arg_min(b, (-gap, b)) AS pick, max(gap) AS farthest FROM (
            SELECT s.n, s.ids, d.b, min(d.dist) AS gap
            FROM (SELECT n, ids, unnest(ids) AS seed FROM seeds) s JOIN d ON d.a = s.seed GROUP BY ALL
        ) GROUP BY n, ids
    ) WHERE farthest > 0 AND n < list_max({ks})
),
fit(k, n, medoids, cost, moving) AS (
    SELECT k, 0, list_sort(ids), NULL::DOUBLE, true
    FROM (SELECT unnest({ks}) AS k) JOIN seeds ON n = least(k, (SELECT max(n) FROM seeds))
    UNION ALL
    (
        WITH labelled AS (
            SELECT k, n, medoids, cost, b, arg_min(m, (dist, m)) AS m
            FROM (SELECT *, unnest(medoids) AS m FROM fit WHERE moving) JOIN d ON a = m GROUP BY ALL
        ), costs AS (
            SELECT l.k, l.n, l.medoids, l.cost, l.m, l.b AS c, round(sum(d.raw * d.w), 6) AS total
            FROM labelled l JOIN labelled r ON l.k = r.k AND l.m = r.m
            JOIN d ON d.a = l.b AND d.b = r.b GROUP BY ALL
        ), best AS (
            SELECT k, n, medoids, cost, m, arg_min(c, (total, c)) AS c, min(total) AS total
            FROM costs GROUP BY ALL
        ), next AS (
            SELECT k, n, medoids, cost, list_sort(list(c)) AS found, round(sum(total), 6) AS total
            FROM best GROUP BY ALL
        )
        SELECT k, n + 1, found, total, found <> medoids AND (cost IS NULL OR total < cost) FROM next
    )
),
fitted AS (SELECT k, medoids FROM fit QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC) = 1),
placed AS (
    SELECT k, b AS id, any_value(w) AS w, arg_min(m, (dist, m)) AS medoid_id, min(dist) AS distance
    FROM (SELECT k, unnest(medoids) AS m FROM fitted) JOIN d ON a = m GROUP BY k, b
)
{rest}"""


_SCALED_VOTES = "SELECT product_id AS id, [" + ", ".join(
    f"coalesce(({k} - avg({k}) OVER ()) / nullif(stddev_pop({k}) OVER (), 0), 0)" for k in VOTE_KEYS
) + "] AS x FROM v_daily"


@query(
    "kmedoids_fit",
    fit_sql(
        _SCALED_VOTES, f"[{C.FINAL_K}]",
        "SELECT medoid_id, sum(w)::BIGINT AS n, round(sum(distance * w), 6) AS cost FROM placed"
        " GROUP BY medoid_id",
    ),
)
def kmedoids_fit(v: Views) -> DataFrame:
    vectors = _scaled_votes(v)
    fit = C.kmedoids_fit(C.weighted_points(vectors), (C.FINAL_K,))[C.FINAL_K]
    assigned = C.kmedoids_assign(vectors, fit.medoids)
    return assigned.groupBy("medoid_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("distance"), 6).alias("cost")
    )


@query(
    "elbow_inertia",
    fit_sql(
        _SCALED_VOTES, f"{list(C.ELBOW_KS)}",
        "SELECT k::BIGINT AS k, round(sum(distance * w), 6) AS inertia FROM placed GROUP BY k",
    ),
)
def elbow_inertia(v: Views) -> DataFrame:
    curve = C.elbow_inertia(C.weighted_points(_scaled_votes(v)))
    return curve.withColumn("inertia", F.round("inertia", 6))


_VOTED_ENTRIES = (
    "SELECT id, 'longevity_' || longevity_label AS f FROM v_labels WHERE longevity_label IS NOT NULL"
    " UNION ALL SELECT id, 'main_accords_' || accord_group FROM v_labels WHERE accord_group IS NOT NULL"
    " UNION ALL SELECT id, 'gender_' || for_gender FROM v_labels WHERE for_gender IS NOT NULL"
)
_KEPT_SCORES = (
    "SELECT i.id, list((CASE WHEN e.id IS NULL THEN 0.0 ELSE 1.0 END - mean) / sqrt(mean * (1 - mean))"
    f" ORDER BY m.f) AS x FROM v_items i CROSS JOIN (SELECT f, count(*)::DOUBLE / (SELECT count(*) FROM"
    f" v_items) AS mean FROM ({_VOTED_ENTRIES}) GROUP BY f HAVING 1 - mean < {FE.SPARSE_SHARE}) m"
    f" LEFT JOIN ({_VOTED_ENTRIES}) e ON e.id = i.id AND e.f = m.f GROUP BY i.id"
)


def _voted_blocks(v: Views, items: DataFrame) -> dict[str, DataFrame]:
    return {
        "longevity": SP.argmax_entries(items, "id", "longevity", H.LONGEVITY_MERGES),
        "main_accords": SP.argmax_entries(items, "id", "main_accords", (), v.taxonomies.accords),
        "gender": SP.one_hot_entries(items, "id", "for_gender"),
    }


@query(
    "cluster_pipeline",
    fit_sql(
        _KEPT_SCORES, f"[{C.FINAL_K}]",
        "SELECT z.id AS point_id, medoid_id, round(distance, 6) AS distance FROM z"
        " JOIN p ON p.x = z.x JOIN placed ON placed.id = p.id",
    ),
)
def cluster_pipeline(v: Views) -> DataFrame:
    items = v.stored_items
    clustered = cluster_sparse(_voted_blocks(v, items), items, "id")
    return clustered.select("point_id", "medoid_id", F.round("distance", 6).alias("distance"))


@query("cluster_pipeline_wide")
def cluster_pipeline_wide(v: Views) -> DataFrame:
    items = v.stored_items
    accords = FE.argmax_one_hot(
        items, "id", "main_accords", list(ACCORD_GROUPS), taxonomy=v.taxonomies.accords
    )
    votes = FE.argmax_one_hot(items, "id", "longevity", _ARGMAX_LABELS, H.LONGEVITY_MERGES)
    clustered = cluster(accords.join(votes, "id"), "id", wanted=items.select("id"))
    return clustered.select("point_id", "medoid_id", F.round("distance", 6).alias("distance"))
