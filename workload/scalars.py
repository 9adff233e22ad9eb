"""Projections, scalar functions and histogram functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions import histograms as H
from kindred.functions import text as X
from kindred.functions import vectors as V
from kindred.operators import tables as T
from kindred.operators.ranking import weighted_score, weighted_score_udf
from workload.registry import query
from workload.views import GENDERS, LONGEVITY, PRICES, VOTE_KEYS, Views, sql_argmax


_VOTE_LIST = "[" + ", ".join(VOTE_KEYS) + "]"


@query("normalize_columns", "SELECT product_id, name AS display_name, price AS price_hk FROM v_catalog")
def normalize_columns(v: Views) -> DataFrame:
    return T.normalize_columns(
        v.catalog.select("product_id", F.col("name").alias("display name"),
                         F.col("price").alias("price hk"))
    )


@query(
    "ensure_column",
    "SELECT product_id, brand, CAST(NULL AS VARCHAR) AS image_name FROM v_catalog",
)
def ensure_column(v: Views) -> DataFrame:
    once = T.ensure_column(v.catalog.select("product_id", "brand"), "image_name")
    return T.ensure_column(once, "brand")


@query(
    "fill_nulls",
    "SELECT id, coalesce(name, '') AS name, coalesce(CAST(size AS BIGINT), 0) AS size FROM"
    " (SELECT vec_id AS id, p_name AS name, p_size AS size FROM embeddings"
    " LEFT JOIN part ON p_partkey = vec_id)",
)
def fill_nulls(v: Views) -> DataFrame:
    joined = v.table("embeddings").join(
        v.table("part"), F.col("p_partkey") == F.col("vec_id"), "left"
    )
    named = joined.select(F.col("vec_id").alias("id"), F.col("p_name").alias("name"),
                          F.col("p_size").cast("bigint").alias("size"))
    return T.fill_nulls(named, ["name", "size"])


@query(
    "literal_replace",
    "SELECT product_id, CASE WHEN class = 'PROMO' THEN '0' ELSE class END AS class,"
    " brand FROM v_catalog",
)
def literal_replace(v: Views) -> DataFrame:
    coded = v.catalog.select(
        "product_id",
        F.when(F.col("class") == "PROMO", "NA").otherwise(F.col("class")).alias("class"), "brand",
    )
    return T.literal_replace(coded, ["class", "brand"])


@query(
    "safe_int_cast",
    "SELECT product_id, coalesce(CAST(trunc(price) AS BIGINT), 0) AS price,"
    " coalesce(CAST(trunc(TRY_CAST(split_part(name, ' ', 2) || size AS DOUBLE)) AS BIGINT), 0)"
    " AS no_number, coalesce(CAST(trunc(TRY_CAST(CAST(price AS VARCHAR) AS DOUBLE)) AS BIGINT), 0)"
    " AS price_text FROM v_catalog",
)
def safe_int_cast(v: Views) -> DataFrame:
    second = F.concat(F.split_part("name", F.lit(" "), F.lit(2)), F.col("size").cast("string"))
    return v.catalog.select(
        "product_id",
        T.safe_int_cast(F.col("price")).cast("bigint").alias("price"),
        T.safe_int_cast(second).cast("bigint").alias("no_number"),
        T.safe_int_cast(F.col("price").cast("string")).cast("bigint").alias("price_text"),
    )


@query(
    "clean_product_name",
    "SELECT l.id, l.name_cleaned AS internal_name, r.name_cleaned AS external_name"
    " FROM v_left_clean l JOIN v_right_clean r USING (id)",
)
def clean_product_name(v: Views) -> DataFrame:
    internal = v.left.select("id", X.clean_product_name(F.col("name"), True).alias("internal_name"))
    external = v.right.select("id", X.clean_product_name(F.col("name")).alias("external_name"))
    return T.fill_nulls(internal.join(external, "id"), ["internal_name", "external_name"])


@query(
    "token_set",
    "SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, md5(array_to_string("
    "list_sort(toks), ' ')) AS tokens FROM (SELECT doc_id, list_distinct(list_filter("
    "string_split(text, ' '), lambda x: x <> '')) AS toks FROM documents)",
)
def token_set(v: Views) -> DataFrame:
    tokens = v.table("documents").select("doc_id", X.token_set(F.col("text")).alias("tokens"))
    return tokens.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"),
        F.md5(F.array_join(F.array_sort("tokens"), " ")).alias("tokens"),
    )


@query(
    "jaccard_similarity",
    "SELECT conv_id, turn, doc_id, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE"
    " len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS sim FROM"
    " (SELECT conv_id, turn, doc_id, list_distinct(list_filter(string_split(c.text, ' '),"
    " lambda x: x <> '')) AS a, list_distinct(list_filter(string_split(d.text, ' '),"
    " lambda x: x <> '')) AS b FROM conversations c JOIN documents d ON d.doc_id = c.conv_id)",
)
def jaccard_similarity(v: Views) -> DataFrame:
    turns = v.table("conversations").select("conv_id", "turn", F.col("text").alias("a"))
    docs = v.table("documents").select("doc_id", F.col("text").alias("b"))
    sim = X.jaccard_similarity(X.token_set(F.col("a")), X.token_set(F.col("b")))
    return turns.join(docs, F.col("conv_id") == F.col("doc_id")).select(
        "conv_id", "turn", "doc_id", F.round(sim, 6).alias("sim")
    )


@query(
    "cosine_similarity",
    "SELECT id, round(list_cosine_similarity(CAST(l.vector AS DOUBLE[]), CAST(r.vector AS"
    " DOUBLE[])), 6) AS sim FROM v_left l JOIN v_right r USING (id)",
)
def cosine_similarity(v: Views) -> DataFrame:
    right = v.right.select("id", F.col("vector").alias("other"))
    sim = V.cosine_similarity(F.col("vector"), F.col("other"))
    return v.left.join(right, "id").select("id", F.round(sim, 6).alias("sim"))


_SEGMENT = "list_extract(string_split(url, '.'), -2)"


@query(
    "asset_name",
    "SELECT page_id, replace(replace(split_part(url, '?', 1), ' ', '_'), '/', '_') || '__' || "
    + _SEGMENT + " || '.jpg' AS asset FROM pages",
)
def asset_name(v: Views) -> DataFrame:
    title = F.split_part("url", F.lit("?"), F.lit(1))
    return v.table("pages").select("page_id", X.asset_name(title, F.col("url")).alias("asset"))


@query(
    "id_asset_roundtrip",
    "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR))::INT), '0') AS code,"
    " lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR))::INT), '0') || '_in_xl.jpg' AS asset FROM customer",
)
def id_asset_roundtrip(v: Views) -> DataFrame:
    code = X.padded_code(F.col("c_custkey"))
    stored = v.table("customer").select("c_custkey", X.asset_of_id(code).alias("asset"))
    return stored.withColumn("code", X.id_of_asset(F.col("asset")))


@query(
    "asset_path",
    "SELECT c_custkey, '/images/xl/' || code[1] || '/' || code[2] || '/' || code[3] || '/' ||"
    " code || '_in_xl.jpg' AS path FROM"
    " (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), greatest(6, length(CAST(c_custkey AS VARCHAR))::INT), '0') AS code FROM customer)",
)
def asset_path(v: Views) -> DataFrame:
    code = X.padded_code(F.col("c_custkey"))
    return v.table("customer").select("c_custkey", X.asset_path(code, "/images/").alias("path"))


@query(
    "fold_accents",
    "SELECT doc_id, md5(t) AS folded, CAST(length(t) AS BIGINT) AS n FROM (SELECT doc_id,"
    " lower(replace(replace(replace(replace(replace(replace(strip_accents(text), 'ß', 'ss'),"
    " 'œ', 'oe'), 'Œ', 'OE'), 'æ', 'ae'), 'Æ', 'AE'), '’', '''')) AS t FROM documents)",
)
def fold_accents(v: Views) -> DataFrame:
    folded = v.table("documents").select("doc_id", X.fold_accents(F.col("text")).alias("t"))
    return folded.select("doc_id", F.md5("t").alias("folded"), F.length("t").cast("bigint").alias("n"))


@query("brand_key", "SELECT product_id, upper(brand) AS brand_key FROM v_catalog")
def brand_key(v: Views) -> DataFrame:
    return v.catalog.select("product_id", X.brand_key(F.col("brand")).alias("brand_key"))


@query(
    "cluster_label",
    "SELECT product_id, class || '_' || brand || '_' || name AS cluster FROM v_catalog",
)
def cluster_label(v: Views) -> DataFrame:
    label = X.cluster_label(F.col("class"), F.col("brand"), F.col("name"))
    return v.catalog.select("product_id", label.alias("cluster"))


@query(
    "cluster_relabel",
    "SELECT id, split_part(cluster, '_', 1) || '_' || split_part(cluster, '_', 2) || '_' ||"
    " split_part(cluster, '_', 4) AS cluster FROM v_categorised",
)
def cluster_relabel(v: Views) -> DataFrame:
    from kindred.plans.segmentation import segment_pipeline

    members = segment_pipeline(v.stored_labels, v.categories, relabel=False)
    return members.select("id", X.cluster_relabel(F.col("cluster")).alias("cluster"))


_RAW_LABEL = "c_mktsegment || ' (' || c_nationkey || ')-x'"


@query(
    "column_label_sanitize",
    "SELECT c_custkey, replace(replace(replace(replace(raw, '(', ''), ')', ''), '-', ' '), ' ', '_')"
    " AS words, replace(raw, ' ', '_') AS spaces, replace(replace(replace(replace(raw, '-', ''),"
    f" '(', ''), ')', ''), ' ', '_') AS compact FROM (SELECT c_custkey, {_RAW_LABEL} AS raw"
    " FROM customer)",
)
def column_label_sanitize(v: Views) -> DataFrame:
    raw = F.concat("c_mktsegment", F.lit(" ("), F.col("c_nationkey").cast("string"), F.lit(")-x"))
    variants = [X.sanitize_label(raw, name).alias(name) for name in ("words", "spaces", "compact")]
    return v.table("customer").select("c_custkey", *variants)


@query(
    "prefix_columns",
    "SELECT product_id, name AS in_name, brand AS in_brand, price AS in_price FROM v_catalog",
)
def prefix_columns(v: Views) -> DataFrame:
    chosen = v.catalog.select("product_id", "name", "brand", "price")
    return T.prefix_columns(chosen, "in_", ["product_id"])


_WEIGHTED_SQL = "SELECT source, sim, round(CAST(score AS DOUBLE), 6) AS score FROM v_scores"


@query("weighted_score", _WEIGHTED_SQL)
def weighted(v: Views) -> DataFrame:
    score = weighted_score().cast("double")
    return v.edges.select("source", "sim", F.round(score, 6).alias("score"))


@query("scalar_udf", _WEIGHTED_SQL)
def scalar_udf(v: Views) -> DataFrame:
    score = weighted_score_udf()("bert_sim", "accord_sim", "season_sim", "note_sim")
    return v.edges.select("source", "sim", F.round(score.cast("double"), 6).alias("score"))


@query(
    "detail_text",
    "SELECT product_id, 'Brand: ' || upper(brand) || chr(10) || 'Category: ' || class || chr(10)"
    " || 'Size: ' || size AS details FROM v_catalog",
)
def detail_text(v: Views) -> DataFrame:
    details = X.detail_text([
        ("Brand", F.upper("brand")), ("Category", F.col("class")),
        ("Size", F.col("size").cast("string")),
    ])
    return v.catalog.select("product_id", details.alias("details"))


@query("constant_column", "SELECT product_id, brand, CAST(1 AS BIGINT) AS dummy FROM v_catalog")
def constant_column(v: Views) -> DataFrame:
    return v.catalog.select("product_id", "brand", F.lit(1).cast("bigint").alias("dummy"))


@query(
    "tidy_projection",
    "SELECT product_id AS item_code, brand AS brand_name, name AS title, class AS class_name,"
    " price AS price_hk FROM v_catalog",
)
def tidy_projection(v: Views) -> DataFrame:
    return T.tidy_projection(v.catalog, {
        "product_id": "item_code", "brand": "brand_name", "name": "title",
        "class": "class_name", "price": "price_hk",
    })


@query("argmax_key", f"SELECT product_id, {sql_argmax(VOTE_KEYS, _VOTE_LIST)} AS winner FROM v_daily")
def argmax_key(v: Views) -> DataFrame:
    return v.daily.select("product_id", H.argmax_key(F.col("votes")).alias("winner"))


@query(
    "merge_keys",
    "SELECT product_id, "
    + sql_argmax(["click", "signup", "view", "error"], "[click, signup, view, error + purchase]")
    + " AS winner, CAST(error + purchase AS BIGINT) AS merged, CAST((click > 0)::INT +"
    " (signup > 0)::INT + (view > 0)::INT + 1 AS BIGINT) AS n_keys FROM v_daily",
)
def merge_keys(v: Views) -> DataFrame:
    merged = v.daily.select(
        "product_id", H.merge_keys(F.col("votes"), ["purchase", "error"], "error").alias("m")
    )
    return merged.select(
        "product_id", H.argmax_key(F.col("m")).alias("winner"),
        H.votes_of(F.col("m"), "error").alias("merged"),
        F.size("m").cast("bigint").alias("n_keys"),
    )


@query(
    "drop_keys",
    "SELECT product_id, CAST((error > 0)::INT + (purchase > 0)::INT + (signup > 0)::INT AS BIGINT)"
    " AS n_keys, CASE WHEN error + purchase + signup > 0 THEN "
    + sql_argmax(["error", "purchase", "signup"], "[error, purchase, signup]")
    + " END AS winner FROM v_daily",
)
def drop_keys(v: Views) -> DataFrame:
    rest = v.daily.select("product_id", H.drop_keys(F.col("votes"), ["click", "view"]).alias("m"))
    return rest.select(
        "product_id", F.size("m").cast("bigint").alias("n_keys"),
        H.argmax_key(F.col("m")).alias("winner"),
    )


@query(
    "day_night",
    "SELECT id, CASE WHEN season_n[1] > season_n[3] THEN 'day' ELSE 'night' END AS day_night"
    " FROM v_items",
)
def day_night(v: Views) -> DataFrame:
    return v.items.select("id", H.day_night(F.col("season_rating")).alias("day_night"))


@query("season_bucket", "SELECT id, season FROM v_labels")
def season_bucket(v: Views) -> DataFrame:
    return v.items.select("id", H.season_bucket(F.col("season_rating")).alias("season"))


@query(
    "rename_map_keys",
    "SELECT id, nullif(price_n[1], 0) AS good_value, nullif(price_n[2], 0) AS great_value,"
    " nullif(price_n[3], 0) AS ok, nullif(price_n[4], 0) AS overpriced,"
    " 'good_value|great_value|ok|overpriced' AS keys FROM v_items",
)
def rename_map_keys(v: Views) -> DataFrame:
    renamed = v.items.select("id", H.rename_map_keys(F.col("price_value")).alias("m"))
    names = [key.replace(" ", "_") for key in PRICES]
    return renamed.select(
        "id", *[F.element_at("m", F.lit(name)).alias(name) for name in names],
        F.array_join(F.map_keys("m"), "|").alias("keys"),
    )


@query(
    "present_keys",
    "SELECT id, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN longevity_n[{i}] > 0 THEN '{k}' END" for i, k in enumerate(LONGEVITY, 1))
    + "], lambda x: x IS NOT NULL), '|') AS keys FROM v_items",
)
def present_keys(v: Views) -> DataFrame:
    keys = H.present_keys(F.col("longevity"))
    return v.items.select("id", F.array_join(keys, "|").alias("keys"))


@query(
    "map_to_columns",
    "SELECT product_id, " + ", ".join(f"{k} AS votes_{k}" for k in VOTE_KEYS) + " FROM v_daily",
)
def map_to_columns(v: Views) -> DataFrame:
    return H.map_to_columns(v.daily, "product_id", "votes", VOTE_KEYS, "votes_")


@query(
    "row_percentage",
    "SELECT id, " + ", ".join(
        f"round(gender_n[{i}] / (gender_n[1] + gender_n[2] + gender_n[3]), 6) AS {k}"
        for i, k in enumerate(GENDERS, 1)
    ) + " FROM v_items",
)
def row_percentage(v: Views) -> DataFrame:
    counts = H.map_to_columns(v.items, "id", "gender_vote", GENDERS)
    shares = H.row_percentage(counts, GENDERS)
    return shares.select("id", *[F.round(key, 6).alias(key) for key in GENDERS])


