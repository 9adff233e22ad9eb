"""Taxonomies, filters, joins, aggregates, row choice and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.operators import features as FE
from kindred.operators import matching as M
from kindred.operators import tables as T
from kindred.operators import taxonomy as X
from kindred.operators.bitmaps import label_index
from kindred.operators.catalog import region_pivot
from kindred.operators.segments import label_sets
from workload.registry import query
from workload.views import MORE_CLASSES, Views, sql_taxonomy

_REGIONS = ["A", "N", "R"]


# --- taxonomies -------------------------------------------------------------------


@query(
    "taxonomy_lookup",
    'SELECT product_id, class, grp AS "group" FROM v_catalog LEFT JOIN v_first ON term = class',
)
def taxonomy_lookup(v: Views) -> DataFrame:
    return X.taxonomy_lookup(v.catalog.select("product_id", "class"), v.classes, "class", "group")


@query(
    "two_level_lookup",
    "SELECT product_id, class, f.grp AS family FROM v_catalog LEFT JOIN v_first c"
    " ON c.term = class LEFT JOIN v_first_family f ON f.term = c.grp",
)
def two_level_lookup(v: Views) -> DataFrame:
    return X.two_level_lookup(
        v.catalog.select("product_id", "class"), v.classes, v.class_families, "class", "family"
    )


@query(
    "taxonomy_merge",
    "SELECT product_id, class, grp AS merged FROM v_catalog LEFT JOIN (SELECT term,"
    ' arg_min("group", place) AS grp FROM (SELECT term, "group", min(pos) OVER (PARTITION BY'
    ' "group") AS place FROM (SELECT "group", term, group_pos AS pos FROM v_taxonomy UNION ALL'
    ' SELECT "group", term, group_pos + 100 FROM (' + sql_taxonomy("more", MORE_CLASSES)
    + "))) GROUP BY term) ON term = class",
)
def taxonomy_merge(v: Views) -> DataFrame:
    merged = X.taxonomy_merge(v.classes, v.taxonomy("more", MORE_CLASSES), "merged")
    return X.taxonomy_lookup(v.catalog.select("product_id", "class"), merged, "class", "merged")


@query(
    "unmapped_terms",
    "SELECT 'unmapped' AS kind, note AS value FROM v_notes WHERE note NOT IN (SELECT term FROM"
    " v_first) GROUP BY note UNION ALL SELECT DISTINCT 'group', coalesce(grp, '') FROM v_notes"
    " LEFT JOIN v_first ON term = note",
)
def unmapped_terms(v: Views) -> DataFrame:
    notes = v.notes.select(F.explode("notes").alias("note"))
    missing = X.unmapped_terms(notes, v.classes, "note").select(
        F.lit("unmapped").alias("kind"), F.col("term").alias("value")
    )
    seen = X.groups_seen(notes, v.classes, "note").select(
        F.lit("group").alias("kind"), F.col("group").alias("value")
    )
    return missing.unionByName(seen)


@query(
    "replicate_membership",
    "SELECT product_id, class, g AS \"group\" FROM v_catalog JOIN (SELECT term, \"group\" AS g FROM"
    " v_taxonomy WHERE \"group\" <> 'big' UNION SELECT t.term, o.\"group\" FROM v_taxonomy t,"
    " (SELECT DISTINCT \"group\" FROM v_taxonomy WHERE \"group\" <> 'big') o WHERE t.\"group\" = 'big')"
    " ON term = class",
)
def replicate_membership(v: Views) -> DataFrame:
    spread = X.replicate_membership(v.classes, ["big"]).select(F.col("term").alias("class"), "group")
    return v.catalog.select("product_id", "class").join(spread, "class")


@query(
    "cluster_merge",
    "SELECT product_id, coalesce(grp, class) AS cluster FROM v_catalog"
    " LEFT JOIN v_first ON term = class",
)
def cluster_merge(v: Views) -> DataFrame:
    merged = X.cluster_merge(v.catalog.select("product_id", "class"), v.classes, "class", "cluster")
    return merged.select("product_id", "cluster")


@query(
    "explode_notes",
    "SELECT product_id, note, grp AS \"group\" FROM v_notes LEFT JOIN v_first ON term = note",
)
def explode_notes(v: Views) -> DataFrame:
    notes = v.notes.select("product_id", F.explode_outer("notes").alias("note"))
    return X.taxonomy_lookup(notes, v.classes, "note", "group")


# --- filters ------------------------------------------------------------------------


@query(
    "latest_snapshot",
    "SELECT product_id, region, stock, price FROM v_feed"
    " WHERE load_date = (SELECT max(load_date) FROM v_feed)",
)
def latest_snapshot(v: Views) -> DataFrame:
    return T.latest_snapshot(v.feed, "load_date").select("product_id", "region", "stock", "price")


@query("class_filter", "SELECT product_id, name FROM v_catalog WHERE class = 'PROMO'")
def class_filter(v: Views) -> DataFrame:
    return T.class_filter(v.catalog, "class", "PROMO").select("product_id", "name")


@query(
    "nonblank_filter",
    "SELECT id, name_cleaned FROM v_left_clean WHERE name_cleaned <> ''",
)
def nonblank_filter(v: Views) -> DataFrame:
    side = M.catalogue_side(v.left, "id", "brand", "name", "vector", True)
    return T.nonblank_filter(side, "name_cleaned").select("id", "name_cleaned")


@query(
    "id_in_list",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def id_in_list(v: Views) -> DataFrame:
    docs = v.table("documents").select("doc_id", "lang", "source")
    return T.id_in_list(docs, v.table("labels"), "doc_id")


@query(
    "threshold_filter",
    "SELECT id, brand_key, sim FROM (SELECT l.id, l.brand_key, round(list_cosine_similarity("
    "l.vector, r.vector), 6) AS sim FROM v_left_clean l JOIN v_right_clean r ON l.id = r.id)"
    " WHERE sim >= 0.1",
)
def threshold_filter(v: Views) -> DataFrame:
    from kindred.functions.vectors import cosine_similarity

    both = v.left.join(v.right.select("id", F.col("vector").alias("other")), "id")
    sim = F.round(cosine_similarity(F.col("vector"), F.col("other")), 6)
    return both.select("id", F.upper("brand").alias("brand_key"), sim.alias("sim")).where("sim >= 0.1")


@query(
    "notnull_category",
    "SELECT p_partkey AS id, lower(strip_accents(p_brand)) AS brand, category FROM part"
    " JOIN v_folded_categories c ON c.brand = lower(strip_accents(p_brand))"
    " WHERE category IS NOT NULL",
)
def notnull_category(v: Views) -> DataFrame:
    from kindred.operators.segments import left_join_category

    parts = v.table("part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    return T.notnull_filter(left_join_category(parts, "brand", v.categories), "category")


@query(
    "fetch_manifest",
    "SELECT url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE strlen(html) > 2000)",
)
def fetch_manifest(v: Views) -> DataFrame:
    stored = v.table("pages").select(
        "url", F.greatest(F.octet_length("html") - 2000, F.lit(0)).alias("size")
    )
    return T.fetch_manifest(v.table("pages").select("url"), stored, "url", "size")


# --- joins --------------------------------------------------------------------------


@query(
    "inner_join",
    "SELECT o_orderkey, o_custkey, l_partkey, l_quantity FROM orders JOIN lineitem"
    " ON o_orderkey = l_orderkey",
)
def inner_join(v: Views) -> DataFrame:
    orders = v.table("orders").select("o_orderkey", "o_custkey")
    lines = v.table("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_quantity"
    )
    return orders.join(lines, "o_orderkey", "inner")


@query(
    "left_join_alias",
    "SELECT product_id, c.brand AS company, a.brand FROM v_catalog c"
    " LEFT JOIN v_aliases a ON a.company = c.brand",
)
def left_join_alias(v: Views) -> DataFrame:
    products = v.catalog.select("product_id", F.col("brand").alias("company"))
    aliases = v.aliases.withColumnRenamed("company", "alias")
    return T.left_join_alias(products, aliases, "company", "alias", "brand")


@query(
    "left_join_category",
    "SELECT p_partkey AS id, lower(strip_accents(p_brand)) AS brand, category FROM part"
    " LEFT JOIN v_folded_categories c ON c.brand = lower(strip_accents(p_brand))",
)
def left_join_category(v: Views) -> DataFrame:
    from kindred.operators.segments import left_join_category as join

    parts = v.table("part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    return join(parts, "brand", v.categories)


@query(
    "left_join_attributes",
    "SELECT o_orderkey, o_custkey, c_mktsegment, c_acctbal FROM orders"
    " LEFT JOIN customer ON c_custkey = o_custkey",
)
def left_join_attributes(v: Views) -> DataFrame:
    members = v.table("orders").select("o_orderkey", "o_custkey")
    attributes = v.table("customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal"
    )
    return members.join(attributes, "o_custkey", "left")


@query(
    "incremental_anti_join",
    "SELECT p_partkey AS id, p_name FROM part WHERE p_partkey NOT IN (SELECT vec_id FROM embeddings)",
)
def incremental_anti_join(v: Views) -> DataFrame:
    stored = v.store.select("id")
    parts = v.table("part").select(F.col("p_partkey").alias("id"), "p_name")
    return T.anti_join(parts, stored, "id")


@query(
    "blocked_cross_join",
    "SELECT left_id, right_id, round(sim, 6) AS sim FROM v_pairs"
    " QUALIFY row_number() OVER (PARTITION BY left_id ORDER BY sim DESC, right_id) = 1",
)
def blocked_cross_join(v: Views) -> DataFrame:
    left = M.catalogue_side(v.left, "id", "brand", "name", "vector", True)
    right = M.catalogue_side(v.right, "id", "company", "name", "vector")
    best = M.nearest_in_block(left, right, share_token=False)
    return best.select("left_id", "right_id", F.round("sim", 6).alias("sim"))


@query(
    "feature_table_join",
    "SELECT o_custkey AS id, n_orders, total, c_acctbal FROM (SELECT o_custkey, count(*) AS n_orders,"
    " round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey)"
    " JOIN customer ON c_custkey = o_custkey",
)
def feature_table_join(v: Views) -> DataFrame:
    by_customer = v.table("orders").groupBy(F.col("o_custkey").alias("id"))
    counts = by_customer.agg(F.count(F.lit(1)).alias("n_orders"))
    totals = by_customer.agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    balances = v.table("customer").select(F.col("c_custkey").alias("id"), "c_acctbal")
    return T.feature_table_join([counts, totals, balances], "id")


@query(
    "set_intersection_join",
    "SELECT id FROM v_labels WHERE season = 'SS' AND day_night = 'day' AND sillage_label = 'strong'"
    " AND id IN (SELECT id FROM v_note_groups WHERE grp = 'ASIA')",
)
def set_intersection_join(v: Views) -> DataFrame:
    sets = label_sets(v.stored_labels, ["season", "day_night", "sillage_label", "note_groups"])
    wanted = {"season": "SS", "day_night": "day", "sillage_label": "strong", "note_groups": "ASIA"}
    return label_index(sets).intersection(wanted)


# --- aggregates ---------------------------------------------------------------------


@query("group_count", "SELECT brand, count(*) AS n FROM v_catalog GROUP BY brand")
def group_count(v: Views) -> DataFrame:
    return v.catalog.groupBy("brand").agg(F.count(F.lit(1)).alias("n"))


@query(
    "nunique_desc",
    "SELECT note, count(DISTINCT product_id) AS \"count\" FROM v_notes GROUP BY note",
)
def nunique_desc(v: Views) -> DataFrame:
    notes = v.notes.select("product_id", F.explode("notes").alias("note"))
    return FE.nunique_desc(notes, "note", "product_id")


def _region_cells(name: str) -> str:
    return ", ".join(
        f"coalesce(CAST(trunc(arg_min({name}, (l_orderkey, l_linenumber, {name})) FILTER"
        f" (WHERE region = '{r}')) AS BIGINT), 0) AS {name}_{r.lower()}"
        for r in _REGIONS
    )


REGION_PIVOT_SQL = (
    f"SELECT product_id, {_region_cells('stock')}, {_region_cells('price')} FROM "
)


def region_cells_as_long(df: DataFrame) -> DataFrame:
    return df.withColumns({
        name: F.col(name).cast("bigint")
        for name in df.columns if name.startswith(("stock_", "price_"))
    })


@query("region_pivot", REGION_PIVOT_SQL + "v_feed GROUP BY product_id")
def pivot_by_region(v: Views) -> DataFrame:
    pivoted = region_pivot(
        v.feed, "product_id", "region", {"stock": "stock", "price": "price"},
        ["l_orderkey", "l_linenumber"], _REGIONS,
    )
    return region_cells_as_long(pivoted)


@query("cluster_sizes", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def cluster_sizes(v: Views) -> DataFrame:
    from kindred.operators.clustering import cluster_sizes as sizes

    return sizes(v.table("embeddings"), "label")


@query(
    "distinct_count_stats",
    "SELECT count(*) AS left_brands, count(r.brand_key) AS common_brands FROM"
    " (SELECT DISTINCT upper(brand) AS brand_key FROM v_catalog) LEFT JOIN"
    " (SELECT DISTINCT upper(brand) AS brand_key FROM v_categories) r USING (brand_key)",
)
def distinct_count_stats(v: Views) -> DataFrame:
    return M.distinct_count_stats(_brands(v.catalog), _brands(v.categories))


def _brands(df: DataFrame) -> DataFrame:
    from kindred.functions.text import brand_key

    return df.select(brand_key(F.col("brand")).alias("brand_key"))


# --- row choice and sets --------------------------------------------------------------


@query(
    "group_max_filter",
    "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem"
    " QUALIFY l_extendedprice = max(l_extendedprice) OVER (PARTITION BY l_orderkey)",
)
def group_max_filter(v: Views) -> DataFrame:
    lines = v.table("lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    return T.group_max_filter(lines, ["l_orderkey"], "l_extendedprice")


@query(
    "dedupe_first",
    "SELECT url, page_id, md5(html) AS html FROM pages"
    " QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1",
)
def dedupe_first(v: Views) -> DataFrame:
    pages = v.table("pages").select("url", "page_id", F.md5("html").alias("html"))
    return T.dedupe_first(pages, ["url"], [F.col("page_id")])


@query("distinct_rows", "SELECT DISTINCT brand, name, class FROM v_catalog")
def distinct_rows(v: Views) -> DataFrame:
    return v.catalog.select("brand", "name", "class").dropDuplicates()


@query(
    "union_all",
    "SELECT product_id, class, name, CAST(NULL AS VARCHAR) AS url FROM v_catalog UNION ALL"
    " SELECT page_id, NULL, NULL, url FROM pages",
)
def union_all(v: Views) -> DataFrame:
    products = v.catalog.select("product_id", "class", "name")
    pages = v.table("pages").select(F.col("page_id").alias("product_id"), "url")
    return T.union_all([products, pages])


@query(
    "brand_intersect",
    "SELECT upper(brand) AS brand_key FROM v_catalog INTERSECT SELECT upper(brand) FROM v_categories",
)
def brand_intersect(v: Views) -> DataFrame:
    return M.brand_intersect(_brands(v.catalog), _brands(v.categories))


@query(
    "brand_except",
    "SELECT upper(brand) AS brand_key FROM v_catalog EXCEPT SELECT upper(brand) FROM v_categories",
)
def brand_except(v: Views) -> DataFrame:
    return M.brand_except(_brands(v.catalog), _brands(v.categories))


@query("distinct_sorted", "SELECT DISTINCT brand FROM v_catalog ORDER BY brand")
def distinct_sorted(v: Views) -> DataFrame:
    return v.catalog.select("brand").distinct().orderBy("brand")


@query(
    "review_sample",
    "SELECT CAST(draw AS BIGINT) AS draw, product_id, name, brand FROM (SELECT UNNEST(range(30))"
    " AS draw), v_catalog QUALIFY row_number() OVER (PARTITION BY draw ORDER BY"
    " md5(product_id || ':0:' || draw), product_id) = 1",
)
def review_sample(v: Views) -> DataFrame:
    rows = v.catalog.select("product_id", "name", "brand")
    return T.review_sample(rows, "product_id", 30).withColumn("draw", F.col("draw").cast("bigint"))


@query("brand_slice", "SELECT product_id, brand, name FROM v_catalog WHERE brand = 'Brand#7'")
def brand_slice(v: Views) -> DataFrame:
    return T.class_filter(v.catalog, "brand", "Brand#7").select("product_id", "brand", "name")

