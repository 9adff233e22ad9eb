"""The roles the library works on, built from the given tables.

Each ``v_`` view exists twice: as a DataFrame here and as a SQL common table
expression in ``SQL_VIEWS``, so that a check never shares code with what it checks.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions.histograms import count_histogram
from kindred.operators.skew import join_large
from kindred.operators.taxonomy import (
    ACCORD_FAMILIES,
    taxonomy_table,
)
from kindred.plans.segmentation import Taxonomies, label_items, segment_pipeline
from kindred.session import local_table, materialise

VOTE_KEYS = ["click", "error", "purchase", "signup", "view"]
ACCORDS = ["citrus", "leather", "musky", "oud", "rose", "vanilla", "zest"]
SEASONS = ["day", "fall", "night", "spring", "summer", "winter"]
SILLAGE = ["enormous", "intimate", "moderate", "strong"]
LONGEVITY = ["eternal", "long_lasting", "moderate", "very_weak", "weak"]
GENDERS = ["female", "male", "unisex"]
PRICES = ["good value", "great value", "ok", "overpriced"]

# Own taxonomies over the tables' vocabulary: a term in two groups, one term in none.
ACCORD_GROUPS = {
    "citrus": ["citrus"],
    "floral": ["rose"],
    "woody": ["leather"],
    "vanilla": ["vanilla", "oud"],
    "musky": ["musky", "leather"],
}
NOTE_REGIONS = {
    "Fresh & Light": ["AFRICA", "AMERICA"],
    "Warm & Earthy": ["ASIA"],
    "Sweet & Rich": ["EUROPE"],
}
CLASSES = {
    "value": ["ECONOMY", "PROMO"],
    "core": ["STANDARD", "MEDIUM", "PROMO"],
    "big": ["LARGE"],
}
CLASS_FAMILIES = {"main": ["core", "value"], "rest": ["big", "core"]}
MORE_CLASSES = {"big": ["SMALL"], "odd": ["MEDIUM", "NONE"]}
CATEGORIES = [
    ("Bránd#1", "niche"), ("BRAND#2", "designer "), ("Brand#3", ""), ("Brand#4", None),
    ("Brànd#5", "mass market"), ("Brand#6", "niche"), ("Brand#7", "designer "),
    ("Brañd#8", "niche"), ("Brand#9", "mass market"), ("Brand#10", "niche"), ("Brand#11", ""),
    ("Brand#12", "designer "), ("Brand#13", "niche"), ("Brand#14", "mass market"),
    ("Brand#16", "niche"), ("Brand#17", "designer "), ("Brand#18", "niche"), ("Brand#19", None),
    ("Brand#21", "mass market"), ("Brand#22", "niche"),
]
ALIASES = [
    ("Brand#1", "BRAND ONE"), ("Brand#2", "BRAND TWO"), ("Brand#2", "BRAND TWO BIS"),
    ("Brand#3", None),
]


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


def sql_list(values: list[str]) -> str:
    """A SQL list literal."""
    return f"[{_quoted(values)}]"


def sql_argmax(keys: list[str], counts: str) -> str:
    """First key with the largest of the listed counts."""
    return f"list_extract({sql_list(keys)}, list_position({counts}, list_max({counts})))"


def sql_taxonomy(name: str, groups: dict[str, list[str]]) -> str:
    """A taxonomy as a VALUES list."""
    rows = [
        f"('{name}', '{group}', {position}, '{term}')"
        for position, (group, terms) in enumerate(groups.items())
        for term in terms
    ]
    return (
        "SELECT * FROM (VALUES " + ", ".join(rows)
        + ') t(taxonomy, "group", group_pos, term)'
    )


def _sql_first(view: str) -> str:
    return f'SELECT term, arg_min("group", group_pos) AS grp FROM {view} GROUP BY term'


def _sql_counts(conditions: list[str]) -> str:
    return "[" + ", ".join(f"count(*) FILTER (WHERE {c})" for c in conditions) + "]"


_MONTH = "month(l_shipdate)"
_TAX = "CAST(round(l_tax * 100) AS INT)"
_DISCOUNT = "CAST(round(l_discount * 100) AS INT)"
_CONDITIONS = {
    "accord_n": [f"l_linenumber = {number}" for number in range(1, 8)],
    "season_n": [
        "l_linestatus = 'O'", f"{_MONTH} IN (9, 10, 11)", "l_linestatus = 'F'",
        f"{_MONTH} IN (3, 4, 5)", f"{_MONTH} IN (6, 7, 8)", f"{_MONTH} IN (12, 1, 2)",
    ],
    "sillage_n": [
        f"{_TAX} >= 7", f"{_TAX} <= 2", f"{_TAX} IN (3, 4)", f"{_TAX} IN (5, 6)",
    ],
    "longevity_n": [
        f"{_DISCOUNT} >= 9", f"{_DISCOUNT} IN (7, 8)", f"{_DISCOUNT} IN (4, 5, 6)",
        f"{_DISCOUNT} <= 1", f"{_DISCOUNT} IN (2, 3)",
    ],
    "gender_n": ["l_returnflag = 'A'", "l_returnflag = 'N'", "l_returnflag = 'R'"],
    "price_n": [
        "l_quantity > 10 AND l_quantity <= 20", "l_quantity <= 10",
        "l_quantity > 20 AND l_quantity <= 30", "l_quantity > 30",
    ],
}
_HISTOGRAMS = {
    "main_accords": ("accord_n", ACCORDS),
    "season_rating": ("season_n", SEASONS),
    "sillage": ("sillage_n", SILLAGE),
    "longevity": ("longevity_n", LONGEVITY),
    "gender_vote": ("gender_n", GENDERS),
    "price_value": ("price_n", PRICES),
}

SQL_VIEWS = {
    "v_catalog": "SELECT p_partkey AS product_id, p_name AS name, p_brand AS brand,"
    " p_type AS class, p_size AS size, p_retailprice AS price FROM part",
    "v_feed": "SELECT l_partkey AS product_id, l_returnflag AS region, l_quantity AS stock,"
    " l_extendedprice AS price, CAST(date_trunc('year', l_shipdate) AS DATE) AS load_date,"
    " l_orderkey, l_linenumber FROM lineitem",
    "v_votes": "SELECT user_id AS product_id, event_type AS k, count(*) AS n FROM events"
    " GROUP BY ALL",
    "v_votes_wide": "SELECT user_id AS product_id, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {k}" for k in VOTE_KEYS)
    + " FROM events GROUP BY user_id",
    "v_daily": "SELECT user_id || ':' || CAST(CAST(ts AS DATE) AS VARCHAR) AS product_id, "
    + ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {k}" for k in VOTE_KEYS)
    + " FROM events GROUP BY ALL",
    "v_notes": "SELECT l_orderkey AS product_id, p_type AS note FROM lineitem"
    " JOIN part ON l_partkey = p_partkey GROUP BY ALL",
    "v_taxonomy": sql_taxonomy("class", CLASSES),
    "v_first": _sql_first("v_taxonomy"),
    "v_families": sql_taxonomy("family", CLASS_FAMILIES),
    "v_first_family": _sql_first("v_families"),
    "v_categories": "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{brand}', {'NULL' if category is None else repr(category)})"
        for brand, category in CATEGORIES
    )
    + ") t(brand, category)",
    "v_aliases": "SELECT * FROM (VALUES "
    + ", ".join(
        f"('{company}', {'NULL' if brand is None else repr(brand)})" for company, brand in ALIASES
    )
    + ") t(company, brand)",
    "v_left": "SELECT vec_id AS id, CAST(label AS VARCHAR) AS brand,"
    " p_name || ' Eau de Parfum ' || p_size || 'ml' AS name,"
    " list_reverse(embedding) AS vector FROM embeddings LEFT JOIN part ON p_partkey = vec_id",
    "v_right": "SELECT vec_id AS id, CAST(label AS VARCHAR) AS company,"
    " p_name || ' EAU DE TOILETTE' AS name, embedding AS vector"
    " FROM embeddings LEFT JOIN part ON p_partkey = vec_id",
    "v_left_clean": "SELECT id, upper(coalesce(brand, '')) AS brand_key, coalesce(regexp_replace("
    "replace(replace(replace(lower(name), 'eau de parfum', ''), 'eau de cologne', ''),"
    " 'eau de toilette', ''), '\\b\\d+(?:ml|g)\\b', '', 'g'), '') AS name_cleaned,"
    " CAST(vector AS DOUBLE[]) AS vector FROM v_left",
    "v_right_clean": "SELECT id, upper(coalesce(company, '')) AS brand_key, coalesce("
    "replace(replace(replace(lower(name), 'eau de parfum', ''), 'eau de cologne', ''),"
    " 'eau de toilette', ''), '') AS name_cleaned,"
    " CAST(vector AS DOUBLE[]) AS vector FROM v_right",
    "v_left_tokens": "SELECT *, list_distinct(list_filter(string_split(name_cleaned, ' '),"
    " lambda x: x <> '')) AS tokens FROM v_left_clean",
    "v_right_tokens": "SELECT *, list_distinct(list_filter(string_split(name_cleaned, ' '),"
    " lambda x: x <> '')) AS tokens FROM v_right_clean",
    "v_pairs": "SELECT l.id AS left_id, r.id AS right_id, l.tokens AS left_tokens,"
    " r.tokens AS right_tokens, l.name_cleaned AS left_name, r.name_cleaned AS right_name,"
    " round(list_cosine_similarity(l.vector, r.vector), 12) AS sim,"
    " len(list_intersect(l.tokens, r.tokens)) AS shared"
    " FROM v_left_tokens l JOIN v_right_tokens r USING (brand_key)",
    "v_item_counts": "SELECT l_partkey AS id, "
    + ", ".join(f"{_sql_counts(c)} AS {name}" for name, c in _CONDITIONS.items())
    + " FROM lineitem GROUP BY l_partkey",
    "v_items": "SELECT c.*, p_brand AS brand, lower(p_type) AS for_gender"
    " FROM v_item_counts c JOIN part ON p_partkey = id",
    "v_item_notes": "SELECT l_partkey AS id, n_name AS note FROM lineitem"
    " JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
    " GROUP BY ALL",
    "v_listed_notes": "SELECT l_partkey AS id, nullif(r_name, 'MIDDLE EAST') AS grp,"
    " l_linenumber <= 2 AS top, l_linenumber >= 4 AS base FROM lineitem"
    " JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"
    " JOIN region ON n_regionkey = r_regionkey",
    "v_note_groups": "SELECT id, note, nullif(r_name, 'MIDDLE EAST') AS grp FROM v_item_notes"
    " JOIN nation ON n_name = note JOIN region ON n_regionkey = r_regionkey",
    "v_note_families": "SELECT DISTINCT id, CASE WHEN grp IN ('AFRICA', 'AMERICA') THEN"
    " 'Fresh & Light' WHEN grp = 'ASIA' THEN 'Warm & Earthy' WHEN grp = 'EUROPE' THEN"
    " 'Sweet & Rich' END AS family_note FROM v_note_groups",
    "v_labels": "SELECT id, brand, for_gender, top_accord, accord_group,"
    " CASE accord_group WHEN 'woody' THEN 'earthy' WHEN 'musky' THEN 'earthy'"
    " WHEN 'vanilla' THEN 'sweet' ELSE accord_group END AS family,"
    " day_night, season, sillage_label, longevity_label, sillage_raw, longevity_raw FROM"
    " (SELECT *, CASE top_accord WHEN 'citrus' THEN 'citrus' WHEN 'rose' THEN 'floral'"
    " WHEN 'leather' THEN 'woody' WHEN 'vanilla' THEN 'vanilla' WHEN 'oud' THEN 'vanilla'"
    " WHEN 'musky' THEN 'musky' END AS accord_group FROM (SELECT id, brand, for_gender, "
    + sql_argmax(ACCORDS, "accord_n")
    + " AS top_accord, CASE WHEN season_n[1] > season_n[3] THEN 'day' ELSE 'night' END"
    " AS day_night, CASE WHEN "
    + sql_argmax(
        ["fall", "spring", "summer", "winter"],
        "[season_n[2], season_n[4], season_n[5], season_n[6]]",
    )
    + " IN ('fall', 'winter') THEN 'AW' ELSE 'SS' END AS season, "
    + sql_argmax(
        ["intimate", "moderate", "strong"],
        "[sillage_n[2], sillage_n[3], sillage_n[4] + sillage_n[1]]",
    )
    + " AS sillage_label, "
    + sql_argmax(
        ["moderate", "long_lasting", "weak"],
        "[longevity_n[3], longevity_n[1] + longevity_n[2], longevity_n[4] + longevity_n[5]]",
    )
    + " AS longevity_label, "
    + sql_argmax(SILLAGE, "sillage_n")
    + " AS sillage_raw, "
    + sql_argmax(LONGEVITY, "longevity_n")
    + " AS longevity_raw FROM v_items))",
    "v_segments": "SELECT id, family, season, family_note AS note_family,"
    " family || '_' || season || '_' || family_note AS cluster"
    " FROM v_labels JOIN v_note_families USING (id)"
    " WHERE family IS NOT NULL AND family_note IS NOT NULL",
    "v_folded_categories": "SELECT lower(strip_accents(brand)) AS brand,"
    " coalesce(category, '') AS category FROM v_categories",
    "v_categorised": "SELECT s.id, lower(strip_accents(l.brand)) AS brand,"
    " s.cluster || '_' || c.category AS cluster, trim(c.category) AS category"
    " FROM v_segments s JOIN v_labels l USING (id)"
    " JOIN v_folded_categories c ON c.brand = lower(strip_accents(l.brand))",
    "v_members": "SELECT DISTINCT id, brand, split_part(cluster, '_', 1) || '_' ||"
    " split_part(cluster, '_', 2) || '_' || split_part(cluster, '_', 4) AS cluster, category"
    " FROM v_categorised",
    "v_feature_labels": "SELECT id, 'dummy' AS feature, '1' AS label FROM v_labels"
    " UNION ALL SELECT id, 'for_gender', for_gender FROM v_labels"
    " UNION ALL SELECT DISTINCT id, 'group', grp FROM v_note_groups"
    " UNION ALL SELECT id, 'main_accords', accord_group FROM v_labels"
    " UNION ALL SELECT id, 'day_night', day_night FROM v_labels"
    " UNION ALL SELECT id, 'season', season FROM v_labels"
    " UNION ALL SELECT id, 'sillage', sillage_label FROM v_labels"
    " UNION ALL SELECT id, 'longevity', longevity_label FROM v_labels",
    "v_profile": "SELECT feature, label, cluster, count(DISTINCT id) AS n"
    " FROM v_members JOIN v_feature_labels USING (id) GROUP BY ALL",
    "v_modal": "SELECT feature, cluster, label FROM v_profile WHERE label IS NOT NULL"
    " QUALIFY row_number() OVER (PARTITION BY feature, cluster ORDER BY n DESC, label) = 1",
    "v_representatives": "SELECT m.id, m.cluster FROM (SELECT DISTINCT id, cluster FROM v_members) m"
    " JOIN v_modal o USING (cluster) JOIN v_feature_labels f ON f.id = m.id"
    " AND f.feature = o.feature AND f.label = o.label WHERE o.feature <> 'dummy'"
    " GROUP BY ALL HAVING count(*) = 7",
    "v_output": "SELECT m.id, m.brand, m.cluster, m.category, l.family AS main_accords,"
    " l.sillage_label AS sillage, l.longevity_label AS longevity, l.day_night,"
    " CAST(CASE WHEN r.id IS NOT NULL THEN 1 END AS BIGINT) AS rank"
    " FROM v_members m LEFT JOIN v_representatives r USING (id, cluster)"
    " LEFT JOIN v_labels l ON l.id = m.id",
    "v_edges": "SELECT l_partkey AS source, l_suppkey AS sim, l_quantity / 50 AS bert_sim,"
    " 1 - l_discount * 10 AS accord_sim, l_tax * 10 AS season_sim,"
    " CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS note_sim FROM lineitem",
    "v_item_edges": "SELECT l_partkey AS source, l_suppkey * 20 + l_orderkey % 20 AS sim,"
    " l_quantity / 50 AS bert_sim, 1 - l_discount * 10 AS accord_sim, l_tax * 10 AS season_sim,"
    " CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END::DOUBLE AS note_sim FROM lineitem",
    "v_scores": "SELECT source, sim, CAST(bert_sim * 0.4::DOUBLE + accord_sim * 0.3::DOUBLE"
    " + season_sim * 0.1::DOUBLE + note_sim * 0.2::DOUBLE AS FLOAT) AS score FROM v_edges",
    "v_brand_members": "SELECT p_partkey AS id, p_brand AS cluster,"
    " CASE WHEN p_type = 'PROMO' THEN 1 END AS rank FROM part",
    "v_brand_reps": "SELECT cluster, arg_min(id, CASE WHEN rank = 1 THEN 0 ELSE 1000000000000 END + id)"
    " AS representative FROM v_brand_members GROUP BY cluster",
    "v_brand_ranks": "SELECT id, cluster, representative, score,"
    " row_number() OVER (PARTITION BY cluster ORDER BY score DESC, id) AS rank FROM"
    " (SELECT DISTINCT m.id, m.cluster, representative, score FROM v_brand_members m"
    " JOIN v_brand_reps USING (cluster) JOIN v_scores s"
    " ON s.source = m.id AND s.sim = representative)",
    "v_store": "SELECT vec_id AS id, label AS part, CAST(vec_id % 97 AS INT) AS pos, embedding"
    " FROM embeddings UNION ALL SELECT vec_id, label * 3 % 10, CAST(vec_id % 89 + 100 AS INT),"
    " list_reverse(embedding) FROM embeddings",
}


class Views:
    """The views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """One of the given tables."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def taxonomy(self, name: str, groups: dict[str, list[str]]) -> DataFrame:
        """A taxonomy table from a mapping."""
        return taxonomy_table(self.spark, name, groups)

    @cached_property
    def catalog(self) -> DataFrame:
        """Internal catalogue."""
        return self.table("part").select(
            F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"),
            F.col("p_brand").alias("brand"), F.col("p_type").alias("class"),
            F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"),
        )

    @cached_property
    def feed(self) -> DataFrame:
        """Product feed by region and load date."""
        return self.table("lineitem").select(
            F.col("l_partkey").alias("product_id"), F.col("l_returnflag").alias("region"),
            F.col("l_quantity").alias("stock"), F.col("l_extendedprice").alias("price"),
            F.trunc("l_shipdate", "year").alias("load_date"), "l_orderkey", "l_linenumber",
        )

    @cached_property
    def votes(self) -> DataFrame:
        """Vote histogram per user; every user has every key."""
        return count_histogram(
            self.table("events").withColumnRenamed("user_id", "product_id"),
            ["product_id"], "event_type", "votes",
        )

    @cached_property
    def daily(self) -> DataFrame:
        """Vote histogram per user and day; keys are often missing."""
        day = F.concat_ws(":", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
        return count_histogram(
            self.table("events").select(day.alias("product_id"), "event_type"),
            ["product_id"], "event_type", "votes",
        )

    @cached_property
    def notes(self) -> DataFrame:
        """Note list per order: the classes of its products."""
        lines = self.table("lineitem").select("l_orderkey", "l_partkey")
        parts = self.table("part").select("p_partkey", "p_type")
        joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        return joined.groupBy(F.col("l_orderkey").alias("product_id")).agg(
            F.sort_array(F.collect_set("p_type")).alias("notes")
        )

    @cached_property
    def classes(self) -> DataFrame:
        """Taxonomy over product classes."""
        return self.taxonomy("class", CLASSES)

    @cached_property
    def class_families(self) -> DataFrame:
        """Families over the groups of ``classes``."""
        return self.taxonomy("family", CLASS_FAMILIES)

    @cached_property
    def categories(self) -> DataFrame:
        """Brand -> category list."""
        return local_table(self.spark, CATEGORIES, "brand string, category string")

    @cached_property
    def aliases(self) -> DataFrame:
        """Company -> brand list."""
        return local_table(self.spark, ALIASES, "company string, brand string")

    @cached_property
    def left(self) -> DataFrame:
        """Internal side of matching: vectors read back to front."""
        named = self.table("embeddings").join(
            self.table("part"), F.col("p_partkey") == F.col("vec_id"), "left"
        )
        return named.select(
            F.col("vec_id").alias("id"), F.col("label").cast("string").alias("brand"),
            F.concat("p_name", F.lit(" Eau de Parfum "), F.col("p_size").cast("string"),
                     F.lit("ml")).alias("name"),
            F.reverse("embedding").alias("vector"),
        )

    @cached_property
    def right(self) -> DataFrame:
        """External side of matching."""
        named = self.table("embeddings").join(
            self.table("part"), F.col("p_partkey") == F.col("vec_id"), "left"
        )
        return named.select(
            F.col("vec_id").alias("id"), F.col("label").cast("string").alias("company"),
            F.concat("p_name", F.lit(" EAU DE TOILETTE")).alias("name"),
            F.col("embedding").alias("vector"),
        )

    @cached_property
    def items(self) -> DataFrame:
        """Products with histograms and note list.

        Votes and notes are aggregated apart, so that the many counters stay in a
        hash aggregate; both come out partitioned by id and join without a shuffle.
        """
        lines = self.table("lineitem").select(
            F.col("l_partkey").alias("id"), "l_linenumber", "l_linestatus",
            "l_returnflag", "l_quantity", F.month("l_shipdate").alias("month"),
            F.round(F.col("l_tax") * 100).cast("int").alias("tax"),
            F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
        )
        month, tax, discount = F.col("month"), F.col("tax"), F.col("discount")
        quantity, status, flag = F.col("l_quantity"), F.col("l_linestatus"), F.col("l_returnflag")
        conditions = {
            "main_accords": [F.col("l_linenumber") == number for number in range(1, 8)],
            "season_rating": [status == "O", month.isin(9, 10, 11), status == "F",
                              month.isin(3, 4, 5), month.isin(6, 7, 8), month.isin(12, 1, 2)],
            "sillage": [tax >= 7, tax <= 2, tax.isin(3, 4), tax.isin(5, 6)],
            "longevity": [discount >= 9, discount.isin(7, 8), discount.isin(4, 5, 6),
                          discount <= 1, discount.isin(2, 3)],
            "gender_vote": [flag == "A", flag == "N", flag == "R"],
            "price_value": [(quantity > 10) & (quantity <= 20), quantity <= 10,
                            (quantity > 20) & (quantity <= 30), quantity > 30],
        }
        histograms = []
        for name, tests in conditions.items():
            keys = F.array(*[F.lit(key) for key in _HISTOGRAMS[name][1]])
            votes = F.array(*[F.nullif(F.count_if(test), F.lit(0)) for test in tests])
            histograms.append(F.map_from_arrays(keys, votes).alias(name))
        nations = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "n_name")
        )
        notes = (
            self.table("lineitem")
            .select(F.col("l_partkey").alias("id"), "l_suppkey")
            .join(nations, F.col("l_suppkey") == F.col("s_suppkey"))
            .groupBy("id")
            .agg(F.sort_array(F.collect_set("n_name")).alias("middle_notes"))
        )
        parts = self.table("part").select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"),
            F.lower("p_type").alias("for_gender"),
        )
        return join_large(join_large(lines.groupBy("id").agg(*histograms), notes, ["id"]), parts, ["id"])

    @cached_property
    def stored_items(self) -> DataFrame:
        """``items`` as a stored table, read by several steps."""
        return materialise(self.items)

    @cached_property
    def feature_items(self) -> DataFrame:
        """``stored_items`` with the notes of the first and of the last lines as lists of their own."""
        nations = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").alias("l_suppkey"), "n_name")
        )
        line = F.col("l_linenumber")
        lists = (
            self.table("lineitem").select(F.col("l_partkey").alias("id"), "l_suppkey", "l_linenumber")
            .join(nations, "l_suppkey").groupBy("id")
            .agg(*[
                F.sort_array(F.collect_set(F.when(test, F.col("n_name")))).alias(name)
                for name, test in (("top_notes", line <= 2), ("base_notes", line >= 4))
            ])
        )
        return materialise(join_large(self.stored_items, lists, ["id"]))

    @cached_property
    def note_taxonomy(self) -> DataFrame:
        """Nations grouped by region; the nations of one region are left unmapped."""
        mapped = self.table("region").where(F.col("r_name") != "MIDDLE EAST")
        return self.table("nation").join(mapped, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.lit("notes").alias("taxonomy"), F.col("r_name").alias("group"),
            F.col("r_regionkey").alias("group_pos"), F.col("n_name").alias("term"),
        )

    @cached_property
    def taxonomies(self) -> Taxonomies:
        """All lookups of the segmentation."""
        return Taxonomies(
            self.taxonomy("accords", ACCORD_GROUPS),
            self.taxonomy("accord families", ACCORD_FAMILIES),
            self.note_taxonomy,
            self.taxonomy("note families", NOTE_REGIONS),
        )

    @cached_property
    def labels(self) -> DataFrame:
        """Labels of every product."""
        return label_items(self.stored_items, self.taxonomies)

    @cached_property
    def stored_labels(self) -> DataFrame:
        """``labels`` written once, for plans that read them more than once."""
        return materialise(self.labels)

    @cached_property
    def members(self) -> DataFrame:
        """Segment members with category, written once."""
        return materialise(segment_pipeline(self.stored_labels, self.categories))

    def _edges(self, sim) -> DataFrame:
        open_line = F.when(F.col("l_linestatus") == "O", 1.0).otherwise(0.0)
        return self.table("lineitem").select(
            F.col("l_partkey").alias("source"), sim.alias("sim"),
            (F.col("l_quantity") / 50).alias("bert_sim"),
            (1 - F.col("l_discount") * 10).alias("accord_sim"),
            (F.col("l_tax") * 10).alias("season_sim"), open_line.alias("note_sim"),
        )

    @cached_property
    def edges(self) -> DataFrame:
        """Similarity edges part -> supplier."""
        return self._edges(F.col("l_suppkey"))

    @cached_property
    def item_edges(self) -> DataFrame:
        """Similarity edges part -> part."""
        return self._edges(F.col("l_suppkey") * 20 + F.col("l_orderkey") % 20)

    @cached_property
    def brand_members(self) -> DataFrame:
        """Products with their brand as cluster; promoted ones are flagged."""
        return self.table("part").select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("cluster"),
            F.when(F.col("p_type") == "PROMO", 1).alias("rank"),
        )

    @cached_property
    def store(self) -> DataFrame:
        """An encoding store in which every id has two versions."""
        vectors = self.table("embeddings").withColumnRenamed("vec_id", "id")
        first = vectors.select(
            "id", F.col("label").alias("part"), (F.col("id") % 97).cast("int").alias("pos"),
            "embedding",
        )
        second = vectors.select(
            "id", (F.col("label") * 3 % 10).alias("part"),
            (F.col("id") % 89 + 100).cast("int").alias("pos"),
            F.reverse("embedding").alias("embedding"),
        )
        return first.unionByName(second)
