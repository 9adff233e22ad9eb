"""Sources and sinks: what is written is read back and compared with its origin."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import histograms as H
from kindred.operators import encoding as E
from kindred.operators.profiles import profile_long
from kindred.session import scratch_path
from kindred.sources import readers as R
from kindred.sources import sinks as S
from workload.registry import query
from workload.views import VOTE_KEYS, Views

_CATALOG = ["product_id", "name", "brand", "class", "price"]
_CATALOG_SQL = "SELECT product_id, name, brand, class, price FROM v_catalog"


def _table_name(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


@query(
    "json_catalog_scan",
    "SELECT product_id, name, class, price, 'brand=' || replace(brand, '#', '%23') AS brand_folder,"
    " CAST(NULL AS VARCHAR) AS image_name, CAST(size AS BIGINT) AS votes FROM v_catalog",
)
def json_catalog_scan(v: Views) -> DataFrame:
    root = scratch_path(v.spark, "scraped")
    nested = F.struct(F.col("size").cast("bigint").alias("count"))
    scraped = v.catalog.select("product_id", "name", "brand", "class", "price", nested.alias("votes"))
    scraped.write.partitionBy("brand").json(root)
    schema = (
        "product_id bigint, name string, class string, price double, image_name string,"
        " votes struct<count: bigint>"
    )
    read = R.json_catalog_scan(v.spark, root, schema, multi_line=False)
    return read.withColumn("votes", F.col("votes.count"))


@query("table_scan_project", _CATALOG_SQL)
def table_scan_project(v: Views) -> DataFrame:
    table = _table_name("scan_project")
    S.table_overwrite_sink(v.catalog, table, scratch_path(v.spark, table))
    return R.table_scan_project(v.spark, table, _CATALOG)


@query(
    "parquet_scan",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem",
)
def parquet_scan(v: Views) -> DataFrame:
    return R.parquet_scan(
        v.spark, f"{v.folder}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"]
    )


@query(
    "feature_store_scan",
    "SELECT product_id, " + ", ".join(f"{k} AS daily_{k}" for k in VOTE_KEYS)
    + ", click + error + purchase + signup + view AS total FROM v_daily",
)
def feature_store_scan(v: Views) -> DataFrame:
    root = scratch_path(v.spark, "features")
    counts = H.map_to_columns(v.daily, "product_id", "votes", VOTE_KEYS, "daily_")
    total = F.aggregate(F.map_values("votes"), F.lit(0).cast("bigint"), lambda a, x: a + x)
    S.parquet_sink(counts, f"{root}/daily.parquet")
    S.parquet_sink(v.daily.select("product_id", total.alias("total")), f"{root}/total.parquet")
    return R.feature_store_scan(v.spark, root, ["daily", "total"], "product_id")


@query("csv_scan", "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer")
def csv_scan(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "customers")
    S.csv_sink(v.table("customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal"), path)
    schema = "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double"
    return R.csv_scan(v.spark, path, schema)


#: All components of a vector, in millionths, as text.
_MILLIONTHS_SQL = (
    "array_to_string([CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT) FOR x IN embedding], ',')"
)


def millionths(vector: Column) -> Column:
    whole = F.transform(vector, lambda x: F.round(x.cast("double") * 1000000).cast("bigint"))
    return F.array_join(whole.cast("array<string>"), ",")


def counts_sql(table: str, key: str, text: str, separator: str) -> str:
    """Hashed token counts of ``text``, all 64 of them, as text."""
    return (
        f"WITH source AS (SELECT DISTINCT {key} AS id, {text} AS t FROM {table}), counted AS ("
        "SELECT id, ('0x' || md5(w)[1:4])::INT % 64 AS place, count(*) AS n FROM (SELECT id,"
        f" unnest(string_split(t, '{separator}')) AS w FROM source) WHERE w <> '' GROUP BY ALL)"
        " SELECT id, string_agg(CAST(coalesce(n, 0) * 1000000 AS BIGINT), ',' ORDER BY place) AS"
        " vector FROM source CROSS JOIN (SELECT unnest(range(64)) AS place)"
        " LEFT JOIN counted USING (id, place) GROUP BY id"
    )


@query(
    "encoding_scan",
    "SELECT id, CAST(part AS BIGINT) AS part, CAST(pos AS BIGINT) AS pos,"
    f" {_MILLIONTHS_SQL} AS vector FROM v_store"
    " WHERE id IN (SELECT p_partkey FROM part)"
    " QUALIFY row_number() OVER (PARTITION BY id ORDER BY part DESC, pos DESC) = 1",
)
def encoding_scan(v: Views) -> DataFrame:
    wanted = v.table("part").select(F.col("p_partkey").alias("id"))
    return E.encoding_scan(v.store, wanted).select(
        "id", F.col("part").cast("bigint").alias("part"), F.col("pos").cast("bigint").alias("pos"),
        millionths(F.col("embedding")).alias("vector"),
    )


@query(
    "latest_encoding",
    "SELECT id, CAST(part AS BIGINT) AS part, CAST(pos AS BIGINT) AS pos FROM v_store"
    " QUALIFY row_number() OVER (PARTITION BY id ORDER BY part DESC, pos DESC) = 1",
)
def latest_encoding(v: Views) -> DataFrame:
    return E.latest_encoding(v.store).select(
        "id", F.col("part").cast("bigint").alias("part"), F.col("pos").cast("bigint").alias("pos")
    )


@query("parquet_sink", _CATALOG_SQL)
def parquet_sink(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "by_class")
    S.parquet_sink(v.catalog.select(*_CATALOG), path, ["class"], skip_empty=True)
    return R.parquet_scan(v.spark, path, _CATALOG)


@query("table_overwrite_sink", _CATALOG_SQL)
def table_overwrite_sink(v: Views) -> DataFrame:
    table = _table_name("catalogue")
    path = scratch_path(v.spark, table)
    S.table_overwrite_sink(v.catalog.select("product_id"), table, path)
    S.table_overwrite_sink(v.catalog.select(*_CATALOG), table, path)
    return v.spark.table(table)


@query(
    "append_or_create_sink",
    "SELECT id, label, CAST(1 AS BIGINT) AS stamped FROM"
    " (SELECT vec_id AS id, CAST(label AS BIGINT) AS label FROM embeddings UNION ALL"
    " SELECT p_partkey, CAST(p_size AS BIGINT) FROM part)",
)
def append_or_create_sink(v: Views) -> DataFrame:
    table = _table_name("appended")
    path = scratch_path(v.spark, table)
    vectors = v.table("embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("bigint").alias("label")
    )
    parts = v.table("part").select(
        F.col("p_size").cast("bigint").alias("label"), F.col("p_partkey").alias("id")
    )
    for rows in (vectors, parts):
        S.append_or_create_sink(
            rows, table, lambda df: "id" in df.columns, add_insert_time=True, path=path
        )
    stamped = F.col("InsertTime") == F.date_trunc("second", "InsertTime")
    return v.spark.table(table).select("id", "label", stamped.cast("bigint").alias("stamped"))


_CHUNK = (
    "SELECT id, CAST(CASE WHEN r < m * (q + 1) THEN r // (q + 1)"
    " ELSE m + (r - m * (q + 1)) // q END AS BIGINT) AS part FROM (SELECT *, n // p AS q,"
    " n % p AS m FROM (SELECT *, (n + {size} - 1) // {size} AS p FROM (SELECT {id} AS id,"
    " row_number() OVER (ORDER BY {id}) - 1 AS r, count(*) OVER () AS n FROM {table})))"
)


@query("encoding_sink", _CHUNK.format(size=400, id="doc_id", table="documents"))
def encoding_sink(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "encodings")
    docs = v.table("documents").select(
        F.col("doc_id").alias("id"), F.array(F.col("n_chars").cast("double")).alias("encoding")
    )
    E.encoding_sink(docs, path, part_size=400)
    stored = R.parquet_scan(v.spark, path)
    return stored.select("id", F.col("part").cast("bigint").alias("part"))


@query("csv_sink", "SELECT product_id, name, brand, price FROM v_catalog")
def csv_sink(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "output")
    S.csv_sink(v.catalog.select("product_id", "name", "brand", "price"), path)
    schema = "product_id bigint, name string, brand string, price double"
    return R.csv_scan(v.spark, path, schema)


@query("sectioned_profile_sink", "SELECT feature, label, cluster, n FROM v_profile")
def sectioned_profile_sink(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "profiles")
    S.parquet_sink(profile_long(v.members, v.stored_labels), path, ["feature"])
    return R.parquet_scan(v.spark, path, ["feature", "label", "cluster", "n"])


@query("temp_view", "SELECT brand, count(*) AS n, sum(size) AS size FROM v_catalog GROUP BY brand")
def temp_view(v: Views) -> DataFrame:
    R.temp_view(v.catalog, "kindred_catalog")
    return v.spark.sql(
        "SELECT brand, count(*) AS n, sum(size) AS size FROM kindred_catalog GROUP BY brand"
    )


@query("batch_encode", counts_sql("documents", "doc_id", "text", " "))
def batch_encode(v: Views) -> DataFrame:
    tasks = int(v.spark.conf.get("spark.sql.shuffle.partitions"))
    encoded = E.batch_encode(
        v.table("documents"), "doc_id", "text", E.HashingEncoder(), partitions=tasks
    )
    return encoded.select("id", millionths(F.col("encoding")).alias("vector"))


@query(
    "incremental_encode",
    "SELECT id, vector, CAST(0 AS BIGINT) AS new_on_rerun FROM ("
    + counts_sql("pages", "url", "url", "/") + ")",
)
def incremental_encode(v: Views) -> DataFrame:
    path = scratch_path(v.spark, "incremental")
    pages = v.table("pages").select(F.col("url").alias("page")).distinct()
    encoder = E.HashingEncoder(separator="/")
    E.incremental_encode(pages, "page", "page", encoder, path, part_size=50)
    store = R.parquet_scan(v.spark, path)
    again = E.pending_ids(pages, "page", store)
    new_on_rerun = again.agg(F.count(F.lit(1))).scalar()
    return E.encoding_scan(store).select(
        "id", millionths(F.col("encoding")).alias("vector"), new_on_rerun.alias("new_on_rerun")
    )
