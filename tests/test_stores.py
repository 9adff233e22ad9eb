"""Encoding store, readers and sinks."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import encoding as E
from kindred.plans.features import cluster_pipeline, scaled_features
from kindred.session import materialise, scratch_path, shared_root
from kindred.sources import readers as R
from kindred.sources import sinks as S


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("size", [1, 5, 7])
def test_even_chunks_equal_array_split(spark, size):
    for total in (1, size, size + 1, 2 * size + 1, 43):
        expected = []
        for part, piece in enumerate(np.array_split(range(total), -(-total // size))):
            expected += [part] * len(piece)
        chunks = spark.range(total).select("id", E.even_chunk(F.col("id"), total, size).alias("c"))
        assert [r["c"] for r in chunks.orderBy("id").collect()] == expected


def encoded(spark, start, stop):
    return spark.range(start, stop).select(
        F.format_string("p%04d", "id").alias("id"), F.array(F.col("id").cast("double")).alias("encoding")
    )


def test_store_continues_after_the_last_part(spark, tmp_path):
    path = str(tmp_path / "store")
    E.encoding_sink(encoded(spark, 0, 11), path, part_size=5)
    first = spark.read.parquet(path)
    sizes = {r["part"]: r["count"] for r in first.groupBy("part").count().collect()}
    assert sizes == {0: 4, 1: 4, 2: 3}
    positions = first.groupBy("part").agg(F.min("pos"), F.max("pos")).orderBy("part").collect()
    assert [tuple(r) for r in positions] == [(0, 0, 3), (1, 0, 3), (2, 0, 2)]
    gap = first.where("part <> 1")
    E.encoding_sink(encoded(spark, 5, 8), path, part_size=5, existing=gap)
    store = spark.read.parquet(path)
    assert {r["part"] for r in store.select("part").distinct().collect()} == {0, 1, 2, 3}
    latest = {r["id"]: r["part"] for r in E.encoding_scan(store).collect()}
    assert len(latest) == 11 and latest["p0005"] == 3 and latest["p0004"] == 1
    assert E.encoding_scan(store, latest_only=False).count() == 14


def test_empty_sink_writes_no_rows(spark, tmp_path):
    path = str(tmp_path / "empty")
    assert E.encoding_sink(encoded(spark, 0, 0), path, part_size=5).count() == 0


def test_latest_is_by_part_then_position(spark):
    store = spark.createDataFrame(
        [("a", 1, 0, "x"), ("a", 3, 0, "y"), ("a", 3, 4, "z"), ("b", 2, 1, "u"), ("b", 2, 0, "v")],
        "id string, part int, pos int, encoding string",
    )
    assert rows(E.latest_encoding(store), "id", "encoding") == [("a", "z"), ("b", "u")]
    wanted = spark.createDataFrame([("a",), ("c",)], "id string")
    assert rows(E.encoding_scan(store, wanted), "id", "encoding") == [("a", "z")]


def test_time_range(spark):
    store = spark.createDataFrame(
        [("a", 1, 0, "2024-01-01"), ("a", 2, 0, "2024-02-01")],
        "id string, part int, pos int, t string",
    ).select("id", "part", "pos", F.to_timestamp("t").alias("insert_time"))
    january = E.encoding_scan(store, time_range=("2024-01-01", "2024-01-31"))
    assert rows(january, "part") == [(1,)]


def test_batches_are_bounded(spark):
    class CountingEncoder(E.HashingEncoder):
        def batch_predict(self, model, data):
            return np.full((len(data), 1), float(len(data)))

    df = spark.range(0, 100, 1, 1).withColumn("t", F.lit("x"))
    sizes = E.batch_encode(df, "id", "t", CountingEncoder(), batch_size=32)
    assert {r["encoding"][0] for r in sizes.collect()} == {32.0, 4.0}


def test_hashed_counts_of_every_token(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None)], "id int, t string")
    found = {r["id"]: r["encoding"] for r in E.batch_encode(df, "id", "t", E.HashingEncoder()).collect()}
    assert sorted(found[1])[-2:] == [1.0, 2.0] and sum(found[1]) == 3
    assert sum(found[2]) == sum(found[3]) == 0 and len(found[3]) == 64


def test_scan_reads_only_the_folders_it_needs(spark, tmp_path):
    path = str(tmp_path / "store")
    ids = spark.range(0, 3000).select("id", F.array(F.col("id").cast("double")).alias("encoding"))
    E.encoding_sink(ids, path, part_size=1)
    store, wanted = spark.read.parquet(path), spark.range(5, 8)
    assert store.select("folder").distinct().count() > 5
    found = E.encoding_scan(store, wanted)
    assert rows(found, "id") == [(5,), (6,), (7,)]
    assert len(found.select("id", "folder").where("folder = 0").collect()) == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "folder" in plan.split("PartitionFilters", 1)[1][:200]


def test_incremental_encoding_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([("a", "1"), ("b", "2"), ("", "3"), (None, "4")], "id string, t string")
    assert rows(E.incremental_encode(df, "id", "t", E.HashingEncoder(), path), "id") == [("a",), ("b",)]
    store = spark.read.parquet(path)
    again = E.incremental_encode(df, "id", "t", E.HashingEncoder(), path, store)
    assert again.count() == 0
    more = df.union(spark.createDataFrame([("c", "5")], "id string, t string"))
    store = spark.read.parquet(path)
    assert rows(E.incremental_encode(more, "id", "t", E.HashingEncoder(), path, store), "id", "part") == [
        ("c", 1)
    ]


def test_json_catalogue(spark, tmp_path):
    for brand, name, body in [
        ("Tom Ford", "1.json", {"name": "Oud", "votes": {"day": 1}}),
        ("Tom Ford", "2.json", {"name": "Noir", "extra": 3}),
        ("Byredo", "3.json", {"name": "Blanche", "notes": ["musk"]}),
        ("Byredo", "readme.txt", {"name": "not a product"}),
    ]:
        (tmp_path / brand).mkdir(exist_ok=True)
        (tmp_path / brand / name).write_text(json.dumps(body, indent=1))
    schema = "name string, votes map<string, bigint>, notes array<string>"
    df = R.json_catalog_scan(spark, str(tmp_path), schema)
    assert rows(df, "name", "brand_folder") == [
        ("Blanche", "Byredo"), ("Noir", "Tom Ford"), ("Oud", "Tom Ford"),
    ]
    oud = df.where("name = 'Oud'").first()
    assert oud["votes"] == {"day": 1} and oud["notes"] is None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, f string")
    path = str(tmp_path / "p")
    assert S.parquet_sink(df, path, ["f"])
    assert not S.parquet_sink(df.limit(0), str(tmp_path / "none"), skip_empty=True)
    assert not (tmp_path / "none").exists()
    assert rows(spark.read.parquet(path), "id", "f") == [(1, "a"), (2, "b")]
    S.csv_sink(df, str(tmp_path / "c"))
    assert rows(R.csv_scan(spark, str(tmp_path / "c"), "id int, f string"), "*") == [(1, "a"), (2, "b")]


def test_append_or_create(spark, tmp_path):
    table = "sink_test_table"
    df = spark.createDataFrame([(1, "a")], "id int, f string")
    with pytest.raises(ValueError, match="check failed"):
        S.append_or_create_sink(df, table, checker=lambda d: False)
    assert not spark.catalog.tableExists(table)
    S.append_or_create_sink(df, table, path=str(tmp_path / "t"))
    S.append_or_create_sink(df.select("f", F.lit(2).alias("id")), table)
    assert rows(spark.table(table), "id", "f") == [(1, "a"), (2, "a")]
    for wrong in (df.withColumn("extra", F.lit(1)), df.select("id")):
        with pytest.raises(ValueError, match="additional"):
            S.append_or_create_sink(wrong, table)
    S.append_or_create_sink(df, table, overwrite=True)
    assert rows(spark.table(table), "id", "f") == [(1, "a")]
    assert rows(R.table_scan_project(spark, table, ["f"]), "f") == [("a",)]
    spark.sql(f"DROP TABLE {table}")


def test_feature_store(spark, tmp_path):
    S.parquet_sink(spark.range(3).withColumn("a", F.lit(1)), str(tmp_path / "one.parquet"))
    S.parquet_sink(spark.range(2).withColumn("b", F.lit(2)), str(tmp_path / "two.parquet"))
    joined = R.feature_store_scan(spark, str(tmp_path), ["one", "two"], "id")
    assert rows(joined, "*") == [(0, 1, 2), (1, 1, 2)]


def test_scaled_features_replace_text_and_drop_sparse(spark):
    df = spark.createDataFrame(
        [(1, "NA", 0), (2, "2", 0), (3, "4", 1)], "id int, t string, s int"
    )
    scaled = scaled_features(df, "id", sparse_share=0.6)
    assert scaled.columns == ["id", "t"]
    assert [r["t"] for r in scaled.orderBy("id").collect()] == pytest.approx(
        [-1.224744871, 0, 1.224744871]
    )
    wanted = spark.createDataFrame([(1,), (2,)], "id int")
    clustered = cluster_pipeline(df, "id", 2, wanted)
    assert {r["point_id"]: r["distance"] for r in clustered.collect()} == {1: 0.0, 2: 0.0}


def test_materialised_rows_survive_their_source(spark, tmp_path):
    path = str(tmp_path / "source")
    spark.range(5).write.parquet(path)
    kept = materialise(spark.read.parquet(path))
    spark.range(1).write.mode("overwrite").parquet(path)
    assert kept.count() == 5
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_root(spark))


def test_writers_at_once_get_disjoint_parts(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = scratch_path(spark, "store")
    with ThreadPoolExecutor(4) as pool:
        starts = list(pool.map(lambda _: E.reserve_parts(spark, path, 3, 5), range(6)))
    assert sorted(starts) == [5 + 3 * i for i in range(6)]
    with ThreadPoolExecutor(2) as pool:
        found = list(pool.map(
            lambda offset: {
                tuple(r) for r in E.encoding_sink(encoded(spark, offset, offset + 20), path, 8).select(
                    "part", "id").collect()
            }, (0, 1000),
        ))
    parts = [{part for part, _ in rows_} for rows_ in found]
    assert not parts[0] & parts[1] and min(parts[0] | parts[1]) == 23
    assert spark.read.parquet(path).count() == 40


def test_a_vector_is_encoded_and_written_once(spark):
    path = scratch_path(spark, "store")
    df = spark.createDataFrame(
        [(f"p{i}", f"w{i % 7} w{i % 3}") for i in range(50)]
        + [("p7", "other"), ("p7", "other"), (None, "x"), ("", "y")], "id string, t string",
    )
    new = E.incremental_encode(df, "id", "t", E.HashingEncoder(), path, part_size=20)
    store = spark.read.parquet(path)
    assert new.count() == 51 and store.count() == 52
    wanted = {(r["id"], tuple(r["encoding"])) for r in E.batch_encode(
        df.where("id <> ''"), "id", "t", E.HashingEncoder()).collect()}
    assert {(r["id"], tuple(r["encoding"])) for r in store.collect()} == wanted
    assert E.incremental_encode(df, "id", "t", E.HashingEncoder(), path, store, 20).count() == 0
