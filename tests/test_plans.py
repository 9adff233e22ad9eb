"""What the physical plans must not contain, for every registered query."""

import re

import pytest

import __spark_entry__ as entry_module
from workload import registry

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
OWN = registry.QUERIES

# Queries that run Arrow-batched Python by design: tiles, distances, encoders, the kept function.
BATCHED = {
    "match_pipeline", "blocked_cross_join", "kmedoids_assign", "kmedoids_update", "kmedoids_fit",
    "cluster_pipeline", "cluster_pipeline_wide", "batch_encode", "scalar_udf", "label_sets",
    "set_intersection_join",
}


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plan(spark, key):
    plan = executed_plan(QUERIES[key](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if key in OWN:
        batched = re.search(r"MapInPandas|MapInArrow|ArrowEvalPython|FlatMapCoGroups", plan)
        assert bool(batched) == (key in BATCHED)


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = executed_plan(QUERIES["class_filter"](spark, FOLDER))
    assert "EqualTo(p_type,PROMO)" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_type:string>" in plan
    plan = executed_plan(QUERIES["parquet_scan"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_matching_sends_a_vector_to_its_cell_and_not_to_its_tokens(spark):
    plan = executed_plan(QUERIES["match_pipeline"](spark, FOLDER))
    keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    tiles = [key for key in keys if "_left" in key]
    assert len(tiles) == 2  # one exchange of each side
    assert all("brand_key" in key and "_lcell" in key and "token" not in key for key in tiles)
    # the only row generator deals rows to the chunks of the other side
    assert set(re.findall(r"Generate (explode\(\w+)", plan)) == {"explode(sequence"}


def test_dense_counts_shuffle_bitmaps(spark):
    plan = executed_plan(QUERIES["count_pivot"](spark, FOLDER))
    partial = plan.index("partial_bitmap_construct_agg")
    exchange = plan.rindex("Exchange hashpartitioning(label", 0, partial)
    # seen from the top, the exchange stands above the partial bitmaps: they are what it moves
    assert exchange < partial and "l_partkey" not in plan[exchange : plan.index(")", exchange)]


def test_hot_keys_are_split(spark):
    """With thresholds scaled down, the join back to an aggregate is a skew join."""
    from pyspark.sql import functions as F

    from kindred.operators.skew import join_per_key

    scaled = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in scaled}
    try:
        for key, value in scaled.items():
            spark.conf.set(key, value)
        rows = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
            F.md5(F.col("id").cast("string")).alias("x"),
        )
        sizes = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        joined = join_per_key(rows, sizes, ["k"])
        assert sum(row["n"] == 100_000 for row in joined.collect()) == 100_000
        assert "skew=true" in executed_plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
