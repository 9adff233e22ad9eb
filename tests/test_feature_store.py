import pytest

from kindred.session import scratch_path
from kindred.sources import feature_store as FS


def tables(spark, count, buckets):
    root = scratch_path(spark, "features")
    store = "s" + root[-12:].replace("-", "_")
    names = []
    for number in range(count):
        rows = [(i, i * number) for i in range(200) if i % (number + 2)] + [(None, 1)]
        df = spark.createDataFrame(rows, f"id int, f{number} int")
        names.append(FS.write_feature_table(df, root, store, f"t{number}", "id", buckets))
    return names


def test_ten_tables_join_without_exchange(spark):
    names = tables(spark, 10, 4)
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = FS.join_feature_tables(spark, names, "id")
        found = {row["id"]: row for row in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert plan.count("SortMergeJoin") >= 9 and "Exchange" not in plan
    kept = [i for i in range(200) if all(i % (n + 2) for n in range(10))]
    assert sorted(found) == kept
    assert all(found[i][f"f{n}"] == i * n for i in kept for n in range(10))


def test_other_layouts_are_an_error(spark):
    names = tables(spark, 1, 4) + tables(spark, 1, 2)
    with pytest.raises(ValueError, match="bucketed alike"):
        FS.join_feature_tables(spark, names, "id")
    with pytest.raises(ValueError, match="bucketed alike"):
        FS.join_feature_tables(spark, names[:1], "f0")
