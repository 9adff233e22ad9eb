"""Sides that grow with the products are joined by sort and merge, however small their files are."""

import re

import pytest

from kindred.operators import bitmaps as B
from kindred.operators import profiles as P
from kindred.operators import segments as S
from kindred.operators import tables as T
from kindred.plans import segmentation
from kindred.session import materialise


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def joins(df):
    return re.findall(r"\b(\w+Join)\b", plan(df))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


MEMBERSHIPS = [("d", "l", 1), ("d", "l", 2), ("d", "m", 2), ("e", "l", 2), ("e", "l", None)]


@pytest.fixture
def memberships(spark):
    return materialise(spark.createDataFrame(MEMBERSHIPS, "dimension string, label string, id int"))


def test_label_index_broadcasts_neither_memberships_nor_numbers(memberships, monkeypatch):
    built = []
    monkeypatch.setattr(B, "materialise", lambda df: built.append(joins(df)) or materialise(df))
    index = B.label_index(memberships)
    found = index.memberships()
    assert built[-1] == joins(found) == ["SortMergeJoin"]
    assert rows(found, "dimension", "label", "id") == sorted(MEMBERSHIPS[:4])


def test_intersection_broadcasts_no_numbers(memberships):
    found = B.label_index(memberships).intersection({"d": "l", "e": "l"})
    assert joins(found) == ["SortMergeJoin"]
    assert rows(found, "id") == [(2,)]


def test_representatives_broadcast_only_the_wanted_labels(spark):
    names = ["for_gender", "accord_group", "day_night", "season", "sillage_label", "longevity_label", "family"]
    labels = materialise(spark.createDataFrame(
        [(i, ["n"], *(["x"] * len(names))) for i in (1, 2, None)],
        "id int, note_groups array<string>, " + ", ".join(f"{name} string" for name in names),
    ))
    members = materialise(spark.createDataFrame(
        [(1, "b", "c", "k"), (2, "b", "c", "k"), (None, "b", "c", "k")],
        "id int, brand string, cluster string, category string",
    ))
    profile = materialise(P.profile_long(members, labels))
    output = segmentation.representative_pipeline(members, labels, profile)
    assert rows(output, "id", "rank", "sillage") == [(1, 1, "x"), (2, 1, "x"), (None, None, None)]
    broadcast = re.findall(r"BroadcastHashJoin \[[^\]]*\], \[[^\]]*\], (\w+), (\w+)", plan(output))
    # labels wanted of a cluster, and the few required features that choose them
    assert broadcast and {side for _, side in broadcast} == {"BuildRight"}
    assert joins(output).count("SortMergeJoin") == 3
    assert "SortMergeJoin" in joins(P.profile_long(members, labels))
    categories = spark.createDataFrame([("b", "k")], "brand string, category string")
    segments = members.select("id", "cluster")
    assert "SortMergeJoin" in joins(S.segment_with_category(segments, members.select("id", "brand"), categories))


def test_feature_tables_are_not_broadcast(spark):
    tables = [
        materialise(spark.createDataFrame([(1, n), (2, n), (None, n)], f"id int, f{n} int")) for n in range(3)
    ]
    joined = T.feature_table_join(tables, "id")
    assert joins(joined) == ["SortMergeJoin"] * 2
    assert rows(joined, "*") == [(1, 0, 1, 2), (2, 0, 1, 2)]
