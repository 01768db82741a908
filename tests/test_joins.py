"""Lookups past the broadcast bound must give what plain joins give."""

import pytest
from pyspark.sql import functions as F

from rosterflow.operators import joins as J
from rosterflow.operators.audit import duplicate_rows


@pytest.fixture()
def sides(spark):
    # a third of the rows share one key, some have none
    left = spark.range(3000).select(
        "id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('k', id % 700) END").alias("v")
    )
    right = spark.range(900).select(
        F.expr("CASE WHEN id = 0 THEN 'hot' WHEN id = 1 THEN NULL ELSE concat('k', id) END").alias("v"),
        F.col("id").alias("v_id"),
    )
    return left, right


def rows(df):
    return sorted((tuple(repr(r[c]) for c in sorted(df.columns)) for r in df.collect()))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("times", [1, 2])
def test_rows_do_not_depend_on_the_size(sides, monkeypatch, how, null_safe, times):
    left, right = sides
    right = right.unionByName(right.where("v_id % 3 = 0")) if times == 2 else right
    small = rows(J.lookup(left, right, ["v"], how, null_safe))
    monkeypatch.setattr(J, "MAX_BROADCAST_BYTES", 0)
    assert not J.fits_broadcast(right)
    assert rows(J.lookup(left, right, ["v"], how, null_safe)) == small


def test_keys_as_text(spark):
    df = spark.createDataFrame([("7.0", 1), ("8", 2), ("x", 3), (None, 4), ("7.5", 5)], "k string, v int")
    parent = spark.createDataFrame([(7,), (9,)], "k long")
    assert [(r.k, r.v) for r in J.keep_members(df, parent, "k").collect()] == [(7, 1)]
    assert [(r.k, r.v) for r in J.keep_members(df, parent.selectExpr("cast(k as double) k"), "k").collect()] == [(7, 1)]


def test_outer_link_nulls_never_match(spark):
    a = spark.createDataFrame([("x", 1), ("x", 2), (None, 3), ("y", 4)], "k string, a int")
    b = spark.createDataFrame([("x", 10), (None, 30), ("z", 40)], "k string, b int")
    got = sorted(((r.k or "", r.a or 0, r.b or 0) for r in J.outer_link(a, b, "k").collect()))
    assert got == sorted([("x", 1, 10), ("x", 2, 10), ("", 3, 0), ("y", 4, 0), ("", 0, 30), ("z", 0, 40)])


def test_name_join_multiplies(spark):
    a = spark.createDataFrame([("Ada B", 1), ("ada b", 2), (None, 3)], "name string, a int")
    b = spark.createDataFrame([("ADA B", 10), ("ADA B", 11), ("Ada B", 12)], "other string, b int")
    got = sorted((r.a, r.b) for r in J.name_join(a, b, F.col("name"), F.col("other")).collect())
    assert got == [(1, 10), (1, 11), (2, 10), (2, 11)]


def test_duplicate_rows_with_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4), ("b", 5)], "k string, v int")
    assert sorted(r.v for r in duplicate_rows(df, ["k"]).collect()) == [1, 2, 3, 4]


def test_orphans_ignore_missing_references(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (None,)], "pk int")
    assert [r.fk for r in J.orphans(child, "fk", parent, "pk").collect()] == [2]
