"""An append writes and compares no more than it has to, and versions share the tables that did not change."""

import os

from pyspark.sql import functions as F
from raw_files import write_raw

from rosterflow.operators.merge import collapse_first, collapse_repeated
from rosterflow.plans.appending import _added
from rosterflow.plans.star import build_star
from rosterflow.session import stage
from rosterflow.sinks.tables import read_ledger, read_star, remove_versions, write_star


def rows(df):
    return sorted(map(repr, df.collect()))


def held(spark, target):
    return {n: rows(df) for n, df in (read_star(spark, target) | read_ledger(spark, target)).items()}


def test_a_load_that_is_stored_writes_no_table_again(spark, tmp_path):
    load = build_star(spark, str(write_raw(tmp_path / "raw")))[0]
    target = str(tmp_path / "store")
    first = write_star(load, target)
    before = held(spark, target)
    second = write_star(load, target, mode="append")
    assert {n for n in os.listdir(second) if not n.startswith("_")} == {"append_rejects"}
    assert held(spark, target) == before
    # the first version goes, but for the tables that the second names
    name = first.rsplit("/", 1)[1]
    assert remove_versions(spark, target, keep=1) == ([], []) and held(spark, target) == before
    write_star(load, target, mode="append")
    assert remove_versions(spark, target, keep=1) == ([second.rsplit("/", 1)[1]], [])
    assert held(spark, target) == before
    write_star(load, target)
    assert name in remove_versions(spark, target, keep=1)[0]
    assert not os.path.exists(first) and held(spark, target) == before


def test_rows_are_told_apart_however_often_their_key_is_stored(spark):
    old = [(1, 10), (1, 20), (1, 30), (1, 40), (None, 5), (2, 7), (2, 7), (4, None)]
    load = [(1, 20), (1, 30), (1, 25), (None, 5), (None, 6), (3, 1), (3, 2), (2, 7), (4, None), (4, 0), (0, 5)]
    for kind in ("long", "string"):
        made = [stage(spark.createDataFrame(r, "k long, v int").withColumn("k", F.col("k").cast(kind)), "told") for r in (old, load)]
        fresh, rejects = _added("told", *made, ["k"], None)
        assert sorted((int(r.k), r.v) for r in fresh.collect()) == [(0, 5), (3, 1), (3, 2)]
        found = rejects.select(F.get_json_object("record", "$.k").cast("long").alias("k"), F.get_json_object("record", "$.v").cast("int").alias("v"))
        assert sorted(map(repr, found.collect())) == sorted(["Row(k=1, v=25)", "Row(k=None, v=6)", "Row(k=4, v=0)"])
        fresh, rejects = _added("told", *made, ["k", "v"], None)
        assert fresh.count() == 6 and rejects.count() == 0


def test_only_repeated_keys_are_merged(spark):
    df = spark.createDataFrame(
        [("a", 2, "x", None), ("a", 1, None, 5), ("b", 1, None, None), (None, 1, "y", 1), ("c", 1, "z", 3)],
        "key string, at int, text string, mark int",
    )
    df = stage(df, "several")
    merged = collapse_repeated(df, "key", ["at"])
    assert rows(merged) == rows(collapse_first(df, "key", ["at"])) and merged.count() == 3
