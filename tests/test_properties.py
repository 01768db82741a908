"""Distributed operators against plain sequential models on random data."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rosterflow.operators import numbering
from rosterflow.operators.linking import apply_links, link_forward
from rosterflow.operators.merge import collapse_first, fill_previous_date
from rosterflow.operators.numbering import carry_forward, dense_ids, number_rows, row_ids, skip_rows, synthetic_keys

SEEDS = [1, 2, 3]


def day(rng, missing=0.25):
    return None if rng.random() < missing else dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(12))


def sequential_links(left, right, rule):
    """left: (pos, name, date, value); right: (pos, name, date). Last chooser wins."""
    out = {}
    for _, name, date, value in sorted(left):
        if name is None or (date is None and rule != "left_wild"):
            continue
        fits = []
        for pos, other, when in right:
            if other != name:
                continue
            if date is None:
                fits.append((when is None, when or dt.date.min, pos))
            elif when is None:
                if rule == "right_wild":
                    fits.append((True, dt.date.min, pos))
            elif when >= date:
                fits.append((False, when, pos))
        if fits:
            out[min(fits)[2]] = value
    return out


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("rule", ["right_wild", "left_wild", "exclude"])
def test_link_forward(spark, seed, rule):
    rng = random.Random(seed)
    names = ["hot"] * 6 + ["a", "b", "c", "undated", None]
    left = [(i, rng.choice(names), day(rng), f"v{i}") for i in range(80)]
    right = []
    for i in range(50):
        name = rng.choice(names)
        right.append((i, name, None if name == "undated" else day(rng)))
    links = link_forward(
        spark.createDataFrame(left, "lpos int, name string, date date, value string"),
        spark.createDataFrame(right, "rpos int, name string, date date"),
        ["name"],
        "date",
        "lpos",
        "rpos",
        "value",
        rule,
    )
    rows = links.collect()
    assert len({r.rpos for r in rows}) == len(rows)
    assert {r.rpos: r.value for r in rows} == sequential_links(left, right, rule)


def test_links_keep_old_values(spark):
    right = spark.createDataFrame([(1, "old"), (2, "old")], "pos int, target string")
    links = spark.createDataFrame([(2, "new")], "pos int, value string")
    got = {r.pos: r.target for r in apply_links(right, links, "pos", "value", "target").collect()}
    assert got == {1: "old", 2: "new"}


def test_link_forward_rejects_timestamps(spark):
    bad = spark.sql("SELECT 1 AS pos, 'a' AS name, current_timestamp() AS date, 'v' AS value")
    with pytest.raises(TypeError):
        link_forward(bad, bad, ["name"], "date", "pos", "pos", "value")


@pytest.mark.parametrize("seed", SEEDS)
def test_collapse_first(spark, seed):
    rng = random.Random(seed)
    some = lambda v: None if rng.random() < 0.5 else v
    rows = [(i, rng.choice(["hot", "hot", "x", "y", None]), some(i), some(f"t{i}")) for i in range(120)]
    rng.shuffle(rows)
    expected = {}
    for _, key, a, b in sorted(rows, key=lambda r: r[0]):
        if key is not None:
            old = expected.get(key, (None, None))
            expected[key] = (a if old[0] is None else old[0], b if old[1] is None else old[1])
    df = spark.createDataFrame(rows, "pos int, key string, a int, b string").repartition(5)
    for order in (["pos"], ["half", "pos"]):
        wide = df.withColumn("half", F.floor(F.col("pos") / 10))
        got = collapse_first(wide if order != ["pos"] else df, "key", order).collect()
        assert {r.key: (r.a, r.b) for r in got} == expected


@pytest.mark.parametrize("width", [3, 7, 1000])
def test_fill_across_blocks(spark, width):
    rng = random.Random(width)
    rows = [(f, i, day(rng, 0.7)) for f, n in (("hot", 60), ("b", 9), ("c", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "f string, id int, d date").repartition(4)
    expected, last = {}, {}
    for f, i, d in rows:
        expected[f, i] = last.get(f)
        last[f] = d or last.get(f)
    got = carry_forward(df, ["f"], "id", "d", "prev", width).collect()
    assert {(r.f, r.id): r.prev for r in got} == expected


def test_leading_rows_without_date_are_flagged(spark):
    rows = [("f", 1, None), ("f", 2, None), ("f", 3, dt.date(2019, 4, 10)), ("f", 4, None), ("f", 5, None)]
    df = fill_previous_date(spark.createDataFrame(rows, "f string, id int, d date"), ["f"], "id", "d")
    got = [(r.iddate, r.date_missing) for r in df.orderBy("id").collect()]
    assert got == [("00000000", True)] * 2 + [("20190410", False)] + [("20190400", False)] * 2


def test_number_rows_over_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("v")).repartition(13)
    got = number_rows(df, ["v"], "n", 5).orderBy("v").collect()
    assert [r.n for r in got] == list(range(5, 5005))


def test_number_rows_empty(spark):
    assert number_rows(spark.range(0), ["id"], "n").count() == 0


@pytest.mark.parametrize("start,nulls,null_id", [(1, "own", 2), (0, "drop", None), (1, "zero", 0), (0, "zero", -1)])
def test_null_rules_of_dense_ids(spark, start, nulls, null_id):
    rows = [("f1", 1, "b"), ("f1", 2, None), ("f2", 1, "a"), ("f2", 2, "b"), ("f2", 3, None)]
    df = spark.createDataFrame(rows, "f string, id int, v string")
    got = {r.v: r.n for r in dense_ids(df, "v", ["f", "id"], "n", start, nulls).collect()}
    expected = {"b": start, "a": start + (2 if nulls == "own" else 1)}
    if null_id is not None:
        expected[None] = null_id
    assert got == expected


def test_row_ids(spark):
    df = spark.createDataFrame([(3, "x", None), (1, "y", "z"), (2, "x", None)], "p int, a string, b string")
    got = {(r.a, r.b): r.n for r in row_ids(df, ["a", "b"], ["p"], "n").collect()}
    assert got == {("y", "z"): 0, ("x", None): 1}


def test_skip_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "a"), (4, None), (5, "b")], "p int, a string")
    for n, left in ((0, {1, 2, 3, 4, 5}), (2, {1, 4, 5}), (4, {4}), (9, set())):
        assert {r.p for r in skip_rows(df, ["a", "p"], n).collect()} == left
    equal = spark.createDataFrame([("x",)] * 4, "a string")
    assert skip_rows(equal, ["a"], 1).count() == 3


def test_synthetic_keys(spark):
    df = spark.createDataFrame([("a", None), ("b", 7), ("c", None), ("d", None)], "id string, k int")
    got = {r.id: r.k for r in synthetic_keys(df, "k", ["id"], skip=1).collect()}
    assert got == {"b": 7, "c": 1_000_000_001, "d": 1_000_000_002}
