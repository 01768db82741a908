from collections import defaultdict
from hashlib import md5

import pytest
from messy import COLUMNS, empty, messy, random_docs

from pyspark.sql import functions as F

from rosterflow.llm import mixing
from rosterflow.llm.common import word_count


def brute(rows, weights, total, repeats=2):
    """taken by row number; sorts each source by hash and size and takes the nearest sum."""
    size = [len((r[1] or "").split()) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    sums = {n: sum(s for s, r in zip(size, rows) if r[3] == n) for n in names}
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, left, open_names = {}, total * sum(sums.values()), set(names)
    while True:
        level = left / sum(weight[n] for n in open_names) if open_names else 0
        full = {n for n in open_names if weight[n] * level > repeats * sums[n]}
        if not full:
            break
        for n in full:
            target[n] = float(repeats * sums[n])
            left -= target[n]
        open_names -= full
    target |= {n: weight[n] * level for n in open_names}
    groups = defaultdict(lambda: defaultdict(list))
    for i, r in enumerate(rows):
        h = int(md5(str(r[0]).encode()).hexdigest()[:15], 16) if r[0] is not None else 0
        groups[r[3]][h, size[i], i].append(i)
    taken = [0] * len(rows)
    for n in names:
        times = int(target[n] // sums[n]) if sums[n] else 0
        rest = target[n] - times * sums[n]
        for i in (i for g in groups[n].values() for i in g):
            taken[i] = times * size[i]
        if times >= repeats:
            continue
        for h in sorted(groups[n]):
            words = sum(size[i] for i in groups[n][h])
            if words > rest and 2 * rest < words:
                break
            for i in groups[n][h]:
                taken[i] += size[i]
            rest -= words
            if rest <= 0:
                break
    return target, taken


@pytest.mark.parametrize("total", [0.3, 1.0, 1.5, 2.5])
def test_against_sorting(spark, total):
    df, rows = random_docs(spark, 300)
    target, taken = brute(rows, [5, 2, 1], total)
    found = {r["doc_id"]: r for r in mixing.mix(df, [5, 2, 1], total).collect()}
    assert len(found) == len(rows)
    for r, t in zip(rows, taken):
        assert found[r[0]]["target"] == pytest.approx(target[r[3]])
        assert found[r[0]]["taken"] == t <= 2 * found[r[0]]["size"]


def test_excess_is_shared_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 5)], "source string, source_size long")
    found = {r["source"]: r["target"] for r in mixing.targets(sizes, [5, 2, 1], 1.0).collect()}
    # a and null stop at twice their size; b at 200 of its 2/3 share; c takes the rest
    assert found == {"a": 20.0, "b": 200.0, None: 10.0, "c": 1115.0 - 230.0}


def test_messy_rows(spark):
    found = mixing.mix(messy(spark)).collect()
    assert len(found) == messy(spark).count()
    assert all(r["size"] == 0 and r["taken"] == 0 for r in found if r["doc_id"] in (2, 3, 4))
    assert {r["taken"] for r in found if r["doc_id"] == 9} == {2}
    assert mixing.mix(empty(spark)).collect() == [] and mixing.mixed_rows(empty(spark)).collect() == []


def test_rows_come_as_often_as_taken(spark):
    df = messy(spark)
    rows = mixing.mixed_rows(df)
    assert rows.columns == df.columns
    words = rows.select(F.sum(word_count(F.col("text"))).alias("s")).first()["s"]
    assert words == mixing.mix(df).selectExpr("sum(taken) s").first()["s"]


def test_one_source_with_equal_ids(spark):
    df = spark.createDataFrame([(7, "a b", "en", "s", 3)] * 5, COLUMNS)
    taken = [r["taken"] for r in mixing.mix(df, [1], 0.7).collect()]
    assert sorted(taken) == [0, 2, 2, 2, 2]  # 8 is as near to 7 as 6


@pytest.mark.parametrize("hot", [7, None])
@pytest.mark.parametrize("total", [0.7, 1.2])
def test_a_third_of_the_rows_under_one_id(spark, hot, total):
    rows = [(hot if i % 3 == 0 else 1000 + i, "w " * (1 + i % 4), "en", "s", 0) for i in range(300)]
    df = spark.createDataFrame(rows, COLUMNS)
    target, taken = brute(rows, [1], total)
    found = mixing.mix(df, [1], total).collect()
    key = lambda r: (r[0] or 0, r[1], r[2])
    sizes = [len(r[1].split()) for r in rows]
    assert sorted(map(key, ((r["doc_id"], r["size"], r["taken"]) for r in found))) == sorted(
        map(key, zip((r[0] for r in rows), sizes, taken))
    )
    assert abs(sum(r["taken"] for r in found) - target["s"]) <= 4
    words = mixing.mixed_rows(df, [1], total).select(F.sum(word_count(F.col("text"))).alias("s")).first()["s"]
    assert words == sum(taken)


def test_reruns_over_files_agree(spark, tmp_path):
    spark.createDataFrame([(7, f"a b{i}", "en", "s", i) for i in range(40)], COLUMNS).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    first, second = (sorted(r["n_chars"] for r in mixing.mixed_rows(docs, [1], 0.5).collect()) for _ in range(2))
    assert first == second and len(first) == 20
