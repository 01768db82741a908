import hashlib
import re
import uuid
from collections import defaultdict

import pytest
from messy import empty, messy, random_docs
from pyspark.sql import functions as F

from rosterflow.llm import exact_dedup
from rosterflow.session import checkpoint_root, stage


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    out = []
    for content, group in groups.items():
        keep = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0]))
        sha = hashlib.sha256(content.encode()).hexdigest()
        out += [(r[0], keep[0], len(group), sha) for r in group]
    return sorted(out, key=repr)


def result(df):
    return sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in df.collect()), key=repr)


# the weak keys make different texts share a key, as if digests collided
@pytest.mark.parametrize("key", [lambda d: d, lambda d: F.substring(d, 1, 1), lambda d: F.lit("k")])
def test_against_grouping(spark, key):
    df, rows = random_docs(spark)
    found = exact_dedup.exact_duplicates(df, key).cache()
    assert result(found) == brute(rows)
    assert found.where("kept").count() == len({r[3] for r in brute(rows)})
    assert found.where("kept AND doc_id != keep_id").count() == 0


def test_messy_rows(spark):
    df = messy(spark)
    rows = [tuple(r)[:2] for r in df.collect()]
    found = exact_dedup.exact_duplicates(df)
    assert result(found) == brute(rows)
    kept = found.where("kept").groupBy("text_sha256").count().collect()
    assert kept and all(r["count"] == 1 for r in kept)
    stays = exact_dedup.drop_copies(df)
    assert stays.columns == df.columns and stays.count() == len(kept)
    assert exact_dedup.exact_duplicates(empty(spark)).collect() == []
    assert exact_dedup.drop_copies(empty(spark)).collect() == []


def test_state_goes_on_with_later_files(spark):
    df, rows = random_docs(spark)
    work = f"{checkpoint_root(spark)}/dedup-test-{uuid.uuid4().hex}"
    exact_dedup.exact_duplicates(stage(df.where("doc_id < 120"), "first"), work=work)
    found = exact_dedup.exact_duplicates(stage(df.where("doc_id >= 120"), "second"), work=work)
    # sizes and keepers count the earlier files, whose rows are known to the state
    groups = {r[3]: r for r in brute(rows)}
    for r in found.where("doc_id >= 120").collect():
        assert (r["keep_id"], r["group_size"]) == groups[r["text_sha256"]][1:3]


def test_batches_give_the_same(spark):
    df, rows = random_docs(spark)
    located = stage(df.repartition(5).select(
        "doc_id", F.char_length("text").alias("points"), F.sha2(exact_dedup.normalised(F.col("text")), 256).alias("key"),
        F.struct(F.lit("f").alias("file"), F.col("doc_id").alias("row")).alias("at"),
    ), "rows")
    path = located.inputFiles()[0].rsplit("/", 1)[0]
    work = f"{checkpoint_root(spark)}/dedup-test-{uuid.uuid4().hex}"
    groups = exact_dedup.update_state(spark, path, located.schema, work, files_per_batch=1).collect()
    assert {r["key"]: r["size"] for r in groups} == {r[3]: r[2] for r in brute(rows)}
