import re

import corpus_pipeline
import pytest
from test_mixing import brute as brute_mix
from test_packing import check
from test_simhash import classes, plain

from rosterflow.llm import quality
from rosterflow.session import stage

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, function in corpus_pipeline.STAGES:
        tables.append(stage(function(spark, tables[-1], SF), f"test-{name}"))
    return tables


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_duplicates", "mixing", "packing"]
    assert all(t.columns == stages[0].columns for t in stages[1:5])


def test_quality_keeps_what_scores(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(stages[0], labels, quality.train_rows())
    kept = [r for r in rows_of(stages[0]) if model.scores([r[1] or ""])[0] >= 0.3]
    assert sorted(kept) == sorted(rows_of(stages[1])) and 0 < len(kept) < stages[0].count()


def test_one_of_each_group_of_copies_stays(stages):
    groups = {}
    for r in rows_of(stages[1]):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r[1] or ""), []).append(r)
    kept = [min(g, key=lambda r: (-len(r[1] or ""), r[0])) for g in groups.values()]
    assert sorted(kept) == sorted(rows_of(stages[2]))


def test_one_of_each_component_stays(stages):
    rows = {r[0]: r for r in rows_of(stages[2])}
    prints = {i: plain(r[1]) for i, r in rows.items()}
    least = classes(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert sorted(rows[i] for i in set(least.values())) == sorted(rows_of(stages[3]))


def test_rows_come_as_often_as_mixed(stages):
    rows = rows_of(stages[3])
    taken = brute_mix(rows, [5, 2, 1], 1.5)[1]
    size = [len(r[1].split()) for r in rows]
    expected = sorted(r for r, t, s in zip(rows, taken, size) for _ in range(t // s if s else 0))
    assert sorted(rows_of(stages[4])) == expected


def test_every_token_is_packed_once(stages):
    pieces = stages[5].collect()
    padding = check(pieces, [(r[0], r[1]) for r in rows_of(stages[4])], 2048)
    assert padding < 0.01 * sum(p["length"] for p in pieces)


def test_run_gives_the_same(spark, stages):
    # where documents are cut depends on how rows are spread over files, the documents themselves do not
    first = [t.where("start = 0").select("doc_id", "doc_tokens").collect() for t in (corpus_pipeline.run(spark, SF), stages[5])]
    assert sorted(first[0]) == sorted(first[1])


def test_empty_documents(spark, stages):
    docs = stages[0].where("false")
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF), f"test-empty-{name}")
        assert docs.count() == 0
