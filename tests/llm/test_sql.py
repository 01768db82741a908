"""Queries of this package against their SQL, and their results' shapes."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from rosterflow.llm.oracles import ORACLES
from rosterflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = con.execute(ORACLES[name])
    columns = sorted(c[0] for c in result.description)
    places = [[c[0] for c in result.description].index(c) for c in columns]
    expected = sorted(repr([r[p] for p in places]) for r in result.fetchall())
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == columns
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == expected


def test_all_are_registered():
    names = entry.queries()
    assert set(QUERIES) < set(names) and "pipeline" in names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(ORACLES) <= set(entry.oracle_sql())
