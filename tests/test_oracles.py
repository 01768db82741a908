"""Every registered query against its SQL on the smallest test tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from rosterflow.checks.oracles import ORACLES
from rosterflow.checks.queries import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _text(value):
    if value is None:
        return "\0"
    return repr(round(value, 6)) if isinstance(value, float) else repr(value)


def _rows(rows, columns, names):
    places = [columns.index(n) for n in names]
    return sorted(tuple(_text(r[i]) for i in places) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    result = db.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    names = sorted(columns)
    assert sorted(df.columns) == names
    assert _rows(df.collect(), df.columns, names) == _rows(result.fetchall(), columns, names)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
