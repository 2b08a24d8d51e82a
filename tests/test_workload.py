"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from workload.base import ORACLE, QUERIES

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")



@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in os.listdir(FOLDER):
        name = file.split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{file}')")
    return con


def cells(row):
    return tuple("\0" if v is None else str(float(v)) if isinstance(v, float) else str(v) for v in row)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    ours = sorted(cells(r[c] for c in columns) for r in frame.collect())
    result = db.execute(ORACLE[name])
    header = [d[0] for d in result.description]
    theirs = sorted(cells(dict(zip(header, r))[c] for c in columns) for r in result.fetchall())
    assert columns == sorted(header)
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
