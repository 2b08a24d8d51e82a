"""The queries that SQL can express, against their SQL on the smallest tables; the others by their shape."""

import os

import pytest

from syncspark.llm import queries

duckdb = pytest.importorskip("duckdb")
FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{FOLDER}/{file}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, db, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    ours = sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)
    result = db.execute(queries.ORACLE[name])
    header = [d[0] for d in result.description]
    theirs = sorted((tuple(dict(zip(header, r))[c] for c in columns) for r in result.fetchall()), key=str)
    assert columns == sorted(header) and ours == theirs


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_without_sql(spark, name):
    """What SQL can't say is held against brute force in the other files; here the query gives its rows."""
    frame = queries.QUERIES[name](spark, FOLDER)
    assert frame.count() > 0 and len(set(frame.columns)) == len(frame.columns)
