"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as engine
from corpusloom import catalog

SF_DIR = "/root/testdata/sf0.001"
ORACLES = engine.oracle_sql()
# Queries of a subpackage are checked here as far as they have SQL.
QUERIES = {n: q for n, q in engine.queries().items() if n in catalog.QUERIES or n in ORACLES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def normalized(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_registration():
    assert set(ORACLES) <= set(QUERIES)
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    rows = result.collect()
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert normalized(rows, result.columns) == normalized(cursor.fetchall(), columns)


def test_entry(spark):
    hits = engine.entry(spark)
    assert hits.columns == ["rank", "id", "url", "title", "score"] and hits.count() > 0
