"""Every registered query against its SQL twin in DuckDB, at the smallest size."""

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
RAW = ("region nation customer supplier part orders lineitem events documents embeddings pages"
       " benchmark labels conversations").split()
QUERIES, ORACLE = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in RAW:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    yield con
    con.close()


def test_every_oracle_has_a_query():
    assert ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(str(tuple(r[c] for c in columns)) for r in df.collect())
    assert rows, "no rows"
    if name not in ORACLE:
        return
    result = duck.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert sorted(str(tuple(r[i] for i in order)) for r in result.fetchall()) == rows


def test_entry(spark):
    df = entry_point.entry(spark)
    assert "merchant_id" in df.columns and df.count() > 0
