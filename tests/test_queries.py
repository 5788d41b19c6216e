"""Every query with SQL against DuckDB on the same Parquet tables; the others for their rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from episodica.plans import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    if name not in SQL:
        assert got
        return
    found = duck.sql(SQL[name])
    assert sorted(found.columns) == columns
    listed = ", ".join(f'"{c}"' for c in columns)
    want = sorted((tuple(r) for r in duck.sql(f"SELECT {listed} FROM ({SQL[name]})").fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() == 64


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
