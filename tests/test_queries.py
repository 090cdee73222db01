"""Every registered query beside its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import TABLES, canonical

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(got, df.columns) == canonical(cur.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["stockcode_x", "stockcode_y", "distance", "match_level", "method"]


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
