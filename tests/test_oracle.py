"""Every registered query against its DuckDB oracle on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_of
from tractlake.plans.stored import REGISTRY

NAMES = sorted(REGISTRY)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, s_rows) == rows_of(res.columns, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[:2] == ["year", "geoid"]
