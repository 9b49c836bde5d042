"""Every registered query against its SQL on DuckDB, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry
from clipwarden.plans.catalog import ORACLES, QUERIES
from check_queries import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got_names, got = rows_of(QUERIES[name](spark, SF).toArrow())
    want_names, want = rows_of(con.execute(ORACLES[name]).to_arrow_table())
    assert got_names == want_names
    assert got == want
