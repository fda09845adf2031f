"""Every demo query against its SQL on the smallest benchmark tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import rows as normal_rows
from starmart_demo.profiling import ALL_TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not there")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in ALL_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    without = set(queries()) - set(oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in without)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, db, name):
    df = queries()[name](spark, SF)
    result = db.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal_rows(df.columns, [tuple(r) for r in df.collect()]) == normal_rows(columns, result.fetchall())
