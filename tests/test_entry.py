"""The driver contract: entry smoke check and every query against its SQL oracle."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE
from tidepool.plans.oracle import ORACLE_SQL
from tidepool.plans.queries import QUERIES
from tools.check_oracle import TABLES, digest


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "n"]
    assert df.count() > 0


def test_every_query_of_the_reference_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_ORACLE}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF_ORACLE).toPandas()
    assert len(got) > 0
    want = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)
