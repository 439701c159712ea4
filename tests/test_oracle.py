"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from tallyrisk.plans.compare import compare, duckdb_connection

from .conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert compare(got, want) == []


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["month", "n_obs", "n_default", "default_rate"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())
