"""Every registered query with SQL equals its DuckDB oracle on sf0.001."""

import pytest

import __spark_entry__ as E
from scripts.oracle_check import canon
from tests.conftest import SF_SMALL

SQLS = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(SQLS[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canon(got) == canon(want)


def test_every_query_has_a_builder():
    assert set(SQLS) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "ID_CORRELATIVO" in df.columns
