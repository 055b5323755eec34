"""Every registered query against its DuckDB oracle on the smallest driver
tables (schema names, row multiset, values rounded to 6 places)."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, sf_small, name):
    line = compare(spark, con, sf_small, name, QUERIES[name], ORACLES[name])
    assert line.startswith("OK"), line


def test_every_query_has_a_runnable_entry(spark):
    assert set(ORACLES) <= set(QUERIES)
    df = E.entry(spark)
    assert df.columns[0] == "table_key"
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_oracle_run(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    assert len(df.collect()) > 0
