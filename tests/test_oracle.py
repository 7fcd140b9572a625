"""Every catalogue query against its DuckDB statement (the driver's check)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE
from oracle import compare

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, name):
    r = compare(QUERIES[name](spark, SF_ORACLE), SQL[name], SF_ORACLE)
    assert r["spark_cols"] == r["oracle_cols"]
    assert r["rows_spark"] == r["rows_oracle"]
    assert r["hash_match"]


def test_every_query_has_an_oracle():
    from clickfeat.oracle_sql import queries as core_sql
    from clickfeat.plans.queries import catalogue

    assert set(catalogue()) == set(core_sql())


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.count() == 896  # FIXTURES.md expected count at sf0.001
    assert len(df.columns) == 53
