"""Every registered query against its SQL twin."""

import pytest
from compare import differences, sql_engine

from __spark_entry__ import entry, oracle_sql, queries
from tidecast.plans import twins
from tidecast.plans.catalogue import QUERIES

SQL = twins.build()


@pytest.fixture(scope="module")
def engine(sf_dir):
    return sql_engine(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, engine, name):
    assert differences(QUERIES[name](spark, sf_dir), engine.sql(SQL[name])) == []


def test_every_twin_has_a_query():
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) == set(SQL)


def test_entry_has_rows(spark, sf_dir):
    df = entry(spark)
    assert df.columns == ["series_id", "origin", "step", "target_date", "predicted"]
    assert df.count() > 0
