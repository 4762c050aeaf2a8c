"""Registered corpus queries against their SQL twins."""

import pytest
from compare import differences, sql_engine

from tidecast.llm import queries, twins

SQL = twins.build()


@pytest.fixture(scope="module")
def engine(sf_dir):
    return sql_engine(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, engine, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), engine.sql(SQL[name])) == []


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 14)]
