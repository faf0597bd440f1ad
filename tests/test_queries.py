"""Every registered query of the library against its SQL on the smallest tables; queries without SQL give rows."""

from __future__ import annotations

import pytest

from sparkloom.plans import registry
from tests.compare import connect, of_frame, of_sql

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(name, spark, sf_dir, con):
    got_names, got = of_frame(QUERIES[name](spark, sf_dir))
    names, expected = of_sql(con, SQL[name])
    assert got_names == names
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_repeats(name, spark, sf_dir):
    first, second = of_frame(QUERIES[name](spark, sf_dir)), of_frame(QUERIES[name](spark, sf_dir))
    assert first[1]
    assert first == second


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
