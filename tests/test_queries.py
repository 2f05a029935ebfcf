"""Every registered core query against its SQL on the smallest tables."""

import pytest

from loomery.operators import queries as Q

from .oracle import assert_same, connection


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert_same(Q.QUERIES[name](spark, sf_dir), con, Q.SQL[name])


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert Q.QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark, sf_dir):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["host", "detail_url", "score", "rank"] and df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
