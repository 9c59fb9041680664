"""Every query with checking SQL against the second engine; the others run and give rows."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

QUERIES, SQL = entry.queries(), entry.oracle_sql()
PAIRWISE = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_to_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in PAIRWISE if p in plan]
    assert compare(df, con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert len(df.columns) == len(set(df.columns))
    assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
