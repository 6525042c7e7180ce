"""Every named query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, difference
from eventlode.plans.oracle import ORACLE_SQL as SQL
from eventlode.plans.queries import QUERIES

# At the smallest scale no user has been idle for thirty days.
MAY_BE_EMPTY = {"kpi_churn_high"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    found = difference(spark, duck, QUERIES[name], SQL[name], sf_dir)
    assert found is None or (found == "no rows" and name in MAY_BE_EMPTY)


def test_entry_is_stable(spark):
    first, second = entry_points.entry(spark), entry_points.entry(spark)
    assert first.schema == second.schema and first.count() == second.count() > 0
