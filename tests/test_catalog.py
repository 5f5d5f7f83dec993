"""Every catalogue query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from check import connect, same
from commwatch.plans.catalog import CATALOG
from commwatch.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_agrees_with_sql(spark, sf_dir, db, name):
    frame = CATALOG[name](spark, sf_dir)
    assert same(frame, db, ORACLE[name]) is None


def test_entry(spark, sf_dir):
    assert entry_points.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(CATALOG) == set(ORACLE)
    assert set(CATALOG) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())
