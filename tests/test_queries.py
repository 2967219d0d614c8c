import pytest

from orefold.plans import flows, shapes  # noqa: F401
from orefold.plans.queries import QUERIES, SQL
from tests import sqlcheck


@pytest.fixture(scope="module")
def con(data):
    return sqlcheck.connect(data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, data, name):
    sqlcheck.assert_equal(QUERIES[name](spark, data), con, SQL[name])


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_driver_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
