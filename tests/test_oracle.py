"""Every registered query against its SQL statement, on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as driver
from fieldloom.plans import catalog

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(driver.queries()) and set(catalog.ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert oracle.compare(df, con, driver.oracle_sql()[name]) is None
