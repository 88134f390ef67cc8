"""The registered queries on the smallest tables, by their SQL statements where there are any."""

import oracle
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from fieldloom.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_by_sql(spark, con, name):
    assert oracle.compare(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name]) is None


def test_all_are_registered():
    numbers = sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES)
    assert numbers == list(range(1, len(numbers) + 1)) and set(queries.QUERIES) <= set(driver.queries())
    assert "pipeline" in driver.queries() and [n for n, _ in corpus_pipeline.STAGES][-1] == "packing"
