"""Every registered query against its expected SQL, over the whole smallest tables."""

import pytest

import __spark_entry__ as driver
from medalstar.checks.oracle import ORACLE
from medalstar.checks.queries import QUERIES
from tests.compare import differences, sql_database

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return sql_database(SF_DIR)


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(driver.queries())
    # The operators for training data have SQL where it can express them; tests/llm covers the others.
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, database, name):
    assert differences(driver.queries()[name](spark, SF_DIR), database, driver.oracle_sql()[name]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0
