"""Every registered query of the library against its SQL statement, run by another engine."""

import pytest

import __spark_entry__ as driver
from checks import catalog, oracle
from checks.compare import difference
from fieldmart.schema import OUTPUT

STATEMENTS = oracle.oracle_sql()


def test_every_query_has_a_statement():
    assert set(catalog.REGISTRY) == set(STATEMENTS)


def test_the_driver_sees_all_queries():
    assert set(catalog.REGISTRY) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", list(catalog.REGISTRY))
def test_query(spark, sf_dir, duck, name):
    df = catalog.REGISTRY[name](spark, sf_dir)
    assert difference(df, duck, STATEMENTS[name]) is None


def test_entry_is_the_whole_product(spark):
    df = driver.entry(spark)
    assert df.columns == [name for name, _ in OUTPUT] and len(df.columns) == 114
    assert df.select("last_data_refresh_timestamp").distinct().count() == 1
