"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import open_tables, rows_of
from tidewatch.plans import catalog

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.queries()) <= set(contract.oracle_sql()) & set(contract.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_sql(spark, tables, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    want = tables.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    alerts = contract.entry(spark)
    assert alerts.count() > 0 and "risk_band" in alerts.columns
