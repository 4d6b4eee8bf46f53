"""Every registered query against its SQL, and the flagship query."""

import pytest

import __spark_entry__ as driver
from tests.oracle import difference

SQL = driver.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf_check, name):
    assert difference(spark, sf_check, driver.queries()[name], SQL[name]) is None


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert {r["action"] for r in rows} == {"NEWT", "MODI", "CORR", "TERM", "EROR", "REVI"}
