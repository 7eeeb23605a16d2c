"""Each query gives the rows its SQL gives on another engine."""

import pytest
from compare import spark_rows, sql_rows

import __spark_entry__ as driver
from wattledger.plans.oracle import ORACLE_SQL
from wattledger.plans.queries import QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, sf_dir, name):
    names, rows = spark_rows(driver.queries()[name](spark, sf_dir))
    sql_names, expected = sql_rows(sf_dir, driver.oracle_sql()[name])
    assert names == sql_names
    assert rows, "no rows to compare"
    assert rows == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_has_rows(spark):
    frame = driver.entry(spark)
    assert frame.columns[:4] == ["file_path", "utility_type", "vendor_id", "element_index"]
    assert frame.take(1)
