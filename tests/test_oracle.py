"""Every registered query against its SQL counterpart, over the whole tables."""

import os

import pytest
from compare import connect, difference

import __spark_entry__ as driver
from oracle_queries import ORACLE_SQL
from ordermill.operators.storage import release

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(autouse=True)
def nothing_left(spark):
    """What a query stored goes after it."""
    yield
    release(spark)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert driver.order_queries().keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", driver.order_queries())
def test_matches_sql(spark, con, name):
    assert difference(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name]) is None


@pytest.mark.parametrize(
    "name",
    ["q07_region_running_revenue", "q09_order_gaps", "q15_cohort_activity", "c01_clean_orders",
     "r05_day_report", "s01_csv_customers"],
)
def test_time_zones_do_not_matter(spark, con, name):
    """A zone whose clocks change at midnight, where the test tables have all their times."""
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        result = difference(driver.queries()[name](spark, SF_DIR), con, driver.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert result is None


def test_entry_has_rows(spark):
    assert driver.entry(spark).count() == 6
