"""Orders and items laid out by month."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.plans import report
from ordermill.sources import monthly
from ordermill.sources.tables import read_tables, write_tables

ORDERS = "order_id string, customer_id string, order_date timestamp_ntz"
ITEMS = "item_id string, order_id string, product_id string, quantity int, unit_price double, discount_percent double"


@pytest.fixture
def laid(spark, tmp_path):
    moments = [dt.datetime(2024, 1, 5) + dt.timedelta(days=3 * i, hours=i % 24) for i in range(120)]
    orders = [(f"O{i}", f"C{i % 7}", m) for i, m in enumerate(moments)]
    # One order under two customers in two months, one without a date.
    orders += [("O5", "C9", dt.datetime(2024, 3, 3)), ("O900", "C1", None)]
    items = [(f"I{i}", f"O{i % 130}", f"P{i % 5}", 1 + i % 3, 10.25, 5.0) for i in range(600)]
    tables = {
        "orders": spark.createDataFrame(orders, ORDERS),
        "order_items": spark.createDataFrame(items, ITEMS),
        "products": spark.createDataFrame([(f"P{i}", f"n{i}") for i in range(5)], "product_id string, product_name string"),
    }
    monthly.write_monthly(tables, str(tmp_path))
    found = monthly.read_monthly(spark, str(tmp_path), {n: tables[n].schema for n in ("orders", "order_items")})
    return tables, {**found, "products": tables["products"]}


def test_nothing_is_lost(laid):
    tables, found = laid
    for name in monthly.TABLES:
        assert sorted(map(str, found[name].drop("month").collect())) == sorted(map(str, tables[name].collect()))
    assert found["order_items"].where("month = 0").select("order_id").distinct().collect()[0].order_id == "O5"


@pytest.mark.parametrize("start,end", [("2024-03-01", "2024-03-31"), ("2024-02-20", "2024-04-02"), ("2023-01-01", "2023-02-01"), ("2024-12-01", "2024-12-31")])
def test_reports_are_the_same(laid, start, end):
    tables, found = laid
    for plan in (report.period_metrics, report.period_comparison, report.top_products, report.executive_summary):
        assert plan(found, start, end).collect() == plan(tables, start, end).collect()


def test_only_the_period_s_months_are_read(laid):
    _, found = laid
    march = monthly.of_period(found, dt.date(2024, 3, 1), dt.date(2024, 3, 31))
    for name, months in (("orders", 1), ("order_items", 2)):  # items of several months are always read
        df = march[name]
        df.collect()
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        assert scan.metrics().apply("numPartitions").value() == months
        whole = found[name]
        assert 0 < scan.metrics().apply("numFiles").value() < len(whole.inputFiles()) / 3
    plan = report.period_metrics(found, "2024-03-01", "2024-03-31")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "month" in line]
    assert scans and all("PartitionFilters: [" in s and "month" in s.split("PartitionFilters: [")[1].split("]")[0] for s in scans)


def test_other_layouts_stay_as_they_are(spark, laid, tmp_path):
    tables, _ = laid
    write_tables(tables, str(tmp_path / "plain"), "parquet")
    plain = read_tables(spark, str(tmp_path / "plain"), "parquet", {n: df.schema for n, df in tables.items()})
    same = monthly.of_period(plain, dt.date(2024, 3, 1), dt.date(2024, 3, 31))
    assert same["orders"].count() == tables["orders"].count() and same["products"].agg(F.count("*")).first()[0] == 5
