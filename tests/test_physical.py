"""What the plans look like, and how they cope with keys that own a third of all rows."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from ordermill.functions.money import line_revenue
from ordermill.operators import joins, ranges
from ordermill.plans import anomalies, cleaning, cohort, customers, quality, report, sales
from ordermill.sources import tables as storing
from ordermill.sources import testdata

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """As with tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", driver.order_queries())
def test_no_python_and_no_pairing_of_everything(spark, no_broadcast, name):
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    assert "Python" not in plan and "Pandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name, key",
    [
        ("q08_product_rank", "_range"),
        ("q09_order_gaps", "customer_id"),  # no customer there is large enough to be split
        ("q11_ltv_quartiles", "_range"),
        ("q14_revenue_concentration", "_range"),
    ],
)
def test_large_windows_do_not_run_in_one_task(spark, name, key):
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    assert "SinglePartition" not in plan
    assert "Window" in plan and f"hashpartitioning({key}" in plan


def test_only_the_large_group_is_split(spark, skewed):
    df = customers.order_gaps(skewed)
    assert "hashpartitioning(_range" in plan_of(df)
    orders = skewed["orders"].select("customer_id", "order_id", "order_date")
    split = ranges.lag_in_groups(orders, "customer_id", "order_date", "order_id")
    assert {cut.grp for cut in split.cuts} == {1}
    sizes = split.rows.filter("customer_id = 1").groupBy(ranges.RANGE).count()
    assert sizes.agg(F.max("count")).first()[0] < 7000 / 3


def test_filters_and_columns_reach_the_scan(spark):
    tables = testdata.tables(spark, SF_DIR)
    plan = plan_of(sales.monthly_orders(tables, driver.AS_OF))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate", plan)
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>", plan)
    plan = plan_of(sales.category_revenue(tables))
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan
    # Name and region of customers are not read by a query that needs neither.
    plan = plan_of(customers.order_gaps(tables))
    assert "customer.parquet" not in plan and "c_name" not in plan


def test_items_are_shuffled_once_and_after_partial_sums(spark, no_broadcast):
    plan = plan_of(joins.customer_revenue(testdata.tables(spark, SF_DIR)))
    assert plan.count("Exchange hashpartitioning") == 3  # items, orders, customers
    below = plan[plan.rindex("Exchange hashpartitioning(order_id") :]
    assert re.search("partial_(try_)?sum", below)


def test_items_of_a_period_are_not_shuffled_when_its_orders_are_small(spark, no_broadcast, monkeypatch):
    tables = testdata.tables(spark, SF_DIR)
    plan = plan_of(report.top_products(tables, *driver.PERIOD))
    assert "hashpartitioning(order_id" not in plan and "BroadcastHashJoin" in plan
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    plan = plan_of(report.top_products(tables, *driver.PERIOD))
    assert "hashpartitioning(order_id" in plan and "BroadcastHashJoin" not in plan


def test_large_periods_filter_the_items_before_their_shuffle(spark, no_broadcast, monkeypatch):
    """Beyond a broadcast, a Bloom filter of the period's order ids stands below the items' exchange."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    threshold = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    spark.conf.set(threshold, "0")
    try:
        tables = testdata.tables(spark, SF_DIR)
        for plan in (report.top_products, report.period_metrics, report.executive_summary):
            text = plan_of(plan(tables, *driver.PERIOD))
            items = text[: text.index("lineitem.parquet")]
            assert "might_contain" in items[items.rindex("Exchange hashpartitioning") :]
    finally:
        spark.conf.unset(threshold)


def test_quality_and_validation_scan_each_table_once(spark):
    tables = driver._parsed(anomalies.inject_anomalies(testdata.tables(spark, SF_DIR), extra=True))
    summary = plan_of(quality.quality_summary(tables, driver.MOMENT))
    assert summary.count("lineitem.parquet") == 1 and summary.count("orders.parquet") == 1
    raw = anomalies.inject_anomalies(testdata.tables(spark, SF_DIR), extra=True)
    findings = plan_of(cleaning.validation_report(raw))
    assert [findings.count(f"{t}.parquet") for t in ("lineitem", "orders", "customer")] == [1, 1, 1]


def test_a_large_product_table_is_joined_after_summing(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    plan = plan_of(sales.category_revenue(testdata.tables(spark, SF_DIR)))
    assert "SortMergeJoin" in plan
    assert re.search("partial_(try_)?sum", plan[plan.index("hashpartitioning(product_id") :])


@pytest.fixture
def skewed(spark, tmp_path):
    """A third of the items in one order and one product, a third of the orders by one customer."""
    rows = spark.range(60_000)
    third = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
    orders = spark.range(20_000).select(
        F.col("id").alias("order_id"),
        F.when(third, 1).otherwise(F.col("id") % 500).alias("customer_id"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 900 as int))")
        .alias("order_date"),
        F.when(F.col("id") % 4 == 0, "RETURNED").otherwise("DELIVERED").alias("status"),
        F.when(third, "X").otherwise("Y").alias("region_code"),
    )
    items = rows.select(
        F.format_string("I%d", "id").alias("item_id"),
        F.when(third, 4).otherwise(F.col("id") % 25_000).alias("order_id"),
        F.when(third, 2).otherwise(F.col("id") % 300).alias("product_id"),
        (F.col("id") % 9 + 1).cast("int").alias("quantity"),
        (F.col("id") % 1000 / 100).cast("decimal(14,2)").alias("unit_price"),
        (F.col("id") % 20).cast("decimal(5,2)").alias("discount_percent"),
    )
    products = spark.range(300).selectExpr(
        "id AS product_id", "concat('p', id % 250) AS product_name", "concat('c', id % 3) AS category"
    )
    people = spark.range(500).selectExpr(
        "id AS customer_id", "concat('n', id) AS customer_name",
        "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(cast(id % 90 as int)) AS registration_date",
    )
    tables = {"orders": orders, "order_items": items, "products": products, "customers": people}
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in tables}


@pytest.fixture
def small_skew_threshold(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize(
    "query",
    [
        lambda t: sales.return_rate(t),
        lambda t: sales.more_returned(t),
        lambda t: cleaning.orphan_items(t["order_items"], t["orders"]),
    ],
    ids=["return_rate", "more_returned", "orphan_items"],
)
def test_an_order_with_very_many_items_is_split(spark, skewed, small_skew_threshold, query):
    df = query(skewed)
    df.collect()
    assert "skew=true" in plan_of(df)


def test_results_on_skewed_tables(spark, skewed, no_broadcast, monkeypatch):
    items = skewed["order_items"].withColumn("rev", line_revenue())
    sold = items.join(skewed["orders"], "order_id")
    total = sold.agg(F.sum("rev")).first()[0]

    for limit in (0, 10**8):
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        share = customers.revenue_concentration(skewed).collect()
        assert max(r.cumulative_percent for r in share) == 100.0
        assert max(r.cumulative_revenue for r in share) == round(float(total), 2)
        ranked = sales.product_rank(skewed).collect()
        names = items.join(skewed["products"], "product_id").select("category", "product_name")
        assert len(ranked) == names.distinct().count()
        per_category = sum(r.total_revenue for r in sales.category_revenue(skewed).collect())
        everything = items.join(skewed["products"], "product_id").agg(F.sum("rev")).first()[0]
        assert abs(per_category - float(everything)) < 0.02

    running = sales.region_running_revenue(skewed).collect()
    last = {r.region_code: r.running_total for r in running}
    assert abs(sum(last.values()) - float(total)) < 0.02
    tiles = [r.quartile for r in customers.ltv_quartiles(skewed).collect()]
    sizes = [tiles.count(t) for t in range(1, 5)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 500
    gaps = customers.order_gaps(skewed).collect()
    with_customer = skewed["orders"].select("customer_id").distinct().count()
    assert len(gaps) == 20_000 - with_customer
    active = cohort.retention_rate(skewed).collect()
    assert {r.month_number for r in active} == {0, 1, 2, 3}


def test_bucketed_tables_join_without_a_shuffle(spark, skewed, no_broadcast, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    for name, df in skewed.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    names = ["orders", "order_items"]
    loaded = storing.load_tables(spark, str(tmp_path), names, "parquet", {}, "bucketed", 4)
    assert {r.status for r in loaded.collect()} == {"loaded"}
    bucketed = {n: spark.table(f"bucketed.{n}") for n in names}
    plan = plan_of(joins.customer_revenue(bucketed))
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(customer_id" in plan
    ours = joins.customer_revenue(bucketed)
    assert ours.exceptAll(joins.customer_revenue(skewed)).count() == 0 < ours.count()

    # One order owns a third of the items: too much for one of many buckets.
    assert storing._fits_buckets(skewed["order_items"], "order_id", 100)
    monkeypatch.setattr(storing, "MANY_ROWS", 10_000)
    assert not storing._fits_buckets(skewed["order_items"], "order_id", 100)
    assert storing._fits_buckets(skewed["orders"], "order_id", 100)


def test_broadcasts_are_measured(spark, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 50 * (joins.ROW_BYTES + 20))
    short = spark.range(50).select("id", F.lit("é" * 5).alias("t"))
    assert joins.broadcast_if_small(short)[1]  # 50 * (the row's overhead + 8 + 10)
    assert not joins.broadcast_if_small(spark.range(50).select("id", F.lit("é" * 7).alias("t")))[1]
    assert not joins.broadcast_if_small(spark.range(70))[1]
    assert joins.broadcast_if_small(short.filter("id < 0"))[1]


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_date_text_is_read_once(spark):
    """One pattern per row, whatever asks for the date: a filter on it, or several columns made of it."""
    orders = spark.createDataFrame([("O1", "C1", "05 Mar 2024 10:00 pm")], "order_id string, customer_id string, order_date string")
    late = quality.future_orders({"orders": cleaning.parsed_orders(orders)}, "2024-01-01")
    twice = cleaning.clean_orders(orders).selectExpr("order_date", "date_trunc('month', order_date) AS m").where("m > '2024-01-01'")
    kept = cleaning.clean_orders(orders, "quarantine").where("order_date IS NULL")
    for df in (late, twice, kept):
        plan = optimized(df)
        assert plan.count("regexp_replace(") == 1 and "regexp_extract" not in plan and "RLIKE" not in plan


def test_cohorts_shuffle_each_table_once(spark, no_broadcast):
    """Customers and their days by customer, then one row per cohort and task; nothing distinct is counted."""
    orders = spark.createDataFrame([("O1", "C1", "2024-03-05")], "order_id string, customer_id string, d string")
    orders = orders.selectExpr("order_id", "customer_id", "CAST(d AS TIMESTAMP_NTZ) AS order_date")
    people = spark.createDataFrame([("C1", "2024-03-01")], "customer_id string, d string")
    people = people.selectExpr("customer_id", "CAST(d AS TIMESTAMP_NTZ) AS registration_date")
    plan = plan_of(cohort.retention_rate({"orders": orders, "customers": people}))
    assert plan.count("Exchange hashpartitioning") == 3 and "distinct" not in plan and "Expand" not in plan


def test_one_hash_per_injected_row(spark):
    items = testdata.order_items(spark, SF_DIR)
    for df in (anomalies.dirty_order_items(items, extra=True), anomalies.dirty_order_items(items, extra=True).where("discount_percent > 100")):
        assert optimized(df).count("md5(") == 1


def test_top_products_in_sql_hand_on_their_first_rows_alone(spark):
    from ordermill.plans import sql_functions

    tables = testdata.tables(spark, SF_DIR)
    for name in ("orders", "order_items", "products"):
        tables[name].createOrReplaceTempView(f"plans_{name}")
    assert sql_functions.register(spark, "plans_") == ["plans_period_metrics", "plans_top_products"]
    query = "SELECT * FROM plans_top_products(:first, :last)"
    plan = plan_of(spark.sql(query, args={"first": dt.date(2000, 3, 1), "last": dt.date(2000, 3, 31)}))
    assert "TakeOrderedAndProject(limit=3" in plan and "Window" not in plan


def test_all_grains_come_from_one_scan_of_the_items(spark, no_broadcast):
    plan = plan_of(report.grain_reports(testdata.tables(spark, SF_DIR)))
    assert plan.count("lineitem.parquet") == plan.count("orders.parquet") == 1
    assert plan.count("Exchange hashpartitioning(order_id") == 2  # items and orders, before the buckets
