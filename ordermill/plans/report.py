"""Period reports against the previous period.

Where orders and items are laid out by month (``sources.monthly``), a report reads the months of its
period alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ordermill.functions.dates import as_date, midnight
from ordermill.functions.money import (
    AMOUNTS,
    money,
    percent_change,
    total_revenue,
    whole_sum,
    with_amounts,
)
from ordermill.operators.joins import Tables, broadcast_if_small, valued_orders
from ordermill.sources.monthly import of_period

Day = str | dt.date
GRAINS = ("day", "week", "month")


def period(start: Day, end: Day) -> tuple[dt.date, dt.date]:
    """Both days validated, and in order."""
    start, end = as_date(start), as_date(end)
    if start > end:
        raise ValueError(f"the period starts on {start}, after its end {end}")
    return start, end


def previous_period(start: Day, end: Day) -> tuple[dt.date, dt.date]:
    """The window of the same length that ends the day before ``start``."""
    start, end = period(start, end)
    last = start - dt.timedelta(days=1)
    return last - (end - start), last


def _within(start: dt.date, end: dt.date) -> Column:
    """From ``start`` to the end of the day ``end``, as a bare comparison the scan can use."""
    stamp = F.col("order_date")
    return (stamp >= midnight(start)) & (stamp < midnight(end + dt.timedelta(days=1)))


def _metrics(tables: Tables, orders: DataFrame, bucket: str, selective: bool) -> DataFrame:
    """Orders with items, their customers and revenue, per value of the column ``bucket``.

    Instead of two distinct counts over all orders, which would copy every row twice, an order is
    counted with the first of its rows, where its rows are together anyway, and only one row per
    customer moves on. So an order listed under several customers counts once, while its revenue
    counts with each listing.
    """
    return _totals(valued_orders(tables, orders.select("order_id", "customer_id", bucket), selective), bucket)


def _totals(valued: DataFrame, *buckets: str) -> DataFrame:
    """The metrics of orders that have their amounts, per value of the columns ``buckets``."""
    listed = Window.partitionBy(*buckets, "order_id").orderBy("customer_id")
    per_customer = (
        valued.withColumn("first", (F.row_number().over(listed) == 1).cast("bigint"))
        .groupBy(*buckets, "customer_id")
        .agg(F.sum("first").alias("orders"), *[whole_sum(a).alias(a) for a in AMOUNTS])
    )
    return per_customer.groupBy(*buckets).agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        money(total_revenue()).alias("total_revenue"),
    )


def period_metrics(tables: Tables, start: Day, end: Day) -> DataFrame:
    """One row: orders, customers and revenue of a period, zeros if nothing was sold."""
    start, end = period(start, end)
    tables = of_period(tables, start, end)
    orders = tables["orders"].filter(_within(start, end)).withColumn("bucket", F.lit(0))
    return _metrics(tables, orders, "bucket", selective=True).agg(
        F.coalesce(F.max("total_orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.max("unique_customers"), F.lit(0)).alias("unique_customers"),
        F.coalesce(F.max("total_revenue"), F.lit(0.0)).alias("total_revenue"),
    )


def period_comparison(tables: Tables, start: Day, end: Day) -> DataFrame:
    """The period and the one before it: first day, last day and orders dated in each."""
    start, end = period(start, end)
    before, last = previous_period(start, end)
    current = F.col("order_date") >= midnight(start)
    counts = of_period(tables, before, end)["orders"].filter(_within(before, end)).agg(
        F.count_if(current).alias("current"), F.count_if(~current).alias("previous")
    )
    rows = [
        F.struct(
            F.lit(name).alias("period"),
            F.lit(first).alias("first_day"),
            F.lit(final).alias("last_day"),
            F.col(name).alias("orders_placed"),
        )
        for name, first, final in (("current", start, end), ("previous", before, last))
    ]
    return counts.select(F.inline(F.array(*rows)))


def top_products(tables: Tables, start: Day, end: Day, k: int = 3) -> DataFrame:
    """The ``k`` products with the largest revenue in a period.

    Revenue is summed per product before the product table is joined. Orders that are not small
    filter the items before their shuffle all the same, through a Bloom filter (``joins.items_of``).
    """
    start, end = period(start, end)
    tables = of_period(tables, start, end)
    in_period = tables["orders"].filter(_within(start, end)).select("order_id")
    orders, _ = broadcast_if_small(in_period)
    per_product = (
        with_amounts(tables["order_items"], "order_id", "product_id")
        .join(orders, "order_id")
        .groupBy("product_id")
        .agg(total_revenue().alias("revenue"))
    )
    return (
        per_product.join(tables["products"].select("product_id", "product_name"), "product_id")
        .groupBy("product_id", "product_name")
        .agg(money(F.sum("revenue")).alias("product_revenue"))
        .orderBy(F.desc("product_revenue"), "product_id")
        .limit(k)
    )


def executive_summary(tables: Tables, start: Day, end: Day) -> DataFrame:
    """One row: the period against the previous one, both from a single scan."""
    start, end = period(start, end)
    before, last = previous_period(start, end)
    is_current = F.col("order_date") >= midnight(start)
    tables = of_period(tables, before, end)
    orders = tables["orders"].filter(_within(before, end)).withColumn("is_current", is_current)
    metrics = _metrics(tables, orders, "is_current", selective=True)

    def pick(name: str, current: bool) -> Column:
        chosen = F.max(F.when(F.col("is_current") == current, F.col(name)))
        return F.coalesce(chosen, F.lit(0).cast(metrics.schema[name].dataType))

    both = metrics.agg(
        pick("total_revenue", True).alias("total_revenue"),
        pick("total_revenue", False).alias("prev_revenue"),
        pick("total_orders", True).alias("total_orders"),
        pick("total_orders", False).alias("prev_orders"),
        pick("unique_customers", True).alias("unique_customers"),
    )
    return both.select(
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        F.lit(before).alias("prev_start_date"),
        F.lit(last).alias("prev_end_date"),
        "*",
        percent_change(F.col("total_revenue"), F.col("prev_revenue")).alias("revenue_change"),
        percent_change(F.col("total_orders"), F.col("prev_orders")).alias("orders_change"),
    )


def grain_report(tables: Tables, grain: str = "month") -> DataFrame:
    """Metrics per day, week (from Monday) or month, against the previous bucket with sales."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    bucket = _bucket(F.to_date("order_date"), grain)
    dated = tables["orders"].filter(F.col("order_date").isNotNull()).withColumn("bucket", bucket)
    # One row per bucket is left, and buckets are bounded by the calendar.
    compared = _against_previous(_metrics(tables, dated, "bucket", selective=False), Window.orderBy("bucket"))
    return compared.orderBy("period_start")


def grain_reports(tables: Tables) -> DataFrame:
    """``grain_report`` of all grains, told apart by the column ``grain``, from one scan of the items: they
    are summed per order, and only the orders with their sums stand in three buckets each."""
    day = F.col("day")
    buckets = [F.struct(F.lit(g).alias("grain"), _bucket(day, g).alias("bucket")) for g in GRAINS]
    dated = tables["orders"].filter(F.col("order_date").isNotNull())
    valued = valued_orders(tables, dated.select("order_id", "customer_id", F.to_date("order_date").alias("day")))
    metrics = _totals(valued.select("*", F.inline(F.array(*buckets))).drop("day"), "grain", "bucket")
    in_time = Window.partitionBy("grain").orderBy("bucket")
    return _against_previous(metrics, in_time, "grain").orderBy("grain", "period_start")


def _bucket(day: Column, grain: str) -> Column:
    """The first day of the bucket that a day is in."""
    return day if grain == "day" else F.trunc(day, grain)


def _against_previous(metrics: DataFrame, in_time: WindowSpec, *keep: str) -> DataFrame:
    """Metrics per bucket with their changes against the previous bucket with sales."""
    previous = metrics.withColumns(
        {
            "prev_revenue": F.lag("total_revenue").over(in_time),
            "prev_orders": F.lag("total_orders").over(in_time),
        }
    )
    return previous.select(
        *keep,
        F.col("bucket").alias("period_start"),
        "total_orders",
        "unique_customers",
        "total_revenue",
        percent_change(F.col("total_revenue"), F.col("prev_revenue")).alias("revenue_change"),
        percent_change(F.col("total_orders"), F.col("prev_orders")).alias("orders_change"),
    )
