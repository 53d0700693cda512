"""Revenue by category, customer, region and product; returns; growth."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.dates import as_date, month_start, month_text
from ordermill.functions.money import AMOUNTS, money, percent_of, total_revenue, with_amounts
from ordermill.operators.joins import (
    Tables,
    customer_revenue,
    valued_orders,
    with_products,
)
from ordermill.operators.ranges import dense_rank_in_groups
from ordermill.operators.storage import store


def category_revenue(tables: Tables) -> DataFrame:
    """Revenue per category, largest first. Orders are not consulted, so orphan items count."""
    lines = with_amounts(tables["order_items"], "product_id")
    return (
        with_products(lines, tables["products"], ["category"], AMOUNTS)
        .groupBy("category")
        .agg(money(total_revenue()).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "category")
    )


def top_customers(tables: Tables, k: int = 10) -> DataFrame:
    """The ``k`` customers with the largest order value."""
    return (
        customer_revenue(tables)
        .join(tables["customers"].select("customer_id", "customer_name"), "customer_id")
        .groupBy("customer_id", "customer_name")
        .agg(money(F.sum("revenue")).alias("total_order_value"))
        .orderBy(F.desc("total_order_value"), "customer_id", "customer_name")
        .limit(k)
    )


def monthly_orders(tables: Tables, as_of: str | dt.date, months: int = 12) -> DataFrame:
    """Orders per month since ``months`` months before ``as_of``; no upper bound."""
    since = F.add_months(F.lit(as_date(as_of)), -months).cast("timestamp_ntz")
    return (
        tables["orders"]
        .filter(F.col("order_date") >= since)
        .groupBy(month_start(F.col("order_date")).alias("month"))
        .agg(F.count_distinct("order_id").alias("total_orders"))
        .select(month_text(F.col("month")).alias("order_month"), "total_orders")
        .orderBy("order_month")
    )


def _lines_by_outcome(tables: Tables) -> DataFrame:
    """Item quantities of existing orders, split into returned and kept.

    Products differ within an order, so nothing can be summed before this join. Only a partial
    aggregate follows it, which leaves AQE free to split an order that owns very many items.
    """
    returned = F.col("status") == "RETURNED"
    quantity = F.col("quantity").cast("bigint")
    return (
        tables["order_items"]
        .select("order_id", "product_id", "quantity")
        .join(tables["orders"].select("order_id", "status"), "order_id")
        .select(
            "product_id",
            quantity.alias("total_items"),
            F.when(returned, quantity).otherwise(0).alias("returned_qty"),
            F.when(~returned, quantity).otherwise(0).alias("purchased_qty"),
        )
    )


def more_returned(tables: Tables) -> DataFrame:
    """Products with more units returned than in all other orders together."""
    keys, measures = ["product_id", "product_name"], ["returned_qty", "purchased_qty"]
    return (
        with_products(_lines_by_outcome(tables), tables["products"], keys, measures)
        .groupBy(*keys)
        .agg(
            F.sum("returned_qty").alias("total_returned_qty"),
            F.sum("purchased_qty").alias("total_purchased_qty"),
        )
        .filter(F.col("total_returned_qty") > F.col("total_purchased_qty"))
    )


def return_rate(tables: Tables) -> DataFrame:
    """Returned units as a percentage of all units per category; NULL without units."""
    measures = ["returned_qty", "total_items"]
    return (
        with_products(_lines_by_outcome(tables), tables["products"], ["category"], measures)
        .groupBy("category")
        .agg(
            F.sum("returned_qty").alias("returned_items"),
            F.sum("total_items").alias("total_items"),
        )
        .withColumn(
            "return_rate_percentage", percent_of(F.col("returned_items"), F.col("total_items"))
        )
        .orderBy(F.desc("return_rate_percentage"), "category")
    )


def region_running_revenue(tables: Tables) -> DataFrame:
    """Daily revenue per region with its running total.

    The window sees one row per region and day, so a region of any size stays small here.
    """
    daily = (
        valued_orders(tables, tables["orders"].select("order_id", "region_code", "order_date"))
        .groupBy("region_code", F.to_date("order_date").alias("order_date"))
        .agg(total_revenue().alias("daily"))
    )
    so_far = Window.partitionBy("region_code").orderBy("order_date")
    return daily.select(
        "region_code",
        "order_date",
        money(F.col("daily")).alias("daily_revenue"),
        money(F.sum("daily").over(so_far)).alias("running_total"),
    ).orderBy("region_code", "order_date")


def product_rank(tables: Tables, **sizes) -> DataFrame:
    """Dense rank of product names by revenue within their category."""
    keys = ["category", "product_name"]
    lines = with_amounts(tables["order_items"], "product_id")
    per_name = (
        with_products(lines, tables["products"], keys, AMOUNTS)
        .groupBy(*keys)
        .agg(total_revenue().alias("revenue"))
    )
    stored, rank = store(per_name, "product-rank"), "rank_in_category"
    ranked = dense_rank_in_groups(stored, "category", "revenue", "product_name", rank, **sizes)
    return ranked.select(
        "category",
        "product_name",
        money(F.col("revenue")).alias("total_revenue"),
        F.col(rank).cast("bigint").alias(rank),
    )


def year_over_year(tables: Tables) -> DataFrame:
    """Revenue per calendar month against the same month of the previous available year."""
    monthly = (
        valued_orders(tables, tables["orders"].select("order_id", "order_date"))
        .groupBy(month_start(F.col("order_date")).alias("first_day"))
        .agg(total_revenue().alias("revenue"))
        .withColumns(
            {
                "year": F.date_format("first_day", "yyyy"),
                "month": F.date_format("first_day", "MM"),
            }
        )
    )
    years = Window.partitionBy("month").orderBy("year")
    before = monthly.withColumn("before", F.lag("revenue").over(years))
    return before.select(
        "year",
        "month",
        money(F.col("revenue")).alias("revenue"),
        money(F.col("before")).alias("prev_year_revenue"),
        percent_of(F.col("revenue") - F.col("before"), F.col("before")).alias(
            "yoy_growth_percent"
        ),
    ).orderBy("month", "year")
