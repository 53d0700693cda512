"""Customer behaviour: delivery, gaps, value bands, quartiles, category shift, concentration."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import elapsed_days, month_start, month_text
from ordermill.functions.money import money, percent_of, total_revenue
from ordermill.operators.joins import Tables, broadcast_if_small, customer_revenue, valued_orders
from ordermill.operators.ranges import (
    global_ntile,
    global_running_sum,
    lag_in_groups,
    totals_in_groups,
)
from ordermill.operators.storage import store

LABELS = ["Platinum", "Gold", "Silver", "Bronze"]


def never_delivered(tables: Tables) -> DataFrame:
    """Customers with at least one order and none delivered.

    "None delivered" is a partial aggregate over the orders instead of an anti join of the
    orders with themselves: one scan, and a customer with very many orders is no hot key.
    """
    delivered = F.coalesce(F.col("status") == "DELIVERED", F.lit(False))
    undelivered = (
        tables["orders"]
        .groupBy("customer_id")
        .agg(F.max(delivered).alias("delivered"))
        .filter(~F.col("delivered"))
        .select("customer_id")
    )
    return (
        undelivered.join(tables["customers"], "customer_id")
        .select("customer_id", "customer_name")
        .distinct()
    )


def order_gaps(tables: Tables, risk_days: float = 30, **sizes) -> DataFrame:
    """Days between consecutive orders; a customer is at risk if they average over the limit."""
    orders = (
        tables["orders"]
        .filter(F.col("customer_id").isNotNull())
        .select("customer_id", "order_id", "order_date")
    )
    orders = store(orders, "order-gaps")
    ranges = lag_in_groups(
        orders, "customer_id", "order_date", "order_id", "previous_order_date", **sizes
    )
    days = elapsed_days(F.col("previous_order_date"), F.col("order_date"))
    ranges.rows = ranges.rows.withColumn("days_gap", days)
    has_gap = F.col("days_gap").isNotNull()
    totals = {"total_days": F.col("days_gap"), "gaps": F.when(has_gap, 1).otherwise(0)}
    at_risk = F.col("total_days") > F.col("gaps") * risk_days
    return (
        totals_in_groups(ranges, "customer_id", totals)
        .filter(F.col("previous_order_date").isNotNull())
        .select(
            "customer_id",
            "order_date",
            "previous_order_date",
            "days_gap",
            F.when(at_risk, "At Risk").otherwise("Safe").alias("risk_flag"),
        )
    )


def monthly_value_bands(tables: Tables, low: float = 5000, high: float = 10000) -> DataFrame:
    """Customers per month and revenue band: above ``high``, from ``low`` on, and the rest."""
    known = tables["orders"].filter(F.col("customer_id").isNotNull())
    monthly = (
        valued_orders(tables, known.select("order_id", "customer_id", "order_date"))
        .groupBy("customer_id", month_start(F.col("order_date")).alias("month"))
        .agg(total_revenue().alias("revenue"))
    )
    band = (
        F.when(F.col("revenue") > high, "High")
        .when(F.col("revenue").between(low, high), "Medium")
        .otherwise("Low")
    )
    return (
        monthly.groupBy("month", band.alias("customer_category"))
        .agg(F.count("customer_id").alias("customer_count"))
        .select(
            month_text(F.col("month")).alias("order_month"), "customer_category", "customer_count"
        )
        .orderBy("order_month", "customer_category")
    )


def ltv_quartiles(tables: Tables, n: int = 4, **sizes) -> DataFrame:
    """Lifetime value and its quantile group, 1 for the largest values; four have labels."""
    values = store(customer_revenue(tables), "lifetime-value")
    tiled = global_ntile(values, "revenue", "customer_id", n, "quartile", **sizes)
    label = F.lit(None).cast("string")
    for number, name in enumerate(LABELS, start=1):
        label = F.when(F.col("quartile") == number, name).otherwise(label)
    return tiled.select(
        "customer_id",
        money(F.col("revenue")).alias("total_value"),
        "quartile",
        label.alias("quartile_label"),
    )


def category_shift(tables: Tables) -> DataFrame:
    """First and most recent category bought per customer, and whether they differ.

    Within an order the smallest category stands for the first purchase and the largest for the
    last one. Both steps are partial aggregates, so neither a large order nor a busy customer
    collects in one task.
    """
    products, _ = broadcast_if_small(tables["products"].select("product_id", "category"))
    per_order = (
        tables["order_items"]
        .select("order_id", "product_id")
        .join(products, "product_id")
        .groupBy("order_id")
        .agg(F.min("category").alias("low"), F.max("category").alias("high"))
    )
    known = tables["orders"].filter(F.col("customer_id").isNotNull())
    when_bought = ["order_date", "order_id"]
    first_last = (
        known.select("customer_id", *when_bought)
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(
            F.min_by("low", F.struct(*when_bought)).alias("first_purchased_category"),
            F.max_by("high", F.struct(*when_bought)).alias("most_recent_category"),
        )
    )
    shifted = F.col("first_purchased_category") != F.col("most_recent_category")
    return first_last.withColumn("category_shift", F.when(shifted, "Yes").otherwise("No"))


def revenue_concentration(tables: Tables, **sizes) -> DataFrame:
    """Customers' revenue with the running total from the largest down, also as a percentage."""
    revenue = store(customer_revenue(tables), "concentration")
    running, total = global_running_sum(revenue, "revenue", "customer_id", "running", **sizes)
    return running.select(
        "customer_id",
        money(F.col("revenue")).alias("revenue"),
        money(F.col("running")).alias("cumulative_revenue"),
        percent_of(F.col("running"), F.lit(total)).alias("cumulative_percent"),
    )
