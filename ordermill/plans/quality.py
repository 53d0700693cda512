"""Data-quality rules: each returns the offending rows; the summary counts them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.dates import end_of
from ordermill.operators.joins import Tables
from ordermill.plans.cleaning import orphan_items


def _bad_discount() -> Column:
    return (F.col("discount_percent") < 0) | (F.col("discount_percent") > 100)


def _zero_quantity() -> Column:
    return F.col("quantity") == 0


def _in_future(as_of: str | dt.date) -> Column:
    return F.col("order_date") > end_of(as_of)


def orphans(tables: Tables) -> DataFrame:
    """Items that name an order the order table does not have."""
    return orphan_items(tables["order_items"], tables["orders"])


def bad_discounts(tables: Tables) -> DataFrame:
    """Items with a discount below 0 or above 100; a missing discount is not flagged."""
    return tables["order_items"].filter(_bad_discount())


def zero_quantities(tables: Tables) -> DataFrame:
    return tables["order_items"].filter(_zero_quantity())


def future_orders(tables: Tables, as_of: str | dt.date) -> DataFrame:
    """Orders dated after the moment ``as_of``, or after that day if it names one; a missing date is
    not flagged."""
    return tables["orders"].filter(_in_future(as_of))


def quality_summary(tables: Tables, as_of: str | dt.date) -> DataFrame:
    """Violations and rows checked per rule, from one scan of each table and one join.

    Both tables are summed per order id first; what has no match in the outer join, like what
    has no order id, still counts.
    """
    items = tables["order_items"].groupBy("order_id").agg(
        F.count("*").alias("items"),
        F.count_if(_bad_discount()).alias("discounts"),
        F.count_if(_zero_quantity()).alias("zeros"),
    )
    orders = tables["orders"].groupBy("order_id").agg(
        F.count("*").alias("orders"), F.count_if(_in_future(as_of)).alias("future")
    )
    orphans = F.when(F.col("orders").isNull(), F.col("items"))
    counts = {
        "orphans": orphans, "discounts": "discounts", "zeros": "zeros",
        "future": "future", "items": "items", "orders": "orders",
    }
    totals = items.join(orders, "order_id", "full").agg(
        *(F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in counts.items())
    )
    rules = [
        ("orphan_items", "orphans", "items"),
        ("bad_discount", "discounts", "items"),
        ("zero_quantity", "zeros", "items"),
        ("future_orders", "future", "orders"),
    ]
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.col(violations).alias("violations"),
            F.col(checked).alias("rows_checked"),
        )
        for rule, violations, checked in rules
    ]
    return totals.select(F.inline(F.array(*rows)))
