"""Making clean tables dirty in a repeatable way, as input for cleaning and quality rules.

Which rows are touched depends on their key alone, so a task that runs again, another cluster
or a SQL engine gets the same dirty rows. The shares are 2 % emails, 5 % names, 5 % customers,
5 % dates and 3 % quantities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.dates import day_first_text, once, stamp_text
from ordermill.operators.joins import Tables
from ordermill.sources.lazy import LazyTables


SLOT = "__slot"


def _numbered(df: DataFrame, key: str) -> DataFrame:
    """Adds the number that a row's slots are taken from. Of a text key it is the first 32 bits of its
    MD5, which other engines have too, computed once per row; keys that differ in one digit fall into
    unrelated slots."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        return df.withColumn(SLOT, F.col(key))
    number = F.conv(F.substring(F.md5(F.col(key).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(SLOT, once(number))


def _slot(slots: int) -> Column:
    return F.pmod(F.col(SLOT), F.lit(slots))


def dirty_customers(customers: DataFrame) -> DataFrame:
    """Emails without ``@``, or cut off at it."""
    email = F.col("email")
    broken = F.when(_slot(100) == 0, F.replace(email, F.lit("@"), F.lit("")))
    broken = broken.when(_slot(100) == 50, F.substring_index(email, "@", 1))
    return _numbered(customers, "customer_id").withColumn("email", broken.otherwise(email)).drop(SLOT)


def dirty_products(products: DataFrame) -> DataFrame:
    """Names padded and in lower case, or in upper case."""
    name = F.col("product_name")
    padded = F.concat(F.lit("  "), F.lower(name), F.lit("  "))
    untidy = F.when(_slot(40) == 0, padded).when(_slot(40) == 20, F.upper(name)).otherwise(name)
    return _numbered(products, "product_id").withColumn("product_name", untidy).drop(SLOT)


def dirty_orders(orders: DataFrame, extra: bool = False) -> DataFrame:
    """Missing customers, and dates as text in two formats; ``extra`` adds future dates."""
    date = F.col("order_date")
    if extra:
        future = date + F.make_ym_interval(F.lit(100))
        date = F.when(_slot(211) == 9, future).otherwise(date)
    changed = {
        "customer_id": F.when(_slot(20) != 0, F.col("customer_id")),
        "order_date": F.when(_slot(20) == 7, day_first_text(date)).otherwise(stamp_text(date)),
    }
    return _numbered(orders, "order_id").withColumns(changed).drop(SLOT)


def dirty_order_items(items: DataFrame, extra: bool = False) -> DataFrame:
    """Negated quantities; ``extra`` adds discounts out of bounds, zeros and orphans.

    Each row is chosen by its own id, so the items of one product differ.
    """
    quantity, discount = F.col("quantity"), F.col("discount_percent")
    amount = F.when(_slot(33) == 1, -quantity).otherwise(quantity)
    changed = {"quantity": amount}
    if extra:
        changed["quantity"] = F.when(_slot(101) == 4, F.lit(0)).otherwise(amount)
        changed["discount_percent"] = (
            F.when(_slot(97) == 3, F.lit(150.0)).when(_slot(97) == 5, F.lit(-5.0)).otherwise(discount)
        )
        order = F.col("order_id")
        whole = isinstance(items.schema["order_id"].dataType, T.IntegralType)
        unknown = -1 - order if whole else F.concat(F.lit("?"), order)
        changed["order_id"] = F.when(_slot(89) == 6, unknown).otherwise(order)
    return _numbered(items, "item_id").withColumns(changed).drop(SLOT)


def inject_anomalies(tables: Tables, extra: bool = False) -> LazyTables:
    """All four tables, dirtied."""
    return LazyTables(
        customers=lambda: dirty_customers(tables["customers"]),
        products=lambda: dirty_products(tables["products"]),
        orders=lambda: dirty_orders(tables["orders"], extra),
        order_items=lambda: dirty_order_items(tables["order_items"], extra),
    )
