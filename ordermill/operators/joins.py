"""Joins with the aggregation moved in front of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.money import AMOUNTS, total_revenue, whole_sum, with_amounts

Tables = Mapping[str, DataFrame]

# Of values with their rows' overhead; the hash table that each executor builds takes about as much.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 24


def order_revenue(items: DataFrame) -> DataFrame:
    """Revenue per order, as its amounts.

    Summed before any join: the partial sums leave one row per order and map task, so an order
    that owns a large share of all items is no hot key, and the join to ``orders`` on the same
    key needs no further shuffle of this side.
    """
    amounts = with_amounts(items, "order_id")
    return amounts.groupBy("order_id").agg(*[whole_sum(a).alias(a) for a in AMOUNTS])


def broadcast_if_small(df: DataFrame) -> tuple[DataFrame, bool]:
    """``df``, marked for broadcast if it is measured to be small, and whether it is.

    Texts count with their length, other values with eight bytes, and each row with a fixed cost.
    Spark's own check goes by the size of the files, which says little after a filter and nothing
    about single rows.
    """
    size = F.lit(ROW_BYTES)
    for field in df.schema:
        is_text = isinstance(field.dataType, T.StringType)
        size += F.coalesce(F.octet_length(field.name), F.lit(0)) if is_text else F.lit(8)
    measured = df.agg(F.sum(size)).first()[0] or 0
    small = measured <= BROADCAST_BYTES
    return (F.broadcast(df) if small else df), small


def items_of(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The items of the given orders, of which there may be few: the others go no further than
    their scan, by a broadcast of the order ids if those are measured to be small.

    Beyond that, Spark builds a Bloom filter of the ids and applies it to the scanned items before
    they are shuffled (``spark.sql.optimizer.runtime.bloomFilter.*`` in ``session.SETTINGS``).
    """
    ids, _ = broadcast_if_small(orders.select("order_id"))
    return items.join(ids, "order_id", "left_semi").select(*items.columns)


def valued_orders(tables: Tables, orders: DataFrame, selective: bool = False) -> DataFrame:
    """The rows of ``orders`` that have items, each with its order's amounts.

    ``selective`` says that ``orders`` may be a small part of all (see ``items_of``).
    """
    items = tables["order_items"]
    if selective:
        items = items_of(items, orders)
    return orders.join(order_revenue(items), "order_id")


def customer_revenue(tables: Tables) -> DataFrame:
    """Lifetime revenue per known customer id."""
    known = tables["orders"].filter(F.col("customer_id").isNotNull())
    return (
        valued_orders(tables, known.select("order_id", "customer_id"))
        .groupBy("customer_id")
        .agg(total_revenue().alias("revenue"))
    )


def with_products(
    facts: DataFrame, products: DataFrame, keys: list[str], measures: list[str]
) -> DataFrame:
    """``facts`` with the product attributes ``keys``, ready for sums of ``measures`` by them.

    A product table that is measured to be small is broadcast to the facts: then nothing but the
    small result is shuffled. A larger one would make the join shuffle every fact row by
    product, a hot product included, so the facts are first summed per product.
    """
    products = products.select("product_id", *[k for k in keys if k != "product_id"])
    facts = facts.select("product_id", *measures)
    products, small = broadcast_if_small(products)
    if not small:
        facts = facts.groupBy("product_id").agg(*[whole_sum(m).alias(m) for m in measures])
    return facts.join(products, "product_id").select(*keys, *measures)
