"""Period reports as SQL table functions over loaded tables.

After ``register``, SQL users call the reports with bind parameters::

    spark.sql("SELECT * FROM period_metrics(:first, :last)", args={"first": first, "last": last})

The functions are temporary and see the tables or views ``orders``, ``order_items`` and ``products`` under the
prefix that ``load_tables`` was given. Lines are the exact amounts of ``functions.money``; items are summed
per order, and per product, before anything is joined.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ordermill.functions.money import AMOUNTS, amounts_sql

_TOTAL = (
    "CAST(CAST(sum(units) AS DECIMAL(20,0)) + CAST(sum(millionths) AS DECIMAL(20,0)) * 0.000001"
    " + CAST(sum(rest) AS DECIMAL(20,0)) * 0.000000000001 AS DECIMAL(38,12))"
)
_SUMS = ", ".join(f"sum({a}) AS {a}" for a in AMOUNTS)


def _dated(prefix: str) -> str:
    """Orders of a period; an order that is listed several times counts as one, its revenue as often."""
    return (
        f"SELECT order_id, customer_id FROM {prefix}orders WHERE order_date >= CAST(first_day AS TIMESTAMP_NTZ)"
        " AND order_date < CAST(date_add(last_day, 1) AS TIMESTAMP_NTZ)"
    )


def _functions(prefix: str, k: int) -> dict[str, tuple[str, str, str]]:
    """Per function its parameters, its columns and its query."""
    days = "first_day DATE, last_day DATE"
    per_order = f"SELECT order_id, {_SUMS} FROM ({amounts_sql(f'{prefix}order_items', 'order_id')}) GROUP BY order_id"
    per_product = (
        f"SELECT product_id, {_TOTAL} AS revenue FROM ({amounts_sql(f'{prefix}order_items', 'order_id', 'product_id')})"
        f" JOIN ({_dated(prefix)}) USING (order_id) GROUP BY product_id"
    )
    return {
        "period_metrics": (
            days,
            "total_orders BIGINT, unique_customers BIGINT, total_revenue DOUBLE",
            "SELECT count(DISTINCT order_id), count(DISTINCT customer_id),"
            f" coalesce(CAST(round({_TOTAL}, 2) AS DOUBLE), 0.0D)"
            f" FROM ({_dated(prefix)}) JOIN ({per_order}) USING (order_id)",
        ),
        "top_products": (
            days,
            "product_id STRING, product_name STRING, product_revenue DOUBLE",
            "SELECT CAST(product_id AS STRING), product_name, CAST(round(sum(revenue), 2) AS DOUBLE) AS r"
            f" FROM ({per_product}) JOIN {prefix}products USING (product_id) GROUP BY product_id, product_name"
            f" ORDER BY r DESC, product_id LIMIT {k}",
        ),
    }


def register(spark: SparkSession, prefix: str = "", k: int = 3) -> list[str]:
    """Make the reports callable from SQL under ``prefix`` and their names, which are returned. The tables must
    have been loaded under the same prefix, a database included (``shop.``); the functions themselves
    are temporary, so their names take only what follows the database. ``k`` is the number of top
    products, which a query cannot bind, as a limit has to be known when it is planned."""
    own = prefix.rpartition(".")[2]
    names = []
    for name, (parameters, columns, query) in _functions(prefix, int(k)).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {own}{name}({parameters}) RETURNS TABLE ({columns}) RETURN {query}")
        names.append(own + name)
    return names
