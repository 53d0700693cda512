"""Orders and items laid out by the month of the order, so that a report opens only the months of its period.

The column ``month`` is the order's year and month as a number, 202403 for March 2024. Items stand in the
month of their order. Those of an order that is listed with dates of different months stand under
``SEVERAL``, which every report reads; orders without a date and items without an order have no month.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.sources.lazy import LazyTables

MONTH, SEVERAL = "month", 0
TABLES = ("orders", "order_items")


def month_number(stamp: Column) -> Column:
    return F.year(stamp) * 100 + F.month(stamp)


def write_monthly(tables: Mapping[str, DataFrame], directory: str, mode: str = "overwrite") -> None:
    """Write orders and items as Parquet under ``directory``, a folder per month; what is too much for one
    task goes to several files."""
    orders = tables["orders"].withColumn(MONTH, month_number(F.col("order_date")))
    listed = orders.where(f"{MONTH} IS NOT NULL").groupBy("order_id").agg(F.min(MONTH).alias("first"), F.max(MONTH).alias("last"))
    month = F.when(F.col("first") == F.col("last"), F.col("first")).otherwise(SEVERAL).alias(MONTH)
    items = tables["order_items"].join(listed.select("order_id", month), "order_id", "left")
    laid = {"orders": orders, "order_items": items.select(*tables["order_items"].columns, MONTH)}
    for name, df in laid.items():
        df.hint("rebalance", MONTH).write.mode(mode).partitionBy(MONTH).parquet(f"{directory}/{name}.parquet")


def read_monthly(spark: SparkSession, directory: str, schemas: Mapping[str, T.StructType]) -> LazyTables:
    """What ``write_monthly`` wrote, with the given schemas and the column ``month``."""

    def read(name: str) -> DataFrame:
        fields = [*schemas[name].fields, T.StructField(MONTH, T.IntegerType())]
        return spark.read.schema(T.StructType(fields)).parquet(f"{directory}/{name}.parquet")

    return LazyTables(**{name: (lambda name=name: read(name)) for name in TABLES})


def of_period(tables: Mapping[str, DataFrame], start: dt.date, end: dt.date) -> Mapping[str, DataFrame]:
    """The tables of which, where they are laid out by month, only the months of a period are read. What
    orders there are of other days of these months stays for the caller to filter."""
    first, last = (day.year * 100 + day.month for day in (start, end))

    def orders() -> DataFrame:
        found = tables["orders"]
        return found.filter(F.col(MONTH).between(first, last)) if MONTH in found.columns else found

    def items() -> DataFrame:
        found, own = tables["order_items"], F.col(MONTH).between(first, last)
        return found.filter(own | (F.col(MONTH) == SEVERAL)) if MONTH in found.columns else found

    others = {n: (lambda n=n: tables[n]) for n in tables if n not in TABLES}
    return LazyTables(**others, orders=orders, order_items=items)
