"""The four relations derived from TPC-H-like Parquet tables.

Only what a query asks for is built: registration dates and regions need joins, so they are
separate switches. Columns nobody reads are pruned from the scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sources.lazy import LazyTables
from ordermill.sources.schemas import PRICE

STATUS = {"F": "DELIVERED", "O": "PLACED", "P": "RETURNED"}

# The columns in use; a declared schema spares every scan the job that would infer it.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double",
}


def _scan(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{directory}/{name}.parquet")


def customers(spark: SparkSession, directory: str, registered: bool = False) -> DataFrame:
    """Customers; with ``registered``, also a registration date near the first order."""
    source = _scan(spark, directory, "customer")
    columns = [
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(
            F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")
        ).alias("email"),
        F.col("c_mktsegment").alias("customer_type"),
    ]
    if registered:
        first = (
            _scan(spark, directory, "orders")
            .groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.min("o_orderdate").alias("first_order"))
        )
        source = source.join(first, "c_custkey", "left")
        days = F.make_dt_interval((F.col("c_custkey") % 61 - 30).cast("int"))
        columns.insert(3, (F.col("first_order") + days).alias("registration_date"))
    return source.select(*columns)


def products(spark: SparkSession, directory: str) -> DataFrame:
    return _scan(spark, directory, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").cast(PRICE).alias("cost_price"),
    )


def orders(spark: SparkSession, directory: str, regions: bool = False) -> DataFrame:
    """Orders; with ``regions``, also the region of the customer's nation."""
    source = _scan(spark, directory, "orders")
    status = F.col("o_orderstatus")
    for code, name in STATUS.items():
        status = F.when(F.col("o_orderstatus") == code, name).otherwise(status)
    columns = [
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        status.alias("status"),
    ]
    if regions:
        home = (
            _scan(spark, directory, "customer")
            .join(_scan(spark, directory, "nation"), F.expr("c_nationkey = n_nationkey"))
            .join(_scan(spark, directory, "region"), F.expr("n_regionkey = r_regionkey"))
            .select(F.col("c_custkey").alias("o_custkey"), F.col("r_name").alias("region_code"))
        )
        source = source.join(home, "o_custkey")
        columns.append(F.col("region_code"))
    return source.select(*columns)


def order_items(spark: SparkSession, directory: str) -> DataFrame:
    return _scan(spark, directory, "lineitem").select(
        F.concat_ws("_", F.lit("ITEM"), "l_orderkey", "l_linenumber", "l_partkey").alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        (F.rint(F.col("l_discount") * 10000) / 100).alias("discount_percent"),
    )


def tables(
    spark: SparkSession, directory: str, registered: bool = False, regions: bool = False
) -> LazyTables:
    return LazyTables(
        customers=lambda: customers(spark, directory, registered),
        products=lambda: products(spark, directory),
        orders=lambda: orders(spark, directory, regions),
        order_items=lambda: order_items(spark, directory),
    )
