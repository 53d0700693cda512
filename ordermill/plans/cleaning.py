"""Cleaning the raw tables and reporting what was found.

Only orders without a customer are removed. Malformed emails and orphan items are reported and
stay in the data, as long as the caller does not split them off.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ordermill.functions.dates import once, parse_mixed_timestamp
from ordermill.functions.text import is_valid_email, title_case
from ordermill.operators.joins import Tables
from ordermill.operators.storage import store
from ordermill.sources.lazy import LazyTables
from ordermill.sources.tables import read_tables, write_tables
from ordermill.sources.versions import commit, new_version


def parsed_orders(orders: DataFrame) -> DataFrame:
    """Orders whose date texts are timestamps, NULL for a text that is no date. Each text is read once,
    whatever is asked of the result."""
    return orders.withColumn("order_date", once(parse_mixed_timestamp(F.col("order_date"))))


def clean_orders(orders: DataFrame, on_bad: str = "raise") -> DataFrame:
    """Drop orders without a customer and turn the date texts into timestamps, each read once.

    A text that is no date fails the job, or with ``on_bad="quarantine"`` becomes NULL;
    ``bad_order_dates`` lists those rows.
    """
    if on_bad not in ("raise", "quarantine"):
        raise ValueError(f"on_bad must be raise or quarantine, not {on_bad!r}")
    raw = F.col("order_date")
    parsed = parse_mixed_timestamp(raw)
    if on_bad == "raise":
        refused = F.raise_error(F.concat(F.lit("not a date: "), raw)).cast("timestamp_ntz")
        parsed = F.coalesce(parsed, F.when(raw.isNotNull(), refused))
    return orders.dropna(subset=["customer_id"]).withColumn("order_date", once(parsed))


def bad_order_dates(orders: DataFrame) -> DataFrame:
    """Raw orders with a customer whose date text cannot be read."""
    raw = F.col("order_date")
    return orders.dropna(subset=["customer_id"]).filter(raw.isNotNull() & parse_mixed_timestamp(raw).isNull())


def clean_products(products: DataFrame) -> DataFrame:
    """Trim and title-case product names. A missing name stays NULL."""
    return products.withColumn("product_name", title_case(F.col("product_name")))


def invalid_emails(customers: DataFrame) -> DataFrame:
    """Customers whose email is missing or malformed."""
    return customers.filter(~is_valid_email(F.col("email"))).select("customer_id", "email")


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items whose order is not in ``orders``; an item without an order id is one too."""
    return items.join(orders.select("order_id"), "order_id", "left_anti").select(*items.columns)


def count_orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Only the number of orphan items: counted per order first, so no order is a hot key."""
    per_order = items.groupBy("order_id").agg(F.count("*").alias("n"))
    orphans = per_order.join(orders.select("order_id"), "order_id", "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def absolute_quantity(items: DataFrame) -> DataFrame:
    return items.withColumn("quantity", F.abs("quantity"))


def clean_tables(tables: Tables, on_bad: str = "raise") -> LazyTables:
    """All cleaning steps; customers pass through unchanged."""
    return LazyTables(
        customers=lambda: tables["customers"],
        products=lambda: clean_products(tables["products"]),
        orders=lambda: clean_orders(tables["orders"], on_bad),
        order_items=lambda: absolute_quantity(tables["order_items"]),
    )


def split_invalid(tables: Tables) -> tuple[LazyTables, LazyTables]:
    """The optional strict mode on cleaned tables: what passes, and what is quarantined."""
    valid = is_valid_email(F.col("email"))

    def known_items() -> DataFrame:
        items = tables["order_items"]
        known = tables["orders"].select("order_id")
        return items.join(known, "order_id", "left_semi").select(*items.columns)

    passed = LazyTables(
        customers=lambda: tables["customers"].filter(valid),
        products=lambda: tables["products"],
        orders=lambda: tables["orders"],
        order_items=known_items,
    )
    rejected = LazyTables(
        customers=lambda: tables["customers"].filter(~valid),
        order_items=lambda: orphan_items(tables["order_items"], tables["orders"]),
    )
    return passed, rejected


def validation_report(tables: Tables, sample: int = 3) -> DataFrame:
    """Findings on the raw tables: check, count, and the first ids of the malformed emails.

    Each table is scanned once. Items and orders are summed per order id before they are joined.
    """
    orders, is_missing = tables["orders"], F.col("customer_id").isNull()
    per_order = orders.groupBy("order_id").agg(
        F.count_if(is_missing).alias("dropped"), F.count_if(~is_missing).alias("kept")
    )
    items = tables["order_items"].groupBy("order_id").agg(F.count("*").alias("items"))
    orphan = F.when(F.coalesce("kept", F.lit(0)) == 0, F.col("items"))
    counts = items.join(per_order, "order_id", "full").agg(
        F.coalesce(F.sum("dropped"), F.lit(0)).alias("null_customer_orders"),
        F.coalesce(F.sum(orphan), F.lit(0)).alias("orphan_items"),
    )
    return _findings(counts, tables["customers"], sample)


def _findings(counts: DataFrame, customers: DataFrame, sample: int = 3) -> DataFrame:
    """The report: a row per column of ``counts``, and one for the emails."""
    no_ids = F.lit(None).cast("array<string>")
    rows = [
        F.struct(F.lit(name).alias("check"), F.col(name).alias("n"), no_ids.alias("sample"))
        for name in counts.columns
    ]
    # The first ids of each scanned part hold the first ids of all.
    within = Window.partitionBy("part").orderBy("customer_id")
    invalid = invalid_emails(customers).withColumn("part", F.spark_partition_id())
    invalid = invalid.withColumn("place", F.row_number().over(within))
    first = F.collect_list(F.when(F.col("place") <= sample, F.col("customer_id")))
    emails = invalid.agg(
        F.lit("invalid_emails").alias("check"),
        F.count("*").alias("n"),
        F.slice(F.sort_array(first), 1, sample).cast("array<string>").alias("sample"),
    )
    return counts.select(F.inline(F.array(*rows))).union(emails)


def run_pipeline(
    tables: Tables, directory: str, fmt: str = "parquet", on_bad: str = "raise", versioned: bool = False
) -> DataFrame:
    """Clean the raw tables, write the four results, and return the validation report.

    Each raw table is read once, and each date text too. What is dropped or rejected is counted as the
    orders are written; the other findings come from the written tables, where the columns concerned
    are unchanged. With ``on_bad="quarantine"``, orders whose date cannot be read are kept with a NULL
    date, and written as they came, with the text of the date, to ``rejected_orders``; the report counts
    them. With ``versioned`` the tables become the next version of the directory (``sources.versions``)
    once all are written, so that readers see all of them or none.
    """
    orders = tables["orders"]
    spark, seen = orders.sparkSession, Observation("orders")
    no_customer = F.count_if(F.col("customer_id").isNull()).alias("null_customer_orders")
    target, rejected = new_version(directory) if versioned else directory, {}
    if on_bad == "quarantine":
        # The texts of unreadable dates lie beside the timestamps, so both results come from one reading.
        bad = F.col("order_date").isNotNull() & F.col("__moment").isNull() & F.col("customer_id").isNotNull()
        parsed = orders.withColumn("__moment", once(parse_mixed_timestamp(F.col("order_date"))))
        parsed = parsed.withColumn("__text", F.when(bad, F.col("order_date")))
        parsed = parsed.observe(seen, no_customer, F.count("__text").alias("bad_order_dates"))
        parsed = store(parsed.dropna(subset=["customer_id"]), "orders")
        cleaned_orders = parsed.withColumn("order_date", F.col("__moment")).select(orders.columns)
        rejects = parsed.where("__text IS NOT NULL").withColumn("order_date", F.col("__text"))
        rejected = {"rejected_orders": rejects.select(orders.columns)}
    else:
        cleaned_orders = clean_orders(orders.observe(seen, no_customer), on_bad)
    cleaned = {**clean_tables(tables, on_bad), "orders": cleaned_orders}
    write_tables(cleaned | rejected, target, fmt)
    written = read_tables(spark, target, fmt, {n: df.schema for n, df in cleaned.items()})
    orphans = count_orphan_items(written["order_items"], written["orders"])
    observed_counts = (F.lit(n).cast("bigint").alias(name) for name, n in seen.get.items())
    counts = orphans.select(F.col("n").alias("orphan_items"), *observed_counts)
    if versioned:
        commit(spark, directory, target, [*cleaned, *rejected], fmt)
    return _findings(counts, written["customers"])
