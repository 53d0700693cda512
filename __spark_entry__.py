"""

All queries run over the whole tables of the given directory, through the adapter in
``ordermill.sources.testdata``. Dates are returned as text and decimals as doubles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from importlib import import_module
from importlib.util import find_spec
from uuid import uuid4

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.dates import stamp_text
from ordermill.operators.joins import Tables
from ordermill.operators.storage import scratch_path, store
from ordermill.plans import anomalies, cleaning, cohort, customers, quality, report, sales, sql_functions
from ordermill.sources import testdata
from ordermill.sources.lazy import LazyTables
from ordermill.sources.monthly import read_monthly, write_monthly
from ordermill.sources.schemas import CLEAN_SCHEMAS, SCHEMAS
from ordermill.sources.tables import drop_loaded, load_tables, read_csv_table, read_raw, write_tables
from ordermill.sources.versions import current
from oracle_queries import ORACLE_SQL

# The amounts and gaps of the test tables are far above the defaults of the library.
AS_OF = "2001-08-01"
MOMENT = "2001-07-31 12:00:00"
BANDS = {"low": 3_500_000, "high": 6_500_000}
RISK_DAYS = 200
PERIOD = ("2000-03-01", "2000-03-31")

Query = Callable[[SparkSession, str], DataFrame]


def _optional(name: str):
    """A module that may have been taken out of the library; one that is there must import."""
    package = name.rpartition(".")[0]
    there = (not package or find_spec(package)) and find_spec(name)
    return import_module(name) if there else None


LLM = _optional("ordermill.llm.entries")
PIPELINE = _optional("corpus_pipeline") if LLM else None  # its stages are that package's


def _portable(df: DataFrame) -> DataFrame:
    """Dates as text and decimals as doubles, so that engines need not agree on those types."""
    changed = {}
    for field in df.schema:
        kind = field.dataType.simpleString()
        if kind == "date":
            changed[field.name] = F.col(field.name).cast("string")
        elif kind == "timestamp_ntz":
            changed[field.name] = stamp_text(F.col(field.name))
        elif kind.startswith("decimal"):
            changed[field.name] = F.col(field.name).cast("double")
    return df.withColumns(changed)


def _clean(plan: Callable[[Tables], DataFrame], **options: bool) -> Query:
    """A query over the tables as they are."""
    return lambda spark, sf_dir: _portable(plan(testdata.tables(spark, sf_dir, **options)))


def _dirty(plan: Callable[[Tables], DataFrame], **options: bool) -> Query:
    """A query over the tables with injected anomalies."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = testdata.tables(spark, sf_dir, **options)
        return _portable(plan(anomalies.inject_anomalies(tables, extra=True)))

    return run


def _parsed(tables: Tables) -> Tables:
    """Raw tables whose order dates are read, with no order dropped."""
    return LazyTables(
        orders=lambda: cleaning.parsed_orders(tables["orders"]),
        order_items=lambda: tables["order_items"],
    )


def _report(tables: Tables) -> DataFrame:
    ids = F.concat_ws(",", "sample").alias("sample")
    return cleaning.validation_report(tables).select("check", "n", ids)


def _csv_round_trip(name: str) -> Callable[[Tables], DataFrame]:
    def run(tables: Tables) -> DataFrame:
        spark = tables[name].sparkSession
        folder = scratch_path(spark, "csv")
        write_tables({name: tables[name].select(SCHEMAS[name].fieldNames())}, folder)
        return read_raw(spark, folder, {name: SCHEMAS[name]})[name]

    return run


def _raw(tables: Tables) -> dict[str, DataFrame]:
    return {n: tables[n].select(s.fieldNames()) for n, s in SCHEMAS.items()}


def _pipeline_and_load(tables: Tables) -> DataFrame:
    """Raw CSV -> cleaning -> cleaned CSV -> loaded tables, with the rows of each."""
    spark = tables["orders"].sparkSession
    raw, cleaned = scratch_path(spark, "raw"), scratch_path(spark, "cleaned")
    write_tables(_raw(tables), raw)
    cleaning.run_pipeline(read_raw(spark, raw), cleaned, fmt="csv")
    prefix = f"pipeline_{uuid4().hex}_"
    report = load_tables(spark, cleaned, schemas=CLEAN_SCHEMAS, prefix=prefix)
    for name in SCHEMAS:
        spark.catalog.dropTempView(prefix + name)
    return report


def _written(name: str, spoil: bool = False) -> Callable[[Tables], DataFrame]:
    """A table that the pipeline wrote, or with the name ``report`` what it returned."""

    def run(tables: Tables) -> DataFrame:
        spark = tables["orders"].sparkSession
        folder, raw = scratch_path(spark, "written"), _raw(tables)
        if spoil:
            junk = F.concat(F.lit("on "), "order_date")
            bad = F.col("order_id") % 50 == 3
            raw["orders"] = raw["orders"].withColumn(
                "order_date", F.when(bad, junk).otherwise(F.col("order_date"))
            )
        report = cleaning.run_pipeline(raw, folder, on_bad="quarantine" if spoil else "raise")
        if name == "report":
            return report.select("check", "n", F.concat_ws(",", "sample").alias("sample"))
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return run


def _published(name: str) -> Callable[[Tables], DataFrame]:
    """A table of the current version, after a second run of the pipeline was killed between two tables."""

    def run(tables: Tables) -> DataFrame:
        spark = tables["orders"].sparkSession
        folder, raw = scratch_path(spark, "published"), _raw(tables)
        cleaning.run_pipeline(raw, folder, versioned=True)
        # The items of the second run do not fit, after its other tables have been written.
        killed = raw | {n: raw[n].limit(0) for n in ("customers", "products", "orders")}
        killed["order_items"] = raw["order_items"].withColumn("quantity", F.raise_error(F.lit("killed")).cast("int"))
        try:
            cleaning.run_pipeline(killed, folder, versioned=True)
        except PySparkException:
            return spark.read.parquet(f"{current(spark, folder)['path']}/{name}.parquet")
        raise RuntimeError("the second run was to fail")

    return run


def _loaded(name: str, managed: bool) -> Callable[[Tables], DataFrame]:
    """The content of a table that was written as CSV and loaded, as a view or a managed table."""

    def run(tables: Tables) -> DataFrame:
        spark = tables[name].sparkSession
        folder, prefix = scratch_path(spark, "loading"), f"load_{uuid4().hex}_"
        write_tables({name: tables[name].select(SCHEMAS[name].fieldNames())}, folder)
        if not managed:
            load_tables(spark, folder, [name], prefix=prefix)
            content = spark.table(prefix + name)
            spark.catalog.dropTempView(prefix + name)
            return content
        load_tables(spark, folder, [name], database="default", buckets=4, prefix=prefix)
        # The table goes once its content has been read.
        content = store(spark.table(f"default.{prefix}{name}"), "loaded")
        drop_loaded(spark, "default", prefix + name)
        return content

    return run


def _timed(tables: Tables) -> Tables:
    """Orders at all hours of the day instead of at midnight."""
    hour = F.make_dt_interval(hours=(F.col("order_id") % 24).cast("int"))
    return LazyTables(
        **{name: (lambda name=name: tables[name]) for name in SCHEMAS if name != "orders"},
        orders=lambda: tables["orders"].withColumn("order_date", F.col("order_date") + hour),
    )


def _late(plan: Callable[[Tables], DataFrame]) -> Query:
    """A query over dirty tables with times of day, their dates read."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = _timed(testdata.tables(spark, sf_dir))
        return _portable(plan(_parsed(anomalies.inject_anomalies(tables, extra=True))))

    return run


def _fine_prices(tables: Tables) -> DataFrame:
    """The flagship query over prices and discounts with three decimals."""
    price = F.col("unit_price") + F.pmod("product_id", F.lit(8)) * 0.125
    discount = F.col("discount_percent") + F.pmod("order_id", F.lit(4)) * 0.125
    items = tables["order_items"].withColumns(
        {"unit_price": F.round(price, 3), "discount_percent": F.round(discount, 3)}
    )
    return sales.category_revenue({"order_items": items, "products": tables["products"]})


def _shared_orders(tables: Tables) -> DataFrame:
    """The monthly report where every tenth order is listed under a second customer too."""
    orders = tables["orders"]
    second = orders.where("order_id % 10 = 0").withColumn("customer_id", F.col("customer_id") + 1)
    shared = {"orders": orders.union(second), "order_items": tables["order_items"]}
    return report.grain_report(shared, "month")


def _monthly(plan: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """A report over orders and items that are laid out by month."""

    def run(tables: Tables) -> DataFrame:
        spark = tables["orders"].sparkSession
        folder = scratch_path(spark, "monthly")
        write_monthly(tables, folder)
        laid = read_monthly(spark, folder, {n: tables[n].schema for n in ("orders", "order_items")})
        return plan({**laid, "products": tables["products"]})

    return run


def _from_sql(call: str, **arguments: object) -> Callable[[Tables], DataFrame]:
    """A report called from SQL with bind parameters, over tables under their names."""

    def run(tables: Tables) -> DataFrame:
        spark, prefix = tables["orders"].sparkSession, f"sql_{uuid4().hex}_"
        for name in ("orders", "order_items", "products"):
            tables[name].createOrReplaceTempView(prefix + name)
        sql_functions.register(spark, prefix)
        return spark.sql(f"SELECT * FROM {prefix}{call}", args=arguments)

    return run


def _missing_table(tables: Tables) -> DataFrame:
    """The load report of a folder in which one table is missing; the others are loaded."""
    spark = tables["orders"].sparkSession
    folder, prefix = scratch_path(spark, "incomplete"), f"incomplete_{uuid4().hex}_"
    write_tables({n: df for n, df in _raw(tables).items() if n != "products"}, folder)
    outcome = load_tables(spark, folder, prefix=prefix)
    try:
        read_raw(spark, folder)
    except AnalysisException as error:
        raw = spark.createDataFrame([("all raw tables", None, error.getCondition())], outcome.schema)
    return outcome.union(raw)


def _argument_dates(tables: Tables) -> DataFrame:
    """Which texts pass as the first day of a report: the first days of all months with orders, in three forms."""
    months = tables["orders"].select(F.trunc("order_date", "month").alias("day")).distinct().dropna()
    texts = [F.date_format("day", form) for form in ("yyyy-MM-dd", "dd-MM-yyyy", "yyyy-MM")]
    rows = months.select(F.explode(F.array(*texts)).alias("argument")).collect()  # bounded by the calendar

    def accepted(text: str) -> bool:
        try:
            return bool(report.period(text, "2999-12-31"))
        except ValueError:
            return False

    found = [(r.argument, accepted(r.argument)) for r in rows]
    return months.sparkSession.createDataFrame(found, "argument string, accepted boolean")


def _date_texts(tables: Tables) -> DataFrame:
    """Order dates written in eight forms and read again."""
    forms = [
        "yyyy/MM/dd", "dd MMM yyyy", "MMMM d, yyyy", "d-M-yy", "yyyyMMdd", "dd-MM-yyyy hh:mm:ss a",
        "yyyy-MM-dd HH:mm:ss'+05:30'", "yyyy-MM-dd'T'HH:mm:ss'Z'",
    ]
    text = F.lit(None).cast("string")
    for number, form in enumerate(forms):
        written = F.date_format("order_date", form)
        text = F.when(F.col("order_id") % len(forms) == number, written).otherwise(text)
    parsed = cleaning.parse_mixed_timestamp(text).alias("order_date")
    return _timed(tables)["orders"].select("order_id", parsed)


def _category_revenue_of_cleaned(tables: Tables) -> DataFrame:
    """The flagship query on cleaned tables that were written and read back."""
    spark = tables["products"].sparkSession
    folder, cleaned = scratch_path(spark, "cleaned"), cleaning.clean_tables(tables)
    used = ("products", "order_items")
    write_tables({n: cleaned[n].select(SCHEMAS[n].fieldNames()) for n in used}, folder)
    return sales.category_revenue(
        {n: read_csv_table(spark, f"{folder}/{n}.csv", CLEAN_SCHEMAS[n]) for n in used}
    )


def entry(spark: SparkSession) -> DataFrame:
    """Revenue per category on the smallest test tables."""
    return queries()["q01_category_revenue"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    found = dict(order_queries())
    if LLM:
        found |= LLM.QUERIES
    if PIPELINE:
        found["pipeline"] = PIPELINE.run
    return found


def order_queries() -> dict[str, Query]:
    return {
        "q01_category_revenue": _clean(sales.category_revenue),
        "q02_top_customers": _clean(sales.top_customers),
        "q03_monthly_orders": _clean(lambda t: sales.monthly_orders(t, AS_OF)),
        "q04_never_delivered": _clean(customers.never_delivered),
        "q05_more_returned": _clean(sales.more_returned),
        "q06_return_rate": _clean(sales.return_rate),
        "q07_region_running_revenue": _clean(sales.region_running_revenue, regions=True),
        "q08_product_rank": _clean(sales.product_rank),
        "q09_order_gaps": _clean(lambda t: customers.order_gaps(t, RISK_DAYS)),
        "q10_monthly_value_bands": _clean(lambda t: customers.monthly_value_bands(t, **BANDS)),
        "q11_ltv_quartiles": _clean(customers.ltv_quartiles),
        "q12_yoy": _clean(sales.year_over_year),
        "q13_category_shift": _clean(customers.category_shift),
        "q14_revenue_concentration": _clean(customers.revenue_concentration),
        "q15_cohort_activity": _clean(cohort.cohort_activity, registered=True),
        "q16_retention_rate": _clean(cohort.retention_rate, registered=True),
        "c01_clean_orders": _dirty(lambda t: cleaning.clean_orders(t["orders"]), regions=True),
        "c02_clean_products": _dirty(lambda t: cleaning.clean_products(t["products"])),
        "c03_invalid_emails": _dirty(lambda t: cleaning.invalid_emails(t["customers"])),
        "c04_orphan_items": _dirty(
            lambda t: cleaning.orphan_items(
                t["order_items"], cleaning.clean_orders(t["orders"])
            ).select("item_id", "order_id")
        ),
        "c05_abs_quantity": _dirty(lambda t: cleaning.absolute_quantity(t["order_items"])),
        "c06_clean_pipeline": _dirty(_pipeline_and_load, registered=True, regions=True),
        **{
            f"c06_written_{n}": _dirty(_written(n), registered=True, regions=True) for n in SCHEMAS
        },
        **{
            f"c06_published_{n}": _dirty(_published(n), registered=True, regions=True)
            for n in ("orders", "order_items")
        },
        "c06_pipeline_report": _dirty(_written("report"), registered=True, regions=True),
        "c06_rejected_orders": _dirty(
            _written("rejected_orders", spoil=True), registered=True, regions=True
        ),
        "c06_quarantine_report": _dirty(
            _written("report", spoil=True), registered=True, regions=True
        ),
        "c06_category_revenue_of_cleaned": _dirty(_category_revenue_of_cleaned),
        "c06_rejected_customers": _dirty(
            lambda t: cleaning.split_invalid(cleaning.clean_tables(t))[1]["customers"].select(
                "customer_id", "email"
            )
        ),
        "c06_kept_order_items": _dirty(
            lambda t: cleaning.split_invalid(cleaning.clean_tables(t))[0]["order_items"]
        ),
        "c07_validation_report": _dirty(_report),
        "d01_orphan_items": _dirty(lambda t: quality.orphans(t).select("item_id", "order_id")),
        "d02_bad_discount": _dirty(
            lambda t: quality.bad_discounts(t).select("item_id", "discount_percent")
        ),
        "d03_zero_quantity": _dirty(
            lambda t: quality.zero_quantities(t).select("item_id", "quantity")
        ),
        "d04_future_orders": _late(
            lambda t: quality.future_orders(t, MOMENT).select("order_id", "order_date")
        ),
        "d05_quality_summary": _late(lambda t: quality.quality_summary(t, MOMENT)),
        "f13_date_forms": _clean(_date_texts),
        "p02_three_decimals": _clean(_fine_prices),
        "r01_period_metrics": _clean(lambda t: report.period_metrics(t, *PERIOD)),
        "r01_monthly_layout": _clean(_monthly(lambda t: report.period_metrics(t, *PERIOD))),
        "r03_monthly_layout": _clean(_monthly(lambda t: report.top_products(t, *PERIOD))),
        "r04_monthly_layout": _clean(_monthly(lambda t: report.executive_summary(t, *PERIOD))),
        "r02_previous_period": _clean(lambda t: report.period_comparison(t, *PERIOD)),
        "r03_top_products": _clean(lambda t: report.top_products(t, *PERIOD)),
        "r04_executive_summary": _clean(lambda t: report.executive_summary(t, *PERIOD)),
        "r05_day_report": _clean(lambda t: report.grain_report(t, "day")),
        "r05_week_report": _clean(lambda t: report.grain_report(t, "week")),
        "r05_month_report": _clean(lambda t: report.grain_report(t, "month")),
        "r05_all_grains": _clean(report.grain_reports),
        "r05_shared_orders": _clean(_shared_orders),
        "f18_argument_dates": _clean(_argument_dates),
        "p11_period_metrics_in_sql": _clean(
            _from_sql("period_metrics(:first, :last)", first=dt.date(2000, 3, 1), last=dt.date(2000, 3, 31))
        ),
        "p11_top_products_in_sql": _clean(
            _from_sql("top_products(:first, :last)", first=dt.date(2000, 3, 1), last=dt.date(2000, 3, 31))
        ),
        "s04_missing_table": _dirty(_missing_table, registered=True, regions=True),
        "s01_csv_customers": _dirty(_csv_round_trip("customers"), registered=True),
        "s01_csv_products": _dirty(_csv_round_trip("products")),
        "s01_csv_orders": _dirty(_csv_round_trip("orders"), regions=True),
        "s01_csv_order_items": _dirty(_csv_round_trip("order_items")),
        **{
            f"s03_{'managed' if managed else 'view'}_{n}": _dirty(
                _loaded(n, managed), registered=n == "customers", regions=n == "orders"
            )
            for n in SCHEMAS
            for managed in (False, True)
        },
        "x01_dirty_customers": _dirty(lambda t: t["customers"], registered=True),
        "x01_dirty_products": _dirty(lambda t: t["products"]),
        "x01_dirty_orders": _dirty(lambda t: t["orders"], regions=True),
        "x01_dirty_order_items": _dirty(lambda t: t["order_items"]),
    }


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLE_SQL)
    if LLM:
        found |= LLM.ORACLE_SQL
    if PIPELINE and PIPELINE.ORACLE_SQL:
        found["pipeline"] = PIPELINE.ORACLE_SQL
    return found
