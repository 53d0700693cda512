"""Reading, writing and loading the four tables."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.functions.dates import once, stamp_text
from ordermill.operators.storage import kept_paths, release, store
from ordermill.sources import split_csv
from ordermill.sources.lazy import LazyTables
from ordermill.sources.schemas import NA_TOKENS, SCHEMAS
from ordermill.sources.versions import KEPT

# Quotes are doubled inside quoted fields; blanks at the ends of a field are data.
CSV_OPTIONS = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# More rows of one key than a task should have to read on its own.
MANY_ROWS = 1_000_000


def _typed(field: T.StructField) -> Column:
    """The column cast to its type; a text that the type does not hold exactly raises, with ANSI
    mode on or off."""
    text = F.when(~F.col(field.name).isin(NA_TOKENS), F.col(field.name))
    typed = text.try_cast(field.dataType)
    kept = typed.isNotNull()
    if isinstance(field.dataType, (T.IntegerType, T.DecimalType)):
        # Integer columns that had gaps are exported as "3.0".
        exact = text.try_cast("decimal(38,18)")
        typed = exact.try_cast(field.dataType)
        kept = F.coalesce(exact == typed, F.lit(False))
    kind = field.dataType.simpleString()
    message = F.concat(F.lit(f"{field.name} is no {kind}: "), text)
    refused = F.raise_error(message).cast(field.dataType)
    return F.when(text.isNotNull() & ~kept, refused).otherwise(typed).alias(field.name)


def read_csv_table(
    spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """Read one CSV table: missing-value texts become NULL, then each column is cast.

    Columns are matched by position under a checked header. A record with too few or too many
    fields raises, and so does a value that does not fit its type. Line breaks inside quotes
    are part of the text. Files larger than a task should read are split nevertheless, at the price of
    a scan that counts quotes (``split_csv``). ``multiline=False`` spares that scan where there are no
    such breaks, and raises where one turns up after all.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    # Pruned columns are not parsed, so that a broken record would pass where few are asked for.
    options = CSV_OPTIONS | {"mode": "FAILFAST", "columnPruning": False}
    if multiline and split_csv.largest_file(spark, path) > split_csv.split_bytes(spark):
        multiline, records = False, split_csv.read_records(spark, path, schema.fieldNames())
        if records is not None:
            options = {k: str(v) for k, v in options.items()}
            fields = once(F.from_csv("value", ", ".join(f"`{f.name}` STRING" for f in schema), options))
            return records.select(fields.alias("r")).select("r.*").select(*map(_typed, schema))
    raw = spark.read.options(**options, multiLine=multiline, enforceSchema=False)
    return raw.schema(as_text).csv(path).select(*map(_typed, schema))


def read_raw(
    spark: SparkSession,
    directory: str,
    schemas: Mapping[str, T.StructType] = SCHEMAS,
    multiline: bool = True,
) -> dict[str, DataFrame]:
    """The raw CSV tables of a directory; a missing one raises at once (PATH_NOT_FOUND)."""
    return {
        name: read_csv_table(spark, f"{directory}/{name}.csv", schema, multiline)
        for name, schema in schemas.items()
    }


def write_tables(
    tables: Mapping[str, DataFrame], directory: str, fmt: str = "csv", mode: str = "overwrite"
) -> None:
    """Write each table to ``directory/<name>.<fmt>``, with a header if it is CSV."""
    for name, df in tables.items():
        writer = df.write.mode(mode).format(fmt)
        if fmt == "csv":
            stamps = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
            texts = {c: stamp_text(F.col(c)) for c in stamps}
            writer = df.withColumns(texts).write.mode(mode).format(fmt).options(**CSV_OPTIONS)
        writer.save(f"{directory}/{name}.{fmt}")


def read_tables(
    spark: SparkSession,
    directory: str,
    fmt: str,
    schemas: Mapping[str, T.StructType],
    multiline: bool = True,
) -> LazyTables:
    """What ``write_tables`` wrote, with the given schemas."""

    def read(name: str, schema: T.StructType) -> DataFrame:
        path = f"{directory}/{name}.{fmt}"
        if fmt == "csv":
            return read_csv_table(spark, path, schema, multiline)
        return spark.read.schema(schema).format(fmt).load(path)

    return LazyTables(**{n: partial(read, n, schema) for n, schema in schemas.items()})


def _fits_buckets(df: DataFrame, key: str, buckets: int) -> bool:
    """Whether no key owns more rows than two buckets should hold.

    A bucket is read by one task. A key that owns a third of the table is better off without
    buckets, where the shuffle of a query sums it up first or AQE splits it.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    largest, total = per_key.agg(F.max("n"), F.sum("n")).first()
    return total is None or largest * buckets <= 2 * total or largest <= MANY_ROWS


def _stored(df: DataFrame) -> tuple[DataFrame, int]:
    """The table written once, every cell of it evaluated, and its number of rows."""
    seen = Observation()
    return store(df.observe(seen, F.count("*").alias("rows")), "loaded"), seen.get["rows"]


def versions_of(database: str) -> str:
    """The database that holds the content of a database's loaded tables."""
    return f"{database}_versions"


def _replace_table(spark: SparkSession, df: DataFrame, database: str, name: str, buckets: int | None) -> None:
    """Save ``df`` as the next content of a table, which stays as it is if that fails.

    The table is a view of its content, a managed table in ``versions_of(database)``. Changing the
    view is one step of the catalog, so there is no moment without a table of that name. The content
    before stays for queries that began with it.
    """
    store_in = versions_of(database)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {store_in}")
    fresh = f"{store_in}.{name}__{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    try:
        writer = df.write
        if buckets:
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id")
        writer.saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        raise
    view, known = f"{database}.{name}", spark.catalog.tableExists(f"{database}.{name}")
    if known and spark.catalog.getTable(view).tableType != "VIEW":
        # A table by an earlier release, which kept the content under the name itself.
        spark.sql(f"DROP TABLE {view}")
        known = False
    spark.sql(f"{'ALTER' if known else 'CREATE'} VIEW {view} AS SELECT * FROM {fresh}")
    for old in _contents(spark, database, name)[:-KEPT]:
        spark.sql(f"DROP TABLE IF EXISTS {store_in}.{old}")


def _contents(spark: SparkSession, database: str, name: str) -> list[str]:
    """The stored contents of a loaded table, oldest first."""
    pattern = re.compile(rf"{re.escape(name.lower())}__\d{{20}}_[0-9a-f]{{8}}")
    tables = spark.sql(f"SHOW TABLES IN {versions_of(database)}").select("tableName").collect()
    return sorted(r.tableName for r in tables if pattern.fullmatch(r.tableName.lower()))


def drop_loaded(spark: SparkSession, database: str, name: str) -> None:
    """Remove a loaded table with all of its contents."""
    spark.sql(f"DROP VIEW IF EXISTS {database}.{name}")
    for old in _contents(spark, database, name):
        spark.sql(f"DROP TABLE IF EXISTS {versions_of(database)}.{old}")


def load_tables(
    spark: SparkSession,
    directory: str,
    names: Iterable[str] = tuple(SCHEMAS),
    fmt: str = "csv",
    schemas: Mapping[str, T.StructType] = SCHEMAS,
    database: str | None = None,
    buckets: int | None = None,
    prefix: str = "",
    multiline: bool = True,
) -> DataFrame:
    """Load stored tables under ``prefix`` and their names, replacing earlier ones, and report row counts.

    With ``database`` they are saved there, else registered as temp views of a copy in the shared folder.
    With ``buckets`` as well, orders and items are bucketed by order, so that no query shuffles them
    again to join the two; where one order is too large for a bucket, the status says so. Every
    cell is read, and a CSV file is parsed once: a table that is missing or does not load is reported, an
    earlier one of its name stays, and the others go on. ``multiline`` is that of ``read_csv_table``.
    """
    report = []
    for name in names:
        path = f"{directory}/{name}.{fmt}"
        status = "loaded"
        try:
            if fmt == "csv":
                df = read_csv_table(spark, path, schemas[name], multiline)
            else:
                df = spark.read.format(fmt).load(path)
            wanted = buckets if database and buckets and "order_id" in df.columns else None
            first = len(kept_paths())
            if database is None:
                df, rows = _stored(df)
                df.createOrReplaceTempView(f"{prefix}{name}")
            elif wanted:
                # Stored once, since the sizes of the orders decide how it is saved.
                df, rows = _stored(df)
                if not _fits_buckets(df, "order_id", wanted):
                    wanted, status = None, "loaded without buckets: an order is too large for one"
                _replace_table(spark, df, database, f"{prefix}{name}", wanted)
                release(spark, first)
            else:
                seen = Observation()
                observed = df.observe(seen, F.count("*").alias("rows"))
                _replace_table(spark, observed, database, f"{prefix}{name}", None)
                rows = seen.get["rows"]
            report.append((name, rows, status))
        except AnalysisException as error:
            missing = error.getCondition() == "PATH_NOT_FOUND"
            report.append((name, None, "missing" if missing else "failed"))
        except Exception as error:  # a bad cell surfaces only when the rows are read
            report.append((name, None, f"failed: {type(error).__name__}"))
    return spark.createDataFrame(report, "table string, rows bigint, status string")
