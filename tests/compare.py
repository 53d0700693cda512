"""Spark result against DuckDB result: same columns, same multiset of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _value(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, _value(r[i])) for i in order) for r in rows)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    result = con.execute(sql)
    oracle_columns = [d[0] for d in result.description]
    oracle = rows_of(oracle_columns, result.fetchall())
    ours = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(oracle_columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(oracle_columns)}"
    if ours != oracle:
        extra, missing = list((ours - oracle).items())[:3], list((oracle - ours).items())[:3]
        counts = f"{ours.total()} rows against {oracle.total()}"
        return f"{counts}; only ours {extra}; only SQL {missing}"
    return None
