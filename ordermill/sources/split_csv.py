"""CSV files with line breaks inside quotes, read by many tasks each.

Spark splits a file between lines, and a line may begin inside quotes. Whether it does follows from the
number of quote characters before it, which is odd exactly there, since doubled quotes count twice. One
scan counts the quotes of every byte range; the sums of the ranges before give each range its first
state. A second scan then joins lines into records within each range. What a range cannot know
of a record, its beginning in an earlier range or its end in a later one, is put together from the
pieces, of which a range has two at most.

A range costs the driver one number, if it begins inside quotes. Files without breaks in quotes
are left to the plain reader.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What a piece of text is: a record, or one that ends, begins, or neither begins nor ends in its range.
WHOLE, HEAD, TAIL, MIDDLE = range(4)
PIECES = "file string, start bigint, kind int, value string"


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file under a path, from listings alone."""
    files = spark.read.format("binaryFile").load(path)
    return files.agg(F.coalesce(F.max("length"), F.lit(0))).first()[0]


def split_bytes(spark: SparkSession) -> int:
    """The most bytes that Spark gives a task of one file."""
    value = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return value(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    place = {"file": F.col("_metadata.file_path"), "start": F.col("_metadata.file_block_start")}
    return spark.read.option("lineSep", "\n").text(path).select("value", *(c.alias(n) for n, c in place.items()))


def ranges(lines: DataFrame) -> DataFrame:
    """Per byte range: whether its first line begins inside quotes, and whether it has breaks in quotes."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.translate(value, '"', ""))
    # A carriage return that ends no line is one more break that a plain reader would see.
    inner = F.rtrim(value, F.lit("\r")).contains("\r")
    counted = lines.groupBy("file", "start").agg(F.sum(quotes % 2).alias("odd"), F.max(inner).alias("inner"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    return counted.select("file", "start", opened.alias("opened"), ((F.col("odd") > 0) | F.col("inner")).alias("breaks"))


def _pieces(opened: dict[str, list[int]], names: list[str]) -> Callable:
    """Joins the lines of each byte range into records; see ``WHOLE`` and the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The executors may not have this module, so what is needed stays in the function.
        import csv

        import pyarrow.compute as pc

        key, inside, first, held = None, False, True, []

        def piece(kind: int, values: pa.Array) -> pa.RecordBatch:
            n = len(values)
            columns = [pa.array([key[0]] * n, pa.string()), pa.array([key[1]] * n, pa.int64()), pa.array([kind] * n, pa.int32())]
            return pa.record_batch([*columns, values], names=["file", "start", "kind", "value"])

        def rest() -> Iterator[pa.RecordBatch]:
            """What is left of a range."""
            if held:
                begun_here = not (first and key[1] in starts)
                yield piece(2 if begun_here else 3, pa.array(["\n".join(held)], pa.string()))

        def check_header(record: str) -> None:
            found = next(csv.reader([record.removeprefix("﻿")]), [])
            if [f.lower() for f in found] != [n.lower() for n in names]:
                raise ValueError(f"CSV header does not conform to the schema: {found} instead of {names}")

        starts: set[int] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column("start").to_numpy()
            file = batch.column("file").dictionary_encode().indices.to_numpy()
            cuts = np.flatnonzero((place[1:] != place[:-1]) | (file[1:] != file[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
                at = (batch.column("file")[int(lo)].as_py(), int(place[lo]))
                if at != key:
                    if key:
                        yield from rest()
                    key, first, held = at, True, []
                    starts = set(opened.get(at[0], ()))
                    inside = at[1] in starts
                values = batch.column("value").slice(int(lo), int(hi - lo))
                odd = pc.count_substring(values, '"').to_numpy(zero_copy_only=False) % 2
                state = (int(inside) + np.cumsum(odd)) % 2
                inside = bool(state[-1])
                ends = np.flatnonzero(state == 0) + 1
                if not len(ends):
                    held += values.to_pylist()
                    continue
                offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
                records = pc.binary_join(pa.ListArray.from_arrays(offsets, values.slice(0, int(ends[-1]))), "\n")
                if held:
                    joined = "\n".join([*held, records[0].as_py()])
                    records = pa.concat_arrays([pa.array([joined], pa.string()), records.slice(1)])
                held = values.slice(int(ends[-1])).to_pylist()
                if first and key[1] in starts:
                    yield piece(1, records.slice(0, 1))
                    records = records.slice(1)
                records = pc.replace_substring_regex(records, "\r\\z", "")
                if first and key[1] == 0:
                    check_header(records[0].as_py())
                    records = records.slice(1)
                first = False
                yield piece(0, records.filter(pc.not_equal(records, "")))
        if key:
            yield from rest()

    return run


def read_records(spark: SparkSession, path: str, names: list[str]) -> DataFrame | None:
    """The records of CSV files as texts, in one column ``value``, without headers and empty lines; None if
    no file has a break inside quotes. Records end with a line feed, after a carriage return or not. The
    names must be those of every file's header, in their order and with case aside."""
    lines = _lines(spark, path)
    found = ranges(lines).where("opened OR breaks").select("file", F.when(F.col("opened"), F.col("start")).alias("start"))
    rows = found.groupBy("file").agg(F.collect_list("start").alias("starts")).collect()
    if not rows:
        return None
    opened = {r.file: list(r.starts) for r in rows if r.starts}
    whole = lines.mapInArrow(_pieces(opened, names), PIECES).where(F.col("kind") == WHOLE).select("value")
    if not opened:
        return whole
    # Only these files have records in several ranges; a record begins with its one tail.
    cut = lines.where(F.col("file").isin(list(opened))).mapInArrow(_pieces(opened, names), PIECES).where(F.col("kind") != WHOLE)
    record = F.sum((F.col("kind") == TAIL).cast("int")).over(Window.partitionBy("file").orderBy("start", "kind"))
    parts = cut.withColumn("record", record).groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "value"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x["value"]), "\n")
    return whole.union(parts.select(F.regexp_replace(joined, r"\r\z", "").alias("value")))
