"""Column rules and batch helpers that several operators share."""

from __future__ import annotations

import ctypes
import gc
import re
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.operators.joins import BROADCAST_BYTES
from ordermill.operators.storage import delete, scratch_path

SLICE_BYTES, BATCH_BYTES = 4 << 20, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of documents, the columns that operators read.

    Texts go to Python in Arrow batches, of which a task holds several copies for a moment. The
    session's limit on their bytes is lowered to ``BATCH_BYTES`` if it is higher.
    """
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(re.sub("[^0-9]", "", conf.get(key)) or 0) <= BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "CAST(text AS STRING) AS text")


def tidy(run: Callable) -> Callable:
    """A function over Arrow batches that gives freed memory back when its task ends.

    Python workers serve one task after another; what allocators keep for later use would add up with
    what the next operator needs.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only of the GNU library
            if trim:
                trim(0)

    return wrapped


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; rows of fold 0 are held out of every training."""
    return (F.crc32(doc_id.cast("string")) % 5).cast("int")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts hold about ``limit`` bytes at most, but one text at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    start = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += int(size)
    if start < batch.num_rows:
        yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; null is the empty text."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def sized(df: DataFrame) -> DataFrame:
    """Broadcast a narrow table of a checked size; a larger one is left to be shuffled."""
    return F.broadcast(df) if df.count() * 64 <= BROADCAST_BYTES else df


def repeated_ids(rows: DataFrame) -> bool:
    """Whether some doc_id stands in several rows."""
    count, distinct = rows.agg(F.count("doc_id"), F.count_distinct("doc_id")).head()
    return count > distinct


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, what a step has shuffled is removed when its result is stored, not when the driver happens
    to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if kept is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, kept)


class Stored:
    """Intermediate tables of one operator, in the shared folder; ``drop`` removes them."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def put(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def forget(self, *labels: str) -> None:
        """Remove the tables of some labels, which nothing reads any more."""
        for path in [p for p in self.paths if any(f"-{label}-" in p for label in labels)]:
            self.paths.remove(path)
            delete(self.spark, path)

    def drop(self) -> None:
        for path in self.paths:
            delete(self.spark, path)
        self.paths.clear()
