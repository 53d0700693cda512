"""Storing an intermediate result so that several passes read it instead of recomputing it."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlsplit

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

# Paths given out and not removed yet. Lazy results may still read them.
_PATHS: list[str] = []
# Whether a machine-local folder of a cluster turned out to be shared, by application and folder.
_TRIALS: dict[tuple[str, str], bool] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A folder set on the context will do as well. Only a local session with neither gets a
    temporary folder of its own; on a cluster a machine-local folder would lose the data with its
    executor. There the warehouse, where tables are shared already, takes the place of a folder that is
    missing or machine-local, and a machine-local one counts only if a trial shows that driver and executors see
    each other's files in it, as they do on one machine or a mounted disk; with neither it is an error.
    All processes of a ``local-cluster`` share one disk.
    """
    context = spark.sparkContext
    setting = spark.conf.get("spark.checkpoint.dir", None)
    folder = qualified(spark, setting) if setting else context.getCheckpointDir()
    local = re.match(r"local(\[|$)", context.master)
    if folder and (local or context.master.startswith("local-cluster") or not _is_local(spark, folder) or _shown_shared(spark, folder)):
        return folder
    if not local:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if warehouse and (not _is_local(spark, warehouse) or _shown_shared(spark, qualified(spark, warehouse))):
            return qualified(spark, warehouse)
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="ordermill-"))
    return context.getCheckpointDir()


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark understands it: one without a scheme lies in the default file system, which only
    where that is the local one goes without saying."""
    if urlsplit(path).scheme:
        return path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if urlsplit(conf.get("fs.defaultFS")).scheme in ("", "file"):
        return path
    if path.startswith("/"):
        return conf.get("fs.defaultFS").rstrip("/") + path
    given = spark._jvm.org.apache.hadoop.fs.Path(path)
    return given.getFileSystem(conf).makeQualified(given).toString()


def _is_local(spark: SparkSession, folder: str) -> bool:
    """Whether a folder lies on the disk of whichever machine looks. A mounted shared disk has to be
    named as such: ``spark.ordermill.sharedFiles=true`` vouches for ``file:`` paths."""
    vouched = spark.conf.get("spark.ordermill.sharedFiles", "false") == "true"
    return urlsplit(qualified(spark, folder)).scheme in ("", "file") and not vouched


def _shown_shared(spark: SparkSession, folder: str) -> bool:
    """Whether rows that the executors write into a folder are all there for the driver to list and the
    executors to read. Tried once for a folder and application."""
    context = spark.sparkContext
    if getattr(context, "_jsc", None) is None:  # not running
        return False
    trial = context.applicationId, folder
    if trial not in _TRIALS:
        path, rows = f"{folder.rstrip('/')}/ordermill-trial-{uuid.uuid4().hex}", 4 * context.defaultParallelism
        try:
            spark.range(0, rows, 1, rows).write.parquet(path)
            _TRIALS[trial] = spark.read.schema("id bigint").parquet(path).count() == rows
        except (PySparkException, Py4JJavaError):
            _TRIALS[trial] = False
        finally:
            delete(spark, path)
    return _TRIALS[trial]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses, removed by ``release``."""
    path = f"{shared_folder(spark).rstrip('/')}/ordermill-{label}-{uuid.uuid4().hex}"
    _PATHS.append(path)
    return path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage in one job. The files are outside the executors, so a lost one costs a
    re-read and not a rerun of what led here.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_paths() -> tuple[str, ...]:
    """The paths given out and not removed yet, in their order."""
    return tuple(_PATHS)


def release(spark: SparkSession, first: int = 0) -> None:
    """Remove the intermediate data given out since place ``first``, all by default.

    Call it when the results that need them have been collected or written.
    """
    for path in _PATHS[first:]:
        delete(spark, path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is stored within the block is removed at its end; finish the results in it."""
    first = len(_PATHS)
    try:
        yield
    finally:
        release(spark, first)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate data, wherever it lies."""
    if path in _PATHS:
        _PATHS.remove(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
