"""Sets of tables that change as a whole.

A version is a folder of its own under ``versions``, written table by table. It becomes the current one by a
single rename of a small file, its commit, to the next number under ``commits``: a writer that is
killed before has changed nothing, and a reader takes the highest commit there is. A commit lists the
version's folder and its tables, so a folder without a commit, or a file that no commit's folder
holds, is never read. The versions before the last stay for readers that began with them.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

KEPT = 2


class _Folder:
    """The files of a directory, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, directory: str):
        self._fs, self._conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self.root = directory.rstrip("/")

    def path(self, name: str):
        return self._fs.Path(f"{self.root}/{name}")

    def system(self):
        return self.path("").getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        system, path = self.system(), self.path(folder)
        return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.system().open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """A file with that text, there as a whole or not at all; False if the name is taken."""
        draft = self.path(f"{name}.{uuid.uuid4().hex}.draft")
        stream = self.system().create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._fs.FileContext.getFileContext(draft.toUri(), self._conf)
        options = self._gateway.new_array(getattr(self._fs, "Options$Rename"), 0)
        try:
            context.rename(draft, self.path(name), options)
            return True
        except Py4JJavaError as error:
            self.system().delete(draft, False)
            if error.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
                raise
            return False

    def delete(self, name: str) -> None:
        self.system().delete(self.path(name), True)


def _commits(folder: _Folder) -> list[int]:
    return sorted(int(n) for n in folder.names("commits") if n.isdigit())


def new_version(directory: str) -> str:
    """A folder for the tables of the next version; ``commit`` makes it the current one."""
    return f"{directory.rstrip('/')}/versions/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def commit(spark: SparkSession, directory: str, version: str, tables: Iterable[str], fmt: str, kept: int = KEPT) -> int:
    """Make a written version the current one and return its number. Where another writer was faster,
    this version comes after its. All but the last ``kept`` versions are removed."""
    folder = _Folder(spark, directory)
    text = json.dumps({"version": version.rsplit("/", 1)[-1], "tables": sorted(tables), "format": fmt})
    number = (_commits(folder) or [0])[-1] + 1
    while not folder.create(f"commits/{number:012d}", text):
        number += 1
    for old in _commits(folder):
        if old <= number - max(1, kept):
            name = f"commits/{old:012d}"
            folder.delete(f"versions/{json.loads(folder.read(name))['version']}")
            folder.delete(name)
    return number


def current(spark: SparkSession, directory: str) -> dict:
    """What the last commit of a directory lists, with the version's whole path as ``path``."""
    folder = _Folder(spark, directory)
    numbers = _commits(folder)
    if not numbers:
        raise FileNotFoundError(f"nothing has been published in {directory}")
    found = json.loads(folder.read(f"commits/{numbers[-1]:012d}"))
    return found | {"path": f"{folder.root}/versions/{found['version']}", "number": numbers[-1]}


def sweep(spark: SparkSession, directory: str, hours: float = 24) -> list[str]:
    """Remove versions that were begun more than ``hours`` ago and never committed; their names."""
    folder = _Folder(spark, directory)
    known = {json.loads(folder.read(f"commits/{n:012d}"))["version"] for n in _commits(folder)}
    before = time.time_ns() - int(hours * 3_600 * 1e9)
    lost = [n for n in folder.names("versions") if n not in known and int(n.split("-")[0]) < before]
    for name in lost:
        folder.delete(f"versions/{name}")
    return lost


def publish(tables: Mapping[str, DataFrame], directory: str, fmt: str = "parquet", kept: int = KEPT) -> int:
    """Write tables as the next version of a directory; readers see all of them or none."""
    from ordermill.sources.tables import write_tables

    spark, version = next(iter(tables.values())).sparkSession, new_version(directory)
    write_tables(tables, version, fmt)
    return commit(spark, directory, version, tables, fmt, kept)


def published(spark: SparkSession, directory: str, schemas: Mapping[str, T.StructType]) -> Mapping[str, DataFrame]:
    """The tables of the current version, of one and the same commit, each read when asked for."""
    from ordermill.sources.tables import read_tables

    found = current(spark, directory)
    return read_tables(spark, found["path"], found["format"], {n: schemas[n] for n in found["tables"] if n in schemas})
