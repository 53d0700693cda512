"""Where stored intermediates go."""

import types
from pathlib import Path
from urllib.parse import urlsplit

import pytest

from ordermill.operators import storage
from ordermill.operators.storage import release, scratch_path, shared_folder, store, temporary


class FakeContext:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, setting=None, folder=None, **more):
    settings = {"spark.checkpoint.dir": setting} | {k.replace("_", "."): v for k, v in more.items()}
    conf = types.SimpleNamespace(get=lambda key, default: settings.get(key) or default)
    return types.SimpleNamespace(conf=conf, sparkContext=FakeContext(master, folder))


def test_the_setting_comes_first():
    assert shared_folder(session("spark://host", "hdfs:///a", "hdfs:///b")) == "hdfs:///a"
    assert shared_folder(session("spark://host", None, "hdfs:///b")) == "hdfs:///b"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host"))


def test_a_machine_local_folder_on_a_cluster_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("spark://host", "file:///tmp/x"))
    vouched = session("spark://host", "file:///mnt/x", spark_ordermill_sharedFiles="true")
    assert shared_folder(vouched) == "file:///mnt/x"
    assert shared_folder(session("local-cluster[3,2,1000]", "file:///tmp/x")) == "file:///tmp/x"


def test_stored_data_goes_when_released(spark):
    folder = Path(urlsplit(spark.conf.get("spark.checkpoint.dir")).path)
    release(spark)
    with temporary(spark):
        kept = store(spark.range(3), "block").count()
        assert list(folder.glob("ordermill-block-*"))
    assert kept == 3 and not list(folder.glob("ordermill-*"))
    stored = store(spark.range(4), "four")
    assert stored.count() == 4
    release(spark)
    assert not list(folder.glob("ordermill-*"))


def test_a_local_session_makes_one_folder_for_itself():
    local = session("local[2]")
    assert shared_folder(local) == shared_folder(local)
    assert scratch_path(local, "x") != scratch_path(local, "x")


def test_stored_rows_are_read_from_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    stored = store(spark.range(5), "five")
    assert all(named in file for file in stored.inputFiles())
    assert stored.count() == 5


def test_paths_without_a_scheme_lie_in_the_default_file_system(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    assert storage.qualified(spark, "/tmp/x") == "/tmp/x"
    conf.set("fs.defaultFS", "hdfs://store:8020/")
    try:
        assert storage.qualified(spark, "/tmp/x") == "hdfs://store:8020/tmp/x"
        assert storage.qualified(spark, "file:///tmp/x") == "file:///tmp/x"
        assert not storage._is_local(spark, "/tmp/x") and storage._is_local(spark, "file:/tmp/x")
    finally:
        conf.set("fs.defaultFS", before)


def test_a_folder_that_executors_turn_out_to_share_will_do_on_a_cluster(spark, tmp_path, monkeypatch):
    """As where master and workers stand on one machine, or the folder on a disk that all have mounted."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    named = storage.qualified(spark, spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(spark) == named
    assert store(spark.range(6), "six").count() == 6
    assert not list(Path(urlsplit(named).path).glob("ordermill-trial-*"))
    release(spark)


def test_a_folder_that_cannot_be_shared_is_an_error_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(storage, "qualified", lambda spark, path: "file:///proc/ordermill")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(spark)


def test_where_the_checkpoint_folder_is_not_shared_a_cluster_takes_its_warehouse(spark, monkeypatch):
    """Tables are shared there already. The trial decides about a machine-local one."""
    warehouse = Path(urlsplit(spark.conf.get("spark.sql.warehouse.dir")).path)
    named = storage.qualified(spark, spark.conf.get("spark.checkpoint.dir"))
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(storage, "_TRIALS", {(spark.sparkContext.applicationId, named): False})
    stored = store(spark.range(7), "seven")
    assert stored.count() == 7 and list(warehouse.glob("ordermill-seven-*"))
    assert not list(warehouse.glob("ordermill-trial-*"))
    release(spark)
    assert not list(warehouse.glob("ordermill-seven-*"))
