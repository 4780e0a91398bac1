import os

import pytest

from finflow.session import ensure_checkpoint_dir, read_or_none, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):   # Spark refuses this for spark.checkpoint.dir at run time
        raise AssertionError(f"conf.set({key!r}) on a running session")


class _Context:
    def __init__(self, current=None, master="local[2]"):
        self.current = current
        self.master = master

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


class _Session:
    def __init__(self, conf, current=None, master="local[2]"):
        self.conf = _Conf(conf)
        self.sparkContext = _Context(current, master)


def test_checkpoint_dir_from_session_is_used(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    if shared:
        assert got == shared                                   # the cluster's folder, as is
    assert ensure_checkpoint_dir(spark) == got                 # stable across calls
    assert scratch_path(spark, "x").startswith(os.path.join(got, "finflow", spark.sparkContext.applicationId, "x-"))


def test_checkpoint_dir_setting_is_never_written():
    s = _Session({"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    s = _Session({}, current="hdfs://shared/ctx/1234")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ctx/1234"
    s = _Session({})                                           # unset everywhere: a private folder
    got = ensure_checkpoint_dir(s)
    assert os.path.isdir(got) and s.sparkContext.current == got
    assert ensure_checkpoint_dir(s) == got


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session({}, master="spark://host:7077"))


def test_only_a_missing_path_is_an_empty_table(spark, tmp):
    assert read_or_none(spark, os.path.join(tmp, "none")) is None
    bad = os.path.join(tmp, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "part-0.parquet"), "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception):
        read_or_none(spark, bad)


def test_scratch_can_be_cleaned(spark):
    path = scratch_path(spark, "cleaned")
    assert os.path.dirname(path).endswith(spark.sparkContext.applicationId)
