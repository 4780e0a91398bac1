import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from finflow.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[*]").appName("finflow-tests")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


SF_SMALL = "/root/testdata/sf0.001"
