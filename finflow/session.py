"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that hold from a laptop to a 1000-executor cluster: AQE re-plans joins and
# coalesces shuffle partitions at run time, skew-join splits hot partitions, and the
# session zone is pinned so date arithmetic is reproducible.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "finflow", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given, so a cluster submit keeps its own master.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Spark applies that setting to the context itself at start-up, and it cannot be changed
    on a running session, so it is only read here. Without it, a checkpoint folder already
    given to the context is used; only when neither exists and the master is local (unit
    tests, a laptop) a private folder is created and given to the context. A cluster
    without a shared folder is an error: executors would not see the driver's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="finflow-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir for written intermediates."""
    root = ensure_checkpoint_dir(spark)
    app = getattr(spark.sparkContext, "applicationId", None) or "app"
    return os.path.join(root, "finflow", app, f"{name}-{uuid.uuid4().hex[:12]}")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path on any storage that Spark reads."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_or_none(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None where no such path is or its folder holds no file. Any
    other failure is raised: a damaged table must not pass for an empty one."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p) or not any(x.getPath().getName()[0] not in "._" for x in fs.listStatus(p)):
        return None
    return spark.read.format(fmt).load(path)


def clean_scratch(spark: SparkSession) -> None:
    """Remove this application's written intermediates (results must have been consumed)."""
    fs, p = hadoop_path(spark, os.path.dirname(scratch_path(spark, "x")))
    fs.delete(p, True)
