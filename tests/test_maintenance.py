import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from finflow.operators import snapshots as SN
from finflow.plans import feeds
from finflow.plans import maintenance as P
from finflow.plans.batch_run import failure_title, sla_breaches


def test_monthly_partition_pruning(spark, tmp):
    li = feeds.read(spark, SF_SMALL, "lineitem")
    path = os.path.join(tmp, "pay")
    P.write_monthly(li, path, "l_shipdate", ["l_orderkey"])
    q = spark.read.parquet(path).filter(F.col("ym") == "1998_03")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan
    assert q.count() == li.filter(F.date_format("l_shipdate", "yyyy_MM") == "1998_03").count()


def test_partitioned_copy_idempotent(spark, tmp):
    src = spark.createDataFrame([(1, dt.date(2026, 1, 5)), (2, dt.date(2020, 1, 1)), (3, None)],
                                "id int, d date")
    path = os.path.join(tmp, "t")
    asof = F.lit("2026-02-10").cast("date")
    P.partitioned_copy(src, path, "id", "d", asof)
    t = P.partitioned_copy(src, path, "id", "d", asof)
    got = sorted((r.id, r.partition_label) for r in t.collect())
    assert got == [(1, "2026_01"), (2, "default")]


def test_record_run_replaces_same_run(spark, tmp):
    path = os.path.join(tmp, "metrics")
    ts = dt.datetime(2026, 2, 1, 10, 0, 0)
    base = {"pipeline_name": "p", "dag_id": "d", "files_processed": 1, "rows_loaded": 10,
            "processing_time_seconds": 1.5, "status": "FAILED", "run_timestamp": ts}
    P.record_run(spark, base, path)
    P.record_run(spark, {**base, "status": "SUCCESS", "rows_loaded": 11}, path)
    P.record_run(spark, {**base, "run_timestamp": ts + dt.timedelta(hours=1)}, path)
    rows = spark.read.parquet(path).orderBy("run_timestamp").collect()
    assert [(r.status, r.rows_loaded) for r in rows] == [("SUCCESS", 11), ("FAILED", 10)]


def test_capture_sizes_export_restore(spark, tmp):
    tables = {n: f"{SF_SMALL}/{n}.parquet" for n in ["region", "nation", "orders"]}
    cap = {r.table_name: r for r in SN.capture_table_sizes(spark, tables).collect()}
    assert cap["orders"].estimated_rows == 1500 and cap["orders"].total_size_bytes > 0
    dfs = {n: spark.read.parquet(p) for n, p in tables.items()}
    out = P.export_snapshot(spark, dfs, os.path.join(tmp, "bk"), stamp="20260101_000000")
    restored = {n: spark.read.parquet(os.path.join(out, n)) for n in tables}
    assert P.restore_check(spark, dfs, restored).count() == 0
    restored["orders"] = restored["orders"].limit(10)
    assert [r.table_name for r in P.restore_check(spark, dfs, restored).collect()] == ["orders"]


def test_statistics_and_compaction(spark, tmp):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    spark.sql("DROP TABLE IF EXISTS finflow_stats_t")
    df.write.mode("overwrite").option("path", os.path.join(tmp, "tbl")).saveAsTable("finflow_stats_t")
    P.refresh_statistics(spark, "finflow_stats_t", ["id", "v"])
    desc = spark.sql("DESCRIBE TABLE EXTENDED finflow_stats_t").collect()
    assert any("Statistics" in (r.col_name or "") and "100 rows" in (r.data_type or "") for r in desc)
    c = P.compact(spark, os.path.join(tmp, "tbl"), os.path.join(tmp, "tbl_v2"), files=1)
    assert c.count() == 100 and len(c.inputFiles()) == 1
    spark.sql("DROP TABLE IF EXISTS finflow_stats_t")


def test_failure_title_and_sla(spark):
    df = spark.createDataFrame([("Data quality validation failed: x", 700.0), ("boom", 10.0)],
                               "msg string, processing_time_seconds double")
    titles = [r.t for r in df.select(failure_title("msg").alias("t")).collect()]
    assert titles == ["Data quality failure", "Pipeline failure"]
    assert sla_breaches(df).count() == 1
