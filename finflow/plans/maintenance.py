"""Physical layout and table jobs: monthly partitions, copies, statistics, exports (P1-P5,
A14, A16, A17, J2)."""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.functions import keys as K
from finflow.session import read_or_none

DEFAULT_PARTITION = "default"


def calendar_bounds(asof: Column, months_back: int = 2, n_months: int = 15) -> tuple[Column, Column]:
    lo = F.add_months(F.trunc(asof, "MM"), -months_back)
    return lo, F.add_months(lo, n_months)


def month_calendar(source: DataFrame, date_col: str, asof=None, months_back: int = 2,
                   n_months: int = 15) -> DataFrame:
    """``n_months`` monthly ranges starting ``months_back`` months before the as-of
    month (default: the latest day in ``source``)."""
    ref = (F.lit(asof).cast("date") if asof is not None
           else F.max(F.to_date(date_col)))
    bounds = source.agg(ref.alias("asof")) if asof is None else source.sparkSession.range(1).select(ref.alias("asof"))
    lo, _ = calendar_bounds(F.col("asof"), months_back, n_months)
    months = bounds.select(F.explode(F.sequence(lo, F.add_months(lo, n_months - 1),
                                                F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return months.select(K.month_label("month_start").alias("partition_label"), "month_start",
                         F.add_months("month_start", 1).alias("month_end"))


def partition_label(date_col: str, asof: Column, months_back: int = 2, n_months: int = 15) -> Column:
    """``YYYY_MM`` inside the calendar, ``default`` outside it (null dates: null)."""
    d = F.to_date(date_col)
    lo, hi = calendar_bounds(asof, months_back, n_months)
    return (F.when(d.isNull(), F.lit(None).cast("string"))
             .when((d >= lo) & (d < hi), K.month_label(d))
             .otherwise(F.lit(DEFAULT_PARTITION)))


def rows_to_copy(src: DataFrame, target: DataFrame | None, key: str, date_col: str) -> DataFrame:
    """Rows with a non-null partition column whose key is absent from the target."""
    out = src.filter(F.col(date_col).isNotNull())
    if target is not None:
        out = out.join(target.select(key), on=key, how="left_anti")
    return out


def partitioned_copy(src: DataFrame, target_path: str, key: str, date_col: str, asof: Column,
                     sort_cols: list[str] | None = None) -> DataFrame:
    """Append the missing rows into a monthly-partitioned Parquet table.

    Rows are clustered by partition label and sorted within files by the key so
    min/max statistics let readers skip row groups (the index access path).
    Returns the rows written (as read back from the new files).
    """
    spark = src.sparkSession
    target = read_or_none(spark, target_path)  # an unreadable table fails the copy
    new = rows_to_copy(src, target, key, date_col).withColumn(
        "partition_label", partition_label(date_col, asof))
    # rebalance (not repartition) by label: AQE splits a month that holds a large share of
    # the rows over several tasks instead of writing it from one
    (new.hint("rebalance", "partition_label")
        .sortWithinPartitions("partition_label", *(sort_cols or [key]))
        .write.mode("append").partitionBy("partition_label").parquet(target_path))
    return spark.read.parquet(target_path)


def write_monthly(df: DataFrame, path: str, date_col: str, sort_cols: list[str],
                  mode: str = "overwrite") -> None:
    """Month-partitioned write. With dynamic partition overwrite only the months
    present in ``df`` are replaced."""
    (df.withColumn("ym", K.month_label(F.to_date(date_col)))
       .hint("rebalance", "ym").sortWithinPartitions("ym", *sort_cols)
       .write.mode(mode).partitionBy("ym").parquet(path))


def refresh_statistics(spark: SparkSession, table: str, columns: list[str] | None = None) -> None:
    """P5: table and column statistics for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    else:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def compact(spark: SparkSession, src_path: str, dst_path: str, files: int) -> DataFrame:
    """P5: rewrite a table with many small files into ``files`` files at a new version
    path (a table cannot be overwritten while it is read)."""
    spark.read.parquet(src_path).repartition(files).write.mode("overwrite").parquet(dst_path)
    return spark.read.parquet(dst_path)


def record_run(spark: SparkSession, metrics: dict, path: str) -> None:
    """Store one run's metrics, replacing an earlier row of the same
    (dag_id, run_timestamp) — dynamic overwrite of that run's partition only."""
    row = spark.createDataFrame([metrics])
    row = row.withColumn("run_key", F.date_format("run_timestamp", "yyyyMMddHHmmssSSS"))
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dag_id", "run_key").parquet(path)


def export_snapshot(spark: SparkSession, tables: dict[str, DataFrame], root: str,
                    stamp: str | None = None, compression: str = "gzip") -> str:
    """Logical export of every table into one time-stamped, compressed directory."""
    stamp = stamp or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    out = os.path.join(root, f"backup_{stamp}")
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", compression).parquet(os.path.join(out, name))
    return out


def restore_check(spark: SparkSession, source: dict[str, DataFrame],
                  restored: dict[str, DataFrame]) -> DataFrame:
    """Per table row counts of source and restored copies, full-outer matched;
    only mismatching tables are returned."""
    def counts(tables: dict[str, DataFrame], col: str) -> DataFrame:
        parts = [df.agg(F.count(F.lit(1)).alias(col)).select(F.lit(n).alias("table_name"), col)
                 for n, df in tables.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    a, b = counts(source, "source_rows"), counts(restored, "restored_rows")
    j = a.join(b, "table_name", "full_outer")
    return j.filter(~F.col("source_rows").eqNullSafe(F.col("restored_rows")))
