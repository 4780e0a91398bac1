"""Table-growth snapshots and their reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def capture_table_sizes(spark: SparkSession, tables: dict[str, str], schema: str = "warehouse",
                        fmt: str = "parquet") -> DataFrame:
    """One row per table: rows and bytes on storage, stamped with the capture time.

    Bytes are the sum of the distinct data files' sizes from the ``_metadata`` column;
    rows and files come from the same scan, which reads no data columns.
    """
    parts = []
    for name, path in tables.items():
        df = spark.read.format(fmt).load(path)
        per_file = (df.select(F.col("_metadata.file_path").alias("f"),
                              F.col("_metadata.file_size").alias("s"))
                      .groupBy("f").agg(F.count(F.lit(1)).alias("r"), F.max("s").alias("s")))
        parts.append(per_file.agg(
            F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"),
            F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("table_size_bytes"),
            F.coalesce(F.sum("s"), F.lit(0)).cast("bigint").alias("total_size_bytes"),
            F.coalesce(F.sum("r"), F.lit(0)).cast("bigint").alias("estimated_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("captured_at", F.current_timestamp())


def with_previous(history: DataFrame, keys: list[str] = ("table_schema", "table_name"),
                  ts: str = "captured_at", value: str = "total_size_bytes") -> DataFrame:
    """Each snapshot with the newest earlier snapshot of the same table (as-of join
    expressed as ``lag``: one sort per table instead of a lateral probe per row)."""
    w = Window.partitionBy(*keys).orderBy(ts)
    return (history.withColumn("previous_capture", F.lag(ts).over(w))
                   .withColumn("previous_size_bytes", F.lag(value).over(w)))


def growth_report(history: DataFrame, keys: list[str] = ("table_schema", "table_name"),
                  ts: str = "captured_at", value: str = "total_size_bytes") -> DataFrame:
    """J5 + J6: latest snapshot per table, growth against the previous one, biggest
    growth first with nulls last."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    ranked = with_previous(history, keys, ts, value).withColumn("__rn", F.row_number().over(w))
    return (ranked.filter(F.col("__rn") == 1)
                  .select(*keys, F.col(ts).alias("current_capture"), "previous_capture",
                          (F.col(value) - F.coalesce("previous_size_bytes", F.lit(0)))
                          .alias("growth_bytes"))
                  .orderBy(F.col("growth_bytes").desc_nulls_last()))


def size_listing(history: DataFrame) -> DataFrame:
    """Snapshots by total size then capture time, both descending."""
    return history.orderBy(F.col("total_size_bytes").desc(), F.col("captured_at").desc())
