"""Flagship slice: landed sales text -> clean -> rules -> clean side -> customers -> daily rollup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.operators import lookups as L
from finflow.operators import quality as Q
from finflow.operators.transform import clean
from finflow.plans import feeds
from finflow.plans.registry import ORACLE


def daily_clean_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = clean(feeds.sales_raw(feeds.read(spark, sf_dir, "orders")), "sales")
    ok, _dirty = Q.split_clean_dirty(cleaned)
    ok = ok.withColumn("customer_key", F.col("customer_id").try_cast("bigint"))
    cust = feeds.read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    j = L.inner_join_non_null(ok, cust, "customer_key", "c_custkey")
    return (j.groupBy(F.to_date("sale_date").alias("sale_date"), F.col("c_mktsegment").alias("segment"))
             .agg(F.count(F.lit(1)).alias("n_sales"),
                  F.sum("sale_price").cast("decimal(18,2)").alias("total_sales")))


FLAGSHIP_SQL = f"""
WITH c AS ({ORACLE['b6_b9_clean_sales']})
SELECT CAST(sale_date AS DATE) AS sale_date, c_mktsegment AS segment, count(*) AS n_sales,
  CAST(sum(sale_price) AS DECIMAL(18,2)) AS total_sales
FROM c JOIN customer ON TRY_CAST(customer_id AS BIGINT) = c_custkey
WHERE NOT is_dirty AND c_custkey IS NOT NULL
GROUP BY 1, 2
"""
