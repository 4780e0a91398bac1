"""Staging -> star schema: the warehouse load for the ten staging tables.

Each refresh reads the staging tables, takes the change log's new runs into the type-2 dimensions
(``incremental``), writes again those months of the sales that can have changed, rewrites the type-1
dimensions and the other facts, payments and telemetry month-partitioned. Every other table goes to a new version
folder under ``warehouse_root`` and ``current`` pointers are returned, because a table
cannot be overwritten while it is being read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finflow import schemas
from finflow.functions import keys as K
from finflow.functions import normalize as N
from finflow.functions import rules as R
from finflow.operators import lookups as L
from finflow.operators import quality as Q
from finflow.operators import scd
from finflow.plans import incremental as I
from finflow.plans import warehouse as W
from finflow.plans.maintenance import write_monthly
from finflow.operators.staging import staged
from finflow.session import read_or_none

CUSTOMER_ATTRS = ["first_name", "last_name", "email", "phone", "address", "city", "state",
                  "zip_code", "date_of_birth"]
VEHICLE_ATTRS = ["vehicle_id", "make", "model", "year", "color", "dealer_id"]
TELEMETRY_SENSORS = ["speed", "fuel_level", "engine_temperature"]


def _history(staged: DataFrame | None, changes: DataFrame | None, key: str, attrs: list[str], first_at: str, asof,
             known: DataFrame | None = None) -> DataFrame:
    """Dated rows of a type-2 member: key, attrs, at, ord.

    With a change log, a row counts from the day it was loaded, and a key's very first one
    (of keys that the dimension does not know yet) from its own date if that is earlier. Without a log the staged rows count from their
    own date, else from the refresh day.
    """
    rows = changes if changes is not None else staged
    rows = rows.filter(F.col(key).isNotNull())
    own = F.col(first_at).cast("timestamp_ntz") if first_at in rows.columns else F.lit(None).cast("timestamp_ntz")
    if changes is not None:
        first = rows.groupBy(key).agg(F.min(F.struct("loaded_at", "row_order")).alias("__first"))
        if known is not None:
            first = first.join(known, key, "left_anti")
        rows = rows.join(first, key, "left")
        is_first = (F.col("loaded_at") == F.col("__first.loaded_at")) & (F.col("row_order") == F.col("__first.row_order"))
        at = F.when(is_first, F.least(own, F.col("loaded_at"))).otherwise(F.col("loaded_at"))
        order = F.struct("loaded_at", "row_order")
    else:
        at, order = F.coalesce(own, F.lit(asof).cast("timestamp_ntz")), F.struct(*[F.col(c) for c in attrs if c in rows.columns])
    have = [F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in attrs]
    return rows.select(key, *have, at.alias("at"), F.to_json(order).alias("ord"))


def refresh_scd2(previous: DataFrame | None, history: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """M2 / M3 / M4 without a change log: this refresh's rows are merged into the previous version."""
    versions = scd.scd2_from_history(history, [key], attrs, "at", ["ord"])
    if previous is None:
        return versions
    return scd.scd2_merge(previous.select(key, *attrs, "effective_date", "expiry_date", "is_current"),
                          versions.select(key, *attrs, "effective_date"), [key], attrs)


def build_star(spark: SparkSession, staging_root: str, warehouse_root: str, version: str,
               asof: str, previous: dict[str, str] | None = None,
               changes_root: str | None = None) -> dict[str, str]:
    """Build every table present in staging; returns {table: path} of this version.

    ``changes_root`` is the batch run's change log (``<out>/changes``), from which changed
    members of the dimensions get new versions although staging keeps its first rows; it also
    carries the sales' discounts, which staging lacks. A run that was written again after a refresh
    took it in counts anew only in a new warehouse.
    Without it ``previous`` points at the last version's type-2 dimensions, into which the
    staged rows are merged. Constraint violations per table are written to ``checks``.
    """
    prev = previous or {}
    out: dict[str, str] = {}

    def save(name: str, df: DataFrame, monthly_on: str | None = None, sort: list[str] | None = None):
        path = os.path.join(warehouse_root, name, f"v_{version}")
        if monthly_on:
            write_monthly(df, path, monthly_on, sort or [])
        else:
            df.write.mode("overwrite").parquet(path)
        out[name] = path

    def log_of(name: str) -> DataFrame | None:
        log = read_or_none(spark, os.path.join(changes_root, name)) if changes_root else None
        if log is None:
            return None
        # Run ids are text, whatever their folders' names look like.
        schema = T.StructType([T.StructField("run_id", T.StringType()) if f.name == "run_id" else f for f in log.schema.fields])
        return spark.read.schema(schema).parquet(os.path.join(changes_root, name))

    stg = {n: staged(spark, os.path.join(staging_root, n)) for n in
           ["customers", "dealers", "vehicles", "sales", "inventory", "payments", "suppliers",
            "procurement", "interactions", "telemetry"]}

    # --- dimensions ---
    def type2(table: str, dataset: str, key: str, attrs: list[str], first_at: str, derive) -> None:
        log = log_of(dataset)
        if log is None:
            prev_dim = spark.read.parquet(prev[table]) if table in prev else None
            save(table, derive(refresh_scd2(prev_dim, _history(stg[dataset], None, key, attrs, first_at, asof), key, attrs)))
            return
        # One table for all refreshes: only the log's new runs are read, only changed keys' folders written.
        out[table] = os.path.join(warehouse_root, table, "by_runs")
        I.refresh_dimension(spark, log, out[table], [key], attrs, "at", ["ord"], derive=derive,
                            history=lambda rows, known: _history(None, rows, key, attrs, first_at, asof, known))

    def newest(dataset: str, key: str, order: list[str]) -> DataFrame:
        log = log_of(dataset)
        rows = stg[dataset] if log is None else log.drop("run_id")
        order = order if log is None else ["loaded_at", "row_order"]
        out_cols = [c for c in stg[dataset].columns if c != "is_dirty"]
        return scd.latest_per_key(rows.filter(F.col(key).isNotNull()), [key], order).select(*out_cols)

    if stg["customers"] is not None:
        type2("dim_customer", "customers", "customer_id", CUSTOMER_ATTRS, "created_at", lambda dim:
              dim.withColumn("customer_name", N.full_name("first_name", "last_name"))
                 .withColumn("customer_key", K.surrogate_key("customer_id", "effective_date")))
    if stg["vehicles"] is not None:
        type2("dim_vehicle", "vehicles", "vin", VEHICLE_ATTRS, "purchase_date", lambda dim:
              dim.withColumn("vehicle_key", K.surrogate_key("vin", "effective_date")))
    if stg["dealers"] is not None:
        d = newest("dealers", "dealer_id", ["created_at", "dealer_name"])
        save("dim_dealer", d.withColumn("dealer_key", K.surrogate_key("dealer_id")))
    if stg["suppliers"] is not None:
        d = newest("suppliers", "supplier_id", ["created_at", "supplier_name"])
        save("dim_supplier", d.withColumn("supplier_key", K.surrogate_key("supplier_id")))

    dims = {n: spark.read.parquet(p) for n, p in out.items()}

    def customer_pit(df: DataFrame, date_col: str) -> DataFrame:
        if "dim_customer" not in dims:
            return df.withColumn("customer_key", F.lit(None).cast("bigint"))
        return L.point_in_time(df, dims["dim_customer"], "customer_id", "customer_id", date_col,
                               {"customer_key": "customer_key"}, open_start=True)

    def vehicle_pit(df: DataFrame, date_col: str) -> DataFrame:
        """vehicle_id -> vin (current vehicle master), then the vin's version on the day."""
        if "dim_vehicle" not in dims:
            return df.withColumn("vehicle_key", F.lit(None).cast("bigint"))
        # one VIN per vehicle id, also if two were registered for it
        cur = (dims["dim_vehicle"].filter("is_current").groupBy(F.col("vehicle_id").alias("__vid"))
               .agg(F.max_by("vin", F.struct("effective_date", "vin")).alias("__vin")))
        j = df.join(cur, F.col("vehicle_id") == F.col("__vid"), "left").drop("__vid")
        j = L.point_in_time(j, dims["dim_vehicle"], "__vin", "vin", date_col, {"vehicle_key": "vehicle_key"},
                            open_start=True)
        return j.drop("__vin")

    def type1(df: DataFrame, dim: str, key: str, out_key: str) -> DataFrame:
        if dim not in dims or key not in df.columns:
            return df.withColumn(out_key, F.lit(None).cast("bigint"))
        return L.lookup(df, dims[dim], key, key.replace("__", ""), {out_key: out_key})

    dates = []

    # --- facts ---
    if stg["sales"] is not None:
        log = log_of("sales")

        def sales_facts(s: DataFrame) -> DataFrame:
            s = s.withColumn("sale_day", F.to_date("sale_date"))
            s = type1(vehicle_pit(customer_pit(s, "sale_day"), "sale_day"), "dim_dealer", "dealer_id", "dealer_key")
            if log is not None and "discount_amount" in log.columns:  # staging lacks it; a sale's first row counts, as there
                given = log.filter(F.col("sale_id").isNotNull()).groupBy(F.col("sale_id").alias("__sale")).agg(
                    F.min_by(F.struct("discount_amount"), F.struct("loaded_at", "row_order")).alias("__given"))
                s = s.join(given, F.col("sale_id") == F.col("__sale"), "left").withColumn("discount_amount", F.col("__given.discount_amount"))
            discount = F.col("discount_amount") if "discount_amount" in s.columns else F.lit(None).cast("decimal(18,2)")
            return s.select(K.surrogate_key("sale_id").alias("sales_key"), "sale_id",
                            F.col("sale_day").alias("sale_date"), K.date_key("sale_day").alias("sale_date_key"),
                            "customer_key", "vehicle_key", "dealer_key", "sale_price",
                            F.coalesce(discount, F.lit(0)).cast("decimal(18,2)").alias("discount_amount"),
                            N.net_price("sale_price", discount).cast("decimal(18,2)").alias("final_price"),
                            "payment_method")

        sold = stg["sales"].filter(F.col("sale_id").isNotNull())
        if log is None:
            save("fact_sales", sales_facts(sold))
        else:  # only months with new sales, or with sales of a changed customer, vehicle or dealer
            def vehicle_ids(rows: DataFrame) -> DataFrame:
                """Ids that a changed vin has or had."""
                held = dims["dim_vehicle"].join(rows.select("vin"), "vin", "left_semi").select("vehicle_id")
                return held.unionByName(rows.select("vehicle_id")).filter(F.col("vehicle_id").isNotNull())

            touched = {"customers": lambda rows: rows.select("customer_id"), "dealers": lambda rows: rows.select("dealer_id"), "vehicles": vehicle_ids}
            logs = {name: log_of(name) for name in touched}
            out["fact_sales"] = os.path.join(warehouse_root, "fact_sales", "by_months")
            I.refresh_months(spark, out["fact_sales"], sold, "sale_date", sales_facts, log,
                             {name: (own, touched[name]) for name, own in logs.items() if own is not None}, ["sale_id"])
        dates.append(("fact_sales", "sale_date"))
    if stg["payments"] is not None:
        p = stg["payments"].filter(F.col("payment_id").isNotNull()).withColumn("pay_day", F.to_date("payment_date"))
        if "fact_sales" in out:  # a payment of an unknown sale has no sales key
            p = L.lookup(p, spark.read.parquet(out["fact_sales"]).select(F.col("sale_id").alias("known_sale"), "sales_key"),
                         "sale_id", "known_sale", {"sales_key": "sales_key"})
        else:
            p = p.withColumn("sales_key", F.lit(None).cast("bigint"))
        fact = p.select(K.surrogate_key("payment_id").alias("payment_key"), "payment_id", "sale_id",
                        "sales_key", F.col("pay_day").alias("payment_date"),
                        K.date_key("pay_day").alias("payment_date_key"),
                        F.col("amount").alias("payment_amount"), "payment_method",
                        F.col("status").alias("payment_status"))
        save("fact_payments", fact, monthly_on="payment_date", sort=["payment_id"])
        dates.append(("fact_payments", "payment_date"))
    if stg["procurement"] is not None:
        p = stg["procurement"].filter(F.col("procurement_id").isNotNull()) \
                              .withColumn("proc_day", F.to_date("procurement_date"))
        p = type1(p, "dim_supplier", "supplier_id", "supplier_key")
        fact = p.select(K.surrogate_key("procurement_id").alias("procurement_key"), "procurement_id",
                        F.col("proc_day").alias("procurement_date"),
                        K.date_key("proc_day").alias("procurement_date_key"), "supplier_key",
                        F.lit(None).cast("bigint").alias("vehicle_key"),
                        F.col("cost").alias("cost_price"), "status")
        save("fact_procurement", fact)
        dates.append(("fact_procurement", "procurement_date"))
    if stg["inventory"] is not None:
        i = stg["inventory"].filter(F.col("inventory_id").isNotNull()).withColumn("inv_day", F.to_date("stock_date"))
        i = type1(vehicle_pit(i, "inv_day"), "dim_dealer", "dealer_id", "dealer_key")
        fact = i.select(K.surrogate_key("inventory_id").alias("inventory_key"), "inventory_id",
                        F.col("inv_day").alias("inventory_date"), K.date_key("inv_day").alias("inventory_date_key"),
                        "vehicle_key", "dealer_key", "quantity")
        save("fact_inventory", fact)
        dates.append(("fact_inventory", "inventory_date"))
    if stg["interactions"] is not None:
        it = stg["interactions"].filter(F.col("interaction_id").isNotNull()) \
                                .withColumn("int_day", F.to_date("interaction_date"))
        it = type1(customer_pit(it, "int_day"), "dim_dealer", "dealer_id", "dealer_key")
        fact = it.select(K.surrogate_key("interaction_id").alias("interaction_key"), "interaction_id",
                         F.col("int_day").alias("interaction_date"),
                         K.date_key("int_day").alias("interaction_date_key"), "customer_key", "dealer_key",
                         "interaction_type", "notes")
        save("fact_interactions", fact)
        dates.append(("fact_interactions", "interaction_date"))
    if stg["telemetry"] is not None:
        # event grain: one row per reading; its sensor's column holds the rounded value, and
        # sensors without a column of their own keep type and value
        tl = stg["telemetry"].filter(F.col("telemetry_id").isNotNull())
        tl = vehicle_pit(tl.withColumn("tel_day", F.to_date("timestamp")), "tel_day")
        value = F.col("sensor_value").try_cast("decimal(18,6)")
        place = F.split("location", ",")
        part = lambda i: F.trim(F.get(place, i)).try_cast("decimal(9,6)")
        other = ~F.coalesce(F.col("sensor_type").isin(TELEMETRY_SENSORS), F.lit(False))
        fact = tl.select(
            K.surrogate_key("telemetry_id").alias("telemetry_key"), "telemetry_id", "vehicle_key", "vehicle_id",
            F.col("timestamp").alias("telemetry_timestamp"), K.date_key("tel_day").alias("telemetry_date_key"),
            *[F.when(F.col("sensor_type") == s, F.round(value).cast("int")).alias(s) for s in TELEMETRY_SENSORS],
            F.when(other, F.col("sensor_type")).alias("other_sensor"), F.when(other, F.col("sensor_value")).alias("other_value"),
            part(0).alias("location_lat"), part(1).alias("location_long"))
        save("fact_telemetry", fact, monthly_on="telemetry_timestamp", sort=["vehicle_id", "telemetry_timestamp"])
        dates.append(("fact_telemetry", "telemetry_timestamp"))
    if dates:  # from the saved tables: nothing is computed a second time
        days = [spark.read.parquet(out[table]).select(F.to_date(c).alias("d")) for table, c in dates]
        u = days[0]
        for d in days[1:]:
            u = u.unionByName(d)
        save("dim_date", W.dim_date(F.col("d"), source=u.filter(F.col("d").isNotNull())))
    checks = [Q.rule_totals(spark.read.parquet(out[n]), R.table_rules(n)) for n in out if n in schemas.TABLE_CHECKS]
    if checks:
        totals = checks[0]
        for c in checks[1:]:
            totals = totals.unionByName(c)
        save("checks", totals)
    return out
