"""Business-domain views derived from the driver's tables.

Role mapping: ``orders`` = sales, ``lineitem`` = payments and procurement,
``customer`` / ``supplier`` / ``part`` / ``nation``+``region`` = customer, supplier,
vehicle and dealer dimensions, ``events`` = interactions, telemetry, run metrics and
table snapshots. The *raw* feeds render columns the way landed text files carry them
(strings, padding, several date formats, free-text statuses) so the cleaning path is
exercised on data whose volume grows with the tables. Every derivation is a
deterministic function of the row's own content.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(col) -> F.Column:
    return F.col(col).cast("decimal(18,2)")


# --- sales (orders) -----------------------------------------------------------------

def sales_raw(orders: DataFrame) -> DataFrame:
    pr = F.col("o_orderpriority")
    sale_date = (F.when(pr == "1-URGENT", F.date_format("o_orderdate", "MM-dd-yyyy"))
                  .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    price = money("o_totalprice").cast("string")
    return orders.select(
        F.col("o_orderkey").cast("string").alias("sale_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        sale_date.alias("sale_date"),
        F.when(pr == "2-HIGH", F.concat(F.lit(" "), price, F.lit(" "))).otherwise(price).alias("sale_price"),
        F.when(F.col("o_orderstatus") == "F", "Completed")
         .when(F.col("o_orderstatus") == "O", " Pending ")
         .otherwise("Shipped").alias("sale_status"),
        F.when(pr == "1-URGENT", "Online").when(pr == "2-HIGH", "Dealership")
         .when(pr == "3-MEDIUM", "Auction").when(pr == "4-NOT SPECIFIED", "Private")
         .otherwise("Phone").alias("sale_channel"),
    )


def sales(orders: DataFrame) -> DataFrame:
    """Typed sales rows."""
    return orders.select(
        F.col("o_orderkey").alias("sale_id"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("sale_date"), money("o_totalprice").alias("sale_price"),
        F.col("o_orderstatus").alias("sale_status"), F.col("o_orderpriority").alias("priority"))


# --- customers (customer) -------------------------------------------------------------

def customers_raw(customer: DataFrame) -> DataFrame:
    seg = F.col("c_mktsegment")
    name = (F.when(seg == "AUTOMOBILE", F.col("c_name"))
             .when(seg == "BUILDING", F.concat(F.lower(seg), F.lit(" "), F.col("c_name"), F.lit(" jr")))
             .otherwise(F.concat(F.lower(seg), F.lit("  "), F.col("c_name"))))
    email = (F.when(seg == "HOUSEHOLD", F.lit("not-an-email"))
              .otherwise(F.concat(F.lit(" "), F.upper(F.regexp_replace("c_name", "#", "@")), F.lit(".COM "))))
    phone = (F.when(F.col("c_acctbal") < 0, F.lit("value??"))
              .otherwise(F.concat(F.lit("+"), (F.col("c_nationkey") + 10).cast("string"), F.lit("-"),
                                  F.lpad(F.col("c_custkey").cast("string"), 7, "0"))))
    status = (F.when(seg == "MACHINERY", "Active").when(seg == "BUILDING", "Inactive")
               .when(seg == "FURNITURE", "Pending").when(seg == "HOUSEHOLD", "Closed")
               .otherwise("active"))
    dob_day = F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey") * 500 + 17)
    dob = (F.when(F.col("c_acctbal") > 9000, F.lit("31-02-2025"))
            .when(F.col("c_nationkey") < 10, F.date_format(dob_day, "yyyy-MM-dd"))
            .otherwise(F.date_format(dob_day, "MM/dd/yyyy")))
    return customer.select(
        F.col("c_custkey").cast("string").alias("customer_id"), name.alias("name"),
        email.alias("email"), phone.alias("phone"), status.alias("status"),
        dob.alias("date_of_birth"))


# --- payments / procurement (lineitem) ---------------------------------------------------

def payment_id() -> F.Column:
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def payments_raw(lineitem: DataFrame) -> DataFrame:
    rf = F.col("l_returnflag")
    return lineitem.select(
        payment_id().alias("payment_id"), F.col("l_orderkey").cast("string").alias("sale_id"),
        F.col("l_shipdate").alias("payment_date"),
        money("l_extendedprice").cast("string").alias("payment_amount"),
        F.when(rf == "R", "refunded").when(rf == "A", " COMPLETED").otherwise("Pending").alias("payment_status"),
        F.when(F.col("l_linestatus") == "F", "Credit Card").otherwise("Cash").alias("payment_method"))


def procurement_raw(lineitem: DataFrame) -> DataFrame:
    status = (F.when(F.col("l_returnflag") == "R", "returned")
               .when(F.col("l_linestatus") == "O", " Pending")
               .otherwise("completed "))
    return lineitem.select(
        payment_id().alias("po_id"), F.col("l_suppkey").cast("string").alias("vendor_id"),
        F.col("l_partkey").cast("string").alias("vehicle_id"),
        F.col("l_shipdate").alias("po_date"), money("l_extendedprice").cast("string").alias("amount"),
        status.alias("procurement_status"))


def payment_facts(lineitem: DataFrame) -> DataFrame:
    """Typed payment rows (not unique on payment_id; see J1)."""
    return lineitem.select(
        payment_id().alias("payment_id"), F.col("l_orderkey").alias("sale_id"),
        F.col("l_linenumber"), F.col("l_shipdate").alias("payment_date"),
        money("l_extendedprice").alias("payment_amount"),
        F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_partkey"), F.col("l_suppkey"),
        F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"))


# --- events: runs, snapshots, telemetry, landing names -----------------------------------

def k_of(props: str = "props") -> F.Column:
    return F.get_json_object(F.col(props), "$.k").cast("int")


def runs_from_events(events: DataFrame) -> DataFrame:
    k = k_of()
    et = F.col("event_type")
    msg = (F.when((et == "error") & (k < 50),
                  F.concat(F.lit("Data quality validation failed: duplicate records detected: "), k.cast("string")))
            .when(et == "error", F.concat(F.lit("Stage timeout after "), k.cast("string"), F.lit(" s"))))
    return events.select(
        F.col("event_id").alias("run_id"),
        F.lit("finflow").alias("pipeline_name"),
        F.concat(F.lit("finflow_"), et).alias("dag_id"),
        k.alias("files_processed"),
        (k.cast("bigint") * F.col("user_id")).alias("rows_loaded"),
        (F.col("value").cast("decimal(12,2)") * 2).cast("decimal(12,2)").alias("processing_time_seconds"),
        F.when(et == "error", "FAILED").when(et == "signup", "RUNNING").otherwise("SUCCESS").alias("status"),
        F.col("ts").alias("run_timestamp"),
        msg.alias("error_message"))


def snapshots_from_events(events: DataFrame) -> DataFrame:
    """One capture per (event type as table, day): rows, bytes from the event payload."""
    k = k_of().cast("bigint")
    return (events.groupBy(F.col("event_type"), F.to_date("ts").alias("d"))
                  .agg(F.max("ts").alias("captured_at"), F.sum(k).alias("kb"),
                       F.count(F.lit(1)).alias("estimated_rows"))
                  .select(F.lit("warehouse").alias("table_schema"),
                          F.concat(F.lit("fact_"), F.col("event_type")).alias("table_name"),
                          "captured_at",
                          (F.col("kb") * 1000).alias("table_size_bytes"),
                          (F.col("kb") * 1024).alias("total_size_bytes"),
                          "estimated_rows"))


# Event type -> landed file stem (a fixed, illustrative naming of the five event types).
LANDING_STEMS = {
    "click": "crm_customers",
    "view": "vehicle_catalog",
    "purchase": "sales_orders",
    "signup": "customer_interactions_auto",
    "error": "iot_sensors_readings_e2e_test",
}


def landing_names(events: DataFrame) -> DataFrame:
    stem = F.coalesce(F.try_element_at(
        F.create_map(*[F.lit(x) for kv in LANDING_STEMS.items() for x in kv]), F.col("event_type")),
        F.col("event_type"))
    name = F.concat(F.lit("landing/"), stem, F.lit("_"), F.date_format("ts", "yyyy"), F.lit("_"),
                    F.date_format("ts", "yyyyMMdd_HHmmss"), F.lit(".CSV"))
    return events.select("event_id", name.alias("file_name"))


# --- workbooks: rows as landed XLSX files -------------------------------------------------

def workbook(header: list[str], rows: list[list], sheet: str = "data") -> bytes:
    """One-sheet workbook of inline strings."""
    def cell(at: int, row: int, value) -> str:
        name, at = "", at + 1
        while at:
            at, digit = divmod(at - 1, 26)
            name = chr(65 + digit) + name
        return f'<c r="{name}{row}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'

    lines = "".join(f'<row r="{k}">' + "".join(cell(i, k, v) for i, v in enumerate(r) if v is not None) + "</row>"
                    for k, r in enumerate([header, *rows], start=1))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}"><Relationship Id="rId1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{lines}</sheetData></worksheet>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + text)
    return out.getvalue()


def workbooks(df: DataFrame, name: str, rows_per_book: int = 5000) -> DataFrame:
    """(path, content) of workbooks that hold the rows of ``df`` (all text)."""
    cols = df.columns

    def pack(batches):
        for k, pdf in enumerate(batches):
            for start in range(0, len(pdf), rows_per_book):
                rows = [[None if v is None or v != v else str(v) for v in r]
                        for r in pdf.iloc[start:start + rows_per_book].itertuples(index=False, name=None)]
                yield pd.DataFrame({"path": [f"{name}_{rows[0][0]}_{k}_{start}.xlsx"], "content": [workbook(cols, rows)]})

    return df.mapInPandas(pack, "path string, content binary")
