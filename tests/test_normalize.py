import datetime as dt

from pyspark.sql import functions as F

from finflow.functions import normalize as N
from finflow.functions import rules as R


def _one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("o")).first()["o"]


def test_infer_dataset_names(spark):
    cases = {
        "raw/sales_2026_20260226_102345.csv": "sales",
        "s3://b/ingested/sales_orders_2026.csv": "sales",           # sales before procurement's 'order'
        "x/purchase_orders_20260101.CSV": "procurement",
        "crm_customers_2026_20260226.xlsx": "customers",
        "customer_interactions_auto_20260226_101010.json": "interactions",
        "iot_sensors_readings_e2e_test_20260226.json": "telemetry",
        "erp_finance_2026.csv": "payments",
        "vehicles.csv": "vehicles",
        "mystery_table_2026.csv": "mystery_table",                    # unmapped stays its stem
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    got = {r["p"]: r["d"] for r in df.select("p", N.infer_dataset("p").alias("d")).collect()}
    assert got == cases


def test_alias_renames_first_alias_wins():
    cols = ["interaction_id", "timestamp", "created_date", "type"]
    assert N.alias_renames(cols, "interactions") == {"type": "interaction_type",
                                                     "timestamp": "interaction_date"}
    # target already present blocks the rename
    assert N.alias_renames(["payment_id", "transaction_id"], "payments") == {}


def test_split_name(spark):
    df = spark.createDataFrame([("Ada",), ("Juan Carlos  Perez",), (None,), ("  Bo Li ",)], "name string")
    rows = N.split_name(df).collect()
    assert [(r.first_name, r.last_name) for r in rows] == [
        ("Ada", ""), ("Juan", "Carlos Perez"), (None, None), ("Bo", "Li")]


def test_recode_status(spark):
    df = spark.createDataFrame([(" COMPLETED",), ("canceled",), ("weird",), (None,)], "status string")
    out = [r.status for r in N.recode_status(df, "payments").collect()]
    assert out == ["Paid", "Failed", "weird", None]
    df2 = spark.createDataFrame([("pending",), ("Completed ",)], "status string")
    assert [r.status for r in N.recode_status(df2, "procurement").collect()] == ["Ordered", "Received"]


def test_dates_several_formats_and_impossible(spark):
    """An ambiguous date is month first, as pandas' ``to_datetime`` has it; 25/01 can only be day first."""
    vals = ["2025-01-05", "01-05-2025", "2025-01-05 10:11:12", "31-02-2025", "junk", None, "03/04/2026", "25/01/2025", "25-01-2025"]
    df = spark.createDataFrame([(v,) for v in vals], "d string")
    out = [r.o for r in df.select(N.parse_date("d").alias("o")).collect()]
    assert out == [dt.date(2025, 1, 5), dt.date(2025, 1, 5), dt.date(2025, 1, 5), None, None, None,
                   dt.date(2026, 3, 4), dt.date(2025, 1, 25), dt.date(2025, 1, 25)]


def test_money_try_cast(spark):
    df = spark.createDataFrame([(" 12.50 ",), ("abc",), ("-5000",), (None,)], "sale_price string")
    out = [r.o for r in df.select(N.to_money("sale_price").alias("o")).collect()]
    assert [None if x is None else str(x) for x in out] == ["12.50", None, "-5000.00", None]
    assert N.money_columns(["sale_price", "amount", "payment_amount", "id"]) == [
        "sale_price", "amount", "payment_amount"]


def test_categorical_null_is_dirty_and_case_sensitive(spark):
    df = spark.createDataFrame([("Online",), ("online",), (None,)], "sale_channel string")
    out = R.evaluate(df, R.categorical_rules("sales")).collect()
    assert [r.is_dirty for r in out] == [False, True, True]
    assert out[1].violations == ["sale_channel_not_allowed"]


def test_check_rule_null_passes(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (5.0,)], "speed double")
    rule = R.Rule("speed_range", F.col("speed").between(0, 350))
    out = [r.v for r in df.select(R.violations([rule]).alias("v")).collect()]
    assert out == [[], ["speed_range"], []]


def test_trim_and_nan(spark):
    df = spark.createDataFrame([(" a ", float("nan")), ("b", 1.0)], "s string, x double")
    out = N.nan_to_null(N.trim_strings(df)).collect()
    assert [(r.s, r.x) for r in out] == [("a", None), ("b", 1.0)]


def test_parse_keeps_wall_clock_in_any_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2024-03-10 02:30:00",), ("31-02-2025",), ("03-10-2024",)], "s string")
        out = [r.o for r in df.select(N.parse_timestamp("s").alias("o")).collect()]
        assert out == [dt.datetime(2024, 3, 10, 2, 30), None, dt.datetime(2024, 3, 10, 0, 0)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_clean_with_dotted_columns_and_text_flag(spark):
    from finflow.operators.transform import clean
    df = spark.createDataFrame(
        [("I1", "C1", "Phone", "2026-02-01 09:00:00", "7", "false", "f.json"),
         ("I1", "C1", "Phone", "2026-02-01 09:00:00", "7", "false", "f.json"),
         ("I2", "C2", "Fax", "2026-02-01", None, "true", "f.json")],
        "interaction_id string, customer_id string, type string, timestamp string, `meta.agent.id` string, "
        "is_dirty string, source_file string")
    out = clean(df, "interactions").orderBy("interaction_id").collect()
    assert len(out) == 2
    assert out[0].interaction_type == "Phone" and out[0].is_dirty is False
    assert out[0]["meta.agent.id"] == "7" and out[0].interaction_date == dt.datetime(2026, 2, 1, 9, 0)
    assert out[1].is_dirty is True and out[1].violations == ["interaction_type_not_allowed"]
    strict = clean(df.dropDuplicates(), "interactions", dedupe=False)
    assert strict.count() == 2


def test_iso_fractions_and_zones(spark):
    cases = {"2026-01-10T08:00:00.123456": dt.datetime(2026, 1, 10, 8, 0, 0, 123456), "2026-01-10T08:00:00.5": dt.datetime(2026, 1, 10, 8, 0, 0, 500000),
             "2026-01-10T08:00:00Z": dt.datetime(2026, 1, 10, 8), "2026-01-10T08:00:00.25+02:00": dt.datetime(2026, 1, 10, 6, 0, 0, 250000),
             "2026-01-10 08:00:00-0530": dt.datetime(2026, 1, 10, 13, 30), "2026-01-10T08:00:00.123456789": dt.datetime(2026, 1, 10, 8, 0, 0, 123456),
             "12/31/2025": dt.datetime(2025, 12, 31), "2025/12/31": dt.datetime(2025, 12, 31), "2026-13-01": None, "2026-01-10T25:00:00": None, "8": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    assert {r.s: r.o for r in df.select("s", N.parse_timestamp("s").alias("o")).collect()} == cases


def test_domain_rules(spark):
    rows = [("S1", "10.00", "x" * 51), (None, "-1.00", "ok"), ("S3", None, None)]
    df = spark.createDataFrame(rows, "sale_id string, sale_price string, sale_channel string").withColumn("sale_price", N.to_money("sale_price"))
    rules = R.applicable(R.domain_rules("sales"), df.columns)
    assert [r.v for r in df.select(R.violations(rules).alias("v")).collect()] == [["sale_channel_length"], ["sale_id_is_null", "sale_price_not_negative"], []]
    now = R.domain_rules("interactions", now="2026-01-01 00:00:00")
    assert {"duration_positive", "interaction_in_the_past", "interaction_id_is_null"} <= {r.name for r in now}
