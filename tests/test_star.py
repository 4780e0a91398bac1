import datetime as dt
import os

from pyspark.sql import functions as F

from finflow import schemas
from finflow.plans.star import build_star


def _stage(spark, root, name, rows):
    schema = schemas.STAGING[name]
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(os.path.join(root, name))


def D(s):
    return dt.date.fromisoformat(s)


def T(s):
    return dt.datetime.fromisoformat(s)


def test_star_from_staging_keeps_history(spark, tmp):
    stg, wh = os.path.join(tmp, "stg"), os.path.join(tmp, "wh")
    _stage(spark, stg, "customers", [
        ("C1", "Ada", "Lovelace", "ada@x.org", None, None, "Toronto", "ON", None, D("1990-05-01"),
         T("2026-01-01 10:00:00"), False),
        ("C2", "Bo", "Li", "bo@x.org", None, None, "Ottawa", "ON", None, None, T("2026-01-05 10:00:00"), False)])
    _stage(spark, stg, "vehicles", [
        ("V1", "VIN1", "Toyota", "Corolla", 2020, "red", "D1", None, T("2026-01-02 00:00:00"), False),
        ("V2", None, "Ford", "F150", 2021, "blue", "D1", None, None, False)])    # null VIN: no version
    _stage(spark, stg, "dealers", [("D1", "North", None, None, None, None, "Toronto", "ON", None,
                                    T("2025-12-01 00:00:00"), False)])
    _stage(spark, stg, "sales", [("S1", "V1", "C1", "D1", T("2026-01-10 00:00:00"), None, "Check", False),
                                 ("S2", "V2", "C9", "D1", T("2026-01-11 00:00:00"), None, None, False)])
    _stage(spark, stg, "payments", [("P1", "S1", "C1", T("2026-01-12 00:00:00"), None, "Check", "Paid", False),
                                    ("P2", "S99", "C1", T("2026-01-12 00:00:00"), None, "Check", "Paid", False)])
    _stage(spark, stg, "telemetry", [
        ("T1", "V1", T("2026-01-10 08:00:00"), "speed", "88", None, False),
        ("T2", "V1", T("2026-01-10 08:00:00"), "fuel_level", "40", None, False),
        ("T3", "V1", T("2026-01-10 08:00:00"), "engine_temperature", "95.53", "43.65,-79.4", False),
        ("T4", "V1", T("2026-01-10 08:00:00"), "tyre_pressure", "2.4", None, False)])
    v1 = build_star(spark, stg, wh, "001", asof="2026-01-31")
    fs = spark.read.parquet(v1["fact_sales"]).orderBy("sale_id").collect()
    assert fs[0].customer_key is not None and fs[0].vehicle_key is not None and fs[0].dealer_key is not None
    assert fs[1].customer_key is None and fs[1].vehicle_key is None          # unknown customer / null VIN
    tel = {r.telemetry_id: r for r in spark.read.parquet(v1["fact_telemetry"]).collect()}
    assert (tel["T1"].speed, tel["T2"].fuel_level, tel["T3"].engine_temperature) == (88, 40, 96)
    assert str(tel["T3"].location_lat) == "43.650000" and (tel["T4"].other_sensor, tel["T4"].other_value) == ("tyre_pressure", "2.4")
    checks = {r.rule_name: r.n_violations for r in spark.read.parquet(v1["checks"]).collect()}
    assert checks["fact_telemetry.speed_range"] == 0 and checks["dim_customer.expiry_after_effective"] == 0
    pays = spark.read.parquet(v1["fact_payments"]).filter(F.col("ym") == "2026_01").collect()
    assert {p.payment_id: p.sales_key is None for p in pays} == {"P1": False, "P2": True}   # P2's sale is unknown
    dd = spark.read.parquet(v1["dim_date"])
    assert dd.count() == 3 and dd.agg(F.min("date_actual")).first()[0] == D("2026-01-10")

    # next refresh: C1 moved on 2026-02-01
    _stage(spark, stg, "customers", [
        ("C1", "Ada", "Lovelace", "ada@x.org", None, None, "Montreal", "QC", None, D("1990-05-01"),
         T("2026-02-01 09:00:00"), False),
        ("C2", "Bo", "Li", "bo@x.org", None, None, "Ottawa", "ON", None, None, T("2026-01-05 10:00:00"), False)])
    v2 = build_star(spark, stg, wh, "002", asof="2026-02-02", previous=v1)
    dc = spark.read.parquet(v2["dim_customer"]).filter("customer_id = 'C1'").orderBy("effective_date").collect()
    assert [(r.city, str(r.effective_date), r.expiry_date and str(r.expiry_date), r.is_current) for r in dc] == [
        ("Toronto", "2026-01-01", "2026-01-31", False), ("Montreal", "2026-02-01", None, True)]
    # the sale of 2026-01-10 still points at the Toronto version
    s1 = spark.read.parquet(v2["fact_sales"]).filter("sale_id = 'S1'").first()
    toronto = [r for r in dc if r.city == "Toronto"][0]
    assert s1.customer_key == toronto.customer_key


def test_landed_files_to_star(spark, tmp):
    """The whole chain: landed files -> batch run -> staging -> star schema."""
    import sys
    sys.path.insert(0, os.path.dirname(__file__))
    from fixtures import write_landing
    from finflow.plans.batch_run import run_batch
    land, out, wh = os.path.join(tmp, "landing"), os.path.join(tmp, "out"), os.path.join(tmp, "wh")
    write_landing(land)
    run_batch(spark, land, out, constraints=False)
    v = build_star(spark, os.path.join(out, "staging"), wh, "001", asof="2026-02-28")
    assert set(v) >= {"dim_customer", "fact_sales", "fact_payments", "dim_date"}
    sales = {r.sale_id: r for r in spark.read.parquet(v["fact_sales"]).collect()}
    assert set(sales) == {"S1", "S2", "S4"}
    assert sales["S1"].customer_key is not None              # C1 loaded from the workbook
    assert sales["S4"].customer_key is None                  # C4 had no valid e-mail
    pays = spark.read.parquet(v["fact_payments"]).collect()
    assert sorted(r.payment_status for r in pays) == ["Failed", "Paid"]
    assert {r.discount_amount for r in sales.values()} == {0}   # staging has none; the change log carries it
    v = build_star(spark, os.path.join(out, "staging"), wh, "002", "2026-02-28", changes_root=os.path.join(out, "changes"))
    logged = {r.sale_id: r for r in spark.read.parquet(v["fact_sales"]).collect()}
    assert all(r.final_price == r.sale_price - r.discount_amount for r in logged.values()) and any(r.discount_amount > 0 for r in logged.values())
    assert "discount_amount" not in spark.read.parquet(os.path.join(out, "staging", "sales")).columns


def test_changed_customer_gets_a_new_version(spark, tmp):
    """Two batch runs through staging that keeps its first rows: the change log feeds the history,
    a late file included."""
    from finflow.plans.batch_run import run_batch
    land, out, wh = (os.path.join(tmp, x) for x in ("land", "out", "wh"))
    os.makedirs(land)

    def drop(name, city):
        with open(os.path.join(land, name), "w") as f:
            f.write(f"customer_id,email,city,created_at\nC1,a@x.org,{city},2026-01-01\n")

    drop("customers_1_20260110.csv", "Toronto")
    run_batch(spark, land, out, started=T("2026-01-10 06:00:00"))
    v1 = build_star(spark, f"{out}/staging", wh, "1", "2026-01-10", changes_root=f"{out}/changes")
    drop("customers_2_20260120.csv", "Montreal")
    s = run_batch(spark, land, out, started=T("2026-01-20 06:00:00"))
    assert s["rows_loaded"] == 1 and s["rows_inserted"] == 0
    v2 = build_star(spark, f"{out}/staging", wh, "2", "2026-01-20", v1, changes_root=f"{out}/changes")
    got = spark.read.parquet(v2["dim_customer"]).orderBy("effective_date").collect()
    assert [(r.city, str(r.effective_date), r.is_current) for r in got] == [("Toronto", "2026-01-01", False), ("Montreal", "2026-01-20", True)]


def test_dimension_refreshed_by_runs(spark, tmp):
    """Runs in order, late rows, confirmations, a same-day correction and nulls equal one build over the
    log; a refresh without new runs does nothing; folders of untouched keys keep their files."""
    from finflow.operators import scd
    from finflow.plans import incremental as I
    log_path, dim_path = os.path.join(tmp, "log"), os.path.join(tmp, "wh", "dim")
    runs = {
        "0001": [(k, "a", f"2026-01-0{1 + k % 3} 10:00:00", 1) for k in range(40)] + [(None, "a", "2026-01-01 00:00:00", 1), (7, "x", None, 1)],
        "0002": [(1, "a", "2026-01-20 10:00:00", 2), (2, "b", "2026-01-20 10:00:00", 2), (2, "c", "2026-01-20 11:00:00", 3), (50, "n", "2026-01-20 10:00:00", 2)],
        "0003": [(1, "z", "2026-01-10 10:00:00", 4), (2, "b", "2026-01-20 12:00:00", 5), (3, None, "2026-02-01 10:00:00", 5)],
    }

    def refresh():
        log = spark.read.schema("k long, v string, at timestamp_ntz, pos int, run_id string").parquet(log_path)
        return I.refresh_dimension(spark, log, dim_path, ["k"], ["v"], "at", ["pos"], buckets=8)

    def files():
        return {os.path.join(d, f) for d, _, fs in os.walk(dim_path) for f in fs if f.endswith(".parquet")}

    done, held = [], []
    for name, rows in runs.items():
        df = spark.createDataFrame([(k, v, at and T(at), p) for k, v, at, p in rows], "k long, v string, at timestamp_ntz, pos int")
        df.write.parquet(os.path.join(log_path, f"run_id={name}"))
        done.append(refresh())
        held.append(files())
    assert [d["runs"] for d in done] == [1, 1, 1] and refresh() == {"runs": 0, "late_keys": 0, "folders_written": 0} and files() == held[-1]
    assert done[1]["late_keys"] == 0 and done[2]["late_keys"] == 2      # key 1 has an older row, key 2 one of the same day
    assert done[0]["folders_written"] == 8 and done[2]["folders_written"] <= 3 and len(held[1] & held[2]) >= 5
    log = spark.read.schema("k long, v string, at timestamp_ntz, pos int, run_id string").parquet(log_path)
    want = scd.scd2_from_history(log, ["k"], ["v"], "at", ["pos"])
    got = I.dimension(spark, dim_path)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))


def test_only_affected_months_of_a_fact_are_written_again(spark, tmp):
    """New facts, a changed member with facts in one month, a member without facts, undated rows: the
    months that can change are replaced, the others keep their files, and all equals one build."""
    from finflow.plans import incremental as I
    log_path, dim_log, fact = (os.path.join(tmp, x) for x in ("log", "members", "wh/fact"))

    def land(path, run, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(path, f"run_id={run}"))

    def refresh():
        log = spark.read.schema("id long, day date, who string, run_id string").parquet(log_path)
        members = spark.read.schema("who string, city string, run_id string").parquet(dim_log)
        newest = members.groupBy("who").agg(F.max_by("city", "run_id").alias("city"))
        build = lambda rows: rows.join(newest, "who", "left").select("id", "day", "city")
        done = I.refresh_months(spark, fact, log.drop("run_id"), "day", build, log, {"who": (members, lambda rows: rows.select("who"))}, ["id"])
        want = build(log).collect()
        assert sorted(map(repr, spark.read.parquet(fact).drop("ym").collect())) == sorted(map(repr, want))
        return done["months"], {os.path.join(d, f) for d, _, fs in os.walk(fact) for f in fs if f.endswith(".parquet")}

    facts, people = "id long, day date, who string", "who string, city string"
    land(log_path, "1", [(k, D(f"2026-0{1 + k % 3}-05"), "A" if k % 3 else "B") for k in range(30)] + [(99, None, "C")], facts)
    land(dim_log, "1", [("A", "x"), ("B", "x")], people)
    months, first = refresh()
    assert months == ["2026_01", "2026_02", "2026_03", "none"]
    assert refresh() == ([], first)
    land(log_path, "2", [(40, D("2026-03-20"), "A"), (41, D("2026-04-01"), "Z")], facts)
    months, second = refresh()
    assert months == ["2026_03", "2026_04"] and len(first & second) == 3
    land(dim_log, "2", [("B", "y"), ("Q", "y")], people)          # B has sales in January only, Q none
    months, third = refresh()
    assert months == ["2026_01"] and len(second & third) == len(second) - 1
    land(dim_log, "3", [("C", "w")], people)                      # the undated row's member
    assert refresh()[0] == ["none"]
