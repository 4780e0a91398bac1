import json
import os

from pyspark.sql import functions as F

from finflow.streaming import events as EV


def _write_events(d, name, evs):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        for e in evs:
            f.write(json.dumps(e) + "\n")


SALES = [{"event_type": "sales", "sale_id": f"S{i}", "sale_date": "2026-02-0%d" % (1 + i % 5),
          "customer_id": "C1", "sale_price": "100.0", "sale_channel": "Online", "sale_status": "Completed"}
         for i in range(7)]
PAY = [{"event_type": "payments", "payment_id": "P1", "sale_id": "S1", "payment_date": "2026-02-01",
        "amount": 10, "status": "completed", "payment_method": "Cash"},
       {"event_type": "payments", "payment_id": "P2", "sale_id": "S1", "payment_date": "2026-02-01",
        "amount": 5, "status": "paid", "payment_method": "Check"}]
ODD = [{"event_type": "weather", "temp": 20}]


def test_route_and_dead_letter(spark, tmp):
    src = os.path.join(tmp, "in")
    _write_events(src, "a.json", SALES[:3] + ODD)
    _write_events(src, "b.json", SALES[3:] + PAY)
    with open(os.path.join(src, "c.json"), "w") as f:
        f.write("{broken\n")
    ev = EV.decode(EV.json_file_source(spark, src))
    q = EV.start_router(ev, os.path.join(tmp, "out"), os.path.join(tmp, "ck"), available_now=True)
    q.awaitTermination(120)
    sales = spark.read.option("header", True).csv(os.path.join(tmp, "out", "sales", "*"))
    assert sales.count() == 7 and "sale_price" in sales.columns
    assert spark.read.csv(os.path.join(tmp, "out", "payments", "*"), header=True).count() == 2
    dead = spark.read.parquet(os.path.join(tmp, "out", "_dead_letter", "*"))
    assert sorted((r.event_type or "", r.raw_value) for r in dead.collect()) == [("", "{broken"), ("weather", json.dumps(ODD[0]))]
    # a restart with the same checkpoint reads nothing new
    q2 = EV.start_router(ev, os.path.join(tmp, "out"), os.path.join(tmp, "ck"), available_now=True)
    q2.awaitTermination(120)
    assert spark.read.option("header", True).csv(os.path.join(tmp, "out", "sales", "*")).count() == 7


def test_stream_feeds_staging(spark, tmp):
    src = os.path.join(tmp, "in")
    _write_events(src, "a.json", SALES + PAY + ODD)
    ev = EV.decode(EV.json_file_source(spark, src))
    q = EV.start_staging(ev, os.path.join(tmp, "stg"), os.path.join(tmp, "quar"), os.path.join(tmp, "ck"))
    q.awaitTermination(180)
    assert spark.read.parquet(os.path.join(tmp, "stg", "sales")).count() == 7
    pay = spark.read.parquet(os.path.join(tmp, "stg", "payments")).collect()
    assert [(r.payment_id, r.status, str(r.amount)) for r in pay] == [("P2", "Paid", "5.00")]
    bad = spark.read.parquet(os.path.join(tmp, "quar", "payments", "*")).collect()
    assert bad[0].violations == ["payment_method_not_allowed"]


def test_bounded_batches_exact_size(spark, tmp):
    src = os.path.join(tmp, "in")
    evs = [{"event_type": "telemetry", "telemetry_id": f"T{i}", "timestamp": "2026-02-01 00:00:00"}
           for i in range(25)]
    _write_events(src, "a.json", evs)
    ev = EV.decode(EV.json_file_source(spark, src))
    out = EV.bounded_batches(ev, max_rows=10, max_seconds=3600, buckets=1)
    q = EV.start_drain(spark, out.writeStream.format("memory").queryName("tele_batches").outputMode("append")
                       .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True))
    q.awaitTermination(180)
    rows = spark.sql("SELECT flush_seq, count(*) n, first(reason) r FROM tele_batches GROUP BY flush_seq").collect()
    assert sorted((r.flush_seq, r.n, r.r) for r in rows) == [(0, 10, "size"), (1, 10, "size")]


def test_arrival_counts(spark, tmp):
    src = os.path.join(tmp, "in")
    _write_events(src, "a.json", SALES + PAY + ODD)
    ev = EV.decode(EV.json_file_source(spark, src))
    q = (EV.arrival_counts(ev).writeStream.format("memory").queryName("arrivals").outputMode("complete")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = {r.event_type: r.arrived for r in spark.sql("SELECT * FROM arrivals").collect()}
    assert got == {"sales": 7, "payments": 2, "weather": 1}


def test_archive_consumed_files(spark, tmp):
    src, arch = os.path.join(tmp, "in"), os.path.join(tmp, "archive")
    _write_events(src, "a.json", SALES[:2])
    _write_events(src, "b.json", SALES[2:4])
    ev = EV.json_file_source(spark, src, max_files_per_trigger=1, archive_dir=arch)
    q = (ev.writeStream.format("memory").queryName("arch_t").option("checkpointLocation", os.path.join(tmp, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert spark.sql("SELECT count(*) c FROM arch_t").first().c == 4
    archived = [f for _, _, fs in os.walk(arch) for f in fs]
    assert "a.json" in archived   # the last batch's file stays until the next run


def test_bounded_batches_flush_on_age(spark, tmp):
    import time
    src = os.path.join(tmp, "in")
    evs = [{"event_type": "telemetry", "telemetry_id": f"T{i}", "timestamp": "2026-02-01 00:00:00"}
           for i in range(5)]
    _write_events(src, "a.json", evs)
    ev = EV.decode(EV.json_file_source(spark, src))
    out = EV.bounded_batches(ev, max_rows=100, max_seconds=2, buckets=1)
    q = (out.writeStream.format("memory").queryName("tele_age").outputMode("append")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 90
        n = 0
        while time.time() < deadline:
            n = spark.sql("SELECT count(*) c FROM tele_age").first().c
            if n >= 5:
                break
            time.sleep(1)
    finally:
        q.stop()
    rows = spark.sql("SELECT reason, flush_seq, count(*) n FROM tele_age GROUP BY reason, flush_seq").collect()
    assert [(r.reason, r.flush_seq, r.n) for r in rows] == [("age", 0, 5)]


def test_bounded_batches_salted_hot_copies(spark, tmp):
    """A third of the events are copies of one payload: with several buckets every event is
    released exactly once, size flushes are exact, and the copies spread over buckets
    (they arrive in different micro-batches)."""
    import time
    src = os.path.join(tmp, "in")
    hot = {"event_type": "telemetry", "telemetry_id": "HOT", "timestamp": "2026-02-01 00:00:00"}
    for f in range(6):
        evs = [hot] * 10 + [{"event_type": "telemetry", "telemetry_id": f"T{f}_{i}",
                             "timestamp": "2026-02-01 00:00:00"} for i in range(20)]
        _write_events(src, f"f{f}.json", evs)
    raw = EV.json_file_source(spark, src, max_files_per_trigger=1)
    ev = EV.decode(raw)
    out = EV.bounded_batches(ev, max_rows=10, max_seconds=2, buckets=8)
    q = (out.writeStream.format("memory").queryName("tele_salted").outputMode("append")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(processingTime="1 second").start())
    try:
        deadline = time.time() + 150
        while time.time() < deadline:
            if spark.sql("SELECT count(*) c FROM tele_salted").first().c >= 180:
                break
            time.sleep(1)
        time.sleep(3)   # nothing further may arrive
    finally:
        q.stop()
    rows = spark.sql("SELECT bucket, payload FROM tele_salted").collect()
    assert len(rows) == 180
    hot_rows = [r for r in rows if '"HOT"' in r.payload]
    assert len(hot_rows) == 60
    others = [r.payload for r in rows if '"HOT"' not in r.payload]
    assert len(others) == len(set(others)) == 120
    assert len({r.bucket for r in hot_rows}) > 1
    batches = spark.sql("SELECT bucket, flush_seq, first(reason) reason, count(*) n FROM tele_salted "
                        "GROUP BY bucket, flush_seq").collect()
    assert all(b.n == 10 for b in batches if b.reason == "size")
    assert all(b.n <= 10 for b in batches)


MIXED = [
    {"event_type": "customers", "customer_id": "C1", "first_name": "A", "gender": "F", "province": "ON"},   # no e-mail
    {"event_type": "customers", "customer_id": "C2", "email": "b@x.org", "gender": "M", "province": "ON", "loyalty": 3},
    {"event_type": "payments", "transaction_id": "P9", "transaction_date": "2026-01-10T08:00:00.123456Z", "payment_amount": 72.53,
     "payment_method": "Check", "payment_status": "completed"},
    {"event_type": "telemetry", "telemetry_id": "T1", "timestamp": "2026-01-10T10:00:00.5+02:00", "sensor_type": "speed", "sensor_value": 72.53,
     "location_lat": 43.65, "location_long": -79.4},
]


def test_events_fare_alike_in_one_or_many_batches(spark, tmp):
    """Aliases, fractions, zones, decimals and unknown keys; the result does not depend on how
    the events fall into micro-batches."""
    import datetime as dt
    results = []
    for name, files in (("one", [MIXED]), ("many", [[e] for e in MIXED])):
        src = os.path.join(tmp, name)
        for i, evs in enumerate(files):
            _write_events(src, f"f{i}.json", evs)
        ev = EV.decode(EV.json_file_source(spark, src, max_files_per_trigger=1))
        EV.start_staging(ev, f"{tmp}/{name}_stg", f"{tmp}/{name}_q", f"{tmp}/{name}_ck").awaitTermination(300)
        rows = {n: [r.asDict() for r in spark.read.parquet(f"{tmp}/{name}_stg/{n}").collect()] for n in ("customers", "payments", "telemetry")}
        results.append(rows)
    assert results[0] == results[1]
    rows = results[0]
    assert [r["customer_id"] for r in rows["customers"]] == ["C2"]
    p = rows["payments"][0]
    assert (p["payment_id"], p["payment_date"], str(p["amount"]), p["status"]) == ("P9", dt.datetime(2026, 1, 10, 8, 0, 0, 123456), "72.53", "Paid")
    t = rows["telemetry"][0]
    assert (t["timestamp"], t["sensor_value"], t["location"]) == (dt.datetime(2026, 1, 10, 8, 0, 0, 500000), "72.53", "43.65,-79.4")
    kept = EV.decode(spark.createDataFrame([(json.dumps(MIXED[1]),)], "value string")).first()
    assert kept.other_fields == {"loyalty": "3"}


def test_age_bound_holds_while_events_keep_arriving(spark, tmp):
    """A trickle: the oldest waiting event is released at its age, not when arrivals stop."""
    import time
    src = os.path.join(tmp, "in")
    _write_events(src, "f0.json", [{"event_type": "telemetry", "telemetry_id": "T0"}])
    ev = EV.decode(EV.json_file_source(spark, src))
    q = (EV.bounded_batches(ev, max_rows=1000, max_seconds=4, buckets=1).writeStream.format("memory").queryName("trickle")
         .outputMode("append").option("checkpointLocation", os.path.join(tmp, "ck")).trigger(processingTime="1 second").start())
    try:
        n = i = 0
        deadline = time.time() + 60
        while time.time() < deadline and not n:
            i += 1
            _write_events(src, f"f{i}.json", [{"event_type": "telemetry", "telemetry_id": f"T{i}"}])
            time.sleep(1)
            n = spark.sql("SELECT count(*) c FROM trickle").first().c
    finally:
        q.stop()
    assert n and {r.reason for r in spark.sql("SELECT reason FROM trickle").collect()} == {"age"}


def test_a_sink_reads_its_own_events_alone(spark, tmp, monkeypatch):
    """Each sink's write scans one part of the micro-batch; positions are those of the batch; null,
    empty and unknown types are dead letters as they came; nothing stays in the scratch folder."""
    src, out, plans, places = os.path.join(tmp, "in"), os.path.join(tmp, "out"), {}, []
    lines = [json.dumps({"event_type": t, "interaction_id": str(i), "odd": i}) for i, t in enumerate(["interactions", "payments", None, "", "x=/y"] * 4)] + ["no json"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(src)
    batch = EV.decode(spark.read.text(src).withColumn("received_at", F.current_timestamp()))
    rows, scratch = EV.dataset_rows, EV.scratch_path
    monkeypatch.setattr(EV, "dataset_rows", lambda ev, et, **kw: plans.__setitem__(et, ev) or rows(ev, et, **kw))
    monkeypatch.setattr(EV, "scratch_path", lambda *a: places.append(scratch(*a)) or places[-1])
    seen = {}
    letters = EV._dead_letters
    monkeypatch.setattr(EV, "_dead_letters", lambda ev, *a: seen.update({et: (df._jdf.queryExecution().executedPlan().toString(), [r.position for r in df.orderBy("position").collect()]) for et, df in plans.items()}) or letters(ev, *a))
    EV.route_batch(batch, 0, out)
    assert sorted(seen) == ["interactions", "payments"]
    for et, (plan, position) in seen.items():
        assert "InMemoryTableScan" not in plan and "PartitionFilters: [isnotnull(__sink" in plan
        assert position == [i for i, x in enumerate(lines) if f'"{et}"' in x]
    dead = spark.read.parquet(f"{out}/_dead_letter/*")
    assert sorted(r.raw_value for r in dead.collect()) == sorted(x for x in lines if '"interactions"' not in x and '"payments"' not in x)
    assert spark.read.option("header", True).csv(f"{out}/payments/*").count() == 4 == spark.read.json(f"{out}/interactions/*").count()
    assert len(places) == 1 and not os.path.exists(places[0].removeprefix("file://"))
