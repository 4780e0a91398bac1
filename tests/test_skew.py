"""A key (or a file, or one row's copies) holding a third of all rows: results equal a
brute-force computation, and the plans reduce the hot group map-side (partial aggregation)
or keep an equi-key join."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from finflow.operators import lookups as L
from finflow.operators import scd
from finflow.operators import staging as ST

HOT = 0
BASE = dt.datetime(2026, 1, 1)


def _history(n_hot=3000, n_keys=300, per_key=20, seed=7):
    """(k, ts, a) rows; key HOT holds a third of them. Timestamps are unique per key."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n_hot):
        rows.append((HOT, BASE + dt.timedelta(minutes=97 * i), rnd.choice(["a", "b", "c", None])))
    for k in range(1, n_keys + 1):
        for i in range(per_key):
            rows.append((k, BASE + dt.timedelta(hours=13 * i + k), rnd.choice(["a", "b"])))
    rnd.shuffle(rows)
    return rows


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _brute_scd2(rows):
    by_key: dict = {}
    for k, ts, a in rows:
        day = ts.date()
        cur = by_key.setdefault(k, {}).get(day)
        if cur is None or ts > cur[0]:
            by_key[k][day] = (ts, a)
    out = []
    for k, days in by_key.items():
        versions, prev = [], object()
        for day in sorted(days):
            a = days[day][1]
            if a != prev:
                versions.append((day, a))
            prev = a
        for i, (day, a) in enumerate(versions):
            nxt = versions[i + 1][0] if i + 1 < len(versions) else None
            out.append((k, a, day, nxt - dt.timedelta(days=1) if nxt else None, nxt is None))
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.fixture(scope="module")
def hist_rows():
    return _history()


def test_scd2_hot_key_matches_brute_force(spark, hist_rows):
    hist = spark.createDataFrame(hist_rows, "k int, ts timestamp_ntz, a string")
    v = scd.scd2_from_history(hist, ["k"], ["a"], "ts")
    got = sorted(((r.k, r.a, r.effective_date, r.expiry_date, r.is_current) for r in v.collect()),
                 key=lambda r: (r[0], r[2]))
    assert got == _brute_scd2(hist_rows)
    # the hot key's rows are reduced per (key, day) before any exchange
    assert "partial_max_by" in _physical(v)


def test_insert_if_absent_hot_key_matches_brute_force(spark, hist_rows):
    batch_rows = [(k, pos, a) for pos, (k, _, a) in enumerate(hist_rows)] + [(None, -1, "n")]
    batch = spark.createDataFrame(batch_rows, "k int, pos int, a string")
    existing = spark.createDataFrame([(k, 0, "old") for k in range(1, 301, 3)], "k int, pos int, a string")
    for _ in range(1):
        out = ST.insert_if_absent(batch, existing, ["k"], ["pos"])
        got = sorted((r.k, r.pos, r.a) for r in out.collect())
        first: dict = {}
        for k, pos, a in batch_rows:
            if k is not None and (k not in first or pos < first[k][0]):
                first[k] = (pos, a)
        taken = {k for k in range(1, 301, 3)}
        want = sorted((k, pos, a) for k, (pos, a) in first.items() if k not in taken)
        assert got == want
        assert "partial_min_by" in _physical(out)


def test_point_in_time_hot_key_matches_brute_force(spark, hist_rows):
    hist = spark.createDataFrame(hist_rows, "k int, ts timestamp_ntz, a string")
    dim = scd.scd2_from_history(hist, ["k"], ["a"], "ts")
    versions = _brute_scd2(hist_rows)
    rnd = random.Random(11)
    facts = [(i, HOT if i % 3 == 0 else rnd.randint(1, 320),
              (BASE + dt.timedelta(days=rnd.randint(-5, 260))).date()) for i in range(6000)]
    fact = spark.createDataFrame(facts, "fid int, k int, d date")
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # the large-dimension path
    try:
        out = L.point_in_time(fact, dim, "k", "k", "d", {"a": "dim_a", "effective_date": "dim_eff"})
        got = sorted((r.fid, r.dim_eff, r.dim_a) for r in out.collect())
        plan = _physical(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    by_key: dict = {}
    for k, a, eff, exp, _ in versions:
        by_key.setdefault(k, []).append((eff, exp, a))
    want = []
    for fid, k, d in facts:
        hit = [(eff, a) for eff, exp, a in by_key.get(k, []) if eff <= d and (exp is None or d <= exp)]
        assert len(hit) <= 1
        want.append((fid, hit[0][0], hit[0][1]) if hit else (fid, None, None))
    assert got == sorted(want, key=lambda r: r[0])
    # an equi-join on the business key, so AQE's skew join can split the hot key
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_profile_hot_file_of_copies_matches_brute_force(spark):
    """One file holds a third of all rows, most of them copies of one row."""
    from collections import Counter

    from finflow.operators import quality as Q
    rnd = random.Random(5)
    rows = [("hot.csv", "x", None)] * 2500 + [("hot.csv", rnd.choice(["x", "y", None]), str(i % 50))
                                              for i in range(500)]
    for f in range(60):
        rows += [(f"f{f}.csv", rnd.choice(["p", None]), rnd.choice(["1", "2", None])) for _ in range(100)]
    df = spark.createDataFrame(rows, "f string, a string, b string")
    prof = Q.batch_profile(df, "f", critical=["a"])
    got = {r.f: r for r in prof.collect()}
    assert len(got) == 61
    for f in got:
        mine = [(a, b) for ff, a, b in rows if ff == f]
        counts = Counter(mine)
        r = got[f]
        assert r.row_count == len(mine)
        assert r.duplicate_records == sum(n - 1 for n in counts.values())
        nulls_a = sum(a is None for a, _ in mine)
        nulls_b = sum(b is None for _, b in mine)
        assert r.null_value_counts == {"a": nulls_a, "b": nulls_b}
        assert r.total_null_values == nulls_a + nulls_b
        assert r.critical_null_violations == ({"a": nulls_a} if nulls_a else {})
    # copies collapse map-side: a partial count over (file, all columns) precedes the exchange
    plan = _physical(prof)
    assert "partial_count" in plan


def test_type1_latest_hot_key_matches_brute_force(spark, hist_rows):
    df = spark.createDataFrame(hist_rows, "k int, ts timestamp_ntz, a string")
    out = scd.latest_per_key(df, ["k"], ["ts"])
    got = sorted((r.k, r.ts, r.a) for r in out.collect())
    last: dict = {}
    for k, ts, a in hist_rows:
        if k not in last or ts > last[k][0]:
            last[k] = (ts, a)
    assert got == sorted((k, ts, a) for k, (ts, a) in last.items())
    assert "partial_max_by" in _physical(out)


def test_a_key_with_thousands_of_versions_meets_a_months_versions_only(spark):
    """A key with a version a day for years and a third of all facts; open starts, gaps, nulls: equal to
    the lookup over all versions, by an equi-join on key and month."""
    import datetime as dt
    from pyspark.sql import functions as F
    day = lambda k: dt.date(2015, 1, 1) + dt.timedelta(days=k)
    dim = [("hot", day(k), day(k), f"v{k}") for k in range(3000)] + [("hot", day(3000), None, "open"),
           ("a", day(500), day(600), "x"), ("a", day(700), None, "y"), ("b", day(9000), None, "late"), (None, day(0), None, "nobody")]
    facts = [(i, "hot" if i % 3 == 0 else ("a", "b", "none", None)[i % 4], None if i % 50 == 7 else day((i * 37) % 3400)) for i in range(900)]
    d = spark.createDataFrame(dim, "k string, effective_date date, expiry_date date, v string")
    f = spark.createDataFrame(facts, "id int, key string, at date")
    for open_start in (False, True):
        want = L.point_in_time(f, d, "key", "k", "at", {"v": "v"}, open_start=open_start)
        got = L.point_in_time_by_month(f, d, "key", "k", "at", {"v": "v"}, open_start=open_start)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter" in plan and "= __month" in plan and f.join(d, F.expr("key = k")).count() > 900_000


def test_facts_without_a_key_do_not_meet_in_one_task(spark):
    """Half of the facts have no key; by the key alone they would all hash to one partition."""
    fact = spark.range(4000).selectExpr("id", "if(id % 2 = 0, null, id % 50) as k", "date'2026-01-02' as d", "map('a', id) as m")
    dim = spark.range(40).selectExpr("id as k", "concat('n', id) as name", "date'2026-01-01' as effective_date", "cast(null as date) as expiry_date")
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out in (L.lookup(fact, dim, "k", "k", {"name": "name"}), L.point_in_time(fact, dim, "k", "k", "d", {"name": "name"})):
            assert out.columns == ["id", "k", "d", "m", "name"]
            rows = out.select("id", "k", "name", F.spark_partition_id().alias("p")).collect()
            assert sorted((r.id, r.name) for r in rows) == [(i, f"n{i % 50}" if i % 2 and i % 50 < 40 else None) for i in range(4000)]
            lone = [r.p for r in rows if r.k is None]
            assert max(lone.count(p) for p in set(lone)) < 600  # of 2000, among 8 tasks
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_versions_of_members_without_facts_are_not_moved(spark):
    """Facts over few members of a large dimension; the result is that over the whole dimension."""
    from conftest import SF_SMALL
    from finflow.plans.registry import QUERIES
    fact = spark.range(60).selectExpr("id", "if(id % 7 = 0, null, id % 4 + 900) as k", "date_add(date'2026-01-01', cast(id as int)) as d")
    dim = spark.range(2000).selectExpr("id % 1000 as k", "id as v", "date_add(date'2026-01-05', cast(20 * (id div 1000) as int)) as effective_date",
                                       "if(id < 1000, date'2026-01-24', null) as expiry_date")
    own = L.members_of(dim, "k", fact, "k")
    assert own.columns == dim.columns and own.count() == 8
    look = lambda d: sorted((r.id, r.v or -1) for r in L.point_in_time(fact, d, "k", "k", "d", {"v": "v"}).collect())
    assert look(own) == look(dim)
    for name in ("m12_fact_interactions", "m13_fact_telemetry"):
        assert "LeftSemi" in QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
