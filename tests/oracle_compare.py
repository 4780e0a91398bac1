"""Run registered Spark queries and their DuckDB oracle side by side; compare results.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for tname in TABLES:
        path = f"{sf_dir}/{tname}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows], sorted(cols)


def duck_type(dt) -> str:
    """Spark data type -> DuckDB type name, for the schema half of the comparison."""
    from pyspark.sql import types as T
    simple = {T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT",
              T.ByteType: "TINYINT", T.StringType: "VARCHAR", T.DoubleType: "DOUBLE",
              T.FloatType: "FLOAT", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
              T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE"}
    for k, v in simple.items():
        if isinstance(dt, k):
            return v
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    return dt.simpleString().upper()


def compare(spark, sf_dir, names=None, check_types=True):
    import __spark_entry__ as E
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in sorted(qs):
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[name] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        dt = time.time() - t0
        if name not in orc:
            results[name] = f"rows-only {len(s_rows)}"
            print(f"{name:32s} {results[name]} ({dt:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(orc[name])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[name] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(name, results[name], flush=True)
            continue
        a, ac = rows_of(s_cols, s_rows)
        b, bc = rows_of(d_cols, d_rows)
        type_note = ""
        if check_types:
            s_types = {f.name: duck_type(f.dataType) for f in df.schema.fields}
            d_types = {c[0]: str(c[1]) for c in cur.description}
            diff = {c: (s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)}
            if diff:
                type_note = f" TYPES {diff}"
        if ac != bc:
            results[name] = f"COLUMNS {ac} vs {bc}"
        elif sorted(a, key=repr) != sorted(b, key=repr):
            sa, sb = set(a), set(b)
            results[name] = (f"VALUES spark={len(a)} duck={len(b)} only_spark={list(sa - sb)[:2]} "
                             f"only_duck={list(sb - sa)[:2]}")
        else:
            results[name] = f"OK {len(a)}{type_note}"
        print(f"{name:32s} {results[name]} ({dt:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    from finflow.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_spark(master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if not (v.startswith("OK") or v.startswith("rows-only"))]
    print(f"\n{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
