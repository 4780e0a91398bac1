"""Command line: ``python -m finflow batch|star|stream ...`` (spark-submit friendly)."""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="finflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch", help="one ETL run over a landing folder")
    b.add_argument("--landing", required=True)
    b.add_argument("--out", required=True, help="root of staging/, quarantine/, metadata")
    b.add_argument("--lenient", action="store_true", help="de-duplicate instead of rejecting files")
    b.add_argument("--categorical-only", action="store_true", help="leave out the domain constraints")
    b.add_argument("--reprocess", action="store_true", help="read files again that earlier runs finished")
    b.add_argument("--run-keys", help="JSON list of file keys of this run")
    s = sub.add_parser("star", help="refresh the star schema from staging")
    s.add_argument("--staging", required=True)
    s.add_argument("--warehouse", required=True)
    s.add_argument("--version", required=True)
    s.add_argument("--asof", required=True)
    s.add_argument("--previous", help="JSON file with the previous version's table paths")
    s.add_argument("--changes", help="change log of the batch runs (<out>/changes)")
    st = sub.add_parser("stream", help="events (JSON lines files) -> staging")
    st.add_argument("--source", required=True)
    st.add_argument("--out", required=True)
    st.add_argument("--checkpoint", required=True)
    st.add_argument("--continuous", action="store_true", help="keep running (default: drain and stop)")
    a = ap.parse_args(argv)

    from finflow.session import get_spark
    spark = get_spark(app=f"finflow-{a.cmd}")
    if a.cmd == "batch":
        from finflow.plans.batch_run import run_batch
        keys = None
        if a.run_keys:
            keys = spark.createDataFrame([(k,) for k in json.loads(a.run_keys)], "key string")
        summary = run_batch(spark, a.landing, a.out, strict=not a.lenient, run_keys=keys,
                            constraints=not a.categorical_only, reprocess=a.reprocess)
        print(summary["line"])
        return 0 if summary["status"] == "SUCCESS" else 1
    if a.cmd == "star":
        from finflow.plans.star import build_star
        prev = json.load(open(a.previous)) if a.previous else None
        print(json.dumps(build_star(spark, a.staging, a.warehouse, a.version, a.asof, prev, a.changes)))
        return 0
    from finflow.streaming import events as EV
    ev = EV.decode(EV.json_file_source(spark, a.source))
    q = EV.start_staging(ev, f"{a.out}/staging", f"{a.out}/quarantine", a.checkpoint,
                         available_now=not a.continuous)
    q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
