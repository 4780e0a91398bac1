"""Batch runs over landed files and run-level reporting (3.1 lifecycle, Q6-Q15).

manifest -> gate -> read per dataset -> per-file verdict -> clean -> split ->
insert-if-absent into staging, quarantine, load log, run summary.
"""

from __future__ import annotations

import datetime as _dt
import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finflow import schemas
from finflow.functions import normalize as N
from finflow.functions import rules as R
from finflow.operators import quality as Q
from finflow.operators import staging as ST
from finflow.operators.transform import clean
from finflow.session import read_or_none
from finflow.sources import files as FS
from finflow.sources import readers as RD


def failure_title(message) -> Column:
    """Q14: quality failure vs pipeline failure, from the error text."""
    m = F.col(message) if isinstance(message, str) else message
    return (F.when(m.contains(schemas.QUALITY_FAILURE_MARKER), F.lit(schemas.QUALITY_FAILURE_TITLE))
             .otherwise(F.lit(schemas.PIPELINE_FAILURE_TITLE)))


def sla_breaches(runs: DataFrame, threshold_seconds: float = schemas.SLA_SECONDS) -> DataFrame:
    """Q15: runs slower than the SLA threshold."""
    return runs.filter(F.col("processing_time_seconds") > F.lit(threshold_seconds))


EMPTY_AFTER_TRANSFORM = "no row was left after cleaning"

VERDICT_SCHEMA = T.StructType([
    T.StructField("source_file", T.StringType()), T.StructField("dataset", T.StringType()),
    T.StructField("file_type", T.StringType()), T.StructField("columns", T.ArrayType(T.StringType())),
])
FILES_SCHEMA = "path string, length long, modificationTime timestamp, run_id string"


def _with_position(df: DataFrame) -> DataFrame:
    """File order of each row: (block start within the file, increasing id in the split)."""
    pos = F.struct(F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("i"))
    return df.withColumn("row_pos", pos)


def _numbered(df: DataFrame) -> DataFrame:
    return df.withColumn("row_pos", F.struct(F.lit(0).cast("long").alias("b"), F.monotonically_increasing_id().alias("i")))


def _renamed_columns(columns: list[str], dataset: str) -> list[str]:
    """A file's own column names after the aliases that apply to that file."""
    renames = N.alias_renames(columns, dataset)
    return [renames.get(c, c) for c in columns]


def _rename(src: str, dst: str):
    return lambda c: F.when(c == src, F.lit(dst)).otherwise(c)


def _per_file_aliases(df: DataFrame, per_file: DataFrame, dataset: str) -> tuple[DataFrame, DataFrame]:
    """Aliases for rows of files with different columns: an alias holds for the files that
    have its source and lack its target. Returns the rows and the files' renamed columns."""
    pairs = schemas.COLUMN_ALIASES.get(dataset, [])
    files = per_file.withColumn("__own", F.col("columns"))
    df = df.join(files.select("source_file", "__own"), "source_file", "left")
    names = F.col("columns")
    for src, dst in pairs:
        if src not in df.columns:
            continue
        has = lambda c: F.array_contains("__own", c)
        taken = [s for s, d in pairs[:pairs.index((src, dst))] if d == dst and s in df.columns]
        holds = F.coalesce(has(src) & ~has(dst), F.lit(False))
        for earlier in taken:
            holds = holds & ~F.coalesce(has(earlier), F.lit(False))
        value = F.when(holds, F.col(f"`{src}`"))
        df = df.withColumn(dst, F.coalesce(F.col(f"`{dst}`"), value) if dst in df.columns else value)
        df = df.withColumn(src, F.when(~holds, F.col(f"`{src}`")))
        files = files.withColumn("columns", F.when(holds, F.transform("columns", _rename(src, dst))).otherwise(names))
        names = F.col("columns")
    return df.drop("__own"), files.drop("__own")


def read_dataset(spark: SparkSession, dataset: str, file_rows: list[dict]) -> tuple[DataFrame, DataFrame]:
    """Rows of all files of one dataset (unioned by name, all text) and, for each file,
    the columns it really has (VERDICT_SCHEMA): a file is judged by those alone."""
    parts, metas = [], []
    by_type: dict[str, list[dict]] = {}
    for r in file_rows:
        by_type.setdefault(r["file_type"], []).append(r)
    groups: dict[tuple, list[str]] = {}
    for r in by_type.get("CSV", []):
        groups.setdefault(tuple(RD.csv_header(r["first_line"])), []).append(r["path"])
    known: list[tuple] = []
    for cols, paths in groups.items():
        if cols:
            parts.append(N.apply_aliases(_with_position(RD.read_csv_group(spark, paths, list(cols))), dataset))
        known += [(p, dataset, "CSV", _renamed_columns(list(cols), dataset)) for p in paths]
    metas.append(spark.createDataFrame(known, VERDICT_SCHEMA))
    for kind, paths in (("JSON", [r["path"] for r in by_type.get("JSON", [])]), ("Excel", [r["path"] for r in by_type.get("Excel", [])])):
        if not paths:
            continue
        files = spark.createDataFrame([(p,) for p in paths], "source_file string")
        if kind == "JSON":
            rows = RD.read_json(spark, paths)
            per_file = RD.json_columns(spark, paths, [c for c in rows.columns if c not in ("source_file", RD.CORRUPT)])
        else:
            cells = RD.workbook_cells(spark.read.format("binaryFile").load(paths)).persist()
            per_file = RD.workbook_columns(cells)
            rows = RD.workbook_rows(cells, RD.union_columns(per_file))
        rows, per_file = _per_file_aliases(_numbered(rows), per_file, dataset)
        parts.append(rows)
        metas.append(files.join(per_file, "source_file", "left").select(
            "source_file", F.lit(dataset).alias("dataset"), F.lit(kind).alias("file_type"),
            F.coalesce("columns", F.array().cast("array<string>")).alias("columns")))
    out = parts[0] if parts else spark.createDataFrame([], "source_file string, row_pos struct<b:long,i:long>")
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if RD.CORRUPT not in out.columns:
        out = out.withColumn(RD.CORRUPT, F.lit(None).cast("string"))
    meta = metas[0]
    for m in metas[1:]:
        meta = meta.unionByName(m)
    return out, meta


def read_plan(spark: SparkSession, found: DataFrame) -> list[dict]:
    """The driver's read plan: (path, dataset, file_type, first_line), a row per new file.

    Spark's own file listing holds every path on the driver as well; rows come in one
    partition at a time, and only these files' headers are read.
    """
    plan = [r.asDict() for r in found.select("path", "dataset", "file_type").toLocalIterator()]
    listed = spark.createDataFrame([(r["path"],) for r in plan if r["file_type"] == "CSV"], "path string")
    heads = {r.path: r.first_line for r in FS.csv_headers(spark, listed).toLocalIterator()} if plan else {}
    return [{**r, "first_line": heads.get(r["path"])} for r in plan]


def landed_rows(spark: SparkSession, landing: str, dataset: str) -> tuple[DataFrame, DataFrame]:
    """Rows and file table of one dataset under ``landing``."""
    inv = FS.gate(FS.manifest(spark, landing))
    found = FS.discover(inv.filter("is_valid")).filter(F.col("dataset") == dataset)
    return read_dataset(spark, dataset, read_plan(spark, found))


def file_verdicts(rows: DataFrame, meta: DataFrame, dataset: str, strict: bool = True) -> DataFrame:
    """Q6-Q12 per file in one job: counts, nulls, duplicates, required / critical columns,
    schema match, malformed rows, then the error messages and the verdict. Nulls, required
    and critical columns are judged over the columns the file itself has."""
    rules = schemas.QUALITY_RULES.get(dataset, {"required": [], "critical": []})
    target = [f.name for f in schemas.STAGING[dataset].fields] if dataset in schemas.STAGING else []
    data_cols = [c for c in rows.columns if c not in ("source_file", "row_pos", RD.CORRUPT)]
    # malformed rows are counted in the same pass (a query reading only the corrupt-record
    # column of a raw file is not allowed, and a second scan is not wanted)
    prof = Q.batch_profile(rows.select("source_file", *[F.col(f"`{c}`") for c in data_cols + [RD.CORRUPT]]),
                           "source_file", data_cols + [RD.CORRUPT], critical=rules["critical"])
    corrupt_nulls = F.coalesce(F.try_element_at("null_value_counts", F.lit(RD.CORRUPT)), F.lit(0))
    prof = prof.select("source_file", "row_count", "duplicate_records", "null_value_counts",
                       "critical_null_violations", (F.col("row_count") - corrupt_nulls).alias("malformed_rows"))
    names = lambda xs: F.array(*[F.lit(c) for c in xs]).cast("array<string>")
    own = lambda m: F.map_filter(F.coalesce(m, F.create_map().cast("map<string,bigint>")),
                                 lambda k, v: F.array_contains(F.col("columns"), k))
    v = meta.join(prof, "source_file", "left").select(
        "source_file", "dataset", "file_type",
        F.array_except(names(rules["required"]), F.col("columns")).alias("missing_required_columns"),
        F.size(F.array_intersect(F.col("columns"), names(target))).alias("shared_columns"),
        F.array_sort(F.array_except(F.col("columns"), names(target))).alias("unexpected_columns"), "columns",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("duplicate_records", F.lit(0)).alias("duplicate_records"),
        F.coalesce("malformed_rows", F.lit(0)).alias("malformed_rows"),
        own(F.col("null_value_counts")).alias("null_value_counts"),
        own(F.col("critical_null_violations")).alias("critical_null_violations"))
    v = v.withColumn("total_null_values", F.aggregate(F.map_values("null_value_counts"), F.lit(0).cast("bigint"), lambda s, x: s + x))
    errors = F.array_compact(F.array(
        F.when(F.lit(strict) & (F.col("duplicate_records") > 0),
               F.format_string("%d repeated rows", F.col("duplicate_records"))),
        F.when(F.size("missing_required_columns") > 0,
               F.concat(F.lit("required columns absent: "), F.array_join("missing_required_columns", ", "))),
        F.when(F.size(F.map_keys("critical_null_violations")) > 0,
               F.concat(F.lit("nulls in critical columns: "), F.to_json("critical_null_violations"))),
        F.when(F.col("malformed_rows") > 0,
               F.format_string("%d malformed rows", F.col("malformed_rows"))),
        F.when((F.col("shared_columns") == 0) & (F.size("missing_required_columns") == 0),
               F.lit("none of the columns belongs to the target table")),
    ))
    return (v.withColumn("validation_errors", errors)
             .withColumn("schema_valid", (F.col("shared_columns") > 0) & (F.size("missing_required_columns") == 0))
             .withColumn("is_valid", F.size("validation_errors") == 0))


def _replace_run(df: DataFrame, path: str, run_id: str, dataset: str | None = None) -> None:
    """Write a run's rows (of one dataset); a repeated write of the same run replaces them."""
    parts = ["run_id"]
    if dataset is not None:
        df, parts = df.withColumn("dataset", F.lit(dataset)), ["dataset", "run_id"]
    (df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*parts).parquet(path))


def _load_dataset(spark, dataset: str, file_rows: list[dict], out_root: str, run_id: str, started,
                  strict: bool, constraints: bool) -> tuple[DataFrame, dict]:
    """Reads, judges, cleans and loads one dataset's files: (file verdicts, load counts)."""
    rows, meta = read_dataset(spark, dataset, file_rows)
    verdict = file_verdicts(rows, meta, dataset, strict).persist()
    accepted = verdict.filter("is_valid").select("source_file")
    good_rows = rows.join(accepted, "source_file", "left_semi").drop(RD.CORRUPT)
    # strict mode rejected every file holding a duplicate, so de-duplication would be a
    # no-op shuffle over all accepted rows; lenient mode de-duplicates per file
    extra = R.domain_rules(dataset) if constraints else []
    cleaned = clean(good_rows, dataset, extra_rules=extra, dedupe=not strict).persist()
    ok, dirty = Q.split_clean_dirty(cleaned)
    load = {"rows_attempted": 0, "rows_inserted": 0}
    if not accepted.isEmpty():
        # (without an accepted file the required columns may not even exist in the rows)
        more = [T.StructField(c, t) for c, t in schemas.LOGGED_EXTRAS.get(dataset, [])]
        typed = typed_for_target(ok, T.StructType([*schemas.STAGING[dataset].fields, *more]))
        load = ST.load_staging(typed.drop(*[f.name for f in more]), os.path.join(out_root, "staging", dataset), schemas.PRIMARY_KEYS[dataset],
                               ["source_file", "row_pos"], drop_cols=["source_file", "row_pos"])
        # the change log beside staging: every clean row as it came, also of known keys
        _replace_run(typed.withColumn("loaded_at", F.lit(started).cast("timestamp_ntz"))
                     .withColumn("row_order", F.concat_ws(":", "source_file", F.format_string("%020d", "row_pos.b"), F.format_string("%020d", "row_pos.i")))
                     .drop("source_file", "row_pos"), os.path.join(out_root, "changes", dataset), run_id)
    _replace_run(dirty.select("source_file", "violations", F.to_json(F.struct(
        *[F.col(f"`{c}`") for c in dirty.columns if c not in ("source_file", "row_pos", "violations", "is_dirty")])).alias("row_json")),
        os.path.join(out_root, "quarantine", dataset), run_id)
    per_file = cleaned.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("rows_after_clean"), F.count(F.when(F.col("is_dirty"), 1)).alias("dirty_rows"))
    # Q12: a file that passed the checks but kept no row after cleaning is rejected too
    v = verdict.join(per_file, "source_file", "left")
    emptied = F.col("is_valid") & (F.coalesce(F.col("rows_after_clean"), F.lit(0)) == 0)
    v = (v.withColumn("validation_errors",
                      F.when(emptied, F.array_union("validation_errors", F.array(F.lit(EMPTY_AFTER_TRANSFORM))))
                       .otherwise(F.col("validation_errors")))
          .withColumn("is_valid", F.col("is_valid") & ~emptied))
    _replace_run(v.drop("null_value_counts", "critical_null_violations"), os.path.join(out_root, "file_verdicts"), run_id, dataset)
    if load["rows_attempted"] > 0:
        _replace_run(ST.metadata_row(spark, dataset, load["rows_attempted"]), os.path.join(out_root, "etl_metadata"), run_id, dataset)
    cleaned.unpersist()
    return v, load


def run_batch(spark: SparkSession, landing: str, out_root: str, strict: bool = True,
              run_keys: DataFrame | None = None, run_id: str | None = None,
              dag_id: str = "finflow_batch", constraints: bool = True, reprocess: bool = False,
              started: _dt.datetime | None = None) -> dict:
    """One ETL run over ``landing``: returns the summary dict (also the ETL_SUMMARY line).

    Under ``out_root``: ``staging/<dataset>`` (insert-if-absent), ``changes/<dataset>`` (every
    clean row with its run's time, for the type-2 dimensions), ``quarantine/<dataset>``,
    ``file_verdicts``, ``etl_metadata`` and ``processed_files``. A file is read
    once (A9): what an earlier run has finished is left out unless ``reprocess`` is set.
    Writing a run again under its ``run_id`` replaces its rows. A dataset that fails is an
    error of the run; the others load, and its files are taken up by the next run.
    ``constraints`` applies the domain rules of ``rules.domain_rules`` besides the categorical ones.
    """
    run_id = run_id or uuid.uuid4().hex[:12]
    started = started or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    began = _dt.datetime.now()
    inv = FS.gate(FS.manifest(spark, landing))
    done_path = os.path.join(out_root, "processed_files")
    done = read_or_none(spark, done_path)
    if done is not None and not reprocess:
        seen = done.filter(F.col("run_id") != run_id).select("path", "length", "modificationTime")
        inv = inv.join(seen, ["path", "length", "modificationTime"], "left_anti")
    inv = inv.persist()
    found = FS.discover(inv.filter("is_valid"), run_keys)
    files = read_plan(spark, found)
    gate_rejects = [{"path": r["path"], "reason": r["reason"]}
                    for r in inv.filter(~F.col("is_valid")).select("path", "reason").toLocalIterator()]
    per_dataset: dict[str, list] = {}
    unmapped = []
    for r in files:
        (per_dataset.setdefault(r["dataset"], []) if r["dataset"] in schemas.DATASETS else unmapped).append(r)
    verdict_frames, metrics, failed = [], [], {}
    for dataset, file_rows in sorted(per_dataset.items()):
        try:
            v, load = _load_dataset(spark, dataset, file_rows, out_root, run_id, started, strict, constraints)
        except Exception as e:  # noqa: BLE001 - one dataset's failure is reported, the others load
            failed[dataset] = f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"
            continue
        verdict_frames.append(v)
        metrics.append({"dataset": dataset, **load})
    finished = [d for d in per_dataset if d not in failed]
    taken = inv.withColumn("dataset", N.infer_dataset("path")).filter(~F.coalesce(F.col("dataset").isin(list(failed)), F.lit(False)) if failed else F.lit(True))
    if run_keys is not None:
        taken = taken.join(found.select("path"), "path", "left_semi")
    _replace_run(taken.select("path", "length", "modificationTime"), done_path, run_id)
    inv.unpersist()
    summary = {"run_id": run_id, "files_found": len(files), "files_processed": 0,
               "rows_loaded": sum(m["rows_attempted"] for m in metrics),
               "rows_inserted": sum(m["rows_inserted"] for m in metrics),
               "gate_rejected": gate_rejects, "unmapped_files": [r["path"] for r in unmapped],
               "datasets": metrics, "datasets_finished": sorted(finished), "file_metrics": [], "errors": []}
    if verdict_frames:
        allv = verdict_frames[0]
        for v in verdict_frames[1:]:
            allv = allv.unionByName(v)
        s = run_summary(allv).first().asDict(recursive=True)
        summary.update({k: s[k] for k in ("files_processed", "files_rejected", "total_rows",
                                          "duplicate_records", "total_null_values",
                                          "schema_validation_failures")})
        # per-file metrics are part of the reported line (Q13)
        summary["file_metrics"] = json.loads(s["file_metrics_json"])
        summary["errors"] = [f"{m['source_file']}: {'; '.join(m['validation_errors'])}"
                             for m in summary["file_metrics"] if m["validation_errors"]]
    summary["errors"] += [f"{d}: {e}" for d, e in sorted(failed.items())]
    summary["errors"] += [f"{r['path']}: dataset {r['dataset']} has no target table" for r in unmapped]
    summary["status"] = ("FAILED" if summary["errors"] or summary["gate_rejected"] else "SUCCESS")
    elapsed = (_dt.datetime.now() - began).total_seconds()
    summary["processing_time_seconds"] = round(elapsed, 2)
    summary["sla_breached"] = elapsed > schemas.SLA_SECONDS
    # The run's metrics row, replacing an earlier row of the same run
    from finflow.plans.maintenance import record_run
    record_run(spark, {"pipeline_name": "finflow", "dag_id": dag_id,
                       "files_processed": int(summary["files_processed"] or 0),
                       "rows_loaded": int(summary["rows_loaded"]),
                       "processing_time_seconds": float(summary["processing_time_seconds"]),
                       "status": summary["status"], "run_timestamp": started},
               os.path.join(out_root, "pipeline_metrics"))
    summary["line"] = "ETL_SUMMARY::" + json.dumps({k: v for k, v in summary.items() if k != "line"},
                                                   default=str)
    return summary


def typed_for_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """Rows in the full staging schema, in target order. Shared columns are typed
    (``try_cast``, multi-format dates); target columns the source lacks are typed nulls,
    as in a database table, so every load and micro-batch appends the same Parquet schema.
    Lineage columns are kept for ordering."""
    lineage = [F.col(c) for c in ("source_file", "row_pos") if c in df.columns]
    cols = [_expr_for(df, f.name, f.dataType) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in target.fields]
    return df.select(*lineage, *cols)


def _expr_for(df: DataFrame, c: str, dst: T.DataType):
    src = df.schema[c].dataType
    if src == dst:
        return F.col(c)
    if isinstance(dst, (T.TimestampNTZType, T.TimestampType)) and isinstance(src, T.StringType):
        return N.parse_timestamp(c).alias(c)
    if isinstance(dst, T.DateType) and isinstance(src, T.StringType):
        return N.parse_date(c).alias(c)
    return F.col(c).try_cast(dst).alias(c)


def run_summary(verdicts: DataFrame) -> DataFrame:
    """Q13: one row over all file verdicts, per-file metrics as a JSON list."""
    m = F.struct("source_file", "dataset", "file_type", "row_count", "duplicate_records",
                 "total_null_values", "malformed_rows", "missing_required_columns",
                 "unexpected_columns", "schema_valid", "validation_errors", "is_valid")
    return verdicts.agg(
        F.count(F.when(F.col("is_valid"), 1)).alias("files_processed"),
        F.count(F.when(~F.col("is_valid"), 1)).alias("files_rejected"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum("duplicate_records"), F.lit(0)).cast("bigint").alias("duplicate_records"),
        F.coalesce(F.sum("total_null_values"), F.lit(0)).cast("bigint").alias("total_null_values"),
        F.count(F.when(~F.col("schema_valid"), 1)).alias("schema_validation_failures"),
        F.to_json(F.sort_array(F.collect_list(m))).alias("file_metrics_json"))
