"""Type-2 dimensions and facts kept up from change logs, run by run.

The log's runs that a dimension has taken in are its high-water mark; a refresh reads the new runs
alone. A changed key is settled from its current version and its new rows. Only where a new row is
not later than all the dimension has seen of its key does the key's history come from the whole log,
since a version does not tell which days merely confirmed it. The dimension lies in folders by key
hash, and only folders with a changed key are written again.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.functions import keys as K
from finflow.operators import scd
from finflow.operators.staging import BUCKET
from finflow.session import read_or_none, scratch_path

DIM_BUCKETS = 32
SEEN = "last_seen"


def applied_path(dim_path: str) -> str:
    root, name = os.path.split(dim_path.rstrip("/"))
    return os.path.join(root, "_applied_runs", name)


def new_runs(spark: SparkSession, log: DataFrame, dim_path: str) -> list[str]:
    """Runs of the log that the dimension has not taken in; run ids are the log's folders."""
    runs = log.select("run_id").distinct()
    done = read_or_none(spark, applied_path(dim_path))
    if done is not None:
        runs = runs.join(done.select("run_id"), "run_id", "left_anti")
    return sorted(r.run_id for r in runs.toLocalIterator())


def dimension(spark: SparkSession, dim_path: str) -> DataFrame | None:
    """The dimension's own columns."""
    dim = read_or_none(spark, dim_path)
    return None if dim is None else dim.drop(BUCKET, SEEN)


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: it is used several times, and its source is about to change."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_dimension(spark: SparkSession, log: DataFrame, dim_path: str, keys: list[str], attrs: list[str], ts_col: str,
                      tiebreak: list[str], history: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
                      derive: Callable[[DataFrame], DataFrame] = lambda df: df, buckets: int = DIM_BUCKETS) -> dict:
    """Take the log's new runs into the dimension at ``dim_path``; returns what was done.

    ``log`` has a ``run_id`` column, best its partition column. ``history`` makes dated rows (keys,
    attrs, ``ts_col``, ``tiebreak``) of log rows, given the keys the dimension knows (None: none);
    ``derive`` adds columns to the versions. The result equals one build over all runs, whatever the
    order in which the changes came. A refresh that dies is taken up by the next one: the runs count
    as taken in only when their folders are written, and rows seen twice are treated as late.
    """
    runs = new_runs(spark, log, dim_path)
    done = {"runs": len(runs), "late_keys": 0, "folders_written": 0}
    if not runs:
        return done
    history = history or (lambda rows, known: rows)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    old = read_or_none(spark, dim_path)
    fresh = log.filter(F.col("run_id").isin(runs))
    if old is None:
        points = scd.daily_points(history(fresh, None), keys, attrs, ts_col, tiebreak)
        out = _versions(points, keys, attrs)
    else:
        # Folders that hold a key of the new runs: a number for each folder at most.
        folders = sorted(r[0] for r in fresh.filter(scd.keys_present(keys)).select(bucket).distinct().collect())
        old = old.filter(F.col(BUCKET).isin(folders))
        seen = old.groupBy(*keys).agg(F.max(SEEN).alias("__seen"))
        points = _kept(scd.daily_points(history(fresh, seen.select(*keys)), keys, attrs, ts_col, tiebreak), "dim-points")
        touched = _kept(points.groupBy(*keys).agg(F.min("effective_date").alias("__first")).join(seen, keys, "left")
                        .withColumn("__late", F.col("__first") <= F.col("__seen")), "dim-touched")
        late = touched.filter("__late").select(*keys)
        done["late_keys"] = late.count()
        names = [*keys, *attrs, "effective_date", "expiry_date", "is_current", SEEN]
        plain = touched.filter("not coalesce(__late, false)").select(*keys)
        now = old.filter("is_current").join(plain, keys, "left_semi").select(*keys, "effective_date", F.struct(*attrs).alias("__a"))
        out = (old.join(touched.select(*keys), keys, "left_anti").select(*names)
               .unionByName(old.filter("not is_current").join(plain, keys, "left_semi").select(*names))
               .unionByName(_versions(now.unionByName(points.join(plain, keys, "left_semi")), keys, attrs)))
        if done["late_keys"]:  # only then is the whole log read
            whole = log.join(late, keys, "left_semi")
            out = out.unionByName(_versions(scd.daily_points(history(whole, None), keys, attrs, ts_col, tiebreak), keys, attrs))
    out = _kept(derive(out).withColumn(BUCKET, bucket), "dim-folders")
    done["folders_written"] = out.select(BUCKET).distinct().count()
    (out.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *keys, "effective_date").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(dim_path))
    spark.createDataFrame([(r,) for r in runs], "run_id string").write.mode("append").parquet(applied_path(dim_path))
    return done


def _versions(points: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """Versions from one row per key and day; each remembers the last day seen of its key. A closed
    version that passes a refresh keeps an older such day; the current one's counts."""
    seen = points.groupBy(*keys).agg(F.max("effective_date").alias(SEEN))
    return scd.versions(points, keys, attrs).join(seen, keys)


# --- facts by month (M8-M13) ---------------------------------------------------------------


def _month(date_col: str) -> F.Column:
    """Label of a row's month; rows without a date share one."""
    return F.coalesce(K.month_label(F.to_date(date_col)), F.lit(NO_MONTH))


NO_MONTH = "none"


def refresh_months(spark: SparkSession, fact_path: str, rows: DataFrame, date_col: str, build: Callable[[DataFrame], DataFrame],
                   own: DataFrame, members: dict[str, tuple[DataFrame, Callable[[DataFrame], DataFrame]]], sort: list[str]) -> dict:
    """Write again those months of a fact that a refresh can change; returns what was done.

    ``rows`` are the fact's staged rows, ``build`` makes facts of any of them and keeps ``date_col``.
    ``own`` is the change log of the rows themselves: its new runs' rows name months. ``members`` maps
    a name to a dimension's change log and a function from that log's new rows to the members they
    touch, as a frame whose columns are named as in ``rows``: months with facts of such a member are
    affected too, since it may have got another version. The fact has a mark of the runs it has seen of
    each log, so a refresh that died is taken up by the next one. Months of the list are replaced one
    by one (dynamic partition overwrite), all others keep their files.
    """
    logs = {"own": own, **{name: log for name, (log, _) in members.items()}}
    marks = {name: f"{fact_path.rstrip('/')}.{name}" for name in logs}
    runs = {name: new_runs(spark, log, marks[name]) for name, log in logs.items()}
    done = {"runs": sum(map(len, runs.values())), "months": []}
    if not done["runs"]:
        return done
    labelled = rows.withColumn("__month", _month(date_col))
    if read_or_none(spark, fact_path) is None:
        part = labelled
    else:
        months = own.filter(F.col("run_id").isin(runs["own"])).select(_month(date_col).alias("__month"))
        for name, (log, touched) in members.items():
            if runs[name]:
                keys = touched(log.filter(F.col("run_id").isin(runs[name]))).distinct()
                months = months.unionByName(labelled.join(keys, keys.columns, "left_semi").select("__month"))
        affected = sorted(r[0] for r in months.distinct().collect())  # bounded by the calendar
        part = labelled.filter(F.col("__month").isin(affected))
    facts = _kept(build(part.drop("__month")).withColumn("ym", _month(date_col)), "fact-months")
    done["months"] = sorted(r.ym for r in facts.select("ym").distinct().collect())
    (facts.hint("rebalance", "ym").sortWithinPartitions("ym", *sort).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("ym").parquet(fact_path))
    for name, own_runs in runs.items():
        if own_runs:
            spark.createDataFrame([(r,) for r in own_runs], "run_id string").write.mode("append").parquet(applied_path(marks[name]))
    return done
