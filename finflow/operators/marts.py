"""Marts and dashboard tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def asof_or_max(df: DataFrame, date_col: str, asof=None) -> Column:
    """The reference day for relative windows: a given date, else the data's latest day
    (an uncorrelated scalar subquery, evaluated once and broadcast)."""
    if asof is not None:
        return F.lit(asof).cast("date") if not isinstance(asof, Column) else asof
    return df.select(F.max(F.to_date(date_col))).scalar()


def daily_count_sum(df: DataFrame, date_col: str, amount_col: str, days: int | None,
                    asof=None, out_date: str = "day", out_count: str = "n",
                    out_sum: str = "total", month_partition: str | None = None) -> DataFrame:
    """G1: per day count and decimal sum over the last ``days`` days (all days if None),
    newest first.

    ``month_partition`` names a ``YYYY_MM`` partition column of ``df``: the date window is
    then also stated on it, so the scan prunes whole months (Spark does not derive a
    partition predicate from a predicate on another column). Out-of-calendar labels such
    as ``default`` sort after every month and are always read.
    """
    d = F.to_date(date_col)
    src = df
    if days is not None:
        ref = asof_or_max(df, date_col, asof)
        lo = F.date_sub(ref, days)
        src = df.filter(d >= lo)
        if month_partition:
            src = src.filter(F.col(month_partition) >= F.date_format(lo, "yyyy_MM"))
    return (src.groupBy(d.alias(out_date))
               .agg(F.count(F.lit(1)).alias(out_count),
                    F.sum(_c(amount_col)).alias(out_sum))
               .orderBy(F.col(out_date).desc()))


def daily_count(df: DataFrame, date_col: str, days: int | None, asof=None,
                out_date: str = "day", out_count: str = "n") -> DataFrame:
    """G2 (after the J3 join): count per day over the last ``days`` days."""
    d = F.to_date(date_col)
    ref = asof_or_max(df, date_col, asof)
    return (df.filter(d >= F.date_sub(ref, days)).groupBy(d.alias(out_date))
              .agg(F.count(F.lit(1)).alias(out_count)).orderBy(F.col(out_date).desc()))


def recent_group_stats(df: DataFrame, group_col: str, ts_col: str, value_col: str,
                       days: int, asof=None) -> DataFrame:
    """Per group latest event and average value over the last ``days`` days.

    ``asof`` is a timestamp; default the latest event. Average is computed from a
    decimal sum so it does not depend on summation order.
    """
    if asof is None:
        ref = df.select(F.max(ts_col)).scalar()
    else:
        ref = F.lit(asof).cast("timestamp_ntz")
    v = _c(value_col).cast("decimal(18,2)")
    return (df.filter(F.col(ts_col) >= ref - F.expr(f"INTERVAL {int(days)} DAYS"))
              .groupBy(group_col)
              .agg(F.max(ts_col).alias("latest_event"),
                   (F.sum(v).cast("double") / F.count(v)).alias("avg_value"))
              .orderBy(F.col("latest_event").desc()))


def monthly_sum(df: DataFrame, date_col: str, amount_col: str) -> DataFrame:
    """Month start, decimal sum and row count."""
    m = F.trunc(F.to_date(date_col), "MM")
    return (df.groupBy(m.alias("month"))
              .agg(F.sum(_c(amount_col)).alias("total_amount"),
                   F.count(F.lit(1)).alias("n_rows")))


def monthly_rollup(df: DataFrame, date_col: str, amount_col: str) -> DataFrame:
    """G7 with subtotals: (year, month), per-year and grand totals in one aggregation
    (``rollup`` expands each row to three grouping sets before the partial aggregate)."""
    d = F.to_date(date_col)
    return (df.rollup(F.year(d).alias("year"), F.month(d).alias("month"))
              .agg(F.sum(_c(amount_col)).alias("total_amount"), F.count(F.lit(1)).alias("n_rows")))


def runs_by_status(runs: DataFrame) -> DataFrame:
    """G4."""
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("runs"))


def run_rates(runs: DataFrame) -> DataFrame:
    """Success / failure rate over SUCCESS + FAILED runs in percent (2 decimals), 0
    when there are none; plus total and latest rows loaded (W3)."""
    ok = F.sum(F.when(F.col("status") == "SUCCESS", 1).otherwise(0))
    bad = F.sum(F.when(F.col("status") == "FAILED", 1).otherwise(0))
    tot = ok + bad

    def rate(x):
        return F.coalesce(F.round(x.cast("double") * 100.0 / F.nullif(tot, F.lit(0)), 2), F.lit(0.0))

    return runs.agg(
        F.count(F.lit(1)).alias("total_runs"),
        rate(ok).alias("success_rate"),
        rate(bad).alias("failure_rate"),
        F.max_by("rows_loaded", F.struct("run_timestamp", "rows_loaded")).alias("latest_rows_loaded"))


def newest(runs: DataFrame, n: int, ts_col: str = "run_timestamp",
           tiebreak: list[str] | None = None) -> DataFrame:
    """The newest ``n`` rows (TakeOrdered: a bounded top-k per task)."""
    order = [F.col(ts_col).desc()] + [F.col(t).desc() for t in (tiebreak or [])]
    return runs.orderBy(*order).limit(n)


def last_n_ascending(runs: DataFrame, n: int, ts_col: str = "run_timestamp",
                     tiebreak: list[str] | None = None) -> DataFrame:
    """Last ``n`` runs re-sorted ascending with a text label."""
    top = newest(runs, n, ts_col, tiebreak)
    return (top.withColumn("run_label", F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss"))
               .orderBy(F.col(ts_col).asc(), *[F.col(t).asc() for t in (tiebreak or [])]))


def series(runs: DataFrame, cols: list[str], ts_col: str = "run_timestamp") -> DataFrame:
    """Time-ordered series (range-partitioned sort, no single-task collect)."""
    return runs.select(ts_col, *cols).orderBy(ts_col)
