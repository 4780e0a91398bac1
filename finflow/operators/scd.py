"""Slowly changing dimensions: type 1 and type 2 (M2-M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finflow.operators.staging import keys_present

OPEN_END = "9999-12-31"


def latest_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Type 1: the newest row per key on a total ``order`` (partial aggregation, skew-safe)."""
    others = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), ordering).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in others])


def scd2_from_history(history: DataFrame, keys: list[str], attrs: list[str], ts_col: str,
                      tiebreak: list | None = None) -> DataFrame:
    """Type 2 versions from a change history.

    1. Several changes on one day keep the last of the day on (ts, tiebreak...), so
       (key, effective_date) is unique. This is a grouped ``max_by``: a key holding a
       third of all rows is reduced map-side and leaves at most one row per day.
    2. A version starts where the attribute struct differs (null-safe) from the previous
       day's; expiry is the next version's start minus one day, open when current.

    The window only sees per-day rows, so its partitions are bounded by the calendar.
    """
    return versions(daily_points(history, keys, attrs, ts_col, tiebreak), keys, attrs)


def daily_points(history: DataFrame, keys: list[str], attrs: list[str], ts_col: str, tiebreak: list | None = None) -> DataFrame:
    """keys, effective_date and ``__a``, the attributes of the day's last change."""
    tb = [F.col(t) if isinstance(t, str) else t for t in (tiebreak or [])]
    order = F.struct(F.col(ts_col), *tb)
    days = history.filter(keys_present(keys) & F.col(ts_col).isNotNull()).groupBy(*keys, F.to_date(ts_col).alias("effective_date"))
    if set(attrs) <= {t for t in [ts_col, *(tiebreak or [])] if isinstance(t, str)}:
        last = days.agg(F.max(order).alias("__o"))  # the order holds the attributes: they need not travel twice
        return last.select(*keys, "effective_date", F.struct(*[F.col(f"__o.`{a}`").alias(a) for a in attrs]).alias("__a"))
    return days.agg(F.max_by(F.struct(*[F.col(a) for a in attrs]), order).alias("__a"))


def versions(daily: DataFrame, keys: list[str], attrs: list[str]) -> DataFrame:
    """Closed and current versions from one row (``__a``: its attributes) per key and day."""
    w = Window.partitionBy(*keys).orderBy("effective_date")
    changed = (daily.withColumn("__prev", F.lag("__a").over(w))
               .filter(F.col("__prev").isNull() | ~F.col("__a").eqNullSafe(F.col("__prev"))))
    nxt = F.lead("effective_date").over(w)
    return changed.withColumn("__next", nxt).select(
        *keys, *[F.col(f"__a.{a}").alias(a) for a in attrs],
        "effective_date",
        F.date_sub("__next", 1).alias("expiry_date"),
        F.col("__next").isNull().alias("is_current"))


def scd2_merge(dim: DataFrame, incoming: DataFrame, keys: list[str], attrs: list[str],
               eff_col: str = "effective_date") -> DataFrame:
    """M4: apply dated incoming rows (one or more per key) to an SCD2 dimension.

    A key that changed has its version closed on the day before the new one starts; new
    keys get a first version; a row dated on a version's own start day corrects it; a row
    older than the current version (late data) is put into its place in the history, and
    the versions around it are closed accordingly. Unchanged rows add nothing. Keys
    without an incoming row pass through untouched.

    A dimension does not remember rows that confirmed what was already current, so a late
    row lasts until the next known change; ``scd2_refresh`` works from the change log.
    """
    new = incoming.filter(keys_present(keys)).select(*keys, F.col(eff_col).alias("effective_date"),
                                                     F.struct(*[F.col(a) for a in attrs]).alias("__a"))
    touched = new.select(*keys).distinct()
    old = dim.select(*keys, F.col(eff_col).alias("effective_date"), F.struct(*[F.col(a) for a in attrs]).alias("__a"))
    points = (old.join(touched, keys, "left_semi").withColumn("__new", F.lit(0))
              .unionByName(new.withColumn("__new", F.lit(1))))
    daily = points.groupBy(*keys, "effective_date").agg(F.max_by("__a", F.struct("__new", "__a")).alias("__a"))
    return _passed_on(dim, touched, keys, attrs, eff_col).unionByName(
        versions(daily, keys, attrs).withColumnRenamed("effective_date", eff_col))


def scd2_refresh(dim: DataFrame, log: DataFrame, new: DataFrame, keys: list[str], attrs: list[str],
                 ts_col: str, tiebreak: list | None = None) -> DataFrame:
    """M4 from a change log: the versions of every key in ``new`` are built again from its
    whole history in ``log`` (which holds ``new``), all other keys pass through. The
    result equals one build over the whole log, in whatever order the changes came."""
    touched = new.filter(keys_present(keys)).select(*keys).distinct()
    rebuilt = scd2_from_history(log.join(touched, keys, "left_semi"), keys, attrs, ts_col, tiebreak)
    return _passed_on(dim, touched, keys, attrs).unionByName(rebuilt)


def _passed_on(dim: DataFrame, touched: DataFrame, keys: list[str], attrs: list[str],
               eff_col: str = "effective_date") -> DataFrame:
    return dim.join(touched, keys, "left_anti").select(
        *keys, *attrs, eff_col, F.col("expiry_date").cast("date").alias("expiry_date"), "is_current")
