"""Row and batch quality operators (Q1-Q13, Q17-Q18, Q23)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Q1. Two all-null rows are duplicates, as in the source semantics."""
    return df.dropDuplicates()


def drop_all_null(df: DataFrame) -> DataFrame:
    """Q2."""
    return df.dropna(how="all")


def keep_valid_email(df: DataFrame, col: str = "email") -> DataFrame:
    """Q3. Null or ``@``-less addresses are removed (null -> filter false)."""
    return df.filter(F.col(col).contains("@")) if col in df.columns else df


def split_clean_dirty(df: DataFrame, flag: str = "is_dirty") -> tuple[DataFrame, DataFrame]:
    """Q5. Both sides come from one plan; persist ``df`` first when both are consumed."""
    dirty = F.coalesce(F.col(flag), F.lit(False))
    return df.filter(~dirty), df.filter(dirty)


def batch_profile(df: DataFrame, batch_col: str, columns: list[str] | None = None,
                  critical: list[str] | None = None) -> DataFrame:
    """Q6-Q8, Q10 in one scan: per batch (file) row count, per-column nulls, duplicates.

    A row crosses the network as its 128-bit hash and its null mask, never with its
    columns: copies within a batch meet by (batch, hash) after map-side counting, and a
    second aggregation folds the distinct rows into the batch's metrics.
    """
    cols = [c for c in (columns or df.columns) if c != batch_col]
    quoted = [F.col(f"`{c}`") for c in cols]
    # xxhash64 skips nulls, so the mask that tells their places is hashed too.
    mask = F.concat(F.lit(""), *[F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in quoted])
    hashed = df.select(F.col(batch_col), mask.alias("__mask"), *quoted).select(
        batch_col, "__mask", F.xxhash64("__mask", *quoted).alias("__h1"),
        F.xxhash64(F.lit(7), "__mask", *reversed(quoted)).alias("__h2"))
    distinct_rows = hashed.groupBy(batch_col, "__h1", "__h2", "__mask").agg(F.count(F.lit(1)).alias("__n"))
    n = F.col("__n")
    null_aggs = [F.sum(F.when(F.substring("__mask", i + 1, 1) == "1", n).otherwise(0)).alias(f"nulls__{c}")
                 for i, c in enumerate(cols)]
    prof = distinct_rows.groupBy(batch_col).agg(
        F.sum(n).alias("row_count"),
        F.sum(n - 1).alias("duplicate_records"),
        *null_aggs,
    )
    null_cols = [F.col(f"`nulls__{c}`") for c in cols]
    total = null_cols[0] if null_cols else F.lit(0)
    for c in null_cols[1:]:
        total = total + c
    crit = [c for c in (critical or []) if c in cols]
    crit_map = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(c) for c in crit]).cast("array<string>"),
                          F.array(*[F.col(f"`nulls__{c}`") for c in crit]).cast("array<bigint>")),
        lambda k, v: v > 0)
    return prof.select(
        batch_col, "row_count", "duplicate_records",
        total.cast("bigint").alias("total_null_values"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                          F.array(*null_cols)).alias("null_value_counts"),
        crit_map.alias("critical_null_violations"),
    )


def unique_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Q17. Keys that occur more than once, with their multiplicity."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Q18. Child rows whose non-null FK has no parent (a null FK is allowed)."""
    p = parent.select(F.col(parent_key).alias("__pk"))  # an anti join needs no distinct parents
    return (child.filter(F.col(child_key).isNotNull())
                 .join(p, F.col(child_key) == F.col("__pk"), "left_anti"))


def null_violations(df: DataFrame, mandatory: list[str]) -> Column:
    """Q23. Array of mandatory columns that are null in the row."""
    from finflow.functions.rules import compact
    return compact(*[F.when(F.col(c).isNull(), F.lit(c)) for c in mandatory])


def rule_totals(df: DataFrame, rules: list) -> DataFrame:
    """Violations per rule, zero included: one aggregation pass, then an unpivot of the
    single result row (``rules`` are :class:`finflow.functions.rules.Rule`)."""
    aggs = [F.sum(F.when(r.violated(), 1).otherwise(0)).cast("bigint").alias(r.name) for r in rules]
    wide = df.agg(*aggs)
    return wide.unpivot([], [F.col(f"`{r.name}`") for r in rules], "rule_name", "n_violations")
