"""The one cleaning path shared by batch files and stream micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finflow import schemas
from finflow.functions import normalize as N
from finflow.functions import rules as R
from finflow.operators import quality as Q

# Columns added by readers that describe where a row came from; never part of row identity.
LINEAGE = ("source_file", "event_type", "_corrupt_record", "row_pos")


def _date_columns(dataset: str) -> dict[str, T.DataType]:
    out = {"date_of_birth": T.DateType(), "sale_date": T.TimestampNTZType()}
    target = schemas.STAGING.get(dataset)
    if target is not None:
        for f in target.fields:
            if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
                out[f.name] = f.dataType
    return out


def clean(df: DataFrame, dataset: str, extra_rules: list[R.Rule] | None = None,
          dedupe: bool = True, optional: tuple[str, ...] = ()) -> DataFrame:
    """Clean one dataset's rows and flag rule violations.

    Exact duplicates (within a source file, when ``source_file`` is present) and all-null
    rows are dropped; aliases renamed; names split; statuses recoded; text trimmed;
    e-mail lower-cased and ``@``-less rows removed; dates parsed in several formats;
    ``*price*`` / ``*amount*`` columns typed as DECIMAL(18,2); then the categorical rules
    (and any ``extra_rules``) give ``violations`` and ``is_dirty``. Nothing leaves the JVM.
    ``optional`` columns may be null under their categorical rule (a stream row carries all
    columns of its dataset, also those its messages need not have).
    """
    data_cols = [c for c in df.columns if c not in LINEAGE]
    if dedupe:
        subset = data_cols + (["source_file"] if "source_file" in df.columns else [])
        if "row_pos" in df.columns:
            # keep the earliest copy, so "first row wins" later still sees file order
            df = df.groupBy(*[F.col(f"`{c}`") for c in subset]).agg(F.min("row_pos").alias("row_pos"))
        else:
            df = df.dropDuplicates(subset)
    df = df.dropna(how="all", subset=[f"`{c}`" for c in data_cols])
    df = N.apply_aliases(df, dataset)
    if dataset == "customers":
        df = N.split_name(df)
    df = N.recode_status(df, dataset)
    df = N.trim_strings(df)
    if "email" in df.columns:
        df = Q.keep_valid_email(N.lower_email(df))
    dates = {}
    for c, t in _date_columns(dataset).items():
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            dates[c] = N.parse_date(c) if isinstance(t, T.DateType) else N.parse_timestamp(c)
    if dates:
        df = df.withColumns(dates)
    money = {c: N.to_money(c) for c in N.money_columns(df.columns)
             if not isinstance(df.schema[c].dataType, T.DecimalType)}
    if money:
        df = df.withColumns(money)
    df = N.with_dirty_flag(df)
    rules = R.categorical_rules(dataset, optional=optional) + list(extra_rules or [])
    return R.evaluate(df, rules)
