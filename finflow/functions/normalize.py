"""Normalisation expressions: file-name inference, renames, text, dates, money."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finflow import schemas


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- B1: dataset from file name ------------------------------------------------

def file_stem(path) -> Column:
    """Lower-cased base name without its last extension.

    Part files written by an engine (``part-*``) carry no name of their own; their
    folder's name is used instead.
    """
    parts = F.split(_c(path), "/")
    base = F.element_at(parts, -1)
    named = F.when(base.startswith("part-"), F.element_at(parts, -2)).otherwise(base)
    return F.lower(F.regexp_replace(named, r"\.[^.]*$", ""))


def normalised_stem(path) -> Column:
    """Stem without trailing ``_<4..14 digits>`` groups and one known suffix."""
    stem = F.regexp_replace(file_stem(path), r"(_[0-9]{4,14})+$", "")
    suffixes = "|".join(schemas.STEM_SUFFIXES)
    return F.regexp_replace(stem, f"_({suffixes})$", "")


def infer_dataset(path) -> Column:
    """Exact dataset name, else first alias contained in the stem (list order), else the stem."""
    stem = normalised_stem(path)
    expr = F.when(stem.isin(schemas.DATASETS), stem)
    for dataset, aliases in schemas.TABLE_ALIASES:
        hit = None
        for alias in aliases:
            cond = stem.contains(alias)
            hit = cond if hit is None else (hit | cond)
        expr = expr.when(hit, F.lit(dataset))
    return expr.otherwise(stem)


def dataset_is_known(dataset) -> Column:
    return _c(dataset).isin(schemas.DATASETS)


# --- B2: alias renames (driver-side mapping over column names, no job) ----------

def is_null_word(col) -> Column:
    """Text that the tabular readers take for a missing value (exact spelling)."""
    return _c(col).isin(schemas.NULL_WORDS)


def null_words(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing-value words of CSV and workbook cells become nulls."""
    return df.withColumns({c: F.when(~is_null_word(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in columns})


def alias_renames(columns: list[str], dataset: str) -> dict[str, str]:
    """Source -> canonical renames; a target already present blocks it; first alias wins."""
    present = set(columns)
    out: dict[str, str] = {}
    for src, dst in schemas.COLUMN_ALIASES.get(dataset, []):
        if src in present and dst not in present and dst not in out.values():
            out[src] = dst
    return out


def apply_aliases(df: DataFrame, dataset: str) -> DataFrame:
    renames = alias_renames(df.columns, dataset)
    return df.withColumnsRenamed(renames) if renames else df


# --- B3: split a full name ---------------------------------------------------------

def first_token(name) -> Column:
    return F.get(F.split(F.trim(_c(name)), r"\s+"), 0)


def rest_tokens(name) -> Column:
    parts = F.split(F.trim(_c(name)), r"\s+")
    return F.array_join(F.slice(parts, 2, F.size(parts) - 1), " ")


def split_name(df: DataFrame, name_col: str = "name") -> DataFrame:
    if name_col not in df.columns:
        return df
    add = {}
    if "first_name" not in df.columns:
        add["first_name"] = first_token(name_col)
    if "last_name" not in df.columns:
        add["last_name"] = rest_tokens(name_col)
    return df.withColumns(add) if add else df


# --- B4 / B5: status recode ----------------------------------------------------------

def recode(col, mapping: dict[str, str]) -> Column:
    """Map ``lower(trim(col))`` through ``mapping``; unknown and null values are kept."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(F.try_element_at(m, F.lower(F.trim(_c(col)))), _c(col))


def recode_status(df: DataFrame, dataset: str) -> DataFrame:
    if "status" not in df.columns:
        return df
    if dataset == "payments":
        return df.withColumn("status", recode("status", schemas.PAYMENT_STATUS_MAP))
    if dataset == "procurement":
        return df.withColumn("status", recode("status", schemas.PROCUREMENT_STATUS_MAP))
    return df


# --- B6 / B7: text -------------------------------------------------------------------

def trim_strings(df: DataFrame) -> DataFrame:
    cols = {f.name: F.trim(F.col(f"`{f.name}`")) for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)}
    return df.withColumns(cols) if cols else df


def lower_email(df: DataFrame, col: str = "email") -> DataFrame:
    return df.withColumn(col, F.lower(col)) if col in df.columns else df


# --- B8: dates -------------------------------------------------------------------------

# Year-first text with an optional time, fraction and zone.
ISO_SHAPE = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?\s?(Z|z|[+-]\d{2}(:?\d{2})?)?)?$")
ZONE = r"\s?([+-])(\d{2}):?(\d{2})?$"


def parse_timestamp(col) -> Column:
    """Text of the accepted shapes as a timestamp without zone; anything else is null.

    The shape decides how the text is read, so a value is cast once: ISO dates and times
    (fractions kept to the microsecond, a zone's offset taken off, so the value is UTC),
    ``yyyy/MM/dd``, and month before day (``MM/dd/yyyy``, ``MM-dd-yyyy``), as tabular readers
    take an ambiguous date; where that is no date, day before month. Impossible dates are null.
    """
    c = F.trim(_c(col).cast("string"))
    iso = c.rlike(ISO_SHAPE)
    zoned = iso & c.rlike(r":\d{2}([.,]\d+)?\s?([Zz]|[+-]\d{2}(:?\d{2})?)$")
    wall = F.regexp_replace(F.regexp_replace(c, r"\s?([Zz]|[+-]\d{2}(:?\d{2})?)$", ""), r"[.,](\d{1,6})\d*$", ".$1")
    plain = F.regexp_replace(c, r"[.,](\d{1,6})\d*$", ".$1")
    sign = F.when(F.regexp_extract(c, ZONE, 1) == "-", -1).otherwise(1)
    minutes = sign * (F.coalesce(F.regexp_extract(c, ZONE, 2).try_cast("int"), F.lit(0)) * 60
                      + F.coalesce(F.regexp_extract(c, ZONE, 3).try_cast("int"), F.lit(0)))
    ntz = T.TimestampNTZType()
    day_first = F.regexp_replace(c, r"^(\d{2})[-/](\d{2})[-/](\d{4})$", "$3-$2-$1").try_cast(ntz)
    month_first = F.regexp_replace(c, r"^(\d{2})[-/](\d{2})[-/](\d{4})$", "$3-$1-$2").try_cast(ntz)
    return (F.when(zoned, wall.try_cast(ntz) - F.make_dt_interval(mins=minutes))
             .when(iso, plain.try_cast(ntz))
             .when(c.rlike(r"^\d{4}/\d{2}/\d{2}$"), F.translate(c, "/", "-").try_cast(ntz))
             .when(c.rlike(r"^\d{2}(-\d{2}-|/\d{2}/)\d{4}$"), F.coalesce(month_first, day_first)))


def parse_date(col) -> Column:
    return F.to_date(parse_timestamp(col))


# --- B9: money ---------------------------------------------------------------------------

def to_money(col, precision: int = 18, scale: int = 2) -> Column:
    return F.trim(_c(col).cast("string")).try_cast(T.DecimalType(precision, scale))


def money_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if "price" in c or "amount" in c]


# --- B10 / B11 / B12 -----------------------------------------------------------------------

def with_dirty_flag(df: DataFrame) -> DataFrame:
    return df if "is_dirty" in df.columns else df.withColumn("is_dirty", F.lit(False))


def nan_to_null(df: DataFrame) -> DataFrame:
    cols = {f.name: F.when(F.isnan(f.name), F.lit(None)).otherwise(F.col(f.name))
            for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(cols) if cols else df


def align_to_target(df: DataFrame, target: T.StructType) -> DataFrame:
    """Keep the columns shared with ``target`` in source order, typed with ``try_cast``."""
    types = {f.name: f.dataType for f in target.fields}
    out = []
    for c in df.columns:
        if c in types:
            src = df.schema[c].dataType
            dst = types[c]
            if src == dst:
                out.append(F.col(c))
            elif isinstance(dst, (T.TimestampType, T.TimestampNTZType)) and isinstance(src, T.StringType):
                out.append(parse_timestamp(c).alias(c))
            elif isinstance(dst, T.DateType) and isinstance(src, T.StringType):
                out.append(parse_date(c).alias(c))
            else:
                out.append(F.col(c).try_cast(dst).alias(c))
    return df.select(*out)


# --- B15 / B16 / B17: derived money and names -------------------------------------------

def net_price(price, discount) -> Column:
    return _c(price) - F.coalesce(_c(discount), F.lit(0))


def full_name(first, last) -> Column:
    return F.concat_ws(" ", _c(first), _c(last))
