"""Stable keys: surrogate hashes and calendar keys (M1, M7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*cols) -> Column:
    """Deterministic 64-bit key from business columns (order-independent of the run).

    A global ``row_number`` would funnel every row through one task; a hash keeps the
    assignment parallel. Collisions are caught by the unique-key check (Q17).
    """
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])


def date_key(col) -> Column:
    """``yyyyMMdd`` as an integer."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_label(col) -> Column:
    """``YYYY_MM`` partition label."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy_MM")


def hour_start(col) -> Column:
    """Start of the hour of a zone-less timestamp, computed on its wall-clock fields
    (``date_trunc`` would pass through the session time zone)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c),
                                F.lit(0), F.lit(0))
