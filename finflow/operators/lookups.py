"""Dimension lookups: type-1 key lookups and point-in-time (SCD2) lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finflow.operators.scd import OPEN_END


#: Tasks among which facts without a key are dealt in a join.
SPREAD = 1 << 10


def _spread(fact: DataFrame, key: str) -> Column:
    """0 for a fact with a key, for one without a number by its first columns (its id, as a rule): such
    facts match nothing, but by the key alone they would all meet in one task."""
    own = [f.name for f in fact.schema if f.name != key and "map<" not in f.dataType.simpleString() and not isinstance(f.dataType, T.VariantType)]
    by = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in own[:3]]), F.lit(SPREAD)).cast("int") if own else F.lit(0)
    return F.when(F.col(key).isNull(), by).otherwise(F.lit(0))


def _nought(dim_key: str) -> Column:
    """0 in every row of a dimension (a literal would be folded and be no key of the join)."""
    return F.pmod(F.xxhash64(dim_key), F.lit(1)).cast("int")


def lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           take: dict[str, str], how: str = "left") -> DataFrame:
    """Resolve ``fact_key`` against a type-1 dimension; ``take`` maps dim column ->
    output name. Whether the dimension is broadcast is the optimizer's choice, by its
    size on storage or, for a computed one, by what AQE measures. Facts without a key
    are dealt among the tasks."""
    cols = [F.col(dim_key).alias("__dk")] + [F.col(c).alias(o) for c, o in take.items()]
    cond = (F.col(fact_key) == F.col("__dk")) & (F.col("__spread") == _nought("__dk"))
    return fact.withColumn("__spread", _spread(fact, fact_key)).join(dim.select(*cols), cond, how).drop("__dk", "__spread")


def inner_join_non_null(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Inner equi-join keeping rows whose dimension key is not null."""
    d = dim.filter(F.col(dim_key).isNotNull())
    return fact.join(d, F.col(fact_key) == F.col(dim_key), "inner")


def members_of(dim: DataFrame, dim_key: str, fact: DataFrame, fact_key: str) -> DataFrame:
    """The dimension's rows of members that occur in ``fact``, for facts over few of a large dimension's
    members: what no fact asks for need not be moved by the joins. Reads the facts' key once more."""
    own = fact.select(F.col(fact_key).alias(dim_key)).filter(F.col(dim_key).isNotNull()).distinct()
    return dim.join(own, dim_key, "left_semi").select(*dim.columns)


def point_in_time(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                  fact_date: str | Column, take: dict[str, str],
                  eff: str = "effective_date", exp: str = "expiry_date",
                  how: str = "left", open_start: bool = False) -> DataFrame:
    """The dimension version valid on ``fact_date``.

    The equality on the business key keeps this a hash / sort-merge join (no theta
    join); the validity range is a residual filter. Versions of one key are disjoint,
    so at most one matches. AQE's skew-join splits a fact-side hot key; facts without a
    key are dealt among the tasks (not with ``open_start``).

    ``open_start`` lets a member's first version also cover earlier dates, so facts that
    predate the member's first load (late-arriving dimension rows) still resolve. The
    per-key minimum is a window over the dimension, partitioned by the join key, so the
    dimension side needs no further shuffle for the join.
    """
    fd = F.col(fact_date) if isinstance(fact_date, str) else fact_date
    start = F.col(eff)
    if open_start:
        first = F.min(eff).over(Window.partitionBy(dim_key))
        start = F.when(F.col(eff) == first, F.lit("0001-01-01").cast("date")).otherwise(F.col(eff))
    cols = ([F.col(dim_key).alias("__dk"), start.alias("__eff"),
             F.coalesce(F.col(exp), F.lit(OPEN_END).cast("date")).alias("__exp")]
            + [F.col(c).alias(o) for c, o in take.items()])
    d = dim.select(*cols)
    d_day = F.to_date(fd)
    cond = (F.col(fact_key) == F.col("__dk")) & (d_day >= F.col("__eff")) & (d_day <= F.col("__exp"))
    if not open_start:  # (the window's partitions are those of the join by the key alone)
        fact, cond = fact.withColumn("__spread", _spread(fact, fact_key)), cond & (F.col("__spread") == _nought("__dk"))
    return fact.join(d, cond, how).drop("__dk", "__eff", "__exp", "__spread")


def point_in_time_by_month(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_date: str | Column,
                           take: dict[str, str], eff: str = "effective_date", exp: str = "expiry_date",
                           open_start: bool = False) -> DataFrame:
    """J8 for members with very many versions: facts and versions meet by key *and* month.

    A version stands in every month of the facts' span that it touches, so a fact is compared with
    the versions of its own month, at most one a day, where ``point_in_time`` compares it with all
    versions of its key; and a hot key's facts are spread over its months. The dimension grows to a
    row per key and month at least, so it is for dimensions whose versions outnumber the months.
    Facts without a match (or with a null key or date) keep nulls. The result is ``point_in_time``'s.
    """
    day = F.to_date(F.col(fact_date) if isinstance(fact_date, str) else fact_date)
    span = fact.agg(F.min(day).alias("__lo"), F.max(day).alias("__hi"))  # one row
    start = F.col(eff)
    if open_start:
        first = F.min(eff).over(Window.partitionBy(dim_key))
        start = F.when(F.col(eff) == first, F.lit("0001-01-01").cast("date")).otherwise(F.col(eff))
    d = dim.select(F.col(dim_key).alias("__dk"), start.alias("__eff"), F.coalesce(F.col(exp), F.lit(OPEN_END).cast("date")).alias("__exp"),
                   *[F.col(c).alias(o) for c, o in take.items()])
    within = (F.col("__eff") <= F.col("__hi")) & (F.col("__exp") >= F.col("__lo")) & (F.col("__exp") >= F.col("__eff"))
    months = F.sequence(F.trunc(F.greatest("__eff", "__lo"), "MM"), F.trunc(F.least("__exp", "__hi"), "MM"), F.expr("INTERVAL 1 MONTH"))
    d = d.join(F.broadcast(span), within).withColumn("__month", F.explode(months)).drop("__lo", "__hi")
    cond = ((F.col(fact_key) == F.col("__dk")) & (F.trunc(day, "MM") == F.col("__month"))
            & (day >= F.col("__eff")) & (day <= F.col("__exp")))
    return fact.join(d, cond, "left").drop("__dk", "__eff", "__exp", "__month")
