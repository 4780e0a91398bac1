"""Declarative quality rules compiled to one violation-array expression (Q4, Q16-Q23)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finflow import schemas


@dataclass(frozen=True)
class Rule:
    """A predicate every row must satisfy.

    ``check`` is a SQL boolean expression (string) or a Column. As in an SQL CHECK
    constraint a NULL result passes, unless ``null_fails`` is set (NOT NULL and
    categorical membership). ``columns`` lists the inputs; a rule whose inputs are
    absent from the frame is skipped.
    """

    name: str
    check: object
    columns: tuple[str, ...] = field(default_factory=tuple)
    null_fails: bool = False

    def expr(self) -> Column:
        return F.expr(self.check) if isinstance(self.check, str) else self.check

    def violated(self) -> Column:
        return ~F.coalesce(self.expr(), F.lit(not self.null_fails))


def categorical_rules(dataset: str | None = None, rules: dict | None = None,
                      optional: tuple[str, ...] = ()) -> list[Rule]:
    table = dict(rules if rules is not None else schemas.CATEGORICAL_RULES)
    if dataset in schemas.STATUS_OVERRIDES and rules is None:
        table["status"] = schemas.STATUS_OVERRIDES[dataset]
    return [Rule(f"{col}_not_allowed", F.col(col).isin(vals), (col,), null_fails=col not in optional)
            for col, vals in table.items()]


def not_null(*cols: str) -> list[Rule]:
    return [Rule(f"{c}_is_null", F.col(c).isNotNull(), (c,), null_fails=True) for c in cols]


def domain_rules(dataset: str, now=None) -> list[Rule]:
    """Q16, Q19, Q21-Q23: a dataset's constraints on its own rows: keys not null, value
    ranges, text lengths and formats. ``now`` adds the rule that an interaction lies before it."""
    key = schemas.STAGING[dataset].fields[0].name
    out = not_null(key)
    out += [Rule(n, check, tuple(cols)) for n, (check, cols) in schemas.ROW_CHECKS.get(dataset, {}).items()]
    out += [Rule(f"{c}_length", F.length(F.col(c)) <= most, (c,)) for c, most in schemas.MAX_LENGTHS.get(dataset, {}).items()]
    if now is not None and dataset == "interactions":
        out.append(Rule("interaction_in_the_past", F.col("interaction_date") < F.lit(now).cast("timestamp_ntz"), ("interaction_date",)))
    return out


def table_rules(table: str) -> list[Rule]:
    """Q16: constraints of a star-schema table."""
    return [Rule(f"{table}.{n}", check) for n, check in schemas.TABLE_CHECKS[table].items()]


def applicable(rules: list[Rule], columns: list[str]) -> list[Rule]:
    have = set(columns)
    return [r for r in rules if all(c in have for c in r.columns)]


def compact(*items: Column) -> Column:
    """``array(items)`` without nulls, in order.

    ``array_except`` against ``[null]`` stays inside whole-stage codegen, unlike
    ``array_compact`` (a lambda ``filter``, which is interpreted per row). It also drops
    repeats, which never occur among distinct rule names.
    """
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))


def violations(rules: list[Rule]) -> Column:
    """Array of names of violated rules (empty array when the row is clean)."""
    if not rules:
        return F.array().cast("array<string>")
    return compact(*[F.when(r.violated(), F.lit(r.name)) for r in rules])


def evaluate(df: DataFrame, rules: list[Rule], out: str = "violations") -> DataFrame:
    """Add ``violations`` and fold it into ``is_dirty`` (a prior dirty flag is kept)."""
    rs = applicable(rules, df.columns)
    df = df.withColumn(out, violations(rs))
    # a landed file may carry its own flag, as text
    prior = (F.coalesce(F.col("is_dirty").try_cast("boolean"), F.lit(False))
             if "is_dirty" in df.columns else F.lit(False))
    return df.withColumn("is_dirty", prior | (F.size(out) > 0))
