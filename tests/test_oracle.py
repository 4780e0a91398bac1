"""Every registered query against its DuckDB oracle on the smallest driver tables."""

from conftest import SF_SMALL
from oracle_compare import compare

# Queries whose output depends on host paths or storage sizes: checked for running and
# row counts only (their operators have unit tests with literal expectations).
ROWS_ONLY: set[str] = set()


def own_queries():
    """Without the optional subpackage's queries, which have their own tests."""
    from finflow.plans.registry import QUERIES
    return [*QUERIES, "flagship_daily_clean_sales"]


def test_registered_queries_match_oracle(spark):
    res = compare(spark, SF_SMALL, own_queries())
    bad = {k: v for k, v in res.items()
           if not (v.startswith("OK") or (k in ROWS_ONLY and v.startswith("rows-only")))}
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(own_queries()) - set(E.oracle_sql()) == ROWS_ONLY
