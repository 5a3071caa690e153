"""Queries without a SQL twin run end to end on sf0.001, every column of every
row computed, with a stable schema (run concurrently)."""

from concurrent.futures import ThreadPoolExecutor

import __spark_entry__ as E
from tests.conftest import SF_SMALL

ROWS_ONLY = sorted(set(E.queries()) - set(E.oracle_sql()))


def _run(spark, name):
    try:
        df = E.queries()[name](spark, SF_SMALL)
        cols = df.columns
        rows = df.collect()  # a count would prune the expressions
        if not rows:
            return f"{name}: no rows"
        if len(cols) != len(set(cols)):
            return f"{name}: duplicate output column names"
        return None
    except Exception as exc:  # noqa: BLE001
        return f"{name}: {type(exc).__name__}: {str(exc).splitlines()[0][:200]}"


def test_rows_only_queries_run(spark):
    with ThreadPoolExecutor(4) as pool:
        errors = [e for e in pool.map(lambda n: _run(spark, n), ROWS_ONLY) if e]
    assert not errors, "\n".join(errors)
