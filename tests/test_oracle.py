"""Every query with an oracle must equal its DuckDB SQL on sf0.001
(row count, column names, value multiset) — the driver's gate, locally.
Queries run concurrently from a thread pool (Spark schedules jobs from
several threads), each DuckDB check on its own cursor."""

from concurrent.futures import ThreadPoolExecutor

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import canon

ORACLES = E.oracle_sql()
QUERIES = E.queries()


def _check(spark, duck, name):
    try:
        sdf = QUERIES[name](spark, SF_SMALL)
        srows = [tuple(r) for r in sdf.collect()]
        cur = duck.cursor()
        cur.execute(ORACLES[name])
        dcols = [d[0] for d in cur.description]
        sc, sr = canon(sdf.columns, srows)
        dc, dr = canon(dcols, cur.fetchall())
        if sc != dc:
            return f"{name}: columns {sc} != {dc}"
        if sr != dr:
            return f"{name}: {len(sr)} vs {len(dr)} rows or values differ"
        return None
    except Exception as exc:  # noqa: BLE001
        return f"{name}: {type(exc).__name__}: {str(exc).splitlines()[0][:200]}"


def test_all_queries_match_oracles(spark, duck):
    with ThreadPoolExecutor(6) as pool:
        errors = [e for e in pool.map(lambda n: _check(spark, duck, n), sorted(ORACLES)) if e]
    assert not errors, "\n".join(errors)


def test_every_rows_only_query_has_docstring():
    missing = [n for n, f in QUERIES.items() if not (f.__doc__ or "").strip() and n not in ORACLES]
    assert not missing, missing


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.collect()) > 0
    assert df.columns == ["segment", "target_rate", "n_rows", "sum_returned", "mean_discount_ratio"]
