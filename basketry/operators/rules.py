"""Rule and constraint checks (§2.4).

Each check compiles to ``count_if`` aggregates so a table is scanned once
per check family; results are small long-form report DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def _long(one_row: DataFrame, rows: list[dict]) -> DataFrame:
    """Turn a one-row aggregate into a long report: ``rows`` is a list of
    {field: Column} dicts evaluated against that row."""
    structs = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows]
    return one_row.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


class UniqueKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_unique_key(df: DataFrame, keys) -> DataFrame:
    """Raise ``UniqueKeyError`` when ``keys`` is not unique; the check
    is a distributed aggregate that stops at the first duplicate."""
    hit = duplicate_keys(df, keys).limit(1).collect()
    if hit:
        raise UniqueKeyError(f"key {_keys(keys)} not unique, e.g. {hit[0].asDict()}")
    return df


_OPS = {
    ">=": lambda c, v: c >= v, "<=": lambda c, v: c <= v, ">": lambda c, v: c > v,
    "<": lambda c, v: c < v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v,
    "between": lambda c, v: c.between(v[0], v[1]),
    "in": lambda c, v: c.isin(list(v)),
}


def validity_rules(df: DataFrame, rules: list[tuple], table: str = "") -> DataFrame:
    """Rules ``(column, op, value)``; NULL values pass. Output per
    rule: table_name, column_name, rule, n_rows, n_checked, violations,
    violation_pct (of checked), min_value, max_value — one scan."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    for i, (col, op, value) in enumerate(rules):
        c = F.col(col)
        ok = _OPS[op](c, value)
        aggs += [F.count(c).alias(f"c{i}"), F.count_if(c.isNotNull() & ~ok).alias(f"v{i}"),
                 F.min(c).cast("string").try_cast("double").alias(f"mn{i}"),
                 F.max(c).cast("string").try_cast("double").alias(f"mx{i}")]
        vtxt = f"{value[0]}..{value[1]}" if op == "between" else str(value)
        rows.append({"table_name": F.lit(table), "column_name": F.lit(col), "rule": F.lit(f"{op} {vtxt}"),
                     "n_rows": F.col("n_rows"), "n_checked": F.col(f"c{i}"), "violations": F.col(f"v{i}"),
                     "violation_pct": F.try_divide(F.col(f"v{i}") * 100.0, F.col(f"c{i}")),
                     "min_value": F.col(f"mn{i}"), "max_value": F.col(f"mx{i}")})
    return _long(df.agg(*aggs), rows)


def business_rules(df: DataFrame, rules: list[tuple], table: str = "") -> DataFrame:
    """Multi-column row predicates ``(name, sql_predicate, severity)``;
    a row whose predicate is NULL (missing input) is not checked."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    for i, (name, pred, sev) in enumerate(rules):
        p = F.expr(pred)
        aggs += [F.count_if(p.isNotNull()).alias(f"c{i}"), F.count_if(~p).alias(f"v{i}")]
        rows.append({"table_name": F.lit(table), "rule": F.lit(name), "severity": F.lit(sev),
                     "n_checked": F.col(f"c{i}"), "violations": F.col(f"v{i}"),
                     "violation_pct": F.try_divide(F.col(f"v{i}") * 100.0, F.col(f"c{i}"))})
    return _long(df.agg(*aggs), rows)


def temporal_rule(left: DataFrame, right: DataFrame, key, left_date: str, right_date: str,
                  op: str = "<=", name: str = "") -> DataFrame:
    """``left_date op right_date`` across a left join on ``key``.
    Output: rule, n_rows, checked (both dates present), violations,
    violation_pct, missing_left, missing_right, status (``not_checkable``
    when nothing is checkable)."""
    k = _keys(key)
    j = left.select(*k, F.col(left_date).alias("_l")).join(
        right.select(*k, F.col(right_date).alias("_r")), k, "left")
    both = F.col("_l").isNotNull() & F.col("_r").isNotNull()
    ok = _OPS[op](F.col("_l"), F.col("_r"))
    agg = j.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(both).alias("checked"),
                F.count_if(both & ~ok).alias("violations"),
                F.count_if(F.col("_l").isNull()).alias("missing_left"),
                F.count_if(F.col("_r").isNull()).alias("missing_right"))
    return agg.select(
        F.lit(name or f"{left_date} {op} {right_date}").alias("rule"), "n_rows", "checked", "violations",
        F.try_divide(F.col("violations") * 100.0, F.col("checked")).alias("violation_pct"),
        "missing_left", "missing_right",
        F.when(F.col("checked") == 0, "not_checkable").when(F.col("violations") > 0, "fail")
        .otherwise("pass").alias("status"))


def foreign_key_check(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None,
                      nullable: bool = True, name: str = "") -> DataFrame:
    """Child rows whose key is absent from the parent. NULL child keys
    are excluded when ``nullable`` and counted as orphans otherwise."""
    parent_key = parent_key or child_key
    pk = parent.select(F.col(parent_key).alias("_pk")).distinct()
    c = child.select(F.col(child_key).alias("_ck"))
    j = c.join(pk, c["_ck"] == pk["_pk"], "left")
    checked = F.col("_ck").isNotNull() if nullable else F.lit(True)
    orphan = checked & F.col("_pk").isNull()
    agg = j.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(checked).alias("checked_rows"),
                F.count_if(orphan).alias("orphan_rows"))
    return agg.select(F.lit(name or f"{child_key}->{parent_key}").alias("relation"), "n_rows", "checked_rows",
                      "orphan_rows", F.try_divide(F.col("orphan_rows") * 1.0, F.col("checked_rows")).alias("orphan_rate"))


def key_coverage(parent: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """Share of distinct parent keys present in each child table."""
    pk = parent.select(key).filter(F.col(key).isNotNull()).distinct()
    parts = []
    for name, ch in children.items():
        ck = ch.select(key).distinct().withColumn("_hit", F.lit(1))
        parts.append(pk.join(ck, key, "left").agg(
            F.count(F.lit(1)).alias("parent_keys"), F.count("_hit").alias("covered_keys"))
            .select(F.lit(name).alias("child_table"), "parent_keys", "covered_keys",
                    F.try_divide(F.col("covered_keys") * 1.0, F.col("parent_keys")).alias("coverage")))
    return reduce(DataFrame.unionByName, parts)


def join_risk_report(left: DataFrame, right: DataFrame, key: str, name: str = "") -> DataFrame:
    """Duplicate keys on both sides, unmatched keys both ways and a risk
    class: many_to_many, right_can_inflate, left_duplicates, low."""
    lk = left.groupBy(key).agg(F.count(F.lit(1)).alias("_ln"))
    rk = right.groupBy(key).agg(F.count(F.lit(1)).alias("_rn"))
    j = lk.join(rk, key, "full")
    agg = j.agg(F.count_if(F.col("_ln") > 1).alias("left_dup_keys"),
                F.count_if(F.col("_rn") > 1).alias("right_dup_keys"),
                F.count_if(F.col("_ln").isNotNull() & F.col("_rn").isNull()).alias("left_only_keys"),
                F.count_if(F.col("_rn").isNotNull() & F.col("_ln").isNull()).alias("right_only_keys"))
    risk = (F.when((F.col("left_dup_keys") > 0) & (F.col("right_dup_keys") > 0), "many_to_many")
            .when(F.col("right_dup_keys") > 0, "right_can_inflate")
            .when(F.col("left_dup_keys") > 0, "left_duplicates").otherwise("low"))
    return agg.select(F.lit(name or key).alias("relation"), "*", risk.alias("risk"))


def join_rowcount_check(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before/after a join must match; new columns listed and the
    missing cells they bring counted. One-row report."""
    new_cols = [c for c in after.columns if c not in before.columns]
    n_before = before.select(F.count(F.lit(1))).scalar()
    missing = sum((F.count_if(F.col(f"`{c}`").isNull()) for c in new_cols), F.lit(0))
    return after.agg(F.count(F.lit(1)).alias("rows_after"), missing.cast("long").alias("new_missing_cells")).select(
        n_before.alias("rows_before"), "rows_after", (n_before == F.col("rows_after")).alias("rowcount_match"),
        F.lit(",".join(new_cols)).alias("new_columns"), "new_missing_cells")


def lifecycle_flags(parent: DataFrame, children: dict[str, DataFrame], key: str) -> DataFrame:
    """D09 (row level): parent rows plus ``has_<child>`` 0/1 flags from
    left joins to each child's distinct keys."""
    out = parent
    for name, ch in children.items():
        ck = ch.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(f"has_{name}", F.lit(1))
        out = out.join(ck, key, "left").withColumn(f"has_{name}", F.coalesce(F.col(f"has_{name}"), F.lit(0)))
    return out


def lifecycle_share(flags: DataFrame, status_col: str, children: list[str]) -> DataFrame:
    """D09 (summary): per status, order count and share of each flag."""
    return flags.groupBy(status_col).agg(
        F.count(F.lit(1)).alias("n_orders"),
        *[F.avg(f"has_{c}").alias(f"share_has_{c}") for c in children])


def named_checks(df: DataFrame, checks: list[tuple]) -> DataFrame:
    """``(name, sql_predicate_marking_a_problem,
    severity)`` → name, severity, n_rows, issue_count, issue_pct, result
    (pass / review). One scan."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    rows = []
    for i, (name, pred, sev) in enumerate(checks):
        aggs.append(F.count_if(F.expr(pred)).alias(f"i{i}"))
        rows.append({"check_name": F.lit(name), "severity": F.lit(sev), "n_rows": F.col("n_rows"),
                     "issue_count": F.col(f"i{i}"),
                     "issue_pct": F.try_divide(F.col(f"i{i}") * 100.0, F.col("n_rows")),
                     "result": F.when(F.col(f"i{i}") > 0, "review").otherwise("pass")})
    return _long(df.agg(*aggs), rows)


def conflict_rows(df: DataFrame, checks: list[tuple], key: str) -> DataFrame:
    """Row-level detail of each conflict; each check contributes its own
    columns, unioned by name (absent columns become NULL)."""
    parts = []
    for name, pred, cols in checks:
        parts.append(df.filter(F.expr(pred)).select(F.lit(name).alias("check_name"), key, *cols))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def return_vs_ordered(returns: DataFrame, items: DataFrame, keys, return_qty: str, ordered_qty: str) -> DataFrame:
    """Return lines with no ordered (order, product) pair, or whose
    returned quantity exceeds the ordered total. Both sides are
    pre-aggregated to the pair before the join."""
    k = _keys(keys)
    r = returns.groupBy(*k).agg(F.sum(return_qty).alias("returned_qty"), F.count(F.lit(1)).alias("return_lines"))
    o = items.groupBy(*k).agg(F.sum(ordered_qty).alias("ordered_qty"))
    j = r.join(o, k, "left")
    issue = (F.when(F.col("ordered_qty").isNull(), "no_ordered_pair")
             .when(F.col("returned_qty") > F.col("ordered_qty"), "returned_above_ordered"))
    return j.withColumn("issue", issue).filter(F.col("issue").isNotNull())


def missing_child_by_status(flags: DataFrame, status_col: str, child: str) -> DataFrame:
    """Per status: totals, missing children, pct within status and pct
    of all missing (share over the grand total from a scalar subquery)."""
    miss = F.col(f"has_{child}") == 0
    g = flags.groupBy(status_col).agg(F.count(F.lit(1)).alias("n_total"), F.count_if(miss).alias("n_missing"))
    all_missing = flags.select(F.count_if(miss)).scalar()
    return g.select(status_col, "n_total", "n_missing",
                    F.try_divide(F.col("n_missing") * 100.0, F.col("n_total")).alias("pct_in_status"),
                    F.try_divide(F.col("n_missing") * 100.0, all_missing).alias("pct_of_missing"),
                    F.when(F.col("n_missing") == 0, "complete")
                    .when(F.col("n_missing") == F.col("n_total"), "expected_absent")
                    .otherwise("partial").alias("interpretation"))


def payment_reconciliation(items: DataFrame, payments: DataFrame, key: str, gross: str, discount: str,
                           payment: str, tol: float = 1e-6) -> DataFrame:
    """Σ(gross − discount) per key vs payment; mismatches above ``tol``
    and the largest absolute difference. Items are pre-aggregated first."""
    s = items.groupBy(key).agg(F.sum(F.col(gross) - F.coalesce(F.col(discount), F.lit(0.0))).alias("_net"))
    p = payments.groupBy(key).agg(F.sum(payment).alias("_pay"))
    j = s.join(p, key, "inner").withColumn("_d", F.abs(F.col("_net") - F.col("_pay")))
    return j.agg(F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("_d") > tol).alias("n_mismatch"),
                 F.max("_d").alias("max_abs_diff"))


def aggregation_conservation(before: DataFrame, after: DataFrame, measures: list[str],
                             count_col: str | None = None) -> DataFrame:
    """Totals of ``measures`` (and the row count, or Σ count_col after)
    before vs after an aggregation. Long form: measure, before, after, diff."""
    b = before.agg(F.count(F.lit(1)).cast("double").alias("rows"),
                   *[F.sum(m).cast("double").alias(m) for m in measures])
    rows_after = F.sum(count_col).cast("double") if count_col else F.count(F.lit(1)).cast("double")
    a = after.agg(rows_after.alias("rows"), *[F.sum(m).cast("double").alias(m) for m in measures])
    names = ["rows"] + list(measures)
    bs = {n: b.select(F.col(n)).scalar() for n in names}
    rows = [{"measure": F.lit(n), "before": bs[n], "after": F.col(n), "difference": F.col(n) - bs[n]} for n in names]
    return _long(a, rows)
