"""Profiling and data-quality reports (§2.3).

Profiles are one wide aggregate over the table (a single scan, partial
aggregation per task) followed by an unpivot of the one-row result into a
long report. Distinct counts and percentiles are exact by default (they match
pandas) and distributed: (column, value) counts with map-side combination, then
a bucketed prefix sum. ``approx=True`` switches to mergeable sketches
(HyperLogLog++ ``approx_count_distinct``, ``percentile_approx``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.expr import select_ladder
from basketry.functions.primitives import column_quantiles, distinct_counts, group_quantiles, skew_adjusted

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def _explode_rows(one: DataFrame, rows: list[dict]) -> DataFrame:
    structs = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in rows]
    return one.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def schema_report(df: DataFrame, approx: bool = False) -> DataFrame:
    """Per column: dtype, non_null, missing, missing_pct, nunique and an
    example (the smallest value, deterministic)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(df.columns):
        aggs += [F.count(_q(c)).alias(f"nn{i}"), F.min(_q(c)).cast("string").alias(f"ex{i}")]
        if approx:
            aggs.append(F.approx_count_distinct(_q(c), 0.01).alias(f"nu{i}"))
    rows = [{"column_name": F.lit(c), "dtype": F.lit(df.schema[c].dataType.simpleString()),
             "non_null": F.col(f"nn{i}"), "missing": F.col("_n") - F.col(f"nn{i}"),
             "missing_pct": F.try_divide((F.col("_n") - F.col(f"nn{i}")) * 100.0, F.col("_n")),
             **({"nunique": F.col(f"nu{i}").cast("long")} if approx else {}), "example": F.col(f"ex{i}")}
            for i, c in enumerate(df.columns)]
    out = _explode_rows(df.agg(*aggs), rows)
    if approx:
        return out
    return out.join(distinct_counts(df, df.columns), "column_name", "left").select(
        "column_name", "dtype", "non_null", "missing", "missing_pct", F.coalesce("nunique", F.lit(0)).cast("long").alias("nunique"), "example")


def missing_report(df: DataFrame, only_missing: bool = False) -> DataFrame:
    """Missing count and percentage per column (one scan)."""
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(_q(c).isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)]
    rows = [{"column_name": F.lit(c), "n_rows": F.col("_n"), "missing": F.col(f"m{i}"),
             "missing_pct": F.try_divide(F.col(f"m{i}") * 100.0, F.col("_n"))} for i, c in enumerate(df.columns)]
    out = _explode_rows(df.agg(*aggs), rows)
    return out.filter(F.col("missing") > 0) if only_missing else out


# Missing-level bands (share of rows).
MISSING_LEVELS = [(0.0, "none"), (0.05, "low"), (0.30, "medium")]


def missing_level(pct_col: str = "missing_pct") -> Column:
    """0 → none, < 5% → low, < 30% → medium, else high."""
    r = F.col(pct_col) / 100.0
    return select_ladder([(r == 0, "none"), (r < 0.05, "low"), (r < 0.30, "medium")], "high")


def missing_decision(report: DataFrame, rules: DataFrame) -> DataFrame:
    """Join per-column business rules (column_name, rule) to the
    missing report; unknown columns with missing values → ``flag``."""
    j = report.join(rules, "column_name", "left")
    return j.withColumn("decision", F.when(F.col("missing") == 0, "no_action").otherwise(
        F.coalesce(F.col("rule"), F.lit("flag"))))


def missing_pattern(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Frequency of each null / not-null combination."""
    cols = cols or df.columns
    return df.groupBy(*[_q(c).isNull().cast("int").alias(f"{c}_null") for c in cols]).agg(F.count(F.lit(1)).alias("n_rows"))


def duplicate_report(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Duplicate rows (rows beyond the first) over the full row and
    over key columns. Struct comparison treats NULL = NULL like pandas."""
    whole = df.groupBy(*[_q(c).alias(f"_{i}") for i, c in enumerate(df.columns)]).agg(F.count(F.lit(1)).alias("_n"))
    if not keys:
        return whole.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_full_rows"))
    # rows are counted once per distinct row, distinct rows once per key: nothing is multiplied
    per_key = whole.groupBy(*[f"_{df.columns.index(k)}" for k in keys]).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_full"))
    return per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("_n") - F.col("_full")), F.lit(0)).alias("duplicate_full_rows"),
                       F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_key_rows"))


def key_uniqueness(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per (table, candidate key): rows, unique keys, duplicate key rows,
    pct and status."""
    parts = []
    for name, (df, keys) in tables.items():
        a = df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.struct(*[_q(k) for k in keys])).alias("unique_key_count"))
        parts.append(a.select(F.lit(name).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "n_rows",
                              "unique_key_count", (F.col("n_rows") - F.col("unique_key_count")).alias("duplicate_key_rows")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("duplicate_pct", F.try_divide(F.col("duplicate_key_rows") * 100.0, F.col("n_rows"))) \
        .withColumn("status", F.when(F.col("duplicate_key_rows") == 0, "unique").otherwise("duplicates"))


def duplicate_examples(df: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """All rows of duplicated keys, sorted by key, first n. Duplicate
    keys are found by aggregation and semi-joined back (no per-key window,
    so a hot key is not sorted inside one task)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    rows = df.join(dup, keys, "left_semi")
    return rows.orderBy(*keys, *[c for c in df.columns if c not in keys]).limit(n)


PCTS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def _quantiles(df: DataFrame, cols: list[str], probs, approx: bool) -> DataFrame:
    """``column_name, q``: exact by default, sketched with ``approx``."""
    if not approx:
        return group_quantiles(df, cols, probs)
    one = df.agg(*[F.percentile_approx(_q(c).cast("double"), list(probs), 10000).alias(f"q{i}") for i, c in enumerate(cols)])
    return _explode_rows(one, [{"column_name": F.lit(c), "q": F.col(f"q{i}")} for i, c in enumerate(cols)])


def _fetched(df: DataFrame, cols: list[str], probs, approx: bool) -> dict[str, list]:
    """A short list per column, for use as literals."""
    got = {r["column_name"]: r["q"] for r in _quantiles(df, cols, probs, approx).collect()}
    return {c: list(got.get(c) or [None] * len(list(probs))) for c in cols}


def numeric_summary(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Count, mean, std, min, p1/5/25/50/75/95/99, max, missing_pct and
    bias-adjusted skew per numeric column: one aggregate for the moments and
    the distributed quantiles."""
    cols = cols or numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mu{i}"), F.stddev_samp(x).alias(f"sd{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), skew_adjusted(c).alias(f"sk{i}")]
    rows = []
    for i, c in enumerate(cols):
        r = {"column_name": F.lit(c), "count": F.col(f"n{i}"), "mean": F.col(f"mu{i}"), "std": F.col(f"sd{i}"),
             "min": F.col(f"lo{i}"), "max": F.col(f"hi{i}"),
             "missing_pct": (F.col("_n") - F.col(f"n{i}")) * 100.0 / F.col("_n"), "skew": F.col(f"sk{i}")}
        rows.append(r)
    out = _explode_rows(df.agg(*aggs), rows).join(_quantiles(df, cols, PCTS, approx), "column_name", "left")
    return out.select("column_name", "count", "mean", "std", "min",
                      *[F.col("q")[j].alias(f"p{int(p * 100):02d}") for j, p in enumerate(PCTS)], "max", "missing_pct", "skew")


def iqr_outlier_report(df: DataFrame, cols: list[str] | None = None, k: float = 1.5, approx: bool = False) -> DataFrame:
    """q1, q3, iqr, bounds at k·iqr, outlier count and pct of all rows.
    Pass 1 fits the quartiles of all columns at once; pass 2 counts against
    them as literals."""
    cols = cols or numeric_columns(df)
    fitted = _fetched(df, cols, [0.25, 0.75], approx)
    qcols = {i: [F.lit(v).cast("double") for v in fitted[c]] for i, c in enumerate(cols)}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        q1, q3 = qcols[i][0], qcols[i][1]
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        aggs.append(F.count_if((_q(c) < lo) | (_q(c) > hi)).alias(f"o{i}"))
        aggs += [q1.alias(f"a{i}"), q3.alias(f"b{i}")]
    one = df.agg(*aggs)
    rows = [{"column_name": F.lit(c), "q1": F.col(f"a{i}"), "q3": F.col(f"b{i}"), "iqr": F.col(f"b{i}") - F.col(f"a{i}"),
             "lower_bound": F.col(f"a{i}") - k * (F.col(f"b{i}") - F.col(f"a{i}")),
             "upper_bound": F.col(f"b{i}") + k * (F.col(f"b{i}") - F.col(f"a{i}")),
             "n_outliers": F.col(f"o{i}"), "outlier_pct": F.try_divide(F.col(f"o{i}") * 100.0, F.col("_n"))}
            for i, c in enumerate(cols)]
    return _explode_rows(one, rows)


def outlier_tail_profile(tables: dict[str, DataFrame], k: float = 1.5, approx: bool = False) -> DataFrame:
    """C11: every numeric column of every table: q01 … q99 and separate
    low / high outlier counts."""
    parts = []
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    for name, df in tables.items():
        cols = numeric_columns(df)
        if not cols:
            continue
        fitted = _fetched(df, cols, probs, approx)
        aggs = []
        for i, c in enumerate(cols):
            q = F.array(*[F.lit(v).cast("double") for v in fitted[c]])
            lo, hi = q[1] - k * (q[3] - q[1]), q[3] + k * (q[3] - q[1])
            aggs += [F.count_if(_q(c) < lo).alias(f"l{i}"), F.count_if(_q(c) > hi).alias(f"h{i}"), q.alias(f"q{i}")]
        rows = [{"table_name": F.lit(name), "column_name": F.lit(c), "q01": F.col(f"q{i}")[0], "q25": F.col(f"q{i}")[1],
                 "q50": F.col(f"q{i}")[2], "q75": F.col(f"q{i}")[3], "q99": F.col(f"q{i}")[4],
                 "n_low": F.col(f"l{i}"), "n_high": F.col(f"h{i}")} for i, c in enumerate(cols)]
        parts.append(_explode_rows(df.agg(*aggs), rows))
    return reduce(DataFrame.unionByName, parts)


def outlier_business_context(lines: DataFrame, price: str, cost: str, key: str, top_n: int = 50) -> DataFrame:
    """Lines above the p99 price labelled by a cost / margin / markup
    rule; top ``top_n`` by price."""
    p99 = F.lit(column_quantiles(lines, price, [0.99])[price][0]).cast("double")
    hi = lines.filter(F.col(price) > p99)
    margin = F.try_divide(F.col(price) - F.col(cost), F.col(price))
    label = select_ladder([(F.col(cost).isNull(), "no_cost_reference"), (F.col(price) < F.col(cost), "below_cost"),
                           (margin > 0.8, "extreme_markup"), (margin >= 0.2, "premium_consistent")], "thin_margin")
    return hi.select(key, price, cost, margin.alias("margin"), label.alias("context")) \
        .orderBy(F.desc(price), F.asc(key)).limit(top_n)


def categorical_summary(df: DataFrame, cols: list[str], top_n: int = 5) -> DataFrame:
    """Per column nunique, missing_pct and the top-n "value:count"
    string (ties by value). Long form (column, value) → counts → rank per
    column; only ``top_n`` values per column are gathered."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), _q(c).cast("string").alias("value"))
                                         for c in cols])).alias("_r")).select("_r.*")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    stats = counts.groupBy("column_name").agg(
        F.count("value").alias("nunique"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("_miss"),
        F.sum("n").alias("_rows"))
    from basketry.functions.primitives import top_n_per_group
    # salted top-n: a high-cardinality column is not ranked inside one task
    top = top_n_per_group(counts.filter(F.col("value").isNotNull()), "column_name", [F.desc("n"), F.asc("value")], top_n,
                          out="_rk")
    top = top.groupBy("column_name").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_rk", F.concat_ws(":", "value", F.col("n").cast("string")).alias("s")))),
        lambda x: x["s"]), ", ").alias("top_values"))
    return stats.join(top, "column_name", "left").select(
        "column_name", "nunique", F.try_divide(F.col("_miss") * 100.0, F.col("_rows")).alias("missing_pct"), "top_values")


def date_range_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """C14: min, max, missing and unique dates per date column."""
    days = df.select(*[F.to_date(_q(c)).alias(c) for c in cols])
    aggs = [f(_q(c)).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("a", F.min), ("b", F.max), ("m", lambda x: F.count_if(x.isNull())))]
    rows = [{"column_name": F.lit(c), "min_date": F.col(f"a{i}"), "max_date": F.col(f"b{i}"), "missing": F.col(f"m{i}")} for i, c in enumerate(cols)]
    unique = distinct_counts(days, cols).select("column_name", F.col("nunique").alias("unique_dates"))
    return _explode_rows(days.agg(*aggs), rows).join(unique, "column_name", "left").na.fill(0, subset=["unique_dates"])


def numeric_value_check(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN, negative and zero counts, min, max, mean per column."""
    cols = cols or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.count_if(F.isnan(x)).alias(f"nan{i}"), F.count_if(x < 0).alias(f"neg{i}"), F.count_if(x == 0).alias(f"z{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.avg(x).alias(f"mu{i}")]
    rows = [{"column_name": F.lit(c), "n_nan": F.col(f"nan{i}"), "n_negative": F.col(f"neg{i}"), "n_zero": F.col(f"z{i}"),
             "min": F.col(f"lo{i}"), "max": F.col(f"hi{i}"), "mean": F.col(f"mu{i}")} for i, c in enumerate(cols)]
    return _explode_rows(df.agg(*aggs), rows)


def dtype_audit(df: DataFrame, approx: bool = False) -> DataFrame:
    """Semantic type from name + type + cardinality: date, id, boolean,
    numeric_discrete (≤ 20 levels), numeric_continuous, categorical_low
    (≤ 30), categorical_high; note when the storage type disagrees."""
    rep = schema_report(df, approx)
    name = F.lower(F.col("column_name"))
    dt = F.col("dtype")
    is_num = dt.isin("tinyint", "smallint", "int", "bigint", "float", "double") | dt.startswith("decimal")
    sem = select_ladder([
        (dt.isin("date", "timestamp", "timestamp_ntz") | name.rlike("(date|_at)$"), "date"),
        (name.rlike("(^id$|_id$|key$)"), "id"),
        (F.col("nunique") <= 2, "boolean"),
        (is_num & (F.col("nunique") <= 20), "numeric_discrete"),
        (is_num, "numeric_continuous"),
        (F.col("nunique") <= 30, "categorical_low")], "categorical_high")
    note = F.when((sem == "date") & ~dt.isin("date", "timestamp", "timestamp_ntz"), F.concat(F.lit("stored_as_"), dt)) \
        .when(sem.isin("numeric_discrete", "numeric_continuous") & ~is_num, "numeric_stored_as_text")
    return rep.select("column_name", "dtype", "nunique", sem.alias("semantic_type"), note.alias("note"))


def feature_view_type(df: DataFrame, cols: list[str]) -> DataFrame:
    """C17: binary (≤ 2 levels), low_cardinality (≤ 12), continuous
    (numeric), other."""
    num = set(numeric_columns(df))
    u = distinct_counts(df, cols)
    return u.select("column_name", "nunique", select_ladder(
        [(F.col("nunique") <= 2, "binary"), (F.col("nunique") <= 12, "low_cardinality"),
         (F.col("column_name").isin(sorted(num)), "continuous")], "other").alias("view_type"))


def date_continuity(df: DataFrame, date_col: str) -> DataFrame:
    """Expected days between min and max, actual unique days, missing
    count, first and last missing day."""
    d = df.select(F.to_date(_q(date_col)).alias("d")).filter(F.col("d").isNotNull())
    b = d.agg(F.min("d").alias("a"), F.max("d").alias("z"), F.count_distinct("d").alias("actual_days"))
    spine = b.select(F.explode(F.sequence("a", "z")).alias("d"))
    miss = spine.join(d.distinct(), "d", "left_anti")
    return b.select(F.col("a").alias("min_date"), F.col("z").alias("max_date"),
                    (F.datediff("z", "a") + 1).alias("expected_days"), "actual_days",
                    miss.select(F.count(F.lit(1))).scalar().alias("missing_days"),
                    miss.select(F.min("d")).scalar().alias("first_missing"), miss.select(F.max("d")).scalar().alias("last_missing"))


def date_coverage(target_dates: DataFrame, sources: dict[str, DataFrame], date_col: str,
                  threshold: float = 0.60) -> DataFrame:
    """Share of target dates present in each source, and the decision
    (use / skip below ``threshold``)."""
    t = target_dates.select(F.to_date(_q(date_col)).alias("d")).distinct()
    parts = []
    for name, src in sources.items():
        s = src.select(F.to_date(_q(date_col)).alias("d")).distinct().withColumn("_hit", F.lit(1))
        parts.append(t.join(s, "d", "left").agg(F.count(F.lit(1)).alias("target_days"), F.count("_hit").alias("covered_days"))
                     .select(F.lit(name).alias("source"), "target_days", "covered_days"))
    out = reduce(DataFrame.unionByName, parts)
    cov = F.try_divide(F.col("covered_days") * 1.0, F.col("target_days"))
    return out.withColumn("coverage", cov).withColumn("decision", F.when(cov >= threshold, "use").otherwise("skip"))


def quick_eda(df: DataFrame, target: str | None = None, keys: list[str] | None = None,
              categorical: list[str] | None = None) -> dict[str, DataFrame]:
    """C20: the bundle of lazy reports for one table."""
    out = {"schema": schema_report(df), "missing": missing_report(df), "duplicates": duplicate_report(df, keys),
           "numeric": numeric_summary(df)}
    if categorical:
        out["categorical"] = categorical_summary(df, categorical)
    if target:
        from basketry.operators.stats import target_relation_report
        feats = [c for c in numeric_columns(df) if c != target]
        out["target_relation"] = target_relation_report(df, feats, target)
    return out


ISSUE_SCHEMA = "table_name string, column_name string, issue string, issue_count long, severity string, action string"


def issue_log(checks: list[DataFrame]) -> DataFrame:
    """Union of check outputs (already in the issue schema) keeping
    only failing rows."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), checks).filter(F.col("issue_count") > 0)


def action_plan(log: DataFrame) -> DataFrame:
    """Issue log grouped by severity × issue × action."""
    order = F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)
    return log.groupBy("severity", "issue", "action").agg(F.sum("issue_count").alias("total_count"),
                                                          F.count(F.lit(1)).alias("n_checks")).withColumn("severity_order", order)


def promo_usage_summary(lines: DataFrame, promo_cols: list[str], discount: str) -> DataFrame:
    """Null share of promo columns and share of lines with discount > 0."""
    aggs = [F.avg(_q(c).isNull().cast("double")).alias(f"{c}_null_share") for c in promo_cols]
    aggs.append(F.avg((F.col(discount) > 0).cast("double")).alias("discounted_share"))
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), *aggs)


def percentile_outlier_days(daily: DataFrame, date_col: str, revenue: str, cogs: str) -> DataFrame:
    """Days with revenue ≤ p1 or ≥ p99, cogs > revenue, or negative
    margin; first matching reason; count and share of all days per reason."""
    q = [F.lit(v).cast("double") for v in column_quantiles(daily, revenue, [0.01, 0.99])[revenue]]
    reason = select_ladder([(F.col(revenue) <= q[0], "revenue_le_p01"), (F.col(revenue) >= q[1], "revenue_ge_p99"),
                            (F.col(cogs) > F.col(revenue), "cogs_gt_revenue"),
                            (F.try_divide(F.col(revenue) - F.col(cogs), F.col(revenue)) < 0, "negative_margin")], None)
    n = daily.select(F.count(F.lit(1))).scalar()
    r = daily.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return r.groupBy("reason").agg(F.count(F.lit(1)).alias("n_days")).withColumn(
        "share_of_days", F.try_divide(F.col("n_days") * 1.0, n))
