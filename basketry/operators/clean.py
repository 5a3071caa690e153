"""Cleaning, casting, projection and filter (§2.2).

ANSI mode is on in Spark 4, so coercions use ``try_*`` functions: a bad
value becomes NULL and is counted in the conversion report instead of
failing the job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.expr import is_finite, select_ladder
from basketry.sources.io import clean_column_names  # noqa: F401  (B01 lives with the readers)


def _conversion_report(df: DataFrame, before: dict[str, Column], after: dict[str, Column],
                       missing: list[str]) -> DataFrame:
    """One scan: newly invalid = NULLs after − NULLs before, per column."""
    spark = df.sparkSession
    schema = "column_name string, status string, n_rows long, newly_invalid long"
    parts = []
    if before:
        aggs = [F.count(F.lit(1)).alias("_n")]
        for i, c in enumerate(before):
            aggs += [F.count_if(before[c].isNull()).alias(f"b{i}"), F.count_if(after[c].isNull()).alias(f"a{i}")]
        one = df.agg(*aggs)
        structs = [F.struct(F.lit(c).alias("column_name"), F.lit("converted").alias("status"),
                            F.col("_n").alias("n_rows"), (F.col(f"a{i}") - F.col(f"b{i}")).alias("newly_invalid"))
                   for i, c in enumerate(before)]
        parts.append(one.select(F.explode(F.array(*structs)).alias("r")).select("r.*"))
    if missing:
        parts.append(spark.createDataFrame([(c, "missing_column", None, None) for c in missing], schema))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def to_date_expr(c: Column, fmt: str | None = None) -> Column:
    """String/timestamp → date; unparseable → NULL; time part dropped."""
    s = c.cast("string")
    ts = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return F.to_date(ts)


def convert_columns_date(df: DataFrame, cols: list[str], fmt: str | None = None):
    """Coerce to date (invalid → NULL). Returns (df, report)."""
    present = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    new = {}
    for c in present:
        dt = df.schema[c].dataType
        new[c] = F.col(c) if isinstance(dt, T.DateType) else (
            F.to_date(F.col(c)) if isinstance(dt, (T.TimestampType, T.TimestampNTZType)) else to_date_expr(F.col(c), fmt))
    report = _conversion_report(df, {c: F.col(c) for c in present}, new, missing)
    return df.withColumns(new), report


def convert_columns_numeric(df: DataFrame, cols: list[str]):
    """Coerce to double (invalid → NULL). Returns (df, report)."""
    present = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    new = {c: F.col(c).cast("string").try_cast("double") if isinstance(df.schema[c].dataType, T.StringType)
           else F.col(c).cast("double") for c in present}
    report = _conversion_report(df, {c: F.col(c) for c in present}, new, missing)
    return df.withColumns(new), report


def empty_string_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """String cells matching ^\\s*$ become NULL."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c).rlike(r"^\s*$"), F.lit(None)).otherwise(F.col(c)) for c in cols})


def drop_full_duplicates(df: DataFrame):
    """Exact duplicate rows dropped; returns (df, one-row report)."""
    out = df.dropDuplicates()
    rows_before = df.select(F.count(F.lit(1))).scalar()
    report = out.agg(F.count(F.lit(1)).alias("rows_after")).select(
        rows_before.alias("rows_before"), "rows_after", (rows_before - F.col("rows_after")).alias("rows_dropped"))
    return out, report


def dedupe_by_order(df: DataFrame, keys, order_by, keep: str = "last") -> DataFrame:
    """One row per key — the last (or first) by an explicit order.

    ``max_by``/``min_by`` over a struct is a partial (map-side) aggregate, so
    a key holding a third of all rows is reduced inside every task before
    the shuffle instead of being sorted in one task."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [c for c in df.columns if c not in keys]
    fn = F.max_by if keep == "last" else F.min_by
    packed = F.struct(*[F.col(f"`{c}`") for c in rest])
    g = df.groupBy(*keys).agg(fn(packed, F.struct(*[F.col(o) for o in order])).alias("_row"))
    return g.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def aggregate_duplicate_keys(df: DataFrame, keys, sums=(), means=(), firsts=()) -> DataFrame:
    """Duplicate key lines merged: sums, means and the smallest non-null
    value for 'first' attributes (deterministic), plus the line count."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means],
                                 *[F.min(c).alias(c) for c in firsts], F.count(F.lit(1)).alias("n_merged_lines"))


def duplicate_line_decision(df: DataFrame, keys) -> DataFrame:
    """For duplicated keys: line count vs distinct full-line count →
    ``review_exact_duplicate`` or ``aggregate_valid_multiple_lines``."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("line_count"),
                              F.count_distinct(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("distinct_line_count"))
    g = g.filter(F.col("line_count") > 1)
    return g.withColumn("decision", F.when(F.col("distinct_line_count") < F.col("line_count"), "review_exact_duplicate")
                        .otherwise("aggregate_valid_multiple_lines"))


def weighted_unit_price(value, qty) -> Column:
    """Line value / quantity when quantity > 0, else NULL."""
    v = F.col(value) if isinstance(value, str) else value
    q = F.col(qty) if isinstance(qty, str) else qty
    return F.when(q > 0, v / q)


def clean_daily_sales(df: DataFrame, date_col: str, revenue: str, cogs: str, order_by) -> DataFrame:
    """Coerce types, drop NULL dates, keep the last row per date (by an
    explicit order), NULL → 0, clip at 0, add profit and margin (0 when
    revenue is 0)."""
    d, _ = convert_columns_date(df, [date_col])
    d, _ = convert_columns_numeric(d, [revenue, cogs])
    d = d.filter(F.col(date_col).isNotNull())
    d = dedupe_by_order(d, date_col, order_by, keep="last")
    r = F.greatest(F.coalesce(F.col(revenue), F.lit(0.0)), F.lit(0.0))
    c = F.greatest(F.coalesce(F.col(cogs), F.lit(0.0)), F.lit(0.0))
    d = d.withColumn(revenue, r).withColumn(cogs, c)
    d = d.withColumn("profit", F.col(revenue) - F.col(cogs))
    return d.withColumn("margin", F.when(F.col(revenue) == 0, F.lit(0.0)).otherwise(F.col("profit") / F.col(revenue)))


def clean_daily_traffic(df: DataFrame, date_col: str, volumes: list[str], rates: list[str],
                        weight: str | None = None) -> DataFrame:
    """NULL dates dropped, aggregated to the day: volumes summed, rates
    averaged (weighted by ``weight`` when given — the default in SURVEY's
    trap table — else plain means)."""
    from basketry.operators.rollup import weighted_mean
    d = df.filter(F.col(date_col).isNotNull())
    aggs = [F.sum(v).alias(v) for v in volumes]
    aggs += [(weighted_mean(r, weight) if weight else F.avg(r)).alias(r) for r in rates]
    return d.groupBy(date_col).agg(*aggs)


def inf_to_null_zero(df: DataFrame, cols: list[str] | None = None, fill: float = 0.0) -> DataFrame:
    """±inf and NaN → NULL → ``fill`` on numeric columns."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.coalesce(F.when(is_finite(F.col(c)), F.col(c)), F.lit(fill)) for c in cols})


def flag_target_anomalies(df: DataFrame, date_col: str, revenue: str, cogs: str) -> DataFrame:
    """Flags (missing, non-positive revenue, cogs > revenue); keeps rows
    with any flag, ordered by flag priority then date; never drops data
    from the source (this is a report)."""
    miss = F.col(revenue).isNull() | F.col(cogs).isNull()
    nonpos = F.col(revenue) <= 0
    over = F.col(cogs) > F.col(revenue)
    f = df.select(date_col, revenue, cogs, F.coalesce(miss, F.lit(False)).alias("flag_missing"),
                  F.coalesce(nonpos, F.lit(False)).alias("flag_non_positive"),
                  F.coalesce(over, F.lit(False)).alias("flag_cogs_gt_revenue"))
    prio = select_ladder([(F.col("flag_missing"), 1), (F.col("flag_non_positive"), 2),
                          (F.col("flag_cogs_gt_revenue"), 3)], 9)
    return f.filter("flag_missing OR flag_non_positive OR flag_cogs_gt_revenue").withColumn("flag_priority", prio)


def value_map_label(df: DataFrame, col: str, mapping: dict, out: str = "label") -> DataFrame:
    """Value → label map; unmapped values → NULL label."""
    cases = [(F.col(col) == F.lit(k), v) for k, v in mapping.items()]
    return df.withColumn(out, select_ladder(cases, None).cast("int"))


def label_audit(df: DataFrame, col: str, label: str = "label") -> DataFrame:
    """B15 audit: rows per (status, label)."""
    return df.groupBy(col, label).agg(F.count(F.lit(1)).alias("n_rows"))


# Label reasons of the conservative return label.
LABEL_REASONS = [
    "valid_returned_status_with_return_record",
    "valid_delivered_without_return_record",
    "conflict_delivered_with_return_record",
    "conflict_returned_missing_return_record",
    "not_binary_outcome_status",
    "unclassified_label_rule",
]


def conservative_label(orders: DataFrame, return_keys: DataFrame, key: str, status: str,
                       returned_value: str = "returned", delivered_value: str = "delivered") -> DataFrame:
    """Label 1/0 only when status and return record agree;
    ``label_reason`` explains each row. Return keys are de-duplicated before
    the left join."""
    rk = return_keys.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_has_ret", F.lit(True))
    j = orders.join(rk, key, "left").withColumn("has_return_record", F.coalesce("_has_ret", F.lit(False))).drop("_has_ret")
    is_ret = F.coalesce(F.col(status) == returned_value, F.lit(False))
    is_del = F.coalesce(F.col(status) == delivered_value, F.lit(False))
    h = F.col("has_return_record")
    label = select_ladder([(is_ret & h, 1), (is_del & ~h, 0)], None).cast("int")
    reason = select_ladder([(is_ret & h, LABEL_REASONS[0]), (is_del & ~h, LABEL_REASONS[1]),
                            (is_del & h, LABEL_REASONS[2]), (is_ret & ~h, LABEL_REASONS[3]),
                            (~F.coalesce(F.col(status).isin(delivered_value, returned_value), F.lit(False)),
                             LABEL_REASONS[4])], LABEL_REASONS[5])
    return j.withColumn("returned_label", label).withColumn("label_reason", reason)


def coalesce_default_clean(c, default: str = "unknown") -> Column:
    """B17 (text): trim, lower, blank/NULL → ``default``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.nullif(F.lower(F.trim(col.cast("string"))), F.lit("")), F.lit(default))


def coalesce_nonneg(c, default: float = 0.0) -> Column:
    """B17 (number): try-cast, NULL → default, clamp at 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.greatest(F.coalesce(col.cast("string").try_cast("double"), F.lit(default)), F.lit(0.0))


def select_feature_contract(df: DataFrame, features: list[str], fill: float = 0.0):
    """Project to an ordered feature list; unknown features created as
    ``fill``. Returns (df, created, extra) — the last two are driver-side
    name lists (schema metadata only)."""
    created = [f for f in features if f not in df.columns]
    extra = [c for c in df.columns if c not in features]
    out = df.select(*[F.col(f"`{f}`") if f in df.columns else F.lit(fill).alias(f) for f in features])
    return out, created, extra


def drop_null_feature_rows(df: DataFrame, features: list[str]):
    """Drop rows with any NULL feature; returns (df, one-row report)."""
    out = df.na.drop(subset=features)
    before = df.select(F.count(F.lit(1))).scalar()
    rep = out.agg(F.count(F.lit(1)).alias("rows_after")).select(
        before.alias("rows_before"), "rows_after", (before - F.col("rows_after")).alias("rows_dropped"))
    return out, rep


def date_window_filter(df: DataFrame, date_col: str, start=None, end=None, warmup_days: int | None = None) -> DataFrame:
    """Rows with start ≤ date ≤ end, or date ≥ min(date) + warmup
    (the minimum is a scalar subquery)."""
    c = F.col(date_col)
    out = df
    if start is not None:
        out = out.filter(c >= F.lit(start).cast(df.schema[date_col].dataType))
    if end is not None:
        out = out.filter(c <= F.lit(end).cast(df.schema[date_col].dataType))
    if warmup_days is not None:
        first = df.select(F.min(date_col)).scalar()
        out = out.filter(c >= F.date_add(first, warmup_days))
    return out


def top_value_filter(df: DataFrame, col: str, k: int) -> DataFrame:
    """Keep rows whose value is among the k most frequent (ties by
    value); semi join against a k-row table."""
    top = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.desc("_n"), F.asc(col)).limit(k).select(col))
    return df.join(F.broadcast(top), col, "left_semi")  # at most k rows
