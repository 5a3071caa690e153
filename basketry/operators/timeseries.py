"""Windows and time-series operators (§2.7).

Every windowed operator takes ``keys`` so a panel (store × product × day)
partitions across executors; the single-series case (``keys=()``) is only
used on tables already reduced to one row per day, where one partition is
small. ``cumulative_share`` uses the distributed prefix sum instead of a
global window.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.calendar import calendar_columns
from basketry.functions.primitives import prefix_sum, top_n_per_group


def _w(keys, date_col):
    keys = [keys] if isinstance(keys, str) else list(keys or [])
    return Window.partitionBy(*keys).orderBy(date_col)


def lag_col(col: str, k: int, date_col: str, keys=()) -> Column:
    return F.lag(col, k).over(_w(keys, date_col))


def lag_features(df: DataFrame, date_col: str, cols, lags, keys=()) -> DataFrame:
    """``{col}_lag_{k}d`` = value k rows earlier in date order (rows
    mean days only on a gap-free spine; see ``daily_spine``)."""
    return df.withColumns({f"{c}_lag_{k}d": lag_col(c, k, date_col, keys) for c in cols for k in lags})


def rolling_col(col: str, w: int, date_col: str, keys=(), stat: str = "mean", min_periods: int = 1,
                include_current: bool = False) -> Column:
    """Rolling statistic over the previous ``w`` rows (current row excluded
    unless ``include_current``); NULL until ``min_periods`` non-null values."""
    end = Window.currentRow if include_current else -1
    start = -(w - 1) if include_current else -w
    win = _w(keys, date_col).rowsBetween(start, end)
    fn = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp, "min": F.min, "max": F.max}[stat]
    val = fn(col).over(win)
    return F.when(F.count(col).over(win) >= min_periods, val)


def rolling_mean_past(df: DataFrame, date_col: str, cols, windows, keys=(), min_periods: int = 1) -> DataFrame:
    """``{col}_rolling_{w}d_mean`` over the previous w rows."""
    return df.withColumns({f"{c}_rolling_{w}d_mean": rolling_col(c, w, date_col, keys, "mean", min_periods)
                           for c in cols for w in windows})


def min_periods_rule(w: int, rule: str = "third") -> int:
    """``third`` → max(2, w // 3); ``full`` → w; ``one`` → 1."""
    return {"third": max(2, w // 3), "full": w, "one": 1}[rule]


def rolling_stats(df: DataFrame, date_col: str, cols, windows, stats=("mean",), keys=(), rule: str = "full") -> DataFrame:
    """``{col}_rolling_{w}d_{stat}`` with a min-periods rule."""
    return df.withColumns({f"{c}_rolling_{w}d_{s}": rolling_col(c, w, date_col, keys, s, min_periods_rule(w, rule))
                           for c in cols for w in windows for s in stats})


def pct_change_lagged(col: str, p: int, date_col: str, keys=()) -> Column:
    """(x[t−1] − x[t−1−p]) / x[t−1−p], NULL-propagating (no fill)."""
    a, b = lag_col(col, 1, date_col, keys), lag_col(col, 1 + p, date_col, keys)
    return F.try_divide(a - b, b)


def diff_lagged(col: str, p: int, date_col: str, keys=()) -> Column:
    """x[t−1] − x[t−1−p]."""
    return lag_col(col, 1, date_col, keys) - lag_col(col, 1 + p, date_col, keys)


def period_growth(df: DataFrame, period_col: str, cols, keys=()) -> DataFrame:
    """Period-over-period percent change of each measure."""
    return df.withColumns({f"{c}_growth": F.try_divide(F.col(c) - lag_col(c, 1, period_col, keys),
                                                       lag_col(c, 1, period_col, keys)) for c in cols})


def trailing_average_inclusive(df: DataFrame, date_col: str, col: str, w: int = 30, keys=()) -> DataFrame:
    """W-row mean including the current row (min_periods = 1)."""
    return df.withColumn(f"{col}_trailing_{w}", rolling_col(col, w, date_col, keys, "mean", 1, include_current=True))


def strictly_prior_cumulative(df: DataFrame, key: str, date_col: str, value: str,
                              out_sum: str = "past_sum", out_count: str = "past_count") -> DataFrame:
    """Per key and day, Σ value and count over *earlier days only*.
    Rows are pre-aggregated to (key, day) first (partial aggregation), then a
    running window per key; first day → 0."""
    d = df.groupBy(key, date_col).agg(F.sum(value).alias("_ds"), F.count(value).alias("_dc"))
    w = Window.partitionBy(key).orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    return d.select(key, date_col, F.coalesce(F.sum("_ds").over(w), F.lit(0)).alias(out_sum),
                    F.coalesce(F.sum("_dc").over(w), F.lit(0)).alias(out_count))


def global_prior_rate(df: DataFrame, date_col: str, value: str, out: str = "prior_global_rate") -> DataFrame:
    """Σ/count over all earlier days, 0 when none. The day table is
    tiny, so its running window is a single small partition."""
    d = df.groupBy(date_col).agg(F.sum(value).alias("_ds"), F.count(value).alias("_dc"))
    w = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    s, c = F.coalesce(F.sum("_ds").over(w), F.lit(0)), F.coalesce(F.sum("_dc").over(w), F.lit(0))
    return d.select(date_col, F.when(c > 0, s / c).otherwise(F.lit(0.0)).alias(out))


# High-risk product rule (minimum prior orders, minimum rate).
HIGH_RISK_MIN_ORDERS = 30
HIGH_RISK_MIN_RATE = 0.10


def backoff_rate(df: DataFrame, key: str, date_col: str, label: str) -> DataFrame:
    """Per (key, day): the key's strictly-prior rate, backing off to the
    global prior rate when the key has no history; high-risk flag."""
    p = strictly_prior_cumulative(df, key, date_col, label)
    g = global_prior_rate(df, date_col, label)
    j = p.join(g, date_col, "left")
    rate = F.when(F.col("past_count") > 0, F.col("past_sum") / F.col("past_count")).otherwise(F.col("prior_global_rate"))
    j = j.withColumn("rate_before", rate)
    return j.withColumn("is_high_risk", ((F.col("past_count") >= HIGH_RISK_MIN_ORDERS)
                                         & (F.col("rate_before") >= HIGH_RISK_MIN_RATE)).cast("int"))


def order_history_features(lines: DataFrame, order_col: str, key: str, date_col: str, label: str) -> DataFrame:
    """Per order, mean/max prior key rate, high-risk count and minimum
    history (audit only — target history is banned from models)."""
    b = backoff_rate(lines, key, date_col, label)
    j = lines.select(order_col, key, date_col).join(b, [key, date_col], "left")
    return j.groupBy(order_col).agg(F.avg("rate_before").alias("mean_rate_before"),
                                    F.max("rate_before").alias("max_rate_before"),
                                    F.sum("is_high_risk").alias("high_risk_count"),
                                    F.min("past_count").alias("min_history_count"))


def first_event_date(df: DataFrame, key: str, date_col: str, out: str = "first_date") -> DataFrame:
    """First date per key (all statuses), one row per key."""
    return df.groupBy(key).agg(F.min(date_col).alias(out))


def daily_spine(df: DataFrame, date_col: str, out: str | None = None) -> DataFrame:
    """Dense calendar from the first to the last date."""
    out = out or date_col
    b = df.agg(F.min(date_col).alias("_a"), F.max(date_col).alias("_b"))
    return b.select(F.explode(F.sequence(F.to_date("_a"), F.to_date("_b"))).alias(out))


def densify(df: DataFrame, date_col: str, fill: dict | None = None) -> DataFrame:
    """Spine ⟕ series so row lags mean day lags."""
    out = daily_spine(df, date_col).join(df, date_col, "left")
    return out.na.fill(fill) if fill else out


def tenure_days(order_date, first_order=None, signup=None, variant: str = "first_order") -> Column:
    """Days from a start to the order date.
    ``first_order`` — from the first order; ``min_clipped`` — from
    min(signup, first order), clipped at 0; ``min`` — the same, unclipped
    (``least`` skips NULLs like pandas ``min(axis=1)``)."""
    od = F.col(order_date)
    if variant == "first_order":
        return F.datediff(od, F.col(first_order))
    start = F.least(*[F.col(c) for c in (signup, first_order) if c])
    d = F.datediff(od, start)
    return F.greatest(d, F.lit(0)) if variant == "min_clipped" else d


def year_normalised_value(df: DataFrame, date_col: str, col: str, out: str | None = None) -> DataFrame:
    """Value / mean of its year (window per year)."""
    out = out or f"{col}_year_norm"
    return df.withColumn(out, F.try_divide(F.col(col), F.avg(col).over(Window.partitionBy(F.year(date_col)))))


def seasonal_profile(df: DataFrame, date_col: str, col: str) -> DataFrame:
    """Mean (normalised) value per (month, day)."""
    return df.groupBy(F.month(date_col).alias("month"), F.dayofmonth(date_col).alias("day")).agg(
        F.avg(col).alias("seasonal_factor"))


def cumulative_share(df: DataFrame, key: str, value: str, top_k: int = 10, threshold: float = 0.80):
    """Rank by value (desc, key asc), share of items, cumulative share
    of the value; plus a one-row summary (items needed for ``threshold``,
    top-k share, top-20% share). Distributed prefix sum, no global window."""
    g = df.groupBy(key).agg(F.sum(value).alias("value"))
    g = g.withColumn("_one", F.lit(1))
    ps = prefix_sum(g, "value", ["value", "_one"], tiebreak=[key], descending=True)
    total = g.select(F.sum("value")).scalar()
    n = g.select(F.count(F.lit(1))).scalar()
    ranked = ps.select(key, "value", F.col("cum__one").alias("rank"), F.try_divide(F.col("cum__one") * 1.0, n).alias("item_share"),
                       F.try_divide(F.col("cum_value"), total).alias("cumulative_share"))
    need = ranked.filter(F.col("cumulative_share") >= threshold).select(F.min("rank")).scalar()
    topk = ranked.filter(F.col("rank") == F.least(F.lit(top_k), n)).select(F.max("cumulative_share")).scalar()
    top20 = ranked.filter(F.col("rank") <= F.ceil(n * F.lit(0.2))).select(F.max("cumulative_share")).scalar()
    summary = g.agg(F.count(F.lit(1)).alias("n_items")).select(
        "n_items", need.alias("items_for_threshold"), topk.alias("top_k_share"), top20.alias("top_20pct_share"))
    return ranked, summary


def importance_cumulative(df: DataFrame, feature: str, importance: str) -> DataFrame:
    """Share, rank and running share of feature importance (a feature
    table is small: one partition is fine)."""
    total = df.select(F.sum(importance)).scalar()
    w = Window.orderBy(F.desc(importance), F.asc(feature))
    return df.select(feature, importance, F.try_divide(F.col(importance), total).alias("share"),
                     F.row_number().over(w).alias("rank")).withColumn(
        "cumulative_share", F.sum("share").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def lag1_autocorrelation(df: DataFrame, date_col: str, col: str, keys=()) -> DataFrame:
    """corr(x, x lagged one row), per key."""
    k = [keys] if isinstance(keys, str) else list(keys)
    d = df.select(*k, F.col(col).cast("double").alias("_x"), lag_col(col, 1, date_col, k).cast("double").alias("_l"))
    return d.groupBy(*k).agg(F.corr("_x", "_l").alias("lag1_autocorr"))


def rank_within_group(df: DataFrame, groups, score: str, name: str, cap: int | None = None,
                      out: str = "rank_in_group") -> DataFrame:
    """Rank by |score| desc within group, name tie-break (method
    ``first``), optional cap."""
    g = [groups] if isinstance(groups, str) else list(groups)
    order = [F.desc(F.abs(score)), F.asc(name)]
    if cap:
        return top_n_per_group(df, g, order, cap, out=out)
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*g).orderBy(*order)))


def recent_period_presence(df: DataFrame, feature: str, period: str, value: str, n_recent: int = 2) -> DataFrame:
    """Per feature, whether its last period with a non-null value is
    among the ``n_recent`` newest periods of the whole table."""
    periods = df.select(period).distinct()
    cutoff = periods.orderBy(F.desc(period)).limit(n_recent).select(F.min(period)).scalar()
    last = df.filter(F.col(value).isNotNull()).groupBy(feature).agg(F.max(period).alias("last_period"))
    feats = df.select(feature).distinct().join(last, feature, "left")
    return feats.withColumn("recent_present", F.coalesce(F.col("last_period") >= cutoff, F.lit(False)))


NAME_RE = {
    "lag": re.compile(r"^(?P<base>.+)_lag_(?P<k>\d+)d?$"),
    "rolling": re.compile(r"^(?P<base>.+)_rolling_(?P<w>\d+)d?_(?P<stat>mean|sum|std|min|max)$"),
    "pct_change": re.compile(r"^(?P<base>.+)_pct_change_(?P<p>\d+)d?$"),
    "diff": re.compile(r"^(?P<base>.+)_diff_(?P<p>\d+)d?$"),
}


def compile_feature(name: str, date_col: str, keys=(), base_cols=(), rule: str = "full") -> Column | None:
    """Feature name → Spark expression over one shared window spec;
    calendar names map to calendar columns. Unknown → None."""
    cal = calendar_columns(date_col)
    if name in cal:
        return cal[name]
    m = NAME_RE["rolling"].match(name)
    if m and m["base"] in base_cols:
        w = int(m["w"])
        return rolling_col(m["base"], w, date_col, keys, m["stat"], min_periods_rule(w, rule))
    m = NAME_RE["pct_change"].match(name)
    if m and m["base"] in base_cols:
        return pct_change_lagged(m["base"], int(m["p"]), date_col, keys)
    m = NAME_RE["diff"].match(name)
    if m and m["base"] in base_cols:
        return diff_lagged(m["base"], int(m["p"]), date_col, keys)
    m = NAME_RE["lag"].match(name)
    if m and m["base"] in base_cols:
        return lag_col(m["base"], int(m["k"]), date_col, keys)
    if name in base_cols:
        return F.col(name)
    return None


def feature_name_compiler(df: DataFrame, names: list[str], date_col: str, keys=(), rule: str = "full",
                          unknown_fill: float = 0.0):
    """Rebuild named features in one ``select``; unknown names become
    ``unknown_fill`` and are reported. Returns (df, unknown_names)."""
    base = [c for c in df.columns if c != date_col]
    cols, unknown = [], []
    for n in names:
        e = compile_feature(n, date_col, keys, base, rule)
        if e is None:
            unknown.append(n)
            e = F.lit(unknown_fill)
        cols.append(e.alias(n))
    k = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*k, date_col, *cols), unknown


def time_features_registry(df: DataFrame, date_col: str, specs: dict[str, dict], keys=(), rule: str = "third"):
    """Per source column a spec {"lags": [...], "rolling": [...],
    "stats": [...]}; only requested features are built (one select) and a
    catalog DataFrame (feature, source, kind) is returned alongside."""
    names, catalog = [], []
    for src, spec in specs.items():
        for k in spec.get("lags", []):
            names.append(f"{src}_lag_{k}d")
            catalog.append((f"{src}_lag_{k}d", src, "lag"))
        for w in spec.get("rolling", []):
            for s in spec.get("stats", ["mean"]):
                names.append(f"{src}_rolling_{w}d_{s}")
                catalog.append((f"{src}_rolling_{w}d_{s}", src, "rolling"))
    out, _ = feature_name_compiler(df, names, date_col, keys, rule)
    cat = df.sparkSession.createDataFrame(catalog, "feature string, source string, kind string")
    return out, cat
