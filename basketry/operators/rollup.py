"""Aggregations, pivots and rollups (§2.6).

Aggregations use Spark's partial (map-side) + final hash aggregate, so a hot
group key is pre-combined inside every task before the shuffle. Totals used
as denominators come from scalar subqueries (computed once, no cross join).
Pivots always take an explicit value list so no extra distinct job runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.expr import clip, slugify
from basketry.functions.primitives import column_quantiles, group_distinct_counts, group_quantiles, null_safe_join, with_group_quantiles


def _k(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def weighted_mean(v, w) -> Column:
    """Σ(v·w)/Σw over pairs with both present and w ≠ 0; NULL if none."""
    vc, wc = F.col(v) if isinstance(v, str) else v, F.col(w) if isinstance(w, str) else w
    ok = vc.isNotNull() & wc.isNotNull() & (wc != 0)
    return F.try_divide(F.sum(F.when(ok, vc * wc)), F.sum(F.when(ok, wc)))


def ratio_of_sums(a, b) -> Column:
    """Σa / Σb (NULL when Σb is 0)."""
    return F.try_divide(F.sum(a), F.sum(b))


def share_of_total(df: DataFrame, col: str, out: str) -> DataFrame:
    """Column / grand total (scalar subquery over the same small frame)."""
    total = df.select(F.sum(col)).scalar()
    return df.withColumn(out, F.try_divide(F.col(col), total))


def group_summary(df: DataFrame, keys, revenue: str, gross: str | None = None, cost: str | None = None,
                  units: str | None = None, order_col: str | None = None, refund: str | None = None,
                  discount: str | None = None) -> DataFrame:
    """revenue, gross, profit, units, distinct orders, refund,
    discount, AOV (revenue / orders), margin (profit / revenue) and
    revenue share per group."""
    aggs = [F.sum(revenue).alias("revenue")]
    if gross:
        aggs.append(F.sum(gross).alias("gross"))
    if cost:
        aggs.append(F.sum(F.col(revenue) - F.col(cost)).alias("profit"))
    if units:
        aggs.append(F.sum(units).alias("units"))
    if order_col:
        aggs.append(F.count_distinct(order_col).alias("n_orders"))
    if refund:
        aggs.append(F.sum(refund).alias("refund"))
    if discount:
        aggs.append(F.sum(discount).alias("discount"))
    g = df.groupBy(*_k(keys)).agg(*aggs)
    if order_col:
        g = g.withColumn("aov", F.try_divide(F.col("revenue"), F.col("n_orders")))
    if cost:
        g = g.withColumn("margin", F.try_divide(F.col("profit"), F.col("revenue")))
    return share_of_total(g, "revenue", "revenue_share")


def kpi_overview(lines: DataFrame, order_values: DataFrame, revenue: str, gross: str, units: str,
                 order_col: str, customer_col: str, product_col: str, order_value: str,
                 cost: str | None = None) -> DataFrame:
    """KPIs in long form (kpi, value): revenue, gross, units, orders,
    customers, products, AOV, median order value, revenue per customer,
    margin. ``order_values`` has one row per order."""
    # distinct keys come from (column, value) counts: no line is multiplied inside the sums
    keys = {"orders": order_col, "customers": customer_col, "products": product_col}
    counts = group_distinct_counts(lines, [], keys).select(F.struct(*keys).alias("c")).scalar()
    a = lines.agg(F.sum(revenue).alias("revenue"), F.sum(gross).alias("gross"), F.sum(units).alias("units"),
                  (F.sum(F.col(revenue) - F.col(cost)) if cost else F.lit(None)).alias("profit"))
    a = a.withColumn("_c", counts).select("*", "_c.*")
    med = F.lit(column_quantiles(order_values, order_value, [0.5])[order_value][0]).cast("double")
    kpis = [("total_revenue", F.col("revenue")), ("total_gross", F.col("gross")),
            ("total_units", F.col("units")), ("n_orders", F.col("orders")),
            ("n_customers", F.col("customers")), ("n_products", F.col("products")),
            ("aov", F.try_divide(F.col("revenue"), F.col("orders"))), ("median_order_value", med),
            ("revenue_per_customer", F.try_divide(F.col("revenue"), F.col("customers"))),
            ("margin", F.try_divide(F.col("profit"), F.col("revenue")))]
    structs = [F.struct(F.lit(i).alias("kpi_order"), F.lit(n).alias("kpi"), v.cast("double").alias("value"))
               for i, (n, v) in enumerate(kpis)]
    return a.select(F.explode(F.array(*structs)).alias("k")).select("k.*")


def period_key(date_col: str, freq: str) -> list[Column]:
    """Period start and end for ``day`` / ``week`` (Monday–Sunday, labelled
    by its Sunday like pandas ``W``) / ``month`` / ``quarter`` / ``year``."""
    d = F.col(date_col)
    if freq == "day":
        return [d.alias("period_start"), d.alias("period_end")]
    if freq == "week":
        start = F.to_date(F.date_trunc("week", d))
        return [start.alias("period_start"), F.date_add(start, 6).alias("period_end")]
    unit = {"month": "month", "quarter": "quarter", "year": "year"}[freq]
    start = F.to_date(F.date_trunc(unit, d))
    months = {"month": 1, "quarter": 3, "year": 12}[freq]
    return [start.alias("period_start"), F.date_sub(F.add_months(start, months), 1).alias("period_end")]


def period_rollup(df: DataFrame, date_col: str, freq: str, sums: list[str], distincts: list[str] = (),
                  order_col: str | None = None, revenue: str | None = None) -> DataFrame:
    """sums and distinct counts per day / week / month; mean AOV when
    ``order_col`` and ``revenue`` are given."""
    ps, pe = period_key(date_col, freq)
    aggs = [F.sum(s).alias(s) for s in sums] + [F.count_distinct(c).alias(f"n_{c}") for c in distincts]
    if order_col and revenue:
        aggs.append(F.try_divide(F.sum(revenue), F.count_distinct(order_col)).alias("aov"))
    return df.groupBy(ps, pe).agg(*aggs)


def month_spine(df: DataFrame, date_col: str, out: str = "month") -> DataFrame:
    """Every calendar month between the first and last date (one row each)."""
    b = df.agg(F.to_date(F.date_trunc("month", F.min(date_col))).alias("_a"),
               F.to_date(F.date_trunc("month", F.max(date_col))).alias("_b"))
    return b.select(F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(out))


def month_resample(df: DataFrame, date_col: str, sums: list[str] = (), means: list[str] = (),
                   count_name: str = "n_rows") -> DataFrame:
    """calendar-month buckets including empty months: sums and counts
    of an empty month are 0, means are NULL."""
    m = F.to_date(F.date_trunc("month", F.col(date_col))).alias("month")
    g = df.groupBy(m).agg(F.count(F.lit(1)).alias(count_name), *[F.sum(s).alias(s) for s in sums],
                          *[F.avg(x).alias(f"mean_{x}") for x in means])
    out = month_spine(df, date_col).join(g, "month", "left")
    for c in [count_name, *sums]:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out


def top_values(df: DataFrame, col: str, k: int) -> list:
    """The ``k`` most frequent non-null values (ties by value): a bounded
    list (k rows) brought to the driver to name pivot columns."""
    rows = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .orderBy(F.desc("_n"), F.asc(col)).limit(k).collect())
    return [r[0] for r in rows]


def levels(df: DataFrame, col: str) -> list:
    """All non-null values of a column in order, to name pivot columns: the
    caller pivots on columns whose values are few by meaning (flags, types)."""
    return sorted(r[0] for r in df.filter(F.col(col).isNotNull()).select(col).distinct().collect())


def crosstab_counts(df: DataFrame, row_key, col: str, values: list | None = None, top_k: int | None = None,
                    prefix: str | None = None) -> DataFrame:
    """row_key × category count columns for an explicit (or top-k)
    value list, slugged names ``{prefix}_{slug}``, missing → 0. One of the two
    must be given: a column per value needs a chosen list."""
    if values is None and top_k is None:
        raise ValueError("crosstab_counts needs values or top_k")
    values = values if values is not None else top_values(df, col, top_k)
    prefix = prefix or col
    aggs = [F.count_if(F.col(col) == F.lit(v)).alias(f"{prefix}_{slugify(v)}") for v in values]
    return df.groupBy(*_k(row_key)).agg(*aggs)


def pivot_agg(df: DataFrame, row_key, pivot_col: str, values: list, agg: str, measure: str | None = None,
              prefix: str | None = None, fill: float | None = None) -> DataFrame:
    """row_key × value matrix of sum / avg / count /
    count_distinct of ``measure``; explicit ``values`` so Spark runs no
    distinct-values job. Columns ``{prefix}_{slug(value)}``."""
    prefix = prefix or pivot_col
    fn = {"sum": F.sum, "avg": F.avg, "mean": F.avg, "max": F.max, "min": F.min,
          "count": F.count, "nunique": F.count_distinct, "count_distinct": F.count_distinct}[agg]
    aggs = []
    for v in values:
        hit = F.col(pivot_col) == F.lit(v)
        src = F.when(hit, F.col(measure) if measure else F.lit(1))
        aggs.append(fn(src).alias(f"{prefix}_{slugify(v)}"))
    out = df.groupBy(*_k(row_key)).agg(*aggs)
    if fill is not None:
        out = out.na.fill(fill)
    return out


def category_share(df: DataFrame, row_key, cat: str, qty: str, values: list, prefix: str = "share") -> DataFrame:
    """per row key, quantity share of each listed category (total 0 →
    NULL)."""
    aggs = [F.sum(qty).alias("_tot")] + [F.sum(F.when(F.col(cat) == F.lit(v), F.col(qty)).otherwise(0))
                                         .alias(f"_s{i}") for i, v in enumerate(values)]
    g = df.groupBy(*_k(row_key)).agg(*aggs)
    return g.select(*_k(row_key), *[F.try_divide(F.col(f"_s{i}"), F.nullif(F.col("_tot"), F.lit(0)))
                                    .alias(f"{prefix}_{slugify(v)}") for i, v in enumerate(values)])


def multihot(df: DataFrame, key: str, levels: dict[str, list]) -> DataFrame:
    """per key, 0/1 flag for each (column, level)."""
    aggs = [F.max(F.when(F.col(c) == F.lit(v), 1).otherwise(0)).alias(f"{c}_{slugify(v)}")
            for c, vals in levels.items() for v in vals]
    return df.groupBy(key).agg(*aggs)


def order_rollup(df: DataFrame, key: str, firsts: list[str], sums: list[str], count_name: str = "n_lines") -> DataFrame:
    """item rows → one row per order: an order-level attribute (taken
    as its minimum, deterministic for attributes constant per order), sums,
    line count."""
    return df.groupBy(key).agg(*[F.min(c).alias(c) for c in firsts], *[F.sum(s).alias(s) for s in sums],
                               F.count(F.lit(1)).alias(count_name))


def order_item_summary(items: DataFrame, key: str, product: str, qty: str, gross: str, discount: str,
                       extra=None) -> DataFrame:
    """per order: total quantity, distinct products, lines, discount,
    gross and the clipped discount ratio Σdiscount/Σgross ∈ [0, 1]."""
    g = items.groupBy(key).agg(F.sum(qty).alias("total_quantity"),
                               F.count_distinct(product).alias("n_products"),
                               F.count(F.lit(1)).alias("n_lines"),
                               F.sum(discount).alias("discount_total"), F.sum(gross).alias("gross_total"),
                               *(extra or []))
    ratio = F.try_divide(F.col("discount_total"), F.col("gross_total"))
    return g.withColumn("discount_ratio", clip(ratio, 0.0, 1.0))


def group_target_rate(df: DataFrame, keys, target: str, sum_col: str | None = None,
                      min_count: int = 0, extra=None) -> DataFrame:
    """per group: mean target, row count, optional sum; NULL targets
    count in n_rows but not in the rate (pandas mean)."""
    aggs = [F.avg(target).alias("target_rate"), F.count(F.lit(1)).alias("n_rows")]
    if sum_col:
        aggs.append(F.sum(sum_col).alias(f"sum_{sum_col}"))
    aggs += list(extra or [])
    g = df.groupBy(*_k(keys)).agg(*aggs)
    return g.filter(F.col("n_rows") >= min_count) if min_count else g


def delta_vs_baseline(df: DataFrame, keys, target: str) -> DataFrame:
    """group rate minus the global rate, in percentage points."""
    base = df.select(F.avg(target)).scalar()
    g = group_target_rate(df, keys, target)
    return g.withColumn("global_rate", base).withColumn("delta_pp", (F.col("target_rate") - base) * 100.0)


def calendar_lift(df: DataFrame, date_col: str, target: str) -> DataFrame:
    """mean target by day-of-week, weekend, month and quarter in one
    GROUPING SETS pass; lift = group mean / global mean."""
    d = F.col(date_col)
    base = df.select(F.weekday(d).alias("dow"), (F.weekday(d) >= 5).cast("int").alias("weekend"),
                     F.month(d).alias("month"), F.quarter(d).alias("quarter"), F.col(target).alias("_y"))
    g = base.groupingSets([["dow"], ["weekend"], ["month"], ["quarter"]], "dow", "weekend", "month", "quarter") \
        .agg(F.avg("_y").alias("target_mean"), F.count(F.lit(1)).alias("n_rows"))
    key = (F.when(F.col("dow").isNotNull(), "dow").when(F.col("weekend").isNotNull(), "weekend")
           .when(F.col("month").isNotNull(), "month").otherwise("quarter"))
    val = F.coalesce("dow", "weekend", "month", "quarter")
    overall = df.select(F.avg(target)).scalar()
    return g.select(key.alias("calendar_key"), val.alias("key_value"), "target_mean", "n_rows",
                    F.try_divide(F.col("target_mean"), overall).alias("lift"))


def channel_growth_recent(df: DataFrame, channel: str, period: str, value: str, n_last: int = 6) -> DataFrame:
    """per channel, mean period-over-period growth over its last
    ``n_last`` growth observations (window per channel)."""
    w = Window.partitionBy(channel).orderBy(period)
    g = df.select(channel, period, F.try_divide(F.col(value) - F.lag(value).over(w), F.lag(value).over(w)).alias("_g"))
    g = g.filter(F.col("_g").isNotNull())
    r = g.withColumn("_rn", F.row_number().over(Window.partitionBy(channel).orderBy(F.desc(period))))
    return r.filter(F.col("_rn") <= n_last).groupBy(channel).agg(
        F.avg("_g").alias("mean_recent_growth"), F.count(F.lit(1)).alias("n_periods"))


def quadrant_summary(df: DataFrame, a: str, b: str, key: str | None = None) -> DataFrame:
    """above/below the median of two measures → 2×2 summary with row
    counts and means."""
    fitted = column_quantiles(df, [a, b], [0.5])
    ma, mb = (F.lit(fitted[c][0]).cast("double") for c in (a, b))
    q = df.select((F.col(a) >= ma).alias(f"high_{a}"), (F.col(b) >= mb).alias(f"high_{b}"), a, b)
    return q.groupBy(f"high_{a}", f"high_{b}").agg(F.count(F.lit(1)).alias("n_rows"),
                                                     F.avg(a).alias(f"mean_{a}"), F.avg(b).alias(f"mean_{b}"))


def revenue_bridge(df: DataFrame, gross: str, discount: str, refund: str | None = None) -> DataFrame:
    """gross, −discount, −refund, net as ordered steps (one scan)."""
    a = df.agg(F.sum(gross).alias("g"), F.sum(discount).alias("d"),
               (F.sum(refund) if refund else F.lit(0.0)).alias("r"))
    steps = [(1, "gross", F.col("g")), (2, "discount", -F.col("d")), (3, "refund", -F.coalesce(F.col("r"), F.lit(0.0))),
             (4, "net", F.col("g") - F.col("d") - F.coalesce(F.col("r"), F.lit(0.0)))]
    structs = [F.struct(F.lit(i).alias("step_order"), F.lit(n).alias("step"), v.cast("double").alias("amount"))
               for i, n, v in steps]
    return a.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def return_impact(df: DataFrame, keys, returned: str, qty: str, refund: str, revenue: str,
                  order_col: str | None = None, min_orders: int = 0) -> DataFrame:
    """per group: lines, returned lines, returned units, refund, return
    rate (returned lines / lines), refund / revenue; optional minimum
    distinct-order support."""
    aggs = [F.count(F.lit(1)).alias("n_lines"), F.count_if(F.col(returned) == 1).alias("returned_lines"),
            F.sum(F.when(F.col(returned) == 1, F.col(qty)).otherwise(0)).alias("returned_units"),
            F.sum(refund).alias("refund"), F.sum(revenue).alias("revenue")]
    if order_col:
        aggs.append(F.count_distinct(order_col).alias("n_orders"))
    g = df.groupBy(*_k(keys)).agg(*aggs)
    g = g.withColumn("return_rate", F.try_divide(F.col("returned_lines") * 1.0, F.col("n_lines"))) \
        .withColumn("refund_to_revenue", F.try_divide(F.col("refund"), F.col("revenue")))
    if order_col and min_orders:
        g = g.filter(F.col("n_orders") >= min_orders)
    return g


def delivery_vs_return(df: DataFrame, returned: str, days: str, rating: str | None = None) -> DataFrame:
    """mean / median delivery days (and mean rating) by returned flag."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.avg(days).alias("mean_days")]
    if rating:
        aggs.append(F.avg(rating).alias("mean_rating"))
    out = with_group_quantiles(df.groupBy(returned).agg(*aggs), df, returned, {"median_days": (days, 0.5)})
    return out.select(returned, "n_rows", "mean_days", "median_days", *(["mean_rating"] if rating else []))


def yoy_growth_geomean(df: DataFrame, date_col: str, value: str, complete_only: bool = True) -> DataFrame:
    """yearly totals, year-over-year growth, and the geometric mean
    growth Π(1+g)^(1/n) over complete years (years with Jan 1 and Dec 31
    present). Yearly table is tiny, so its window is single-partition."""
    y = df.groupBy(F.year(date_col).alias("year")).agg(
        F.sum(value).alias("total"), F.min(date_col).alias("_a"), F.max(date_col).alias("_b"))
    if complete_only:
        y = y.filter((F.month("_a") == 1) & (F.dayofmonth("_a") == 1) & (F.month("_b") == 12) & (F.dayofmonth("_b") == 31))
    w = Window.orderBy("year")
    g = y.select("year", "total", F.try_divide(F.col("total"), F.lag("total").over(w)).alias("_ratio"))
    return g.agg(F.count("_ratio").alias("n_growth_years"),
                 F.exp(F.avg(F.ln(F.col("_ratio")))).alias("geomean_ratio")) \
        .withColumn("geomean_growth", F.col("geomean_ratio") - 1.0)


def histogram_data(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """equal-width bins from min to max (last bin closed), counts per
    bin including empty bins; edges from one scalar subquery."""
    mm = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))
    lo, hi = mm.select("lo").scalar(), mm.select("hi").scalar()
    width = (hi - lo) / bins
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1))).cast("int")
    counts = df.filter(F.col(col).isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("bin_left"), (lo + (F.col("bin") + 1) * width).alias("bin_right"),
        F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def boxplot_stats(df: DataFrame, col: str, keys=(), k: float = 1.5) -> DataFrame:
    """q1, median, q3, whiskers at k·IQR clipped to the data, outlier
    count, per group (no keys: the whole table's quartiles as literals)."""
    keys, probs = _k(keys), [0.25, 0.5, 0.75]
    if keys:
        q = group_quantiles(df, col, probs, keys).select(*keys, F.col("q").alias("_q"))
        j = null_safe_join(df.select(*keys, col), q, keys)
        qcol = F.col("_q")
    else:
        j = df.select(col)
        qcol = F.array(*[F.lit(v).cast("double") for v in column_quantiles(df, col, probs)[col]])
    j = j.withColumn("q1", qcol[0]).withColumn("median", qcol[1]).withColumn("q3", qcol[2])
    j = j.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo, hi = F.col("q1") - k * F.col("iqr"), F.col("q3") + k * F.col("iqr")
    inside = (F.col(col) >= lo) & (F.col(col) <= hi)
    return j.groupBy(*keys, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col(col))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col(col))).cast("double").alias("whisker_high"),
        F.count_if(F.col(col).isNotNull() & ~inside).alias("n_outliers"))


def category_counts(df: DataFrame, col: str, top_n: int | None = None) -> DataFrame:
    """value counts including NULL as a value, share of rows, top n
    (ties broken by value)."""
    total = df.select(F.count(F.lit(1))).scalar()
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).withColumn(
        "rate", F.try_divide(F.col("count") * 1.0, total))
    if top_n:
        g = g.orderBy(F.desc("count"), F.asc_nulls_last(col)).limit(top_n)
    return g


def group_target_agg(df: DataFrame, key: str, target: str, agg: str = "mean", top_k: int | None = None) -> DataFrame:
    """any aggregate of the target per group, optionally only over the
    top-k most frequent groups (semi join against a k-row table)."""
    src = df
    if top_k:
        top = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
               .orderBy(F.desc("_n"), F.asc(key)).limit(top_k).select(key))
        src = df.join(F.broadcast(top), key, "left_semi")  # k rows
    if agg == "median":
        rows = src.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
        return with_group_quantiles(rows, src, key, {f"median_{target}": (target, 0.5)}).select(key, f"median_{target}", "n_rows")
    fn = {"mean": F.avg, "sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[agg]
    return src.groupBy(key).agg(fn(target).alias(f"{agg}_{target}"), F.count(F.lit(1)).alias("n_rows"))


def split_contract(df: DataFrame, split_col: str, date_col: str, target: str | None = None,
                   key: str | None = None) -> DataFrame:
    """per split: rows, distinct keys, start, end, positive rate."""
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.min(date_col).alias("start_date"), F.max(date_col).alias("end_date")]
    if key:
        aggs.append(F.count_distinct(key).alias("n_keys"))
    if target:
        aggs.append(F.avg(target).alias("positive_rate"))
    return df.groupBy(split_col).agg(*aggs)


def daily_agg(df: DataFrame, date_col: str, aggs: dict[str, Column], out_date: str = "date") -> DataFrame:
    """a source table aggregated to one row per day."""
    return df.groupBy(F.col(date_col).alias(out_date)).agg(*[v.alias(k) for k, v in aggs.items()])


def flag_vs_noflag(df: DataFrame, flag: str, measures: list[str]) -> DataFrame:
    """F32: mean and median of measures for flagged vs unflagged rows."""
    rows = df.groupBy(flag).agg(F.count(F.lit(1)).alias("n_rows"), *[F.avg(m).alias(f"mean_{m}") for m in measures])
    out = with_group_quantiles(rows, df, flag, {f"median_{m}": (m, 0.5) for m in measures})
    return out.select(flag, "n_rows", *[c for m in measures for c in (f"mean_{m}", f"median_{m}")])


def distribution_by_group(df: DataFrame, keys, value: str) -> DataFrame:
    """count, mean, median, sample std, min, max per group."""
    rows = df.groupBy(*_k(keys)).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"))
    return with_group_quantiles(rows, df, _k(keys), {"median": (value, 0.5)}).select(
        *_k(keys), "n", "mean", "median", "std", "min", "max")


