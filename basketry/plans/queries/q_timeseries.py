"""Queries for §2.7 windows and time-series operators."""

from pyspark.sql import functions as F

from basketry.functions import calendar as cal
from basketry.operators import timeseries as ts
from basketry.plans.catalog import register, table, tidy
from basketry.plans.features import daily_sales
from basketry.plans.queries.q_rollup import LINES_SQL, lines
from basketry.sources import retail
from basketry.sources.retail import with_roles


def dense_daily(spark, sf):
    """Daily revenue/cogs on a gap-free calendar (missing days NULL)."""
    d = daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    return ts.densify(d, "sale_date")


DENSE_SQL = LINES_SQL + """,
daily AS (SELECT ship_date AS sale_date, sum(net) AS revenue, sum(cost) AS cogs FROM lines WHERE ship_date IS NOT NULL GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series(min(sale_date), max(sale_date), INTERVAL 1 DAY)) AS DATE) AS sale_date FROM daily),
dd AS (SELECT spine.sale_date, revenue, cogs FROM spine LEFT JOIN daily USING (sale_date))
"""


@register("lag_features", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(revenue, 4) AS revenue,
       round(lag(revenue, 1) OVER w, 4) AS revenue_lag_1d, round(lag(revenue, 7) OVER w, 4) AS revenue_lag_7d
FROM dd WINDOW w AS (ORDER BY sale_date)""")
def q_lag_features(spark, sf):
    """Row lags on the dense daily series."""
    d = ts.lag_features(dense_daily(spark, sf).select("sale_date", "revenue"), "sale_date", ["revenue"], [1, 7])
    return tidy(d, 4)


@register("rolling_mean_past", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date,
       round(CASE WHEN count(revenue) OVER w >= 1 THEN avg(revenue) OVER w END, 4) AS revenue_rolling_7d_mean
FROM dd WINDOW w AS (ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def q_rolling_mean_past(spark, sf):
    """Mean of the previous 7 rows, current excluded, min_periods 1."""
    d = ts.rolling_mean_past(dense_daily(spark, sf).select("sale_date", "revenue"), "sale_date", ["revenue"], [7])
    return tidy(d.drop("revenue"), 4)


@register("rolling_min_periods", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date,
       round(CASE WHEN count(revenue) OVER w >= 9 THEN avg(revenue) OVER w END, 7) AS revenue_rolling_28d_mean
FROM dd WINDOW w AS (ORDER BY sale_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""")
def q_rolling_min_periods(spark, sf):
    """28-row mean, NULL until max(2, 28 // 3) = 9 values."""
    d = ts.rolling_stats(dense_daily(spark, sf).select("sale_date", "revenue"), "sale_date", ["revenue"], [28],
                         ["mean"], rule="third")
    return tidy(d.drop("revenue"), 7)


@register("rolling_stats", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date,
       round(CASE WHEN count(revenue) OVER w >= 7 THEN avg(revenue) OVER w END, 4) AS revenue_rolling_7d_mean,
       round(CASE WHEN count(revenue) OVER w >= 7 THEN sum(revenue) OVER w END, 4) AS revenue_rolling_7d_sum,
       round(CASE WHEN count(revenue) OVER w >= 7 THEN stddev_samp(revenue) OVER w END, 2) AS revenue_rolling_7d_std,
       round(CASE WHEN count(revenue) OVER w >= 7 THEN min(revenue) OVER w END, 4) AS revenue_rolling_7d_min,
       round(CASE WHEN count(revenue) OVER w >= 7 THEN max(revenue) OVER w END, 4) AS revenue_rolling_7d_max
FROM dd WINDOW w AS (ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def q_rolling_stats(spark, sf):
    """mean/sum/std/min/max over the previous 7 rows, full window."""
    d = ts.rolling_stats(dense_daily(spark, sf).select("sale_date", "revenue"), "sale_date", ["revenue"], [7],
                         ["mean", "sum", "std", "min", "max"], rule="full")
    return tidy(d.drop("revenue"), 4, {"revenue_rolling_7d_std": 2})


@register("pct_change_and_diff", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date,
       round((lag(revenue, 1) OVER w - lag(revenue, 8) OVER w) / nullif(lag(revenue, 8) OVER w, 0), 9) AS revenue_pct_change_7d,
       round(lag(revenue, 1) OVER w - lag(revenue, 8) OVER w, 4) AS revenue_diff_7d
FROM dd WINDOW w AS (ORDER BY sale_date)""")
def q_pct_change_and_diff(spark, sf):
    """G05 + G06: lagged percent change and difference."""
    d = dense_daily(spark, sf)
    return tidy(d.select("sale_date", ts.pct_change_lagged("revenue", 7, "sale_date").alias("revenue_pct_change_7d"),
                         ts.diff_lagged("revenue", 7, "sale_date").alias("revenue_diff_7d")), 4, {"revenue_pct_change_7d": 9})


@register("period_growth", LINES_SQL + """,
m AS (SELECT date_trunc('month', ship_date) AS month, sum(net) AS revenue, sum(quantity) AS units FROM lines GROUP BY 1)
SELECT CAST(CAST(month AS DATE) AS VARCHAR) AS month, round(revenue, 4) AS revenue, round(units, 2) AS units,
       round((revenue - lag(revenue) OVER w) / nullif(lag(revenue) OVER w, 0), 9) AS revenue_growth,
       round((units - lag(units) OVER w) / nullif(lag(units) OVER w, 0), 9) AS units_growth
FROM m WINDOW w AS (ORDER BY month)""")
def q_period_growth(spark, sf):
    """Month-over-month growth of revenue and units."""
    m = lines(spark, sf).groupBy(F.to_date(F.date_trunc("month", "ship_date")).alias("month")).agg(
        F.sum("net").alias("revenue"), F.sum("quantity").alias("units"))
    return tidy(ts.period_growth(m, "month", ["revenue", "units"]), 9, {"revenue": 4, "units": 2})


@register("trailing_average_inclusive", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(revenue, 4) AS revenue,
       round(avg(revenue) OVER (ORDER BY sale_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 7) AS revenue_trailing_30
FROM dd""")
def q_trailing_average(spark, sf):
    """30-row mean including the current row."""
    d = ts.trailing_average_inclusive(dense_daily(spark, sf).select("sale_date", "revenue"), "sale_date", "revenue", 30)
    return tidy(d, 4, {"revenue_trailing_30": 7})


@register("strictly_prior_cumulative", LINES_SQL + """,
d AS (SELECT product_id, ship_date, sum(returned) AS ds, count(returned) AS dc FROM lines GROUP BY 1, 2)
SELECT product_id, CAST(ship_date AS VARCHAR) AS ship_date,
       coalesce(sum(ds) OVER w, 0)::BIGINT AS past_sum, coalesce(sum(dc) OVER w, 0)::BIGINT AS past_count
FROM d WINDOW w AS (PARTITION BY product_id ORDER BY ship_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def q_strictly_prior(spark, sf):
    """Per product and day, returns and lines on earlier days only."""
    return tidy(ts.strictly_prior_cumulative(lines(spark, sf), "product_id", "ship_date", "returned"))


GLOBAL_PRIOR_SQL = """,
g AS (SELECT ship_date, sum(returned) AS ds, count(returned) AS dc FROM lines GROUP BY 1),
gp AS (SELECT ship_date, CASE WHEN coalesce(sum(dc) OVER w, 0) > 0 THEN coalesce(sum(ds) OVER w, 0) / sum(dc) OVER w ELSE 0.0 END
              AS prior_global_rate FROM g WINDOW w AS (ORDER BY ship_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
"""


@register("global_prior_rate", LINES_SQL + GLOBAL_PRIOR_SQL + """
SELECT CAST(ship_date AS VARCHAR) AS ship_date, round(prior_global_rate, 9) AS prior_global_rate FROM gp""")
def q_global_prior_rate(spark, sf):
    """Global return rate over earlier days, 0 when none."""
    return tidy(ts.global_prior_rate(lines(spark, sf), "ship_date", "returned"))


BACKOFF_SQL = LINES_SQL + GLOBAL_PRIOR_SQL + """,
d AS (SELECT product_id, ship_date, sum(returned) AS ds, count(returned) AS dc FROM lines GROUP BY 1, 2),
p AS (SELECT product_id, ship_date, coalesce(sum(ds) OVER w, 0) AS past_sum, coalesce(sum(dc) OVER w, 0) AS past_count
      FROM d WINDOW w AS (PARTITION BY product_id ORDER BY ship_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT p.*, CASE WHEN past_count > 0 THEN past_sum / past_count ELSE prior_global_rate END AS rate_before
      FROM p LEFT JOIN gp USING (ship_date)),
bb AS (SELECT *, CASE WHEN past_count >= 30 AND rate_before >= 0.10 THEN 1 ELSE 0 END AS is_high_risk FROM b)
"""


@register("backoff_rate", BACKOFF_SQL + """
SELECT product_id, CAST(ship_date AS VARCHAR) AS ship_date, past_count::BIGINT AS past_count,
       round(rate_before, 9) AS rate_before, is_high_risk FROM bb""")
def q_backoff_rate(spark, sf):
    """Product prior rate, else global prior rate; high-risk flag."""
    b = ts.backoff_rate(lines(spark, sf), "product_id", "ship_date", "returned")
    return tidy(b.select("product_id", "ship_date", "past_count", "rate_before", "is_high_risk"))


@register("order_history_features", BACKOFF_SQL + """
SELECT l.order_id, round(avg(rate_before), 9) AS mean_rate_before, round(max(rate_before), 9) AS max_rate_before,
       sum(is_high_risk)::BIGINT AS high_risk_count, min(past_count)::BIGINT AS min_history_count
FROM lines l LEFT JOIN bb USING (product_id, ship_date) GROUP BY 1""")
def q_order_history(spark, sf):
    """Per-order aggregates of the products' prior return rates."""
    return tidy(ts.order_history_features(lines(spark, sf), "order_id", "product_id", "ship_date", "returned"))


@register("first_event_date", """
SELECT o_custkey, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS first_date FROM orders GROUP BY 1""")
def q_first_event(spark, sf):
    """First order date per customer."""
    return tidy(ts.first_event_date(retail.orders(spark, sf).withColumnRenamed("customer_id", "o_custkey"),
                                    "o_custkey", "order_date"))


@register("daily_spine", with_roles("orders") + """,
s AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS d FROM r_orders)
SELECT count(*) AS n_days, count(*) - (SELECT count(DISTINCT order_date) FROM r_orders) AS n_missing,
       CAST(min(d) FILTER (WHERE d NOT IN (SELECT order_date FROM r_orders)) AS VARCHAR) AS first_missing,
       CAST(max(d) FILTER (WHERE d NOT IN (SELECT order_date FROM r_orders)) AS VARCHAR) AS last_missing FROM s""")
def q_daily_spine(spark, sf):
    """Dense calendar and the days the data misses."""
    o = retail.orders(spark, sf)
    spine = ts.daily_spine(o, "order_date", "d")
    miss = spine.join(o.select(F.col("order_date").alias("d")).distinct(), "d", "left_anti")
    return tidy(spine.agg(F.count(F.lit(1)).alias("n_days")).select(
        "n_days", miss.select(F.count(F.lit(1))).scalar().alias("n_missing"),
        miss.select(F.min("d")).scalar().alias("first_missing"), miss.select(F.max("d")).scalar().alias("last_missing")))


@register("tenure_days", with_roles("orders") + """
SELECT order_id, date_diff('day', min(order_date) OVER (PARTITION BY customer_id), order_date) AS tenure_days,
       CASE WHEN date_diff('day', min(order_date) OVER (PARTITION BY customer_id), order_date) < 30 THEN '< 30 days (New)'
            WHEN date_diff('day', min(order_date) OVER (PARTITION BY customer_id), order_date) <= 180 THEN '30-180 days'
            WHEN date_diff('day', min(order_date) OVER (PARTITION BY customer_id), order_date) <= 365 THEN '180-365 days'
            ELSE '> 365 days (Loyal)' END AS tenure_group
FROM r_orders""")
def q_tenure_days(spark, sf):
    """G15 + J07: days since the customer's first order and its group."""
    from basketry.operators.binning import tenure_group
    o = retail.orders(spark, sf)
    f = ts.first_event_date(o, "customer_id", "order_date", "first_order")
    j = o.join(f, "customer_id").withColumn("tenure_days", ts.tenure_days("order_date", "first_order"))
    return j.select("order_id", "tenure_days", tenure_group("tenure_days", "eda").alias("tenure_group"))


@register("seasonal_profile", DENSE_SQL + """,
n AS (SELECT sale_date, revenue / avg(revenue) OVER (PARTITION BY year(sale_date)) AS norm FROM dd)
SELECT month(sale_date) AS month, day(sale_date) AS day, round(avg(norm), 9) AS seasonal_factor FROM n GROUP BY 1, 2""")
def q_seasonal_profile(spark, sf):
    """G16 + G17: value / its year mean, averaged per (month, day)."""
    d = ts.year_normalised_value(dense_daily(spark, sf), "sale_date", "revenue", "norm")
    return tidy(ts.seasonal_profile(d, "sale_date", "norm"))


CUMSHARE_SQL = LINES_SQL + """,
g AS (SELECT product_id, sum(net) AS value FROM lines GROUP BY 1),
r AS (SELECT product_id, value, row_number() OVER (ORDER BY value DESC, product_id) AS rank,
             sum(value) OVER (ORDER BY value DESC, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / (SELECT sum(value) FROM g) AS cs
      FROM g)
"""


@register("cumulative_share", CUMSHARE_SQL + """
SELECT product_id, round(value, 4) AS value, rank, round(rank * 1.0 / (SELECT count(*) FROM g), 9) AS item_share,
       round(cs, 9) AS cumulative_share FROM r""")
def q_cumulative_share(spark, sf):
    """Products ranked by revenue with running share (distributed
    prefix sum; no single-partition window over rows)."""
    ranked, _ = ts.cumulative_share(lines(spark, sf), "product_id", "net")
    return tidy(ranked, 9, {"value": 4})


@register("cumulative_share_summary", CUMSHARE_SQL + """
SELECT (SELECT count(*) FROM g) AS n_items, (SELECT min(rank) FROM r WHERE cs >= 0.8) AS items_for_threshold,
       round((SELECT max(cs) FROM r WHERE rank = least(10, (SELECT count(*) FROM g))), 9) AS top_k_share,
       round((SELECT max(cs) FROM r WHERE rank <= ceil((SELECT count(*) FROM g) * 0.2)), 9) AS top_20pct_share""")
def q_cumulative_share_summary(spark, sf):
    """G18 summary: items for 80%, top-10 and top-20% shares."""
    _, summary = ts.cumulative_share(lines(spark, sf), "product_id", "net")
    return tidy(summary)


@register("importance_cumulative", LINES_SQL + """,
t AS (SELECT category, sum(net) AS importance FROM lines GROUP BY 1)
SELECT category, round(importance, 4) AS importance, round(importance / (SELECT sum(importance) FROM t), 9) AS share,
       row_number() OVER (ORDER BY importance DESC, category) AS rank,
       round(sum(importance / (SELECT sum(importance) FROM t)) OVER (ORDER BY importance DESC, category
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 9) AS cumulative_share FROM t""")
def q_importance_cumulative(spark, sf):
    """Share, rank and running share on a small importance table."""
    t = lines(spark, sf).groupBy("category").agg(F.sum("net").alias("importance"))
    return tidy(ts.importance_cumulative(t, "category", "importance"), 9, {"importance": 4})


@register("lag1_autocorrelation", DENSE_SQL + """
SELECT round(corr(revenue, l), 9) AS lag1_autocorr FROM (SELECT revenue, lag(revenue) OVER (ORDER BY sale_date) AS l FROM dd)""")
def q_lag1_autocorr(spark, sf):
    """corr(x, x lagged one day)."""
    return tidy(ts.lag1_autocorrelation(dense_daily(spark, sf), "sale_date", "revenue"))


@register("rank_within_group", LINES_SQL + """,
t AS (SELECT brand, category, sum(net) AS score FROM lines GROUP BY 1, 2)
SELECT * FROM (SELECT brand, category, round(score, 4) AS score,
       row_number() OVER (PARTITION BY brand ORDER BY abs(score) DESC, category) AS rank_in_group FROM t) WHERE rank_in_group <= 3""")
def q_rank_within_group(spark, sf):
    """Top 3 categories per brand by |score|, name tie-break."""
    t = lines(spark, sf).groupBy("brand", "category").agg(F.sum("net").alias("score"))
    return tidy(ts.rank_within_group(t, "brand", "score", "category", cap=3), 4)


@register("recent_period_presence", """
WITH t AS (SELECT p_brand AS feature, year(l_shipdate) AS period,
                  sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS value
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
c AS (SELECT min(period) AS cutoff FROM (SELECT DISTINCT period FROM t ORDER BY period DESC LIMIT 2)),
l AS (SELECT feature, max(period) AS last_period FROM t WHERE value IS NOT NULL GROUP BY 1)
SELECT f.feature, l.last_period, coalesce(l.last_period >= (SELECT cutoff FROM c), false) AS recent_present
FROM (SELECT DISTINCT feature FROM t) f LEFT JOIN l USING (feature)""")
def q_recent_presence(spark, sf):
    """Is each feature's last valid period among the two newest?"""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand"),
                                           "l_partkey")
    t = li.groupBy(F.col("p_brand").alias("feature"), F.year("l_shipdate").alias("period")).agg(
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("value"))
    return ts.recent_period_presence(t, "feature", "period", "value")


@register("calendar_features", with_roles("orders") + """
SELECT CAST(d AS VARCHAR) AS d, isodow(d) - 1 AS dayofweek, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       month(d) AS month, quarter(d) AS quarter, year(d) AS year, day(d) AS dayofmonth, dayofyear(d) AS dayofyear,
       weekofyear(d) AS weekofyear, CASE WHEN day(d) = 1 THEN 1 ELSE 0 END AS is_month_start,
       CASE WHEN d = last_day(d) THEN 1 ELSE 0 END AS is_month_end,
       round(sin(2 * pi() * (isodow(d) - 1) / 7.0), 9) AS dow_sin, round(cos(2 * pi() * (isodow(d) - 1) / 7.0), 9) AS dow_cos,
       round(sin(2 * pi() * (month(d) - 1) / 12.0), 9) AS month_sin, round(cos(2 * pi() * (month(d) - 1) / 12.0), 9) AS month_cos,
       date_diff('day', d, make_date(year(d), 12, 31)) AS days_to_year_end
FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS d FROM r_orders)""")
def q_calendar_features(spark, sf):
    """G23 + G24 + G27: calendar columns, cyclic encodings, days to year end."""
    spine = ts.daily_spine(retail.orders(spark, sf), "order_date", "d")
    out = spine.withColumns(cal.calendar_columns("d")).withColumns(cal.cyclic_encoding(F.weekday("d"), 7, "dow")) \
        .withColumns(cal.cyclic_encoding(F.month("d"), 12, "month", offset=1)) \
        .withColumn("days_to_year_end", cal.days_to_year_end("d"))
    return tidy(out, 9)


@register("holiday_calendar_fixed", """
WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events)
SELECT CAST(d AS VARCHAR) AS event_date, CASE WHEN (month(d), day(d)) IN ((1, 1), (4, 30), (5, 1), (9, 2))
  OR d BETWEEN DATE '2024-02-08' AND DATE '2024-02-14' OR d = DATE '2024-04-18' THEN 1 ELSE 0 END AS is_holiday FROM d""")
def q_holiday_fixed(spark, sf):
    """Event days flagged against the fixed + lunar holiday table."""
    ev = retail.events(spark, sf).select("event_date").distinct()
    yrs = ev.agg(F.min(F.year("event_date")).alias("a"), F.max(F.year("event_date")).alias("b")).first()
    hol = cal.fixed_holiday_table(spark, yrs["a"], yrs["b"])
    return tidy(cal.holiday_flag(ev, "event_date", hol))


@register("holiday_calendar_rule", with_roles("orders") + """,
y AS (SELECT unnest(generate_series(year(min(order_date)) - 1, year(max(order_date)) + 1)) AS y FROM r_orders),
fx AS (SELECT * FROM (VALUES ('new_years_day', 1, 1, 0), ('juneteenth', 6, 19, 2021), ('independence_day', 7, 4, 0),
                             ('veterans_day', 11, 11, 0), ('christmas', 12, 25, 0)) t(holiday, m, dd, since)),
nth AS (SELECT * FROM (VALUES ('mlk_day', 1, 0, 3, 1986), ('presidents_day', 2, 0, 3, 0), ('memorial_day', 5, 0, -1, 0),
                              ('labor_day', 9, 0, 1, 0), ('columbus_day', 10, 0, 2, 0), ('thanksgiving', 11, 3, 4, 0)) t(holiday, m, wd, n, since)),
a AS (SELECT holiday, make_date(y, m, dd) AS raw FROM fx, y WHERE y >= since),
b AS (SELECT holiday, CASE WHEN isodow(raw) = 6 THEN raw - 1 WHEN isodow(raw) = 7 THEN raw + 1 ELSE raw END AS holiday_date FROM a),
c AS (SELECT holiday, CASE WHEN n > 0 THEN make_date(y, m, 1) + CAST((wd - (isodow(make_date(y, m, 1)) - 1) + 7) % 7 + (n - 1) * 7 AS INTEGER)
            ELSE last_day(make_date(y, m, 1)) - CAST(((isodow(last_day(make_date(y, m, 1))) - 1) - wd + 7) % 7 AS INTEGER) END AS holiday_date
      FROM nth, y WHERE y >= since),
u AS (SELECT * FROM b UNION ALL SELECT * FROM c)
SELECT holiday, CAST(holiday_date AS VARCHAR) AS holiday_date FROM u
WHERE holiday_date BETWEEN (SELECT min(order_date) FROM r_orders) AND (SELECT max(order_date) FROM r_orders)""")
def q_holiday_rule(spark, sf):
    """US federal holidays (observed) within the order date range."""
    b = retail.orders(spark, sf).agg(F.min("order_date").alias("a"), F.max("order_date").alias("b")).first()
    return tidy(cal.us_federal_holidays(spark, str(b["a"]), str(b["b"])))


FEATURE_NAMES = ["revenue_lag_1d", "revenue_lag_7d", "revenue_rolling_7d_mean", "revenue_rolling_28d_std",
                 "cogs_pct_change_7d", "revenue_diff_1d", "dayofweek", "is_weekend", "mystery_feature"]


@register("feature_name_compiler", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(lag(revenue, 1) OVER w, 4) AS revenue_lag_1d,
       round(lag(revenue, 7) OVER w, 4) AS revenue_lag_7d,
       round(CASE WHEN count(revenue) OVER w7 >= 7 THEN avg(revenue) OVER w7 END, 4) AS revenue_rolling_7d_mean,
       round(CASE WHEN count(revenue) OVER w28 >= 28 THEN stddev_samp(revenue) OVER w28 END, 2) AS revenue_rolling_28d_std,
       round((lag(cogs, 1) OVER w - lag(cogs, 8) OVER w) / nullif(lag(cogs, 8) OVER w, 0), 9) AS cogs_pct_change_7d,
       round(lag(revenue, 1) OVER w - lag(revenue, 2) OVER w, 4) AS revenue_diff_1d,
       isodow(sale_date) - 1 AS dayofweek, CASE WHEN isodow(sale_date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       0.0::DOUBLE AS mystery_feature
FROM dd WINDOW w AS (ORDER BY sale_date), w7 AS (ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
               w28 AS (ORDER BY sale_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)""")
def q_feature_name_compiler(spark, sf):
    """G29 (+G28): saved feature names compiled to window expressions in
    one select; the unknown name becomes 0."""
    out, _unknown = ts.feature_name_compiler(dense_daily(spark, sf), FEATURE_NAMES, "sale_date", rule="full")
    return tidy(out, 4, {"revenue_rolling_28d_std": 2, "cogs_pct_change_7d": 9})


@register("time_features_registry", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(lag(revenue, 1) OVER w, 4) AS revenue_lag_1d, round(lag(revenue, 7) OVER w, 4) AS revenue_lag_7d,
       round(CASE WHEN count(revenue) OVER w7 >= 2 THEN avg(revenue) OVER w7 END, 7) AS revenue_rolling_7d_mean,
       round(CASE WHEN count(revenue) OVER w7 >= 2 THEN max(revenue) OVER w7 END, 4) AS revenue_rolling_7d_max,
       round(lag(cogs, 1) OVER w, 4) AS cogs_lag_1d, 5::BIGINT AS n_catalog_rows
FROM dd WINDOW w AS (ORDER BY sale_date), w7 AS (ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def q_time_features_registry(spark, sf):
    """Only requested lag/rolling features are created; catalog rows."""
    out, catalog = ts.time_features_registry(dense_daily(spark, sf), "sale_date",
                                             {"revenue": {"lags": [1, 7], "rolling": [7], "stats": ["mean", "max"]},
                                              "cogs": {"lags": [1]}})
    return tidy(out.withColumn("n_catalog_rows", F.lit(catalog.count())), 4, {"revenue_rolling_7d_mean": 7})
