"""Queries for §2.13 end-to-end feature tables (plus A08 and S03)."""

from pyspark.sql import functions as F

from basketry.operators import timeseries as ts
from basketry.plans import features as ft
from basketry.plans.catalog import ORACLES, register, table, tidy
from basketry.plans.daily_sources import DailySource, build_daily_model, join_report
from basketry.plans.queries.q_rollup import PART_TYPES, category_levels
from basketry.plans.queries.q_timeseries import DENSE_SQL, dense_daily
from basketry.sources import io, retail
from basketry.sources.retail import with_roles

def spec(spark, sf) -> ft.OrderFeatureSpec:
    return ft.OrderFeatureSpec(cash_col="priority", cash_value="1-urgent", categorical=["priority", "segment"],
                               multihot=category_levels(spark, sf))


STATUS = "CASE order_status WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'returned' ELSE 'processing' END"


def master(spark, sf):
    """Order × item master (E03) with a text order status. Items meet their product
    before their order: wide rows are shuffled once and lie by order afterwards."""
    o = retail.orders(spark, sf).withColumn("order_status", F.when(F.col("order_status") == "F", "delivered")
                                            .when(F.col("order_status") == "P", "returned").otherwise("processing"))
    c = retail.customers(spark, sf).select("customer_id", "segment")
    it = retail.items(spark, sf).select("order_id", "product_id", "quantity", "unit_price", "discount_amount")
    p = retail.products(spark, sf).select("product_id", "category")
    return o.join(c, "customer_id", "left").join(it.join(p, "product_id", "left"), "order_id", "left")


M02_SQL = with_roles("orders", "customers", "items", "products") + f""",
m AS (SELECT o.order_id, o.customer_id, o.order_date, o.payment_value, o.priority, c.segment, {STATUS.replace('order_status', 'o.order_status')} AS order_status,
             i.product_id, i.quantity, i.unit_price, i.discount_amount, p.category
      FROM r_orders o LEFT JOIN r_customers c USING (customer_id) LEFT JOIN r_items i USING (order_id) LEFT JOIN r_products p USING (product_id)),
a AS (SELECT order_id, min(customer_id) AS customer_id, min(order_date) AS order_date, min(payment_value) AS payment_value,
             min(priority) AS priority, min(segment) AS segment, min(order_status) AS order_status, sum(quantity) AS total_quantity,
             count(DISTINCT product_id) AS unique_product_count, sum(discount_amount) AS _disc, sum(quantity * unit_price) AS _gross,
             """ + ", ".join(f"max(coalesce(CAST(category = '{v}' AS INTEGER), 0)) AS category_{v.lower()}" for v in PART_TYPES) + """
      FROM m GROUP BY 1),
f AS (SELECT customer_id, min(order_date) AS first FROM a GROUP BY 1),
b AS (SELECT a.*, date_diff('day', f.first, a.order_date) AS tenure, CASE WHEN _gross > 0 THEN _disc / _gross ELSE 0.0 END AS ratio
      FROM a LEFT JOIN f USING (customer_id))
SELECT order_id, CASE order_status WHEN 'returned' THEN 1 WHEN 'delivered' THEN 0 END AS label, tenure AS customer_tenure_days,
       round(total_quantity, 2) AS total_quantity, unique_product_count, round(ratio, 9) AS discount_ratio,
       round(ln(1 + greatest(payment_value, 0)), 9) AS log_payment_value,
       coalesce(nullif(lower(trim(priority)), ''), 'unknown') AS priority, coalesce(nullif(lower(trim(segment)), ''), 'unknown') AS segment,
       CASE WHEN tenure >= 0 AND tenure < 30 THEN 'new_lt_30d' WHEN tenure >= 30 AND tenure < 180 THEN '30_179d'
            WHEN tenure >= 180 AND tenure < 365 THEN '180_364d' WHEN tenure >= 365 THEN 'loyal_365d_plus' END AS tenure_group,
       CASE WHEN lower(trim(priority)) = '1-urgent' THEN 1 ELSE 0 END AS is_cash, CASE WHEN ratio > 0 THEN 1 ELSE 0 END AS is_discounted,
       """ + ", ".join(f"category_{v.lower()}" for v in PART_TYPES) + """, round(payment_value, 2) AS payment_value FROM b"""


@register("serving_features", M02_SQL)
def q_serving_features(spark, sf):
    """Master (order × item fan-out) → one row per order with label,
    numeric, categorical, binary, multi-hot and quantile inputs."""
    history = retail.orders(spark, sf).select("customer_id", "order_date")  # first dates need no second master
    return tidy(ft.serving_features(master(spark, sf), spec(spark, sf), history), 9, {"total_quantity": 2, "payment_value": 2})


@register("order_feature_table", with_roles("orders", "customers", "items", "products") + """,
it AS (SELECT i.*, p.category FROM r_items i LEFT JOIN r_products p USING (product_id)),
blk AS (SELECT order_id, sum(quantity) AS total_quantity, count(DISTINCT product_id) AS n_products, count(*) AS n_lines,
               sum(discount_amount) AS discount_total, sum(gross) AS gross_total, max(CASE WHEN return_flag = 'R' THEN 1 ELSE 0 END) AS returned,
               """ + ", ".join(f"max(CASE WHEN category = '{v}' THEN 1 ELSE 0 END) AS category_{v.lower()}" for v in PART_TYPES) + """
        FROM it GROUP BY 1),
f AS (SELECT customer_id, min(order_date) AS first FROM r_orders GROUP BY 1),
b AS (SELECT o.*, c.* EXCLUDE (customer_id), date_diff('day', f.first, o.order_date) AS customer_tenure_days
      FROM r_orders o LEFT JOIN f USING (customer_id) LEFT JOIN r_customers c USING (customer_id))
SELECT order_id, customer_id, CAST(order_date AS VARCHAR) AS order_date, order_status, round(payment_value, 2) AS payment_value, priority, customer_name,
       nation_id, round(account_balance, 2) AS account_balance, segment, customer_tenure_days,
       CASE WHEN customer_tenure_days >= 0 AND customer_tenure_days < 30 THEN 'new_lt_30d' WHEN customer_tenure_days >= 30 AND customer_tenure_days < 180 THEN '30_179d'
            WHEN customer_tenure_days >= 180 AND customer_tenure_days < 365 THEN '180_364d' WHEN customer_tenure_days >= 365 THEN 'loyal_365d_plus' END AS tenure_group,
       round(ln(1 + greatest(payment_value, 0)), 9) AS log_payment_value, isodow(order_date) - 1 AS dayofweek,
       CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, month(order_date) AS month,
       CASE WHEN quarter(order_date) = 4 THEN 1 ELSE 0 END AS is_q4, round(total_quantity, 2) AS total_quantity, n_products, n_lines,
       round(discount_total, 4) AS discount_total, round(gross_total, 2) AS gross_total, returned,
       round(discount_total / nullif(gross_total, 0), 9) AS discount_ratio, """ + ", ".join(f"category_{v.lower()}" for v in PART_TYPES) + """
FROM b JOIN blk USING (order_id)""")
def q_order_feature_table(spark, sf):
    """Labelled-order training table from pre-aggregated blocks."""
    t = ft.order_feature_table(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf),
                               retail.products(spark, sf), category_levels(spark, sf))
    return tidy(t, 9, {"payment_value": 2, "account_balance": 2, "total_quantity": 2, "discount_total": 4, "gross_total": 2})


@register("nested_order_features", M02_SQL[:M02_SQL.rindex("SELECT order_id")] + """
SELECT order_id, tenure AS customer_tenure_days, round(coalesce(total_quantity, 0), 9) AS total_quantity, unique_product_count,
       round(least(greatest(ratio, 0), 1), 9) AS discount_ratio, round(ln(1 + greatest(payment_value, 0)), 9) AS log_payment_value,
       coalesce(nullif(lower(trim(priority)), ''), 'unknown') AS payment_method,
       (SELECT lower(o_orderstatus) FROM orders WHERE o_orderkey = order_id) AS device_type,
       coalesce(nullif(lower(trim(segment)), ''), 'unknown') AS segment,
       CASE WHEN tenure >= 0 AND tenure < 30 THEN 'new_lt_30d' WHEN tenure >= 30 AND tenure < 180 THEN '30_179d'
            WHEN tenure >= 180 AND tenure < 365 THEN '180_364d' WHEN tenure >= 365 THEN 'loyal_365d_plus' END AS tenure_group,
       CASE WHEN lower(trim(priority)) = '1-urgent' THEN 1 ELSE 0 END AS is_cash, CASE WHEN ratio > 0 THEN 1 ELSE 0 END AS is_discounted,
       payment_value, """ + ", ".join(f"coalesce(category_{v.lower()}, 0) AS category_{v.lower()}" for v in PART_TYPES) + " FROM b")
def q_nested_order_features(spark, sf):
    """Nested JSON order requests (built from the tables) → the same
    features through from_json + higher-order functions."""
    from basketry.plans.scoring import parse_requests, requests_from_tables
    req = requests_from_tables(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf))
    parsed = parse_requests(req).filter(F.col("reject_reason").isNull()).select("order.*")
    return tidy(ft.nested_order_features(parsed, retail.products(spark, sf), category_levels(spark, sf), cash_value="1-urgent"), 9)


@register("daily_target_table", DENSE_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(revenue, 4) AS revenue, round(cogs, 2) AS cogs, round(revenue - cogs, 4) AS profit,
       round(CASE WHEN revenue = 0 THEN 0.0 ELSE (revenue - cogs) / revenue END, 9) AS margin,
       round(lag(revenue, 1) OVER w, 4) AS revenue_lag_1d, round(lag(revenue, 7) OVER w, 4) AS revenue_lag_7d,
       round(avg(revenue) OVER (ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 7) AS revenue_rolling_7d_mean,
       round(avg(revenue) OVER (ORDER BY sale_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 7) AS revenue_rolling_28d_mean
FROM dd WINDOW w AS (ORDER BY sale_date)""")
def q_daily_target_table(spark, sf):
    """Dense daily target with profit, margin, lags and past means."""
    d = ft.daily_target_table(ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf)), "sale_date", "revenue", "cogs")
    return tidy(d, 4, {"cogs": 2, "margin": 9, "revenue_rolling_7d_mean": 7, "revenue_rolling_28d_mean": 7})


@register("daily_candidate_table", DENSE_SQL + """,
o AS (SELECT CAST(o_orderdate AS DATE) AS sale_date, count(*) AS n_orders FROM orders GROUP BY 1),
e AS (SELECT CAST(ts AS DATE) AS sale_date, count(*) AS n_events FROM events GROUP BY 1),
t AS (SELECT sale_date, revenue, cogs FROM daily)
SELECT (SELECT count(*) FROM t) AS rows_before, count(*) AS rows_after, (SELECT count(*) FROM t) = count(*) AS rowcount_match,
       'n_orders,n_events,dayofweek,is_weekend,month,quarter,year,dayofmonth,dayofyear,weekofyear,is_month_start,is_month_end' AS new_columns,
       count_if(n_orders IS NULL) + count_if(n_events IS NULL) AS new_missing_cells
FROM t LEFT JOIN o USING (sale_date) LEFT JOIN e USING (sale_date)""")
def q_daily_candidate_table(spark, sf):
    """Daily target ⟕ daily orders ⟕ daily events ⟕ calendar with the
    row-count check."""
    t = ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    o = retail.orders(spark, sf).groupBy(F.col("order_date").alias("sale_date")).agg(F.count(F.lit(1)).alias("n_orders"))
    e = retail.events(spark, sf).groupBy(F.col("event_date").alias("sale_date")).agg(F.count(F.lit(1)).alias("n_events"))
    _, check = ft.daily_candidate_table(t, {"orders": o, "events": e}, "sale_date")
    return check


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def daily_sources(spark, sf):
    """The sources that the given tables can supply. Reviews have no table:
    nothing here holds a rating."""
    orders, items, products = retail.orders(spark, sf), retail.items(spark, sf), retail.products(spark, sf)
    events = retail.events(spark, sf)
    bought = items.join(orders.select("order_id", "order_date"), "order_id").join(products.select("product_id", "price"), "product_id", "left")
    months = items.withColumn("snapshot_date", F.last_day("ship_date"))
    customers = orders.groupBy("customer_id").agg(F.min("order_date").alias("first_date"))
    flights = orders.join(items.groupBy("order_id").agg(F.max("ship_date").alias("last_date"), F.max("discount_rate").alias("discount_rate")), "order_id")
    counted = F.count(F.lit(1))
    return [
        DailySource("traffic", "event", "after_day", events, "event_date",
                    {"sessions_sum": counted, "event_value_sum": F.sum("value"),
                     **{f"sessions_{t}": F.count_if(F.col("event_type") == t) for t in EVENT_TYPES}}, {"visitors_count": "user_id"}),
        DailySource("orders", "event", "after_day", orders, "order_date",
                    {"order_count": counted, **{f"order_status_{v}_count": F.count_if(F.col("order_status") == v) for v in "FOP"}},
                    {"customer_count": "customer_id", "priority_count": "priority"}),
        DailySource("items", "event", "after_day", bought, "order_date",
                    {"item_quantity_sum": F.sum("quantity"), "gross_item_revenue_sum": F.sum("gross"), "discount_amount_sum": F.sum("discount_amount"),
                     "estimated_cogs_sum": F.sum(F.col("quantity") * F.col("price"))}, {"distinct_product_count": "product_id"}),
        DailySource("payments", "event", "after_day", orders, "order_date",
                    {"payment_value_sum": F.sum("payment_value"), "payment_value_mean": F.avg("payment_value")}),
        DailySource("returns", "event", "after_day", items.filter(F.col("return_flag") == "R"), "ship_date",
                    {"return_count": counted, "return_quantity_sum": F.sum("quantity"), "refund_amount_sum": F.sum(F.col("gross") - F.col("discount_amount"))}),
        DailySource("customers", "event", "after_day", customers, "first_date", {"new_customer_count": counted}),
        DailySource("inventory", "snapshot", "after_day", months, "snapshot_date",
                    {"units_sold_sum": F.sum("quantity"), "shipped_lines": counted}, {"inventory_product_count": "product_id"}),
        DailySource("promo", "interval", "known_now", flights, "order_date", end="last_date", measure="discount_rate", decimal_scale=2),
    ]


LAGS, WINDOWS = (1, 7), (7,)


def _digits(column):
    """Sums have four decimals; means are cut further out, off rounding ties."""
    return 12 if column == "promo_mean" else 7 if "_mean" in column else 4


def _all_sources_sql():
    """The same table by grouping, a scalar lookup of the last snapshot and a join of
    days and intervals."""
    sources = {
        "traffic": ("ev", ["sessions_sum", "event_value_sum", *[f"sessions_{t}" for t in EVENT_TYPES], "visitors_count"]),
        "orders": ("od", ["order_count", *[f"order_status_{v}_count" for v in "FOP"], "customer_count", "priority_count"]),
        "items": ("it", ["item_quantity_sum", "gross_item_revenue_sum", "discount_amount_sum", "estimated_cogs_sum", "distinct_product_count"]),
        "payments": ("pa", ["payment_value_sum", "payment_value_mean"]),
        "returns": ("re", ["return_count", "return_quantity_sum", "refund_amount_sum"]),
        "customers": ("cu", ["new_customer_count"]),
        "inventory": ("inv", ["units_sold_sum", "shipped_lines", "inventory_product_count"]),
    }
    late = ["revenue", "cogs", *[c for _, cols in sources.values() for c in cols]]
    made = ", ".join([f"round(lag({c}, {k}) OVER w, {_digits(c)}) AS {c}_lag_{k}d" for c in late for k in LAGS]
                     + [f"round(avg({c}) OVER (ORDER BY sale_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING), 7) AS {c}_rolling_{n}d_mean"
                        for c in late for n in WINDOWS])
    joins = " ".join(f"LEFT JOIN {a} ON {a}.k = dd.sale_date" for a, _ in sources.values() if a != "inv")
    return DENSE_SQL + f""",
r_orders AS ({retail.SQL["orders"]}), r_events AS ({retail.SQL["events"]}),
ev AS (SELECT event_date AS k, count(*) AS sessions_sum, sum(value) AS event_value_sum,
       {", ".join(f"count_if(event_type = '{t}') AS sessions_{t}" for t in EVENT_TYPES)}, count(DISTINCT user_id) AS visitors_count
       FROM r_events GROUP BY 1),
od AS (SELECT order_date AS k, count(*) AS order_count, {", ".join(f"count_if(order_status = '{v}') AS order_status_{v}_count" for v in "FOP")},
       count(DISTINCT customer_id) AS customer_count, count(DISTINCT priority) AS priority_count FROM r_orders GROUP BY 1),
it AS (SELECT o.order_date AS k, sum(quantity) AS item_quantity_sum, sum(gross) AS gross_item_revenue_sum,
       sum(discount_amount) AS discount_amount_sum, sum(cost) AS estimated_cogs_sum, count(DISTINCT product_id) AS distinct_product_count
       FROM lines JOIN r_orders o USING (order_id) GROUP BY 1),
pa AS (SELECT order_date AS k, sum(payment_value) AS payment_value_sum, avg(payment_value) AS payment_value_mean FROM r_orders GROUP BY 1),
re AS (SELECT ship_date AS k, count(*) AS return_count, sum(quantity) AS return_quantity_sum, sum(net) AS refund_amount_sum
       FROM lines WHERE return_flag = 'R' GROUP BY 1),
cu AS (SELECT k, count(*) AS new_customer_count FROM (SELECT customer_id, min(order_date) AS k FROM r_orders GROUP BY 1) GROUP BY 1),
mo AS (SELECT last_day(ship_date) AS k, sum(quantity) AS units_sold_sum, count(*) AS shipped_lines,
       count(DISTINCT product_id) AS inventory_product_count FROM lines WHERE ship_date IS NOT NULL GROUP BY 1),
fl AS (SELECT order_date AS s, last_date AS e, m FROM r_orders JOIN (SELECT order_id, max(ship_date) AS last_date, max(discount_rate) AS m
       FROM lines GROUP BY 1) USING (order_id) WHERE order_date <= last_date),
act AS (SELECT spine.sale_date AS k, count(s) AS n, CAST(sum(CAST(m AS DECIMAL(38, 2))) AS DOUBLE) / count(s) AS mean, max(m) AS mx FROM spine LEFT JOIN fl ON sale_date BETWEEN s AND e GROUP BY 1),
hol AS ({_holiday_dates_sql()}),
j AS (SELECT dd.*, {", ".join(f"{a}.* EXCLUDE (k)" for a, _ in sources.values() if a != "inv")}, inv.* EXCLUDE (k), n, mean, mx,
      sale_date IN (SELECT holiday_date FROM hol) AS is_h
      FROM dd {joins} LEFT JOIN mo inv ON inv.k = (SELECT max(k) FROM mo WHERE k <= dd.sale_date) LEFT JOIN act ON act.k = dd.sale_date)
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(revenue, 4) AS revenue, round(cogs, 4) AS cogs, isodow(sale_date) - 1 AS dayofweek, month(sale_date) AS month,
       quarter(sale_date) AS quarter, year(sale_date) AS year, CAST(isodow(sale_date) >= 6 AS INTEGER) AS is_weekend,
       date_diff('day', sale_date, make_date(year(sale_date), 12, 31)) AS days_to_year_end, CAST(is_h AS INTEGER) AS is_holiday,
       n AS promo_count_active, round(coalesce(mean, 0), 12) AS promo_mean, round(coalesce(mx, 0), 4) AS promo_max,
       CAST(n > 0 AS INTEGER) AS is_promo_active, {made}
FROM j WINDOW w AS (ORDER BY sale_date)"""


def _holiday_dates_sql():
    """Observed federal holidays between the first and the last day of the spine."""
    sql = ORACLES["holiday_calendar_rule"].replace("r_orders", "h_days").replace("order_date", "sale_date")
    body = sql[sql.index("y AS ("):]
    return ("WITH h_days AS (SELECT sale_date FROM spine),\n" + body).replace("SELECT holiday, CAST(holiday_date AS VARCHAR) AS holiday_date", "SELECT DISTINCT holiday_date")


@register("daily_model_all_sources", _all_sources_sql())
def q_daily_model_all_sources(spark, sf):
    """The daily model table from eight sources and the calendar: planned
    intervals on the day, everything else only by lags and past means."""
    t = ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    model = build_daily_model(t, "sale_date", ["revenue", "cogs"], daily_sources(spark, sf), LAGS, WINDOWS)
    return tidy(model.table, 4, {c: _digits(c) for c in model.table.columns})


@register("daily_source_report", DENSE_SQL + f""",
r_orders AS ({retail.SQL["orders"]}), r_events AS ({retail.SQL["events"]}),
days AS (SELECT 'traffic' AS source, event_date AS k FROM r_events UNION SELECT 'orders', order_date FROM r_orders UNION SELECT 'payments', order_date FROM r_orders
  UNION SELECT 'items', o.order_date FROM lines JOIN r_orders o USING (order_id) UNION SELECT 'returns', ship_date FROM lines WHERE return_flag = 'R'
  UNION SELECT 'customers', min(order_date) FROM r_orders GROUP BY customer_id
  UNION SELECT 'inventory', sale_date FROM spine WHERE sale_date >= (SELECT min(last_day(ship_date)) FROM lines)
  UNION SELECT 'promo', sale_date FROM spine JOIN (SELECT order_date AS s, max(ship_date) AS e FROM lines JOIN r_orders USING (order_id) GROUP BY order_id, order_date)
    ON sale_date BETWEEN s AND e)
SELECT d.source, (SELECT count(*) FROM spine) AS rows_before, (SELECT count(*) FROM spine) AS rows_after, count_if(days.k IS NULL) AS unmatched_days
FROM (SELECT source, sale_date FROM spine, (SELECT DISTINCT source FROM days)) d LEFT JOIN days ON days.source = d.source AND days.k = d.sale_date GROUP BY 1""")
def q_daily_source_report(spark, sf):
    """Rows before and after each source's join, and its days without data."""
    t = ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    model = build_daily_model(t, "sale_date", ["revenue", "cogs"], daily_sources(spark, sf), LAGS, WINDOWS)
    return join_report(model, t, "sale_date")


@register("recreate_selected_features", "SELECT * FROM (" + ORACLES["feature_name_compiler"] + """) WHERE revenue_lag_1d IS NOT NULL
  AND revenue_lag_7d IS NOT NULL AND revenue_rolling_7d_mean IS NOT NULL AND revenue_rolling_28d_std IS NOT NULL
  AND cogs_pct_change_7d IS NOT NULL AND revenue_diff_1d IS NOT NULL""")
def q_recreate_selected(spark, sf):
    """Saved feature list rebuilt, contract kept, incomplete rows dropped."""
    from basketry.plans.queries.q_timeseries import FEATURE_NAMES
    t = ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    kept, _unknown, _report = ft.recreate_selected_features(t, "sale_date", FEATURE_NAMES)
    return tidy(kept, 4, {"revenue_rolling_28d_std": 2, "cogs_pct_change_7d": 9})


@register("target_driver_table", DENSE_SQL + """,
o AS (SELECT CAST(o_orderdate AS DATE) AS sale_date, count(*) AS n_orders FROM orders GROUP BY 1),
j AS (SELECT dd.sale_date, revenue, cogs, n_orders FROM dd LEFT JOIN o USING (sale_date))
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(revenue, 4) AS revenue, round(cogs, 2) AS cogs, n_orders,
       lag(n_orders, 1) OVER w AS n_orders_lag_1d, lag(n_orders, 7) OVER w AS n_orders_lag_7d FROM j WINDOW w AS (ORDER BY sale_date)""")
def q_target_driver_table(spark, sf):
    """Target + daily driver with lag 1 and 7."""
    t = ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    o = retail.orders(spark, sf).groupBy(F.col("order_date").alias("sale_date")).agg(F.count(F.lit(1)).alias("n_orders"))
    return tidy(ft.target_driver_table(t, o, "sale_date"), 4, {"cogs": 2})


@register("submission_export", DENSE_SQL + """
SELECT strftime(sale_date, '%Y-%m-%d') AS Date, round(revenue, 4) AS Revenue, round(cogs, 2) AS COGS FROM daily""")
def q_submission_export(spark, sf):
    """Prediction columns renamed, date formatted, written as CSV and
    read back."""
    t = ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    sub = io.submission_frame(t, "sale_date", {"revenue": "Revenue", "cogs": "COGS"})
    path = io.scratch_path(spark, "submission")
    io.csv_sink(sub, path)
    back = io.read_csv(spark, path, schema="Date string, Revenue double, COGS double")
    return tidy(back, 4, {"COGS": 2})


@register("row_expansion", with_roles("orders") + """,
x AS (SELECT CAST(unnest(generate_series(order_date, order_date + 6, INTERVAL 1 DAY)) AS DATE) AS d FROM r_orders)
SELECT CAST(d AS VARCHAR) AS d, count(*) AS n_active FROM x GROUP BY 1""")
def q_row_expansion(spark, sf):
    """One row per order and day of its 7-day window."""
    o = retail.orders(spark, sf)
    x = o.select(F.explode(F.sequence("order_date", F.date_add("order_date", 6))).alias("d"))
    return tidy(x.groupBy("d").agg(F.count(F.lit(1)).alias("n_active")))
