"""Queries for §2.6 aggregations, pivots and rollups."""

from pyspark.sql import functions as F

from basketry.functions.primitives import group_distinct_counts, with_group_quantiles
from basketry.operators import rollup
from basketry.plans.catalog import register, table, tidy
from basketry.sources import retail
from basketry.sources.retail import with_roles

# Levels of the test tables, for naming columns in the oracle SQL only; queries fit theirs on the data
PART_TYPES = ["MEDIUM", "STANDARD", "LARGE", "PROMO", "SMALL", "ECONOMY"]
RETURN_FLAGS = ["A", "N", "R"]
STATUSES = ["F", "O", "P"]


def category_levels(spark, sf) -> dict[str, list]:
    """Product categories, fitted on the product table."""
    return {"category": rollup.levels(retail.products(spark, sf), "category")}


def lines(spark, sf):
    """Item lines with product attributes, net revenue, cost and returned flag."""
    it = retail.items(spark, sf)
    pr = retail.products(spark, sf).select("product_id", "category", "brand", "price")
    j = it.join(pr, "product_id", "left")
    return j.select("*", (F.col("gross") - F.col("discount_amount")).alias("net"),
                    (F.col("quantity") * F.col("price")).alias("cost"),
                    (F.col("return_flag") == "R").cast("int").alias("returned"))


LINES_SQL = with_roles("items", "products") + """,
lines AS (SELECT i.*, p.category, p.brand, p.price, i.gross - i.discount_amount AS net, i.quantity * p.price AS cost,
                 CASE WHEN i.return_flag = 'R' THEN 1 ELSE 0 END AS returned
          FROM r_items i LEFT JOIN r_products p ON i.product_id = p.product_id)
"""


@register("group_summary", LINES_SQL + """
SELECT category, round(sum(net), 4) AS revenue, round(sum(gross), 2) AS gross, round(sum(net - cost), 4) AS profit,
       round(sum(quantity), 2) AS units, count(DISTINCT order_id) AS n_orders, round(sum(discount_amount), 4) AS discount,
       round(sum(net) / count(DISTINCT order_id), 7) AS aov, round(sum(net - cost) / sum(net), 9) AS margin,
       round(sum(net) / (SELECT sum(net) FROM lines), 9) AS revenue_share
FROM lines GROUP BY 1""")
def q_group_summary(spark, sf):
    """revenue/gross/profit/units/orders/discount/AOV/margin/share."""
    g = rollup.group_summary(lines(spark, sf), "category", "net", gross="gross", cost="cost", units="quantity",
                             order_col="order_id", discount="discount_amount")
    return tidy(g, 2, {"revenue": 4, "profit": 4, "discount": 4, "aov": 7, "margin": 9, "revenue_share": 9})


@register("kpi_overview", LINES_SQL + """,
r_orders AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders),
a AS (SELECT sum(net) AS revenue, sum(gross) AS gross, sum(quantity) AS units, count(DISTINCT order_id) AS orders,
             count(DISTINCT customer_id) AS customers, count(DISTINCT product_id) AS products, sum(net - cost) AS profit
      FROM lines JOIN r_orders USING (order_id))
SELECT * FROM (
  SELECT 0 AS kpi_order, 'total_revenue' AS kpi, round(revenue, 4) AS value FROM a
  UNION ALL SELECT 1, 'total_gross', round(gross, 4) FROM a
  UNION ALL SELECT 2, 'total_units', round(units, 4) FROM a
  UNION ALL SELECT 3, 'n_orders', orders FROM a
  UNION ALL SELECT 4, 'n_customers', customers FROM a
  UNION ALL SELECT 5, 'n_products', products FROM a
  UNION ALL SELECT 6, 'aov', round(revenue / orders, 4) FROM a
  UNION ALL SELECT 7, 'median_order_value', round((SELECT quantile_cont(o_totalprice, 0.5) FROM orders), 4) FROM a
  UNION ALL SELECT 8, 'revenue_per_customer', round(revenue / customers, 4) FROM a
  UNION ALL SELECT 9, 'margin', round(profit / revenue, 4) FROM a)""")
def q_kpi_overview(spark, sf):
    """headline KPIs in long form."""
    ln = lines(spark, sf).join(retail.orders(spark, sf).select("order_id", "customer_id"), "order_id")
    k = rollup.kpi_overview(ln, retail.orders(spark, sf), "net", "gross", "quantity", "order_id", "customer_id",
                            "product_id", "payment_value", cost="cost")
    return tidy(k, 4)


@register("period_rollup_weekly", with_roles("items") + """
SELECT CAST(CAST(date_trunc('week', ship_date) AS DATE) AS VARCHAR) AS period_start,
       CAST(CAST(date_trunc('week', ship_date) AS DATE) + 6 AS VARCHAR) AS period_end,
       round(sum(quantity), 2) AS quantity, round(sum(gross), 2) AS gross, count(DISTINCT order_id) AS n_order_id,
       round(sum(gross) / count(DISTINCT order_id), 7) AS aov
FROM r_items GROUP BY 1, 2""")
def q_period_rollup(spark, sf):
    """weekly (Mon–Sun) sums, distinct orders, AOV."""
    g = rollup.period_rollup(retail.items(spark, sf), "ship_date", "week", ["quantity", "gross"], ["order_id"],
                             order_col="order_id", revenue="gross")
    return tidy(g, 2, {"aov": 7})


@register("month_resample", with_roles("orders") + """,
b AS (SELECT date_trunc('month', min(order_date)) AS a, date_trunc('month', max(order_date)) AS z FROM r_orders),
m AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 MONTH)) AS DATE) AS month FROM b),
g AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS n_rows, sum(payment_value) AS payment_value,
             avg(payment_value) AS mean_payment_value FROM r_orders GROUP BY 1)
SELECT CAST(m.month AS VARCHAR) AS month, coalesce(n_rows, 0) AS n_rows, round(coalesce(payment_value, 0), 2) AS payment_value,
       round(mean_payment_value, 4) AS mean_payment_value FROM m LEFT JOIN g ON m.month = g.month""")
def q_month_resample(spark, sf):
    """monthly buckets including empty months."""
    g = rollup.month_resample(retail.orders(spark, sf), "order_date", ["payment_value"], ["payment_value"])
    return tidy(g, 2, {"mean_payment_value": 4})


@register("weighted_mean", with_roles("items") + """
SELECT EXTRACT(year FROM ship_date) AS year,
       round(sum(CASE WHEN discount_rate IS NOT NULL AND gross IS NOT NULL AND gross <> 0 THEN discount_rate * gross END)
           / sum(CASE WHEN discount_rate IS NOT NULL AND gross IS NOT NULL AND gross <> 0 THEN gross END), 9) AS weighted_discount,
       round(avg(discount_rate), 9) AS plain_discount
FROM r_items GROUP BY 1""")
def q_weighted_mean(spark, sf):
    """gross-weighted discount rate per year vs the plain mean."""
    it = retail.items(spark, sf)
    return tidy(it.groupBy(F.year("ship_date").alias("year")).agg(
        rollup.weighted_mean("discount_rate", "gross").alias("weighted_discount"),
        F.avg("discount_rate").alias("plain_discount")))


@register("ratio_of_sums", with_roles("items") + """
SELECT return_flag, round(sum(discount_amount) / sum(gross), 9) AS discount_rate FROM r_items GROUP BY 1""")
def q_ratio_of_sums(spark, sf):
    """rates from sums, not means of rates."""
    return tidy(retail.items(spark, sf).groupBy("return_flag").agg(
        rollup.ratio_of_sums("discount_amount", "gross").alias("discount_rate")))


def _pivot_sql(row_expr, row_alias, pivot_col, values, agg, measure, src, prefix, where=""):
    cols = []
    for v in values:
        slug = v.lower().replace(" ", "_")
        if agg == "count":
            cols.append(f"count_if({pivot_col} = '{v}') AS {prefix}_{slug}")
        elif agg == "nunique":
            cols.append(f"count(DISTINCT CASE WHEN {pivot_col} = '{v}' THEN {measure} END) AS {prefix}_{slug}")
        elif agg == "sum":
            cols.append(f"round(sum(CASE WHEN {pivot_col} = '{v}' THEN {measure} END), 2) AS {prefix}_{slug}")
        else:
            cols.append(f"round(avg(CASE WHEN {pivot_col} = '{v}' THEN {measure} END), 4) AS {prefix}_{slug}")
    return f"SELECT {row_expr} AS {row_alias}, {', '.join(cols)} FROM {src} {where} GROUP BY 1"


TOP4_SQL = """,
top AS (SELECT category FROM lines WHERE category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, category LIMIT 4)
"""


@register("crosstab_counts", LINES_SQL + TOP4_SQL + """
SELECT EXTRACT(year FROM ship_date) AS year, 'category_' || lower(category) AS variable,
       CAST(count(*) AS DOUBLE) AS value FROM lines WHERE category IN (SELECT category FROM top) GROUP BY 1, 2
UNION ALL
SELECT y.year, 'category_' || lower(t.category), 0.0 FROM (SELECT DISTINCT EXTRACT(year FROM ship_date) AS year FROM lines) y, top t
WHERE NOT EXISTS (SELECT 1 FROM lines l WHERE EXTRACT(year FROM l.ship_date) = y.year AND l.category = t.category)""")
def q_crosstab_counts(spark, sf):
    """year × top-4 category line counts (top-k computed from the data;
    the wide result is shown in long form so its data-dependent column
    names can be checked)."""
    from basketry.operators.topk import melt
    ln = lines(spark, sf)
    top = rollup.top_values(ln, "category", 4)
    wide = rollup.crosstab_counts(ln.withColumn("year", F.year("ship_date")), "year", "category", values=top)
    return melt(wide, "year", [c for c in wide.columns if c != "year"])


@register("pivot_sum", with_roles("items") + _pivot_sql("EXTRACT(year FROM ship_date)", "year", "return_flag", RETURN_FLAGS,
                                                        "sum", "quantity", "r_items", "qty"))
def q_pivot_sum(spark, sf):
    """year × return flag summed quantity."""
    it = retail.items(spark, sf).withColumn("year", F.year("ship_date"))
    return tidy(rollup.pivot_agg(it, "year", "return_flag", rollup.levels(it, "return_flag"), "sum", "quantity", prefix="qty"), 2)


@register("pivot_mean", """
WITH j AS (SELECT c_mktsegment, o_orderstatus, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey)
""" + _pivot_sql("c_mktsegment", "c_mktsegment", "o_orderstatus", STATUSES, "avg", "o_totalprice", "j", "price"))
def q_pivot_mean(spark, sf):
    """segment × status mean order value."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"),
                                        "o_custkey")
    return tidy(rollup.pivot_agg(o, "c_mktsegment", "o_orderstatus", rollup.levels(o, "o_orderstatus"), "avg", "o_totalprice", prefix="price"), 4)


@register("pivot_nunique", with_roles("items") + _pivot_sql("EXTRACT(year FROM ship_date)", "year", "return_flag",
                                                            RETURN_FLAGS, "nunique", "order_id", "r_items", "orders"))
def q_pivot_nunique(spark, sf):
    """year × return flag distinct orders."""
    it = retail.items(spark, sf).withColumn("year", F.year("ship_date"))
    return rollup.pivot_agg(it, "year", "return_flag", rollup.levels(it, "return_flag"), "nunique", "order_id", prefix="orders")


@register("category_share", LINES_SQL + TOP4_SQL + """,
yt AS (SELECT EXTRACT(year FROM ship_date) AS year, sum(quantity) AS tot FROM lines GROUP BY 1),
yc AS (SELECT EXTRACT(year FROM ship_date) AS year, category, sum(quantity) AS q FROM lines GROUP BY 1, 2)
SELECT yt.year, 'share_' || lower(t.category) AS variable, round(coalesce(yc.q, 0) / nullif(tot, 0), 9) AS value
FROM yt CROSS JOIN top t LEFT JOIN yc ON yc.year = yt.year AND yc.category = t.category""")
def q_category_share(spark, sf):
    """yearly quantity share of the top 4 categories (long form)."""
    from basketry.operators.topk import melt
    ln = lines(spark, sf).withColumn("year", F.year("ship_date"))
    wide = rollup.category_share(ln, "year", "category", "quantity", rollup.top_values(ln, "category", 4))
    return tidy(melt(wide, "year", [c for c in wide.columns if c != "year"]))


@register("multihot", LINES_SQL + "SELECT order_id, " + ", ".join(
    [f"max(CASE WHEN category = '{v}' THEN 1 ELSE 0 END) AS category_{v.lower()}" for v in PART_TYPES]
    + [f"max(CASE WHEN return_flag = '{v}' THEN 1 ELSE 0 END) AS return_flag_{v.lower()}" for v in RETURN_FLAGS])
    + " FROM lines GROUP BY 1")
def q_multihot(spark, sf):
    """per order 0/1 flag per category and return-flag level."""
    d = lines(spark, sf)
    return rollup.multihot(d, "order_id", {c: rollup.levels(d, c) for c in ("category", "return_flag")})


@register("order_rollup", with_roles("items") + """
SELECT order_id, min(supplier_id) AS supplier_id, round(sum(quantity), 2) AS quantity, round(sum(gross), 2) AS gross,
       count(*) AS n_lines FROM r_items GROUP BY 1""")
def q_order_rollup(spark, sf):
    """items → one row per order."""
    return tidy(rollup.order_rollup(retail.items(spark, sf), "order_id", ["supplier_id"], ["quantity", "gross"]), 2)


@register("order_item_summary", with_roles("items") + """
SELECT order_id, round(sum(quantity), 2) AS total_quantity, count(DISTINCT product_id) AS n_products, count(*) AS n_lines,
       round(sum(discount_amount), 4) AS discount_total, round(sum(gross), 2) AS gross_total,
       round(least(greatest(sum(discount_amount) / nullif(sum(gross), 0), 0), 1), 9) AS discount_ratio
FROM r_items GROUP BY 1""")
def q_order_item_summary(spark, sf):
    """per-order totals and clipped discount ratio."""
    s = rollup.order_item_summary(retail.items(spark, sf), "order_id", "product_id", "quantity", "gross", "discount_amount")
    return tidy(s, 2, {"discount_total": 4, "discount_ratio": 9})


@register("conditional_count", """
SELECT o_custkey, count_if(o_orderstatus = 'F') AS n_finished, count_if(o_orderpriority = '1-URGENT') AS n_urgent,
       count(*) AS n_orders FROM orders GROUP BY 1""")
def q_conditional_count(spark, sf):
    """conditional counts per customer."""
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("n_finished"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"), F.count(F.lit(1)).alias("n_orders"))


@register("distinct_daily_counts", with_roles("items") + """
SELECT CAST(ship_date AS VARCHAR) AS ship_date, count(DISTINCT order_id) AS n_orders, count(DISTINCT product_id) AS n_products,
       count(DISTINCT supplier_id) AS n_suppliers FROM r_items GROUP BY 1""")
def q_distinct_daily_counts(spark, sf):
    """F16: distinct orders / products / suppliers per day."""
    return tidy(group_distinct_counts(retail.items(spark, sf), "ship_date",
                                      {"n_orders": "order_id", "n_products": "product_id", "n_suppliers": "supplier_id"}))


@register("group_target_rate", LINES_SQL + """
SELECT category, round(avg(returned), 9) AS target_rate, count(*) AS n_rows, CAST(sum(returned) AS BIGINT) AS sum_returned
FROM lines GROUP BY 1""")
def q_group_target_rate(spark, sf):
    """returned-line rate per category."""
    return tidy(rollup.group_target_rate(lines(spark, sf), "category", "returned", sum_col="returned"))


@register("delta_vs_baseline", LINES_SQL + """
SELECT brand, round(avg(returned), 9) AS target_rate, count(*) AS n_rows,
       round((SELECT avg(returned) FROM lines), 9) AS global_rate,
       round((avg(returned) - (SELECT avg(returned) FROM lines)) * 100, 9) AS delta_pp FROM lines GROUP BY 1""")
def q_delta_vs_baseline(spark, sf):
    """brand return rate minus global rate in percentage points."""
    return tidy(rollup.delta_vs_baseline(lines(spark, sf), "brand", "returned"))


@register("calendar_lift", with_roles("orders") + """,
d AS (SELECT order_date, count(*) AS n_orders FROM r_orders GROUP BY 1),
g AS (SELECT 'dow' AS calendar_key, isodow(order_date) - 1 AS key_value, avg(n_orders) AS m, count(*) AS n FROM d GROUP BY 2
      UNION ALL SELECT 'weekend', CASE WHEN isodow(order_date) >= 6 THEN 1 ELSE 0 END, avg(n_orders), count(*) FROM d GROUP BY 2
      UNION ALL SELECT 'month', month(order_date), avg(n_orders), count(*) FROM d GROUP BY 2
      UNION ALL SELECT 'quarter', quarter(order_date), avg(n_orders), count(*) FROM d GROUP BY 2)
SELECT calendar_key, key_value, round(m, 9) AS target_mean, n AS n_rows, round(m / (SELECT avg(n_orders) FROM d), 9) AS lift FROM g""")
def q_calendar_lift(spark, sf):
    """mean daily orders by dow / weekend / month / quarter (one
    GROUPING SETS pass) and lift over the overall mean."""
    d = retail.orders(spark, sf).groupBy("order_date").agg(F.count(F.lit(1)).alias("n_orders"))
    return tidy(rollup.calendar_lift(d, "order_date", "n_orders"))


@register("channel_growth_recent", with_roles("orders") + """,
m AS (SELECT priority, date_trunc('month', order_date) AS p, count(*) AS v FROM r_orders GROUP BY 1, 2),
g AS (SELECT priority, p, (v - lag(v) OVER w) / lag(v) OVER w AS gr FROM m WINDOW w AS (PARTITION BY priority ORDER BY p)),
r AS (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY p DESC) AS rn FROM g WHERE gr IS NOT NULL)
SELECT priority, round(avg(gr), 9) AS mean_recent_growth, count(*) AS n_periods FROM r WHERE rn <= 6 GROUP BY 1""")
def q_channel_growth(spark, sf):
    """mean month-over-month growth of each channel's last 6 months."""
    m = retail.orders(spark, sf).groupBy("priority", F.date_trunc("month", "order_date").alias("p")).agg(
        F.count(F.lit(1)).cast("double").alias("v"))
    return tidy(rollup.channel_growth_recent(m, "priority", "p", "v"))


@register("quadrant_summary", """
WITH c AS (SELECT o_custkey, sum(o_totalprice) AS spend, count(*)::DOUBLE AS n_orders FROM orders GROUP BY 1)
SELECT spend >= (SELECT quantile_cont(spend, 0.5) FROM c) AS high_spend,
       n_orders >= (SELECT quantile_cont(n_orders, 0.5) FROM c) AS high_n_orders,
       count(*) AS n_rows, round(avg(spend), 4) AS mean_spend, round(avg(n_orders), 9) AS mean_n_orders FROM c GROUP BY 1, 2""")
def q_quadrant_summary(spark, sf):
    """customers split at the median of spend and order count."""
    c = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spend"),
                                                            F.count(F.lit(1)).cast("double").alias("n_orders"))
    return tidy(rollup.quadrant_summary(c, "spend", "n_orders"), 9, {"mean_spend": 4})


@register("revenue_bridge", LINES_SQL + """
SELECT * FROM (
  SELECT 1 AS step_order, 'gross' AS step, round(sum(gross), 4) AS amount FROM lines
  UNION ALL SELECT 2, 'discount', round(-sum(discount_amount), 4) FROM lines
  UNION ALL SELECT 3, 'refund', round(-coalesce(sum(CASE WHEN returned = 1 THEN net ELSE 0 END), 0), 4) FROM lines
  UNION ALL SELECT 4, 'net', round(sum(gross) - sum(discount_amount) - coalesce(sum(CASE WHEN returned = 1 THEN net ELSE 0 END), 0), 4) FROM lines)""")
def q_revenue_bridge(spark, sf):
    """gross → −discount → −refund → net."""
    ln = lines(spark, sf).withColumn("refund", F.when(F.col("returned") == 1, F.col("net")).otherwise(0.0))
    return tidy(rollup.revenue_bridge(ln, "gross", "discount_amount", "refund"), 4)


@register("return_impact", LINES_SQL + """
SELECT category, count(*) AS n_lines, count_if(returned = 1) AS returned_lines,
       round(sum(CASE WHEN returned = 1 THEN quantity ELSE 0 END), 2) AS returned_units,
       round(sum(CASE WHEN returned = 1 THEN net ELSE 0 END), 4) AS refund, round(sum(net), 4) AS revenue,
       count(DISTINCT order_id) AS n_orders, round(count_if(returned = 1) * 1.0 / count(*), 9) AS return_rate,
       round(sum(CASE WHEN returned = 1 THEN net ELSE 0 END) / sum(net), 9) AS refund_to_revenue
FROM lines GROUP BY 1 HAVING count(DISTINCT order_id) >= 20""")
def q_return_impact(spark, sf):
    """returns by category with minimum order support."""
    ln = lines(spark, sf).withColumn("refund", F.when(F.col("returned") == 1, F.col("net")).otherwise(0.0))
    out = rollup.return_impact(ln, "category", "returned", "quantity", "refund", "net", order_col="order_id", min_orders=20)
    return tidy(out, 2, {"refund": 4, "revenue": 4, "return_rate": 9, "refund_to_revenue": 9})


@register("delivery_vs_return", with_roles("items", "orders") + """
SELECT CASE WHEN return_flag = 'R' THEN 1 ELSE 0 END AS returned, count(*) AS n_rows,
       round(avg(date_diff('day', order_date, ship_date)), 9) AS mean_days,
       round(quantile_cont(date_diff('day', order_date, ship_date), 0.5), 9) AS median_days
FROM r_items JOIN r_orders USING (order_id) GROUP BY 1""")
def q_delivery_vs_return(spark, sf):
    """delivery days (order → ship) by returned flag."""
    j = retail.items(spark, sf).join(retail.orders(spark, sf).select("order_id", "order_date"), "order_id")
    j = j.select((F.col("return_flag") == "R").cast("int").alias("returned"),
                 F.datediff("ship_date", "order_date").alias("days"))
    return tidy(rollup.delivery_vs_return(j, "returned", "days"))


@register("histogram_data", """
WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
c AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, count(*) AS n FROM orders, b GROUP BY 1),
s AS (SELECT CAST(range AS INTEGER) AS bin FROM range(20))
SELECT s.bin, round(lo + s.bin * ((hi - lo) / 20), 4) AS bin_left, round(lo + (s.bin + 1) * ((hi - lo) / 20), 4) AS bin_right,
       coalesce(n, 0) AS count FROM s LEFT JOIN c ON s.bin = c.bin, b""")
def q_histogram(spark, sf):
    """20 equal-width bins of order value."""
    return tidy(rollup.histogram_data(table(spark, sf, "orders"), "o_totalprice", 20), 4)


@register("boxplot_stats", """
WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1),
j AS (SELECT l.l_returnflag, l_extendedprice AS v, q1, median, q3, q3 - q1 AS iqr FROM lineitem l JOIN q USING (l_returnflag))
SELECT l_returnflag, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3, round(iqr, 4) AS iqr,
       round(min(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN v END), 4) AS whisker_low,
       round(max(CASE WHEN v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr THEN v END), 4) AS whisker_high,
       count_if(v IS NOT NULL AND NOT (v >= q1 - 1.5 * iqr AND v <= q3 + 1.5 * iqr)) AS n_outliers
FROM j GROUP BY l_returnflag, q1, median, q3, iqr""")
def q_boxplot(spark, sf):
    """box-plot statistics of line value per return flag."""
    return tidy(rollup.boxplot_stats(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"]), 4)


@register("group_target_agg", LINES_SQL + """,
top AS (SELECT brand FROM lines WHERE brand IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, brand LIMIT 5)
SELECT brand, round(avg(quantity), 9) AS mean_quantity, count(*) AS n_rows FROM lines WHERE brand IN (SELECT brand FROM top) GROUP BY 1""")
def q_group_target_agg(spark, sf):
    """mean quantity for the 5 most frequent brands."""
    return tidy(rollup.group_target_agg(lines(spark, sf), "brand", "quantity", "mean", top_k=5))


@register("category_counts", """
SELECT o_orderpriority, count(*) AS count, round(count(*) * 1.0 / (SELECT count(*) FROM orders), 9) AS rate
FROM orders GROUP BY 1 ORDER BY count DESC, o_orderpriority LIMIT 3""")
def q_category_counts(spark, sf):
    """value counts with share, top 3."""
    return tidy(rollup.category_counts(table(spark, sf, "orders"), "o_orderpriority", top_n=3))


@register("daily_source_features", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, count(*) AS n_events, count(DISTINCT user_id) AS n_users,
       count_if(event_type = 'purchase') AS n_purchases, count_if(event_type = 'error') AS n_errors,
       round(sum(value), 4) AS value_sum, round(avg(value), 9) AS value_mean FROM events GROUP BY 1""")
def q_daily_source_features(spark, sf):
    """event source aggregated to the day."""
    ev = retail.events(spark, sf)
    return tidy(rollup.daily_agg(ev, "event_date", {
        "n_events": F.count(F.lit(1)), "n_users": F.count_distinct("user_id"),
        "n_purchases": F.count_if(F.col("event_type") == "purchase"), "n_errors": F.count_if(F.col("event_type") == "error"),
        "value_sum": F.sum("value"), "value_mean": F.avg("value")}), 9, {"value_sum": 4})


@register("promo_vs_nopromo", LINES_SQL + """
SELECT discount_rate > 0.05 AS promo, count(*) AS n_rows, round(avg(net), 4) AS mean_net, round(quantile_cont(net, 0.5), 4) AS median_net,
       round(avg(quantity), 9) AS mean_quantity, round(quantile_cont(quantity, 0.5), 9) AS median_quantity FROM lines GROUP BY 1""")
def q_promo_vs_nopromo(spark, sf):
    """F32: promoted (discount > 5%) vs other lines."""
    ln = lines(spark, sf).withColumn("promo", F.col("discount_rate") > 0.05)
    return tidy(rollup.flag_vs_noflag(ln, "promo", ["net", "quantity"]), 9, {"mean_net": 4, "median_net": 4})


@register("distribution_by_group", """
SELECT EXTRACT(year FROM o_orderdate) AS year, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
       round(quantile_cont(o_totalprice, 0.5), 4) AS median, round(stddev_samp(o_totalprice), 4) AS std,
       round(min(o_totalprice), 4) AS min, round(max(o_totalprice), 4) AS max FROM orders GROUP BY 1""")
def q_distribution_by_group(spark, sf):
    """count/mean/median/std/min/max per year."""
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return tidy(rollup.distribution_by_group(o, "year", "o_totalprice"), 4)


@register("top_risk_join", LINES_SQL + """,
rev AS (SELECT product_id, sum(net) AS revenue FROM lines GROUP BY 1 ORDER BY revenue DESC, product_id LIMIT 30),
risk AS (SELECT product_id, count_if(returned = 1) * 1.0 / count(*) AS return_rate,
                sum(CASE WHEN returned = 1 THEN net ELSE 0 END) AS refund FROM lines GROUP BY 1)
SELECT rev.product_id, round(revenue, 4) AS revenue, round(return_rate, 9) AS return_rate, round(refund, 4) AS refund
FROM rev LEFT JOIN risk USING (product_id)""")
def q_top_risk_join(spark, sf):
    """top 30 products by revenue with their return rate and refund."""
    from basketry.operators.topk import top_k
    ln = lines(spark, sf).withColumn("refund", F.when(F.col("returned") == 1, F.col("net")).otherwise(0.0))
    rev = top_k(ln.groupBy("product_id").agg(F.sum("net").alias("revenue")), "revenue", 30, tiebreak=["product_id"])
    risk = rollup.return_impact(ln, "product_id", "returned", "quantity", "refund", "net").select("product_id", "return_rate", "refund")
    return tidy(rev.join(risk, "product_id", "left"), 4, {"return_rate": 9})


@register("yoy_growth_geomean", LINES_SQL + """,
d AS (SELECT ship_date, sum(net) AS revenue FROM lines GROUP BY 1),
y AS (SELECT year(ship_date) AS year, sum(revenue) AS total, min(ship_date) AS a, max(ship_date) AS b FROM d GROUP BY 1),
c AS (SELECT * FROM y WHERE month(a) = 1 AND day(a) = 1 AND month(b) = 12 AND day(b) = 31),
g AS (SELECT total / lag(total) OVER (ORDER BY year) AS r FROM c)
SELECT count(r) AS n_growth_years, round(exp(avg(ln(r))), 9) AS geomean_ratio, round(exp(avg(ln(r))) - 1, 9) AS geomean_growth FROM g""")
def q_yoy_growth(spark, sf):
    """Π(1 + yoy)^(1/n) over complete calendar years of daily revenue."""
    d = lines(spark, sf).groupBy("ship_date").agg(F.sum("net").alias("revenue"))
    return tidy(rollup.yoy_growth_geomean(d, "ship_date", "revenue"))


@register("group_apply_aggregates", LINES_SQL + """
SELECT category, round(sum(CASE WHEN discount_rate IS NOT NULL AND quantity IS NOT NULL AND quantity <> 0 THEN discount_rate * quantity END)
                        / sum(CASE WHEN discount_rate IS NOT NULL AND quantity IS NOT NULL AND quantity <> 0 THEN quantity END), 9) AS qty_weighted_discount,
       round(max(net) / sum(net), 9) AS top_line_share, arg_max(order_id, (net, order_id)) AS top_order_id,
       round(quantile_cont(quantity, 0.5), 9) AS median_quantity FROM lines GROUP BY 1""")
def q_group_apply(spark, sf):
    """The reference's ``groupby.apply`` lambdas (weighted mean, share of
    the largest line, arg-max, median) as built-in aggregates — no group is
    materialised in one task."""
    ln = lines(spark, sf)
    groups = ln.groupBy("category").agg(
        rollup.weighted_mean("discount_rate", "quantity").alias("qty_weighted_discount"),
        F.try_divide(F.max("net"), F.sum("net")).alias("top_line_share"),
        F.max_by("order_id", F.struct("net", "order_id")).alias("top_order_id"))
    return tidy(with_group_quantiles(groups, ln, "category", {"median_quantity": ("quantity", 0.5)}))
