"""Queries for §2.9 scalar expressions."""

from pyspark.sql import functions as F

from basketry.functions import expr as X
from basketry.plans.catalog import register, table, tidy
from basketry.plans.queries.q_rollup import LINES_SQL, lines
from basketry.sources import retail


@register("safe_div", """
SELECT l_returnflag, count_if(l_discount = 0) AS n_null, round(sum(CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END), 6) AS sum_ratio
FROM lineitem GROUP BY 1""")
def q_safe_div(spark, sf):
    """Tax / discount with 0 → NULL (no ANSI error)."""
    li = table(spark, sf, "lineitem").withColumn("r", X.safe_div("l_tax", "l_discount"))
    return tidy(li.groupBy("l_returnflag").agg(F.count_if(F.col("r").isNull()).alias("n_null"), F.sum("r").alias("sum_ratio")), 6)


@register("line_measures", LINES_SQL + """
SELECT return_flag, round(sum(quantity * unit_price), 2) AS gross, round(sum(quantity * unit_price - discount_amount), 4) AS net,
       round(sum(quantity * price), 2) AS cost, round(sum(quantity * unit_price - discount_amount - quantity * price), 4) AS profit,
       round(avg((quantity * unit_price - discount_amount - quantity * price) / nullif(quantity * unit_price - discount_amount, 0)), 9) AS mean_margin,
       round(avg(discount_amount / nullif(quantity * unit_price, 0)), 9) AS mean_discount_rate FROM lines GROUP BY 1""")
def q_line_measures(spark, sf):
    """Gross, net, cost, profit, margin, discount rate per line."""
    ln = lines(spark, sf)
    m = X.line_measures("quantity", "unit_price", "discount_amount", cost="price")
    d = ln.select("return_flag", *[v.alias(k) for k, v in m.items()])
    return tidy(d.groupBy("return_flag").agg(
        F.sum("gross").alias("gross"), F.sum("net").alias("net"), F.sum("cost").alias("cost"), F.sum("profit").alias("profit"),
        F.avg("margin").alias("mean_margin"), F.avg("discount_rate").alias("mean_discount_rate")), 2,
        {"net": 4, "profit": 4, "mean_margin": 9, "mean_discount_rate": 9})


@register("log1p_clip_and_clip", """
SELECT o_orderstatus, round(sum(ln(1 + greatest(o_totalprice - 100000, 0))), 6) AS sum_log,
       round(avg(least(greatest(o_totalprice, 50000), 300000)), 7) AS mean_clipped FROM orders GROUP BY 1""")
def q_log1p_clip(spark, sf):
    """I03 + I04: log(1 + max(x, 0)) and clamping."""
    o = table(spark, sf, "orders").select("o_orderstatus", X.log1p_clip(F.col("o_totalprice") - 100000).alias("lg"),
                                          X.clip("o_totalprice", 50000.0, 300000.0).alias("cl"))
    return tidy(o.groupBy("o_orderstatus").agg(F.sum("lg").alias("sum_log"), F.avg("cl").alias("mean_clipped")), 6,
                {"mean_clipped": 7})


@register("binary_flags", """
WITH d AS (SELECT l_orderkey, max(l_discount) AS mx FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN lower(trim(o_orderpriority)) = '1-urgent' THEN 1 ELSE 0 END AS is_urgent,
       coalesce(CAST(mx > 0 AS INTEGER), 0) AS is_discounted, CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN quarter(o_orderdate) = 4 THEN 1 ELSE 0 END AS is_q4
FROM orders LEFT JOIN d ON o_orderkey = l_orderkey""")
def q_binary_flags(spark, sf):
    """0/1 flags; string flag compared case-insensitively."""
    d = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_discount").alias("mx"))
    o = table(spark, sf, "orders").join(d, "o_orderkey", "left")
    return o.select("o_orderkey", X.flag(X.ieq("o_orderpriority", "1-URGENT")).alias("is_urgent"),
                    X.flag(F.col("mx") > 0).alias("is_discounted"), X.flag(F.weekday("o_orderdate") >= 5).alias("is_weekend"),
                    X.flag(F.quarter("o_orderdate") == 4).alias("is_q4"))


@register("concat_interaction", """
SELECT coalesce(c_mktsegment, 'Unknown') || '_' || coalesce(o_orderpriority, 'Unknown') AS segment_priority, count(*) AS n_orders
FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def q_concat_interaction(spark, sf):
    """Two categoricals joined into one interaction level."""
    o = table(spark, sf, "orders").join(table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"),
                                        "o_custkey", "left")
    return o.groupBy(X.concat_interaction("c_mktsegment", "o_orderpriority").alias("segment_priority")).agg(
        F.count(F.lit(1)).alias("n_orders"))


@register("slugify", """
SELECT DISTINCT o_orderpriority, regexp_replace(regexp_replace(lower(trim(o_orderpriority)), '[^0-9a-z]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug
FROM orders""")
def q_slugify(spark, sf):
    """Category value → safe column suffix."""
    return table(spark, sf, "orders").select("o_orderpriority", X.slugify_col("o_orderpriority").alias("slug")).distinct()


@register("format_report_values", """
WITH g AS (SELECT o_orderstatus, avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS r, sum(o_totalprice) AS m FROM orders GROUP BY 1),
b AS (SELECT avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0 ELSE 0.0 END) AS base FROM orders)
SELECT o_orderstatus, format('{:.2f}', r * 100) || '%' AS rate_pct,
       CASE WHEN (r - base) * 100 >= 0 THEN '+' ELSE '' END || format('{:.1f}', (r - base) * 100) || ' pp' AS delta_pp,
       CASE WHEN abs(m) >= 1e9 THEN format('{:.1f}', m / 1e9) || 'B' WHEN abs(m) >= 1e6 THEN format('{:.1f}', m / 1e6) || 'M'
            WHEN abs(m) >= 1e3 THEN format('{:.1f}', m / 1e3) || 'K' ELSE format('{:.1f}', m) END AS money FROM g, b""")
def q_format(spark, sf):
    """Percent, signed percentage-point and K/M/B money labels."""
    o = table(spark, sf, "orders").withColumn("u", (F.col("o_orderpriority") == "1-URGENT").cast("double"))
    base = o.select(F.avg("u")).scalar()
    g = o.groupBy("o_orderstatus").agg(F.avg("u").alias("r"), F.sum("o_totalprice").alias("m"))
    return g.select("o_orderstatus", F.regexp_replace(X.format_percent("r"), ",", "").alias("rate_pct"),
                    X.format_pp(F.col("r") - base).alias("delta_pp"), X.format_money("m").alias("money"))


@register("relation_label", """
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 9) AS r,
       CASE WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.6 THEN 'strong' WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.3 THEN 'medium'
            WHEN abs(corr(l_quantity, l_extendedprice)) >= 0.1 THEN 'weak' ELSE 'unclear' END AS relation FROM lineitem GROUP BY 1""")
def q_relation_label(spark, sf):
    """Correlation strength label."""
    g = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.corr("l_quantity", "l_extendedprice").alias("r"))
    return tidy(g.withColumn("relation", X.relation_label("r")))


@register("date_parts", """
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, year(o_orderdate) AS year, month(o_orderdate) AS month,
       day(o_orderdate) AS day, dayofyear(o_orderdate) AS day_of_year, strftime(o_orderdate, '%Y-%m') AS period,
       strftime(o_orderdate, '%A') AS day_name FROM orders""")
def q_date_parts(spark, sf):
    """Year, month, day, day of year, yyyy-MM period, day name."""
    o = retail.orders(spark, sf).select(F.col("order_date").alias("d")).distinct()
    return tidy(o.select("d", *[v.alias(k) for k, v in X.date_parts("d").items()]))


FEATURE_NAME_SQL = """lower(p_type) || '_' || CASE WHEN p_size < 10 THEN 'lag_' || p_size || 'd' WHEN p_size < 20 THEN 'rolling_' || p_size || 'd_mean'
            WHEN p_size < 35 THEN 'diff_' || p_size || 'd' ELSE 'pct_change_' || p_size || 'd' END"""


@register("regex_family", f"""
SELECT DISTINCT {FEATURE_NAME_SQL} AS feature,
       regexp_replace({FEATURE_NAME_SQL}, '(_lag_\\d+d?|_rolling_\\d+d?_(mean|sum|std|min|max)|_diff_\\d+d?|_pct_change_\\d+d?)$', '') AS family
FROM part""")
def q_regex_family(spark, sf):
    """Strip time-series suffixes to get the feature family (feature
    names composed from part attributes)."""
    s = F.col("p_size").cast("string")
    name = F.concat(F.lower("p_type"), F.lit("_"), F.when(F.col("p_size") < 10, F.concat(F.lit("lag_"), s, F.lit("d")))
                    .when(F.col("p_size") < 20, F.concat(F.lit("rolling_"), s, F.lit("d_mean")))
                    .when(F.col("p_size") < 35, F.concat(F.lit("diff_"), s, F.lit("d")))
                    .otherwise(F.concat(F.lit("pct_change_"), s, F.lit("d"))))
    return table(spark, sf, "part").select(name.alias("feature")).distinct().withColumn("family", X.regex_family("feature"))


@register("rowwise_min_any", """
WITH s AS (SELECT l_orderkey, min(l_shipdate) AS first_ship, avg(l_tax) AS tax, avg(l_discount) AS disc FROM lineitem GROUP BY 1)
SELECT o_orderkey, CAST(CAST(least(o_orderdate, first_ship) AS DATE) AS VARCHAR) AS first_event,
       (first_ship IS NULL OR tax IS NULL) AS any_missing, (first_ship IS NULL AND tax IS NULL) AS all_missing,
       round((coalesce(tax, 0) + coalesce(disc, 0)) / nullif(CAST(tax IS NOT NULL AS INTEGER) + CAST(disc IS NOT NULL AS INTEGER), 0), 9) AS row_mean
FROM orders LEFT JOIN s ON o_orderkey = l_orderkey""")
def q_rowwise(spark, sf):
    """Row-wise min skipping nulls, any/all null, mean of present."""
    s = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("first_ship"), F.avg("l_tax").alias("tax"), F.avg("l_discount").alias("disc"))
    o = table(spark, sf, "orders").join(s, "o_orderkey", "left")
    return tidy(o.select("o_orderkey", F.to_date(X.rowwise_min("o_orderdate", "first_ship")).alias("first_event"),
                         X.any_null("first_ship", "tax").alias("any_missing"), X.all_null("first_ship", "tax").alias("all_missing"),
                         X.rowwise_mean("tax", "disc").alias("row_mean")))


@register("select_ladder", """
SELECT CASE WHEN o_totalprice >= 400000 THEN 'xl' WHEN o_totalprice >= 200000 THEN 'l' WHEN o_totalprice >= 100000 THEN 'm' ELSE 's' END AS size_class,
       count(*) AS n_orders FROM orders GROUP BY 1""")
def q_select_ladder(spark, sf):
    """First matching condition wins."""
    p = F.col("o_totalprice")
    lad = X.select_ladder([(p >= 400000, "xl"), (p >= 200000, "l"), (p >= 100000, "m")], "s")
    return table(spark, sf, "orders").groupBy(lad.alias("size_class")).agg(F.count(F.lit(1)).alias("n_orders"))


@register("nested_fields", """
SELECT l_orderkey AS order_id, count(*) AS n_items, round(sum(l_quantity), 2) AS total_quantity,
       round(sum(l_quantity * (l_extendedprice / l_quantity)), 4) AS gross, count(DISTINCT l_partkey) AS n_products
FROM lineitem GROUP BY 1""")
def q_nested_fields(spark, sf):
    """Order records with an ``items`` array of structs (built from the
    tables as JSON), parsed with from_json and reduced with higher-order
    functions — size, aggregate, transform + array_distinct."""
    from basketry.functions.expr import nested_item_totals
    from basketry.plans.scoring import parse_requests, requests_from_tables
    req = requests_from_tables(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf))
    o = parse_requests(req).filter(F.col("reject_reason").isNull()).select("order.*")
    o = o.filter(F.size("items") > 0)
    return tidy(o.select("order_id", *[v.alias(k) for k, v in nested_item_totals("items").items()]), 4, {"total_quantity": 2})
