"""Queries for §2.5 joins."""

from pyspark.sql import functions as F

from basketry.functions.expr import normalised_key
from basketry.operators import joins
from basketry.plans.catalog import register, table, tidy
from basketry.sources import retail
from basketry.sources.retail import with_roles


@register("left_join_m1", """
SELECT p_type, count(*) AS n_lines, round(sum(l_quantity), 2) AS quantity, count_if(p_partkey IS NULL) AS unmatched
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def q_left_join_m1(spark, sf):
    """Fact ⟕ dimension with the m:1 cardinality validated first."""
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity")
    pt = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", F.lit(1).alias("_hit"))
    j = joins.left_join_m1(li, pt, "l_partkey")
    return tidy(j.groupBy("p_type").agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity"),
                                        F.count_if(F.col("_hit").isNull()).alias("unmatched")), 2)


@register("left_join_daily_chain", with_roles("orders", "items") + """,
o AS (SELECT order_date AS d, count(*) AS n_orders FROM r_orders GROUP BY 1),
s AS (SELECT ship_date AS d, round(sum(quantity), 2) AS shipped_qty FROM r_items GROUP BY 1),
r AS (SELECT ship_date AS d, count(*) AS returned_lines FROM r_items WHERE return_flag = 'R' GROUP BY 1)
SELECT CAST(o.d AS VARCHAR) AS d, n_orders, shipped_qty, returned_lines FROM o LEFT JOIN s ON o.d = s.d LEFT JOIN r ON o.d = r.d""")
def q_left_join_daily_chain(spark, sf):
    """Chain of 1:1 left joins of daily tables on the date."""
    o = retail.orders(spark, sf).groupBy(F.col("order_date").alias("d")).agg(F.count(F.lit(1)).alias("n_orders"))
    it = retail.items(spark, sf)
    s = it.groupBy(F.col("ship_date").alias("d")).agg(F.sum("quantity").alias("shipped_qty"))
    r = it.filter(F.col("return_flag") == "R").groupBy(F.col("ship_date").alias("d")).agg(F.count(F.lit(1)).alias("returned_lines"))
    return tidy(joins.left_join_chain(o, [s, r], "d", validate=True), 2)


@register("master_table_join", with_roles("orders", "customers", "items", "products") + """
SELECT o.order_id, o.customer_id, c.segment, i.product_id, i.line_number, p.category, p.price,
       round(i.quantity, 2) AS quantity, round(o.payment_value, 2) AS payment_value_payment
FROM r_orders o LEFT JOIN r_customers c ON o.customer_id = c.customer_id
LEFT JOIN r_items i ON o.order_id = i.order_id LEFT JOIN r_products p ON i.product_id = p.product_id""")
def q_master_table_join(spark, sf):
    """Orders ⟕ customers ⟕ items ⟕ products ⟕ payments (order × item
    grain; clashing payment column suffixed)."""
    o = retail.orders(spark, sf).select("order_id", "customer_id", "payment_value")
    pay = retail.orders(spark, sf).select("order_id", "payment_value")
    m = joins.master_table_join(o.drop("payment_value"), retail.customers(spark, sf).select("customer_id", "segment"),
                                retail.items(spark, sf).select("order_id", "product_id", "line_number", "quantity"),
                                retail.products(spark, sf).select("product_id", "category", "price"),
                                pay.withColumnRenamed("payment_value", "payment_value").select("order_id", "payment_value"))
    m = m.withColumnRenamed("payment_value", "payment_value_payment")
    return tidy(m.select("order_id", "customer_id", "segment", "product_id", "line_number", "category", "price",
                         "quantity", "payment_value_payment"), 2)


@register("inner_join_labelled", """
SELECT l_returnflag, count(*) AS n_lines, count(DISTINCT l_orderkey) AS n_orders
FROM lineitem JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') o ON l_orderkey = o.o_orderkey GROUP BY 1""")
def q_inner_join(spark, sf):
    """Item lines inner-joined to labelled (finished) orders."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_returnflag")
    lab = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("k"))
    j = joins.inner_join(li, lab, "k")
    return j.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"), F.count_distinct("k").alias("n_orders"))


@register("semi_join_orders_with_returns", """
SELECT o_orderstatus, count(*) AS n_orders FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') GROUP BY 1""")
def q_semi(spark, sf):
    """Key membership filter."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    r = table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("k"))
    return joins.semi_join(o, r, "k").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_orders"))


@register("anti_join_orders_without_items", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def q_anti(spark, sf):
    """Orders whose key never appears in the items."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.anti_join(o, li, "o_orderkey")


@register("asof_ffill_join", """
WITH snaps AS (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
b AS (SELECT min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS z FROM lineitem),
days AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
spine AS (SELECT s_suppkey AS l_suppkey, d FROM supplier, days),
f AS (SELECT spine.l_suppkey, spine.d, snaps.qty FROM spine ASOF LEFT JOIN snaps
      ON spine.l_suppkey = snaps.l_suppkey AND spine.d >= snaps.d)
SELECT l_suppkey, count(*) AS n_days, count(qty) AS n_filled, round(sum(qty), 2) AS sum_filled FROM f GROUP BY 1""")
def q_asof_ffill(spark, sf):
    """Per-supplier snapshots forward-filled onto a supplier × day spine."""
    li = table(spark, sf, "lineitem")
    snaps = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("d")).agg(F.sum("l_quantity").alias("qty"))
    b = li.agg(F.min(F.to_date("l_shipdate")).alias("a"), F.max(F.to_date("l_shipdate")).alias("z"))
    sup = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    spine = _supplier_day_spine(sup, b)
    f = joins.asof_ffill_join(spine, snaps, "d", ["qty"], keys=["l_suppkey"])
    return tidy(f.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_days"), F.count("qty").alias("n_filled"),
                                           F.sum("qty").alias("sum_filled")), 2)


def _supplier_day_spine(sup, bounds):
    """Supplier × day panel: each supplier row expands its own calendar
    (``sequence`` per row; the bounds are one scalar subquery)."""
    a = bounds.select("a").scalar()
    z = bounds.select("z").scalar()
    return sup.select("l_suppkey", F.explode(F.sequence(a, z)).alias("d"))


@register("interval_active", """
WITH iv AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s, max(CAST(l_shipdate AS DATE)) AS e, o_totalprice AS m
            FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderdate, o_totalprice),
b AS (SELECT min(s) AS a, max(e) AS z FROM iv),
days AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
hit AS (SELECT d, count(iv.o_orderkey) AS c, CAST(sum(CAST(m AS DECIMAL(38, 2))) AS DOUBLE) AS sm, max(m) AS mx
        FROM days LEFT JOIN iv ON d BETWEEN s AND e AND s <= e GROUP BY d)
SELECT CAST(d AS VARCHAR) AS d, c AS active_count, round(CASE WHEN c > 0 THEN sm ELSE 0 END, 2) AS active_sum,
       round(CASE WHEN c > 0 THEN sm / c END, 7) AS active_mean, round(mx, 2) AS active_max FROM hit""")
def q_interval_active(spark, sf):
    """For each day, the orders in flight [order date, last ship date]:
    count, sum, mean and max of the order value."""
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max(F.to_date("l_shipdate")).alias("e"))
    iv = o.join(li, "o_orderkey", "inner").select("o_orderkey", F.to_date("o_orderdate").alias("s"), "e",
                                                  F.col("o_totalprice").alias("m"))
    b = iv.agg(F.min("s").alias("a"), F.max("e").alias("z"))
    spine = b.select(F.explode(F.sequence("a", "z")).alias("d"))
    out = joins.interval_active(spine, iv, "s", "e", "m", day_col="d", decimal_scale=2)
    return tidy(out.select("d", "active_count", "active_sum", "active_mean", "active_max"),
                digits_by={"active_sum": 2, "active_mean": 7, "active_max": 2})


@register("lookup_enrich", """
SELECT l_orderkey AS order_id, l_linenumber, CAST(l_partkey AS VARCHAR) AS product_key,
       coalesce(CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'listed' END, p_type) AS category, p_brand AS brand
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def q_lookup_enrich(spark, sf):
    """Item attributes filled from the product lookup when absent;
    text keys such as "609.0" normalised before matching."""
    li = table(spark, sf, "lineitem")
    items = li.select(F.col("l_orderkey").alias("order_id"), "l_linenumber",
                      F.col("l_partkey").cast("double").cast("string").alias("product_key"),
                      F.when(F.col("l_returnflag") != "N", F.lit("listed")).alias("category"))
    lk = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_key"),
                                         F.col("p_type").alias("category"), F.col("p_brand").alias("brand"))
    out = joins.lookup_enrich(items, lk, "product_key", ["category", "brand"])
    return out.withColumn("product_key", normalised_key("product_key"))


@register("date_offset_join", with_roles("orders") + """,
d AS (SELECT order_date, round(sum(payment_value), 2) AS v FROM r_orders GROUP BY 1)
SELECT CAST(a.order_date AS VARCHAR) AS order_date, a.v, b.v AS v_same_day_7d_ago
FROM d a LEFT JOIN d b ON b.order_date + INTERVAL 7 DAY = a.order_date""")
def q_date_offset_join(spark, sf):
    """Value on date − 7 by calendar lookup (not a row lag)."""
    d = retail.orders(spark, sf).groupBy("order_date").agg(F.round(F.sum("payment_value"), 2).alias("v"))
    return tidy(joins.date_offset_join(d, "order_date", "v", 7, out="v_same_day_7d_ago"), 2)


NULL_KEY_SQL = """
WITH n AS (SELECT n_nationkey, n_name, CASE WHEN n_regionkey = 4 THEN NULL ELSE n_regionkey END AS rk FROM nation),
r AS (SELECT CASE WHEN r_regionkey = 4 THEN NULL ELSE r_regionkey END AS rk, r_name FROM region)
SELECT n_nationkey, n_name, n.rk, r_name FROM n LEFT JOIN r ON n.rk {op} r.rk"""


def _null_key_frames(spark, sf):
    n = table(spark, sf, "nation").select("n_nationkey", "n_name",
                                          F.when(F.col("n_regionkey") != 4, F.col("n_regionkey")).alias("rk"))
    r = table(spark, sf, "region").select(F.when(F.col("r_regionkey") != 4, F.col("r_regionkey")).alias("rk"), "r_name")
    return n, r


@register("null_key_join_sql", NULL_KEY_SQL.format(op="="))
def q_null_key_sql(spark, sf):
    """E11 default: NULL keys do not match (SQL semantics)."""
    n, r = _null_key_frames(spark, sf)
    return joins.keyed_join(n, r, "rk", "left")


@register("null_key_join_null_safe", NULL_KEY_SQL.format(op="IS NOT DISTINCT FROM"))
def q_null_key_safe(spark, sf):
    """E11 null_safe=True: NULL keys match each other (pandas merge)."""
    n, r = _null_key_frames(spark, sf)
    return joins.keyed_join(n, r, "rk", "left", null_safe=True)
