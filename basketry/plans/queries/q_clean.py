"""Queries for §2.2 cleaning, casting, projection and filter."""

from pyspark.sql import functions as F

from basketry.operators import clean
from basketry.plans.catalog import register, table, tidy
from basketry.sources import retail
from basketry.sources.retail import with_roles


@register("convert_dates_report", """
SELECT 'o_orderdate' AS column_name, 'converted' AS status, count(*) AS n_rows,
       count_if(CAST(o_orderdate AS DATE) IS NULL) - count_if(o_orderdate IS NULL) AS newly_invalid FROM orders
UNION ALL
SELECT 'o_orderpriority', 'converted', count(*),
       count_if(TRY_CAST(o_orderpriority AS TIMESTAMP) IS NULL) - count_if(o_orderpriority IS NULL) FROM orders
UNION ALL SELECT 'o_shipdate', 'missing_column', NULL, NULL""")
def q_convert_dates(spark, sf):
    """Timestamps and text coerced to dates; unparseable → NULL, counted."""
    _, rep = clean.convert_columns_date(table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority", "o_shipdate"])
    return rep


@register("convert_numeric_report", """
SELECT 'value' AS column_name, 'converted' AS status, count(*) AS n_rows, 0::BIGINT AS newly_invalid FROM events
UNION ALL SELECT 'props', 'converted', count(*), count_if(TRY_CAST(props AS DOUBLE) IS NULL) - count_if(props IS NULL) FROM events
UNION ALL SELECT 'event_type', 'converted', count(*), count_if(TRY_CAST(event_type AS DOUBLE) IS NULL) - count_if(event_type IS NULL) FROM events
UNION ALL SELECT 'amount', 'missing_column', NULL, NULL""")
def q_convert_numeric(spark, sf):
    """text/numbers coerced to double; invalid → NULL, counted."""
    _, rep = clean.convert_columns_numeric(table(spark, sf, "events"), ["value", "props", "event_type", "amount"])
    return rep


@register("empty_string_to_null", r"""
SELECT lang, count(*) AS n_docs, count_if(regexp_matches(text, '^\s*$') OR text IS NULL) AS n_null_text,
       count_if(source IS NULL OR regexp_matches(source, '^\s*$')) AS n_null_source
FROM documents GROUP BY lang""")
def q_empty_string_to_null(spark, sf):
    """Blank strings become NULL on every string column."""
    d = clean.empty_string_to_null(table(spark, sf, "documents").select("lang", "text", "source"), ["text", "source"])
    return d.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("text").isNull()).alias("n_null_text"),
                                 F.count_if(F.col("source").isNull()).alias("n_null_source"))


@register("drop_full_duplicates", """
SELECT (SELECT count(*) FROM lineitem) AS rows_before,
       (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem)) AS rows_after,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey, l_returnflag FROM lineitem)) AS rows_dropped""")
def q_drop_full_duplicates(spark, sf):
    """Exact duplicate rows dropped, with before/after counts."""
    _, rep = clean.drop_full_duplicates(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag"))
    return rep


@register("dedupe_keep_last", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_date FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) WHERE rn = 1""")
def q_dedupe_keep_last(spark, sf):
    """Last row per key by an explicit (date, tie-break) order."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                              F.to_date("l_shipdate").alias("ship_date"), "l_shipdate")
    out = clean.dedupe_by_order(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"])
    return tidy(out.drop("l_shipdate"))


@register("dedupe_keep_first", """
SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def q_dedupe_keep_first(spark, sf):
    """First order per customer by (date, order id)."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    out = clean.dedupe_by_order(o, "o_custkey", ["o_orderdate", "o_orderkey"], keep="first")
    return tidy(out.withColumn("o_orderdate", F.to_date("o_orderdate")))


@register("aggregate_duplicate_lines", """
SELECT l_orderkey AS order_id, l_partkey AS product_id, round(sum(l_quantity), 9) AS quantity,
       round(avg(l_extendedprice / l_quantity), 9) AS unit_price, round(sum(l_extendedprice * l_discount), 9) AS discount_amount,
       min(l_returnflag) AS return_flag, count(*) AS n_merged_lines
FROM lineitem GROUP BY 1, 2""")
def q_aggregate_duplicate_lines(spark, sf):
    """Duplicate (order, product) lines merged."""
    it = retail.items(spark, sf)
    out = clean.aggregate_duplicate_keys(it, ["order_id", "product_id"], sums=["quantity", "discount_amount"],
                                         means=["unit_price"], firsts=["return_flag"])
    return tidy(out)


@register("duplicate_line_decision", """
SELECT l_orderkey, l_linenumber, count(*) AS line_count,
       count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
                       l_returnflag, l_linestatus, l_shipdate)) AS distinct_line_count,
       CASE WHEN count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
                                 l_tax, l_returnflag, l_linestatus, l_shipdate)) < count(*)
            THEN 'review_exact_duplicate' ELSE 'aggregate_valid_multiple_lines' END AS decision
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_duplicate_line_decision(spark, sf):
    """Duplicated keys classified as exact duplicates or valid lines."""
    return clean.duplicate_line_decision(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("weighted_unit_price", """
SELECT l_orderkey AS order_id, round(CASE WHEN sum(l_quantity) > 0 THEN sum(l_extendedprice) / sum(l_quantity) END, 9)
       AS weighted_unit_price FROM lineitem GROUP BY 1""")
def q_weighted_unit_price(spark, sf):
    """Σ line value / Σ quantity when quantity > 0."""
    g = retail.items(spark, sf).groupBy("order_id").agg(F.sum("gross").alias("v"), F.sum("quantity").alias("q"))
    return tidy(g.select("order_id", clean.weighted_unit_price("v", "q").alias("weighted_unit_price")))


SALES_LINES_SQL = with_roles("items", "products") + """,
lines AS (SELECT i.ship_date AS sale_date, i.gross - i.discount_amount AS revenue, i.quantity * p.price AS cogs,
                 i.order_id, i.line_number, i.product_id
          FROM r_items i LEFT JOIN r_products p ON i.product_id = p.product_id)
"""


def sales_lines(spark, sf):
    it = retail.items(spark, sf)
    pr = retail.products(spark, sf).select("product_id", "price")
    return it.join(pr, "product_id", "left").select(
        F.col("ship_date").alias("sale_date"), (F.col("gross") - F.col("discount_amount")).alias("revenue"),
        (F.col("quantity") * F.col("price")).alias("cogs"), "order_id", "line_number", "product_id")


@register("clean_daily_sales", SALES_LINES_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(greatest(coalesce(revenue, 0), 0), 4) AS revenue,
       round(greatest(coalesce(cogs, 0), 0), 4) AS cogs,
       round(greatest(coalesce(revenue, 0), 0) - greatest(coalesce(cogs, 0), 0), 4) AS profit,
       round(CASE WHEN greatest(coalesce(revenue, 0), 0) = 0 THEN 0
             ELSE (greatest(coalesce(revenue, 0), 0) - greatest(coalesce(cogs, 0), 0)) / greatest(coalesce(revenue, 0), 0) END, 4) AS margin
FROM (SELECT *, row_number() OVER (PARTITION BY sale_date ORDER BY order_id DESC, line_number DESC, product_id DESC) AS rn
      FROM lines WHERE sale_date IS NOT NULL) WHERE rn = 1""")
def q_clean_daily_sales(spark, sf):
    """Raw sales records → one clean row per date (last record wins)."""
    out = clean.clean_daily_sales(sales_lines(spark, sf), "sale_date", "revenue", "cogs",
                                  ["order_id", "line_number", "product_id"])
    return tidy(out.select("sale_date", "revenue", "cogs", "profit", "margin"), 4)


@register("clean_daily_traffic", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS event_date, round(sum(value), 4) AS value,
       round(sum(CASE WHEN value IS NOT NULL AND k IS NOT NULL AND value <> 0 THEN k * value END)
             / sum(CASE WHEN value IS NOT NULL AND k IS NOT NULL AND value <> 0 THEN value END), 4) AS k
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events) GROUP BY 1""")
def q_clean_daily_traffic(spark, sf):
    """Events → day: volumes summed, rate weighted by volume."""
    ev = retail.events(spark, sf).withColumn("k", F.get_json_object("props", "$.k").cast("double"))
    return tidy(clean.clean_daily_traffic(ev, "event_date", ["value"], ["k"], weight="value"), 4)


@register("inf_to_null_zero", """
SELECT l_returnflag, count_if(r = 0) AS n_zero, round(sum(r), 4) AS sum_r FROM (
  SELECT l_returnflag, CASE WHEN l_discount = 0 THEN 0 ELSE l_quantity / l_discount END AS r FROM lineitem) GROUP BY 1""")
def q_inf_to_null_zero(spark, sf):
    """±inf / NaN → NULL → 0."""
    li = table(spark, sf, "lineitem")
    r = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_quantity") / F.col("l_discount"))
    d = clean.inf_to_null_zero(li.select("l_returnflag", r.alias("r")), ["r"])
    return tidy(d.groupBy("l_returnflag").agg(F.count_if(F.col("r") == 0).alias("n_zero"), F.sum("r").alias("sum_r")), 4)


DAILY_SQL = SALES_LINES_SQL + """,
daily AS (SELECT sale_date, sum(revenue) AS revenue, sum(cogs) AS cogs FROM lines WHERE sale_date IS NOT NULL GROUP BY 1)
"""


@register("flag_target_anomalies", DAILY_SQL + """
SELECT CAST(sale_date AS VARCHAR) AS sale_date, round(revenue, 2) AS revenue, round(cogs, 2) AS cogs,
       coalesce(revenue IS NULL OR cogs IS NULL, false) AS flag_missing, coalesce(revenue <= 0, false) AS flag_non_positive,
       coalesce(cogs > revenue, false) AS flag_cogs_gt_revenue,
       CASE WHEN coalesce(revenue IS NULL OR cogs IS NULL, false) THEN 1 WHEN coalesce(revenue <= 0, false) THEN 2
            WHEN coalesce(cogs > revenue, false) THEN 3 ELSE 9 END AS flag_priority
FROM daily WHERE coalesce(revenue IS NULL OR cogs IS NULL, false) OR coalesce(revenue <= 0, false) OR coalesce(cogs > revenue, false)""")
def q_flag_target_anomalies(spark, sf):
    """Daily revenue/cogs anomalies flagged, never dropped."""
    from basketry.plans.features import daily_sales
    d = daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    return tidy(clean.flag_target_anomalies(d, "sale_date", "revenue", "cogs"), 2)


@register("value_map_label", """
SELECT o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'P' THEN 1 END AS label, count(*) AS n_rows
FROM orders GROUP BY 1, 2""")
def q_value_map_label(spark, sf):
    """Status → label map; audit rows by status × label."""
    d = clean.value_map_label(table(spark, sf, "orders"), "o_orderstatus", {"F": 0, "P": 1})
    return clean.label_audit(d, "o_orderstatus")


STATUS_SQL = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'returned' ELSE 'processing' END"


def order_status_text(spark, sf):
    """Orders with a text status (F delivered, P returned, O processing)."""
    o = table(spark, sf, "orders")
    st = F.when(F.col("o_orderstatus") == "F", "delivered").when(F.col("o_orderstatus") == "P", "returned").otherwise("processing")
    return o.select(F.col("o_orderkey").alias("order_id"), st.alias("order_status"), F.to_date("o_orderdate").alias("order_date"),
                    F.col("o_custkey").alias("customer_id"))


@register("conservative_label", f"""
WITH r AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R'),
o AS (SELECT o_orderkey, {STATUS_SQL} AS st, r.l_orderkey IS NOT NULL AS h FROM orders LEFT JOIN r ON o_orderkey = r.l_orderkey)
SELECT CASE WHEN st = 'returned' AND h THEN 'valid_returned_status_with_return_record'
            WHEN st = 'delivered' AND NOT h THEN 'valid_delivered_without_return_record'
            WHEN st = 'delivered' AND h THEN 'conflict_delivered_with_return_record'
            WHEN st = 'returned' AND NOT h THEN 'conflict_returned_missing_return_record'
            ELSE 'not_binary_outcome_status' END AS label_reason,
       CASE WHEN st = 'returned' AND h THEN 1 WHEN st = 'delivered' AND NOT h THEN 0 END AS returned_label,
       count(*) AS n_orders
FROM o GROUP BY 1, 2""")
def q_conservative_label(spark, sf):
    """Label only when status and return record agree, with reasons."""
    ret = retail.items(spark, sf).filter(F.col("return_flag") == "R").select("order_id")
    lab = clean.conservative_label(order_status_text(spark, sf), ret, "order_id", "order_status")
    return lab.groupBy("label_reason", "returned_label").agg(F.count(F.lit(1)).alias("n_orders"))


@register("coalesce_default_clean", """
SELECT c_custkey, coalesce(nullif(lower(trim(c_mktsegment)), ''), 'unknown') AS segment,
       greatest(coalesce(TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE), 0), 0) AS balance FROM customer""")
def q_coalesce_default_clean(spark, sf):
    """Text trimmed/lowered with an 'unknown' default; numbers ≥ 0."""
    c = table(spark, sf, "customer")
    return tidy(c.select("c_custkey", clean.coalesce_default_clean("c_mktsegment").alias("segment"),
                         clean.coalesce_nonneg("c_acctbal").alias("balance")))


@register("select_feature_contract", """
SELECT c_acctbal, c_custkey, 0.0::DOUBLE AS loyalty_score, c_nationkey FROM customer""")
def q_select_feature_contract(spark, sf):
    """Ordered feature list; an unknown feature is created as 0."""
    out, _, _ = clean.select_feature_contract(table(spark, sf, "customer"),
                                              ["c_custkey", "c_acctbal", "loyalty_score", "c_nationkey"])
    return tidy(out)


@register("drop_null_feature_rows", """
WITH s AS (SELECT l_orderkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, q FROM orders LEFT JOIN s ON o_orderkey = l_orderkey)
SELECT (SELECT count(*) FROM j) AS rows_before, (SELECT count(*) FROM j WHERE q IS NOT NULL) AS rows_after,
       (SELECT count(*) FROM j WHERE q IS NULL) AS rows_dropped""")
def q_drop_null_feature_rows(spark, sf):
    """Rows with a NULL feature dropped, with a report."""
    s = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("q"))
    j = table(spark, sf, "orders").select("o_orderkey").join(s, "o_orderkey", "left")
    _, rep = clean.drop_null_feature_rows(j, ["q"])
    return rep


@register("date_window_filter", """
SELECT 'between' AS mode, count(*) AS n_rows FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
UNION ALL SELECT 'warmup', count(*) FROM orders
  WHERE CAST(o_orderdate AS DATE) >= (SELECT min(CAST(o_orderdate AS DATE)) FROM orders) + INTERVAL 365 DAY""")
def q_date_window_filter(spark, sf):
    """Date bounds and warm-up trim (min date + N days)."""
    o = retail.orders(spark, sf)
    a = clean.date_window_filter(o, "order_date", "1996-01-01", "1996-12-31")
    b = clean.date_window_filter(o, "order_date", warmup_days=365)
    return a.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("between").alias("mode"), "n_rows").unionByName(
        b.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("warmup").alias("mode"), "n_rows"))


@register("top_value_filter", """
WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 5)
SELECT l_suppkey, count(*) AS n_rows FROM lineitem WHERE l_suppkey IN (SELECT l_suppkey FROM top) GROUP BY 1""")
def q_top_value_filter(spark, sf):
    """Rows of the k most frequent suppliers."""
    d = clean.top_value_filter(table(spark, sf, "lineitem"), "l_suppkey", 5)
    return d.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_rows"))
