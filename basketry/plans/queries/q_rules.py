"""Queries for §2.4 rule and constraint checks."""

from pyspark.sql import functions as F

from basketry.operators import rules
from basketry.plans.catalog import register, table, tidy
from basketry.sources import retail


@register("validity_rules", """
SELECT 'lineitem' AS table_name, column_name, rule, n_rows, n_checked, violations,
       round(violations * 100.0 / n_checked, 9) AS violation_pct, min_value, max_value FROM (
  SELECT 'l_quantity' AS column_name, 'between 1..50' AS rule, count(*) AS n_rows, count(l_quantity) AS n_checked,
         count_if(l_quantity IS NOT NULL AND NOT (l_quantity BETWEEN 1 AND 50)) AS violations,
         min(l_quantity)::DOUBLE AS min_value, max(l_quantity)::DOUBLE AS max_value FROM lineitem
  UNION ALL SELECT 'l_discount', '<= 0.08', count(*), count(l_discount), count_if(l_discount IS NOT NULL AND NOT (l_discount <= 0.08)),
         min(l_discount), max(l_discount) FROM lineitem
  UNION ALL SELECT 'l_tax', '>= 0.02', count(*), count(l_tax), count_if(l_tax IS NOT NULL AND NOT (l_tax >= 0.02)),
         min(l_tax), max(l_tax) FROM lineitem
  UNION ALL SELECT 'l_returnflag', 'in [''A'', ''N'']', count(*), count(l_returnflag),
         count_if(l_returnflag IS NOT NULL AND NOT (l_returnflag IN ('A', 'N'))), NULL, NULL FROM lineitem)""")
def q_validity_rules(spark, sf):
    """(column, op, value) rules, NULL passes; one scan."""
    out = rules.validity_rules(table(spark, sf, "lineitem"),
                               [("l_quantity", "between", (1, 50)), ("l_discount", "<=", 0.08), ("l_tax", ">=", 0.02),
                                ("l_returnflag", "in", ["A", "N"])], "lineitem")
    return tidy(out)


@register("business_rules", """
SELECT 'lineitem' AS table_name, rule, severity, n_checked, violations, round(violations * 100.0 / n_checked, 9) AS violation_pct FROM (
  SELECT 'discount_le_gross' AS rule, 'high' AS severity, count_if((l_extendedprice * l_discount <= l_extendedprice) IS NOT NULL) AS n_checked,
         count_if(NOT (l_extendedprice * l_discount <= l_extendedprice)) AS violations FROM lineitem
  UNION ALL SELECT 'tax_le_discount', 'medium', count_if((l_tax <= l_discount) IS NOT NULL), count_if(NOT (l_tax <= l_discount)) FROM lineitem
  UNION ALL SELECT 'quantity_positive', 'high', count_if((l_quantity > 0) IS NOT NULL), count_if(NOT (l_quantity > 0)) FROM lineitem)""")
def q_business_rules(spark, sf):
    """Multi-column predicates with severity."""
    return tidy(rules.business_rules(table(spark, sf, "lineitem"), [
        ("discount_le_gross", "l_extendedprice * l_discount <= l_extendedprice", "high"),
        ("tax_le_discount", "l_tax <= l_discount", "medium"),
        ("quantity_positive", "l_quantity > 0", "high")], "lineitem"))


@register("temporal_rule", """
WITH j AS (SELECT o_orderdate AS l, l_shipdate AS r FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)
SELECT 'o_orderdate <= l_shipdate' AS rule, count(*) AS n_rows, count_if(l IS NOT NULL AND r IS NOT NULL) AS checked,
       count_if(l IS NOT NULL AND r IS NOT NULL AND NOT (l <= r)) AS violations,
       round(count_if(l IS NOT NULL AND r IS NOT NULL AND NOT (l <= r)) * 100.0 / count_if(l IS NOT NULL AND r IS NOT NULL), 9) AS violation_pct,
       count_if(l IS NULL) AS missing_left, count_if(r IS NULL) AS missing_right,
       CASE WHEN count_if(l IS NOT NULL AND r IS NOT NULL) = 0 THEN 'not_checkable'
            WHEN count_if(l IS NOT NULL AND r IS NOT NULL AND NOT (l <= r)) > 0 THEN 'fail' ELSE 'pass' END AS status FROM j""")
def q_temporal_rule(spark, sf):
    """Order date ≤ ship date across the order → item join."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), "o_orderdate")
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_shipdate")
    return tidy(rules.temporal_rule(o, li, "k", "o_orderdate", "l_shipdate", "<="))


@register("foreign_key_check", """
SELECT 'l_partkey->p_partkey' AS relation, count(*) AS n_rows, count(l_partkey) AS checked_rows,
       count_if(l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)) AS orphan_rows,
       round(count_if(l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part)) * 1.0 / count(l_partkey), 9) AS orphan_rate
FROM lineitem
UNION ALL
SELECT 'l_orderkey->o_orderkey', count(*), count(l_orderkey),
       count_if(l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')),
       round(count_if(l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')) * 1.0 / count(l_orderkey), 9)
FROM lineitem""")
def q_foreign_key_check(spark, sf):
    """Orphan child keys (second relation uses a date-bounded parent,
    so orphans exist)."""
    li = table(spark, sf, "lineitem")
    a = rules.foreign_key_check(li, table(spark, sf, "part"), "l_partkey", "p_partkey")
    parent = table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    b = rules.foreign_key_check(li, parent, "l_orderkey", "o_orderkey")
    return tidy(a.unionByName(b))


@register("key_coverage", """
SELECT 'items' AS child_table, count(*) AS parent_keys, count_if(o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS covered_keys,
       round(count_if(o_orderkey IN (SELECT l_orderkey FROM lineitem)) * 1.0 / count(*), 9) AS coverage FROM orders
UNION ALL
SELECT 'returns', count(*), count_if(o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')),
       round(count_if(o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')) * 1.0 / count(*), 9) FROM orders""")
def q_key_coverage(spark, sf):
    """Share of orders present in each child table."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_returnflag")
    return tidy(rules.key_coverage(o, {"items": li, "returns": li.filter(F.col("l_returnflag") == "R")}, "k"))


@register("join_risk_report", """
WITH l AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
r AS (SELECT p_partkey AS k, count(*) AS n FROM part GROUP BY 1),
j AS (SELECT l.n AS ln, r.n AS rn FROM l FULL JOIN r ON l.k = r.k)
SELECT 'lineitem-part' AS relation, count_if(ln > 1) AS left_dup_keys, count_if(rn > 1) AS right_dup_keys,
       count_if(ln IS NOT NULL AND rn IS NULL) AS left_only_keys, count_if(rn IS NOT NULL AND ln IS NULL) AS right_only_keys,
       CASE WHEN count_if(ln > 1) > 0 AND count_if(rn > 1) > 0 THEN 'many_to_many' WHEN count_if(rn > 1) > 0 THEN 'right_can_inflate'
            WHEN count_if(ln > 1) > 0 THEN 'left_duplicates' ELSE 'low' END AS risk FROM j""")
def q_join_risk(spark, sf):
    """Duplicate and unmatched keys on both sides, risk class."""
    li = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k"))
    pt = table(spark, sf, "part").select(F.col("p_partkey").alias("k"))
    return rules.join_risk_report(li, pt, "k", "lineitem-part")


@register("assert_unique_key", """
SELECT 'c_custkey' AS key_name, count(*) AS n_rows, count(DISTINCT c_custkey) AS n_keys, true AS is_unique FROM customer
UNION ALL SELECT 'l_orderkey,l_linenumber', count(*), count(DISTINCT (l_orderkey, l_linenumber)), false FROM lineitem""")
def q_assert_unique(spark, sf):
    """Uniqueness assertion (raises when the key is not unique); the
    query records whether it raised."""
    out = []
    for name, df, keys in [("c_custkey", table(spark, sf, "customer"), ["c_custkey"]),
                           ("l_orderkey,l_linenumber", table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])]:
        try:
            rules.assert_unique_key(df, keys)
            ok = True
        except rules.UniqueKeyError:
            ok = False
        out.append(df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(*keys).alias("n_keys"))
                   .select(F.lit(name).alias("key_name"), "n_rows", "n_keys", F.lit(ok).alias("is_unique")))
    return out[0].unionByName(out[1])


@register("join_rowcount_check", """
SELECT (SELECT count(*) FROM orders) AS rows_before, count(*) AS rows_after, (SELECT count(*) FROM orders) = count(*) AS rowcount_match,
       'c_mktsegment,c_acctbal' AS new_columns, count_if(c_mktsegment IS NULL) + count_if(c_acctbal IS NULL) AS new_missing_cells
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q_join_rowcount(spark, sf):
    """Row count preserved by a m:1 left join; new missing cells."""
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_acctbal")
    return rules.join_rowcount_check(o, o.join(c, "o_custkey", "left"))


def _flags(spark, sf):
    from basketry.plans.queries.q_clean import order_status_text
    it = retail.items(spark, sf)
    children = {"item": it, "return": it.filter(F.col("return_flag") == "R"),
                "shipment": it.filter(F.col("line_status") == "F")}
    return rules.lifecycle_flags(order_status_text(spark, sf), children, "order_id")


FLAGS_SQL = """
WITH f AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'returned' ELSE 'processing' END AS order_status,
  CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 1 ELSE 0 END AS has_item,
  CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') THEN 1 ELSE 0 END AS has_return,
  CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') THEN 1 ELSE 0 END AS has_shipment
  FROM orders)
"""


@register("lifecycle_share", FLAGS_SQL + """
SELECT order_status, count(*) AS n_orders, round(avg(has_item), 9) AS share_has_item, round(avg(has_return), 9) AS share_has_return,
       round(avg(has_shipment), 9) AS share_has_shipment FROM f GROUP BY 1""")
def q_lifecycle_share(spark, sf):
    """Child-record flags per order, share per status."""
    return tidy(rules.lifecycle_share(_flags(spark, sf), "order_status", ["item", "return", "shipment"]))


LIFECYCLE_CHECKS = [
    ("delivered_without_items", "order_status = 'delivered' AND has_item = 0", "high"),
    ("processing_with_return", "order_status = 'processing' AND has_return = 1", "medium"),
    ("returned_without_return_record", "order_status = 'returned' AND has_return = 0", "high"),
    ("delivered_with_return_record", "order_status = 'delivered' AND has_return = 1", "medium"),
    ("shipment_without_item", "has_shipment = 1 AND has_item = 0", "high"),
    ("delivered_without_shipment", "order_status = 'delivered' AND has_shipment = 0", "high"),
    ("processing_fully_shipped", "order_status = 'processing' AND has_shipment = 1", "low"),
]


@register("lifecycle_consistency", FLAGS_SQL + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, '{s}' AS severity, count(*) AS n_rows, count_if({p}) AS issue_count, "
    f"round(count_if({p}) * 100.0 / count(*), 9) AS issue_pct, CASE WHEN count_if({p}) > 0 THEN 'review' ELSE 'pass' END AS result FROM f"
    for n, p, s in LIFECYCLE_CHECKS) + ")")
def q_lifecycle_consistency(spark, sf):
    """Named status-vs-child checks in one scan."""
    return tidy(rules.named_checks(_flags(spark, sf), LIFECYCLE_CHECKS))


@register("lifecycle_conflict_rows", FLAGS_SQL + """
SELECT 'delivered_without_items' AS check_name, o_orderkey AS order_id, has_item, NULL::INTEGER AS has_return FROM f
  WHERE order_status = 'delivered' AND has_item = 0
UNION ALL SELECT 'returned_without_return_record', o_orderkey, NULL, has_return FROM f
  WHERE order_status = 'returned' AND has_return = 0""")
def q_lifecycle_conflict_rows(spark, sf):
    """Row-level conflict detail, differing columns unioned by name."""
    return rules.conflict_rows(_flags(spark, sf), [
        ("delivered_without_items", "order_status = 'delivered' AND has_item = 0", ["has_item"]),
        ("returned_without_return_record", "order_status = 'returned' AND has_return = 0", ["has_return"])], "order_id")


@register("return_vs_ordered", """
WITH r AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS returned_qty, count(*) AS return_lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
o AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS ordered_qty FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2)
SELECT r.l_orderkey AS order_id, r.l_partkey AS product_id, returned_qty, return_lines, ordered_qty,
       CASE WHEN ordered_qty IS NULL THEN 'no_ordered_pair' ELSE 'returned_above_ordered' END AS issue
FROM r LEFT JOIN o ON r.l_orderkey = o.l_orderkey AND r.l_partkey = o.l_partkey
WHERE ordered_qty IS NULL OR returned_qty > ordered_qty""")
def q_return_vs_ordered(spark, sf):
    """Returned (order, product) pairs without a matching closed line,
    or above the ordered quantity."""
    it = retail.items(spark, sf)
    return tidy(rules.return_vs_ordered(it.filter(F.col("return_flag") == "R"), it.filter(F.col("line_status") == "F"),
                                        ["order_id", "product_id"], "quantity", "quantity"))


@register("missing_child_by_status", FLAGS_SQL + """
SELECT order_status, count(*) AS n_total, count_if(has_shipment = 0) AS n_missing,
       round(count_if(has_shipment = 0) * 100.0 / count(*), 9) AS pct_in_status,
       round(count_if(has_shipment = 0) * 100.0 / (SELECT count_if(has_shipment = 0) FROM f), 9) AS pct_of_missing,
       CASE WHEN count_if(has_shipment = 0) = 0 THEN 'complete' WHEN count_if(has_shipment = 0) = count(*) THEN 'expected_absent'
            ELSE 'partial' END AS interpretation FROM f GROUP BY 1""")
def q_missing_child_by_status(spark, sf):
    """Missing shipments per status with shares."""
    return tidy(rules.missing_child_by_status(_flags(spark, sf), "order_status", "shipment"))


@register("payment_reconciliation", """
WITH s AS (SELECT l_orderkey AS k, sum(l_extendedprice - coalesce(l_extendedprice * l_discount, 0)) AS net FROM lineitem GROUP BY 1),
p AS (SELECT o_orderkey AS k, sum(o_totalprice) AS pay FROM orders GROUP BY 1)
SELECT count(*) AS n_keys, count_if(abs(net - pay) > 1e-6) AS n_mismatch, round(max(abs(net - pay)), 2) AS max_abs_diff
FROM s JOIN p ON s.k = p.k""")
def q_payment_reconciliation(spark, sf):
    """Σ(gross − discount) per order vs the paid amount."""
    it = retail.items(spark, sf)
    pay = retail.orders(spark, sf).select("order_id", "payment_value")
    return tidy(rules.payment_reconciliation(it, pay, "order_id", "gross", "discount_amount", "payment_value"), 2)


@register("aggregation_conservation", """
WITH a AS (SELECT l_orderkey, l_partkey, sum(l_quantity) AS q, sum(l_extendedprice) AS g, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT 'rows' AS measure, (SELECT count(*) FROM lineitem)::DOUBLE AS "before", sum(n)::DOUBLE AS "after",
       sum(n)::DOUBLE - (SELECT count(*) FROM lineitem)::DOUBLE + 0.0 AS difference FROM a
UNION ALL SELECT 'quantity', round((SELECT sum(l_quantity) FROM lineitem), 2), round(sum(q), 2), round(sum(q) - (SELECT sum(l_quantity) FROM lineitem), 2) + 0.0 FROM a
UNION ALL SELECT 'gross', round((SELECT sum(l_extendedprice) FROM lineitem), 2), round(sum(g), 2), round(sum(g) - (SELECT sum(l_extendedprice) FROM lineitem), 2) + 0.0 FROM a""")
def q_aggregation_conservation(spark, sf):
    """Totals before vs after merging duplicate lines."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").alias("quantity"),
                                              F.col("l_extendedprice").alias("gross"))
    agg = li.groupBy("l_orderkey", "l_partkey").agg(F.sum("quantity").alias("quantity"), F.sum("gross").alias("gross"),
                                                    F.count(F.lit(1)).alias("n"))
    out = tidy(rules.aggregation_conservation(li, agg, ["quantity", "gross"], count_col="n"), 2)
    # the difference of two float totals is noise of either sign around 0: + 0.0 drops the sign of a rounded zero
    return out.withColumn("difference", F.col("difference") + F.lit(0.0))


@register("logic_checks", """
SELECT * FROM (
SELECT 'negative_price' AS check_name, 'high' AS severity, count(*) AS n_rows, count_if(l_extendedprice < 0) AS issue_count,
  round(count_if(l_extendedprice < 0) * 100.0 / count(*), 9) AS issue_pct, CASE WHEN count_if(l_extendedprice < 0) > 0 THEN 'review' ELSE 'pass' END AS result FROM lineitem
UNION ALL SELECT 'price_below_cost', 'medium', count(*), count_if(l_extendedprice / l_quantity < 0.95 * p_retailprice),
  round(count_if(l_extendedprice / l_quantity < 0.95 * p_retailprice) * 100.0 / count(*), 9),
  CASE WHEN count_if(l_extendedprice / l_quantity < 0.95 * p_retailprice) > 0 THEN 'review' ELSE 'pass' END
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
UNION ALL SELECT 'discount_above_gross', 'high', count(*), count_if(l_extendedprice * l_discount > l_extendedprice),
  round(count_if(l_extendedprice * l_discount > l_extendedprice) * 100.0 / count(*), 9),
  CASE WHEN count_if(l_extendedprice * l_discount > l_extendedprice) > 0 THEN 'review' ELSE 'pass' END FROM lineitem)""")
def q_logic_checks(spark, sf):
    """Negative values, price below 0.95·cost, discount above gross."""
    li = table(spark, sf, "lineitem")
    pt = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    a = rules.named_checks(li, [("negative_price", "l_extendedprice < 0", "high")])
    b = rules.named_checks(li.join(pt, "l_partkey", "left"),
                           [("price_below_cost", "l_extendedprice / l_quantity < 0.95 * p_retailprice", "medium")])
    c = rules.named_checks(li, [("discount_above_gross", "l_extendedprice * l_discount > l_extendedprice", "high")])
    return tidy(a.unionByName(b).unionByName(c))


@register("tenure_date_audit", """
WITH f AS (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY 1),
j AS (SELECT o_orderdate, first_order FROM orders JOIN f USING (o_custkey))
SELECT 'order_before_start' AS check_name, 'high' AS severity, count(*) AS n_rows, count_if(o_orderdate < first_order) AS issue_count,
       round(count_if(o_orderdate < first_order) * 100.0 / count(*), 9) AS issue_pct,
       CASE WHEN count_if(o_orderdate < first_order) > 0 THEN 'review' ELSE 'pass' END AS result FROM j""")
def q_tenure_audit(spark, sf):
    """Orders dated before the customer's start (first order here)."""
    o = table(spark, sf, "orders")
    f = o.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"))
    return tidy(rules.named_checks(o.join(f, "o_custkey"), [("order_before_start", "o_orderdate < first_order", "high")]))
