"""Flagship query: return rate by customer segment with the order-level
discount ratio (A01 → D07 → F14 → E01 → F17 → H01)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.joins import left_join_m1
from basketry.operators.rollup import group_target_rate, order_item_summary
from basketry.operators.topk import top_k
from basketry.sources import retail


def return_rate_by_segment(spark: SparkSession, sf_dir: str, validate: bool = True, k: int = 10) -> DataFrame:
    items = retail.items(spark, sf_dir)
    orders = retail.orders(spark, sf_dir).select("order_id", "customer_id")
    customers = retail.customers(spark, sf_dir).select("customer_id", "segment")
    # Pre-aggregate the item fan-out to the order grain before any join.
    per_order = order_item_summary(
        items, "order_id", "product_id", "quantity", "gross", "discount_amount",
        extra=[F.max((F.col("return_flag") == "R").cast("int")).alias("returned")])
    base = left_join_m1(orders, customers, "customer_id", validate=validate)
    base = left_join_m1(base, per_order, "order_id", validate=False)  # per_order is unique by construction
    rates = group_target_rate(base, "segment", "returned", sum_col="returned",
                              extra=[F.avg("discount_ratio").alias("mean_discount_ratio")])
    return top_k(rates, "target_rate", k, tiebreak=["segment"])


ORACLE = """
WITH s AS (
  SELECT l_orderkey, sum(l_extendedprice * l_discount) AS d, sum(l_extendedprice) AS g,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned
  FROM lineitem GROUP BY l_orderkey),
r AS (SELECT *, least(greatest(CASE WHEN g = 0 THEN NULL ELSE d / g END, 0), 1) AS ratio FROM s)
SELECT c_mktsegment AS segment, round(avg(returned), 9) AS target_rate, count(*) AS n_rows,
       CAST(sum(returned) AS BIGINT) AS sum_returned,
       round(avg(ratio), 9) AS mean_discount_ratio
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN r ON l_orderkey = o_orderkey
GROUP BY c_mktsegment ORDER BY target_rate DESC NULLS LAST, segment LIMIT 10
"""
