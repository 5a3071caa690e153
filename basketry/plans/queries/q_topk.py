"""Queries for §2.8 sort, limit, top-k and set operations."""

from pyspark.sql import functions as F

from basketry.operators import topk
from basketry.plans.catalog import register, table, tidy
from basketry.plans.queries.q_rollup import LINES_SQL, lines
from basketry.sources import retail


@register("top_k", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def q_top_k(spark, sf):
    """Nlargest with ties broken by key."""
    return topk.top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 20, tiebreak=["o_orderkey"])


@register("top_k_min_support", LINES_SQL + """
SELECT brand, round(avg(returned), 9) AS rate, count(*) AS n FROM lines GROUP BY 1 HAVING count(*) >= 100
ORDER BY rate DESC, brand LIMIT 10""")
def q_top_k_min_support(spark, sf):
    """Top 10 brands by return rate among brands with ≥ 100 lines."""
    g = lines(spark, sf).groupBy("brand").agg(F.avg("returned").alias("rate"), F.count(F.lit(1)).alias("n"))
    return tidy(topk.top_k_min_support(g, "rate", "n", 100, 10, tiebreak=["brand"]))


@register("top_extremes_union", """
SELECT * FROM (SELECT o_orderkey, o_totalprice, 'top' AS slice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)
UNION ALL SELECT * FROM (SELECT o_orderkey, o_totalprice, 'bottom' FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 3)""")
def q_top_extremes(spark, sf):
    """Top and bottom slices tagged and unioned."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return topk.top_extremes_union(o, [("top", "o_totalprice", 3, False), ("bottom", "o_totalprice", 3, True)])


@register("per_group_head", """
SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank_in_group FROM orders) WHERE rank_in_group <= 2""")
def q_per_group_head(spark, sf):
    """Two largest orders of each customer."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return topk.per_group_head(o, "o_custkey", "o_totalprice", 2, tiebreak=["o_orderkey"])


@register("ordered_categories", """
WITH lv(o_orderpriority, level_order) AS (VALUES ('1-URGENT', 0), ('2-HIGH', 1), ('3-MEDIUM', 2), ('4-NOT SPECIFIED', 3), ('5-LOW', 4), ('6-NONE', 5)),
g AS (SELECT o_orderpriority, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT coalesce(lv.o_orderpriority, g.o_orderpriority) AS o_orderpriority, coalesce(level_order, 6) AS level_order, coalesce(n_orders, 0) AS n_orders
FROM lv FULL JOIN g ON lv.o_orderpriority = g.o_orderpriority""")
def q_ordered_categories(spark, sf):
    """Custom level order with an absent level kept (count 0)."""
    g = table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]
    return topk.ordered_categories(g, "o_orderpriority", levels, fill={"n_orders": 0})


@register("union_by_name", """
SELECT 'customer' AS src, c_custkey AS id, c_acctbal AS balance, NULL AS name FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, s_name FROM supplier""")
def q_union_by_name(spark, sf):
    """Frames with differing columns concatenated by name."""
    c = table(spark, sf, "customer").select(F.lit("customer").alias("src"), F.col("c_custkey").alias("id"),
                                            F.col("c_acctbal").alias("balance"))
    s = table(spark, sf, "supplier").select(F.lit("supplier").alias("src"), F.col("s_suppkey").alias("id"),
                                            F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"))
    return topk.union_by_name([c, s])


@register("set_overlap", """
WITH t AS (SELECT DISTINCT o_custkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'early' WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'mid' ELSE 'late' END AS s FROM orders)
SELECT a.s AS left_set, b.s AS right_set, count(*) AS overlap_keys FROM t a JOIN t b ON a.o_custkey = b.o_custkey
WHERE (a.s, b.s) IN (('early', 'mid'), ('early', 'late'), ('mid', 'late')) GROUP BY 1, 2""")
def q_set_overlap(spark, sf):
    """Customer overlap between three time slices."""
    o = table(spark, sf, "orders")
    ts = F.col("o_orderdate")
    frames = {"early": o.filter(ts < F.lit("1998-01-01").cast("timestamp_ntz")),
              "mid": o.filter((ts >= F.lit("1998-01-01").cast("timestamp_ntz")) & (ts < F.lit("2000-01-01").cast("timestamp_ntz"))),
              "late": o.filter(ts >= F.lit("2000-01-01").cast("timestamp_ntz"))}
    return topk.set_overlap(frames, "o_custkey")


@register("set_difference", """
SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def q_set_difference(spark, sf):
    """Customers without orders."""
    c = table(spark, sf, "customer").select("c_custkey")
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return topk.set_difference(c, o, "c_custkey")


@register("melt", """
SELECT * FROM (
  SELECT c_custkey, 'c_acctbal' AS variable, c_acctbal AS value FROM customer
  UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer)""")
def q_melt(spark, sf):
    """Wide → long."""
    return topk.melt(table(spark, sf, "customer"), "c_custkey", ["c_acctbal", "c_nationkey"])


@register("unstack", """
SELECT o_orderstatus, count_if(o_orderpriority = '1-URGENT') AS p_1_urgent, count_if(o_orderpriority = '2-HIGH') AS p_2_high,
       count_if(o_orderpriority = '3-MEDIUM') AS p_3_medium, count_if(o_orderpriority = '4-NOT SPECIFIED') AS p_4_not_specified,
       count_if(o_orderpriority = '5-LOW') AS p_5_low FROM orders GROUP BY 1""")
def q_unstack(spark, sf):
    """Group counts to a 0-filled matrix."""
    from basketry.operators.rollup import pivot_agg
    levels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return pivot_agg(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", levels, "count", prefix="p", fill=0)


@register("sample_rows", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5('7|' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 100""")
def q_sample_rows(spark, sf):
    """Seeded, partition-independent sample of 100 orders (hash order;
    checked for determinism and size in the tests)."""
    return topk.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 100, seed=7, key="o_orderkey")
