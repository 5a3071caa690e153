"""Queries for §2.14 splits and validation folds (and F30)."""

from pyspark.sql import functions as F

from basketry.operators import splits
from basketry.operators.rollup import split_contract
from basketry.plans.catalog import register, tidy
from basketry.plans.queries.q_stats import ORDER_FEATS_SQL
from basketry.sources import retail

LABELLED_SQL = ORDER_FEATS_SQL + """,
lab AS (SELECT o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date, returned FROM of JOIN orders o USING (o_orderkey)
        WHERE returned IS NOT NULL),
pos AS (SELECT order_date, row_number() OVER (ORDER BY order_date, order_id) - 1 AS i, count(*) OVER () AS n FROM lab),
cuts AS (SELECT (SELECT order_date FROM pos WHERE i = floor(n * 0.70)) AS c1, (SELECT order_date FROM pos WHERE i = floor(n * 0.85)) AS c2
         FROM pos LIMIT 1),
sp AS (SELECT lab.*, CASE WHEN order_date < c1 THEN 'train' WHEN order_date < c2 THEN 'validation' ELSE 'test' END AS data_split FROM lab, cuts)
"""


def labelled_orders(spark, sf):
    """Orders with items and the returned label (any R line)."""
    it = retail.items(spark, sf)
    lab = it.groupBy("order_id").agg(F.max((F.col("return_flag") == "R").cast("int")).alias("returned"))
    return retail.orders(spark, sf).select("order_id", "order_date").join(lab, "order_id")


@register("time_split", """
SELECT CASE WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN 'train' WHEN o_orderdate < TIMESTAMP '2000-06-01' THEN 'validation' ELSE 'test' END AS data_split,
       count(*) AS n_rows FROM orders GROUP BY 1""")
def q_time_split(spark, sf):
    """Train / validation / test by date bounds."""
    o = retail.orders(spark, sf)
    return splits.time_split(o, "order_date", "1999-01-01", "2000-06-01").groupBy("data_split").agg(F.count(F.lit(1)).alias("n_rows"))


@register("positional_cutoff_split", LABELLED_SQL + """
SELECT data_split, count(*) AS n_rows, CAST(min(order_date) AS VARCHAR) AS start_date, CAST(max(order_date) AS VARCHAR) AS end_date,
       count(DISTINCT order_id) AS n_keys, round(avg(returned), 9) AS positive_rate FROM sp GROUP BY 1""")
def q_positional_split(spark, sf):
    """N02 + F30: cut dates at the 70% / 85% row positions on the date axis;
    per split rows, distinct orders, date range and return rate."""
    sp = splits.positional_cutoff_split(labelled_orders(spark, sf), "order_date")
    return tidy(split_contract(sp, "data_split", "order_date", "returned", "order_id"))


FOLDS_SQL = LABELLED_SQL + """,
tr AS (SELECT * FROM sp WHERE data_split = 'train'),
d AS (SELECT order_date, row_number() OVER (ORDER BY order_date) - 1 AS i, count(*) OVER () AS nd FROM (SELECT DISTINCT order_date FROM tr)),
fr(fold, a, b) AS (VALUES (1, 0.55, 0.70), (2, 0.70, 0.85), (3, 0.85, 1.00)),
fb AS (SELECT fold, (SELECT order_date FROM d WHERE i = least(floor(nd * a), nd - 1)) AS train_end,
              (SELECT order_date FROM d WHERE i = least(floor(nd * b), nd - 1)) AS valid_end, fold = 3 AS closed_right
       FROM fr, (SELECT DISTINCT nd FROM d))
"""


@register("expanding_folds", FOLDS_SQL + """
SELECT fold, role, count(*) AS n_rows, CAST(min(order_date) AS VARCHAR) AS start_date, CAST(max(order_date) AS VARCHAR) AS end_date,
       round(avg(returned), 9) AS target_rate FROM (
  SELECT fold, order_date, returned, CASE WHEN order_date < train_end THEN 'train'
         WHEN order_date >= train_end AND (order_date < valid_end OR (closed_right AND order_date = valid_end)) THEN 'validation' END AS role
  FROM tr, fb) WHERE role IS NOT NULL GROUP BY 1, 2""")
def q_expanding_folds(spark, sf):
    """Three expanding folds on the distinct-date axis of the train
    split; audit rows per fold and role."""
    sp = splits.positional_cutoff_split(labelled_orders(spark, sf), "order_date")
    tr = sp.filter(F.col("data_split") == "train")
    folds = splits.expanding_folds(tr, "order_date")
    return tidy(splits.fold_audit(tr, folds, "order_date", "returned"))


@register("rolling_origin", """
WITH d AS (SELECT min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS z FROM lineitem),
o AS (SELECT CAST(unnest(generate_series(a + 1095, z - 29, INTERVAL 90 DAY)) AS DATE) AS origin FROM d),
r AS (SELECT origin, row_number() OVER (ORDER BY origin DESC) AS rk FROM o)
SELECT row_number() OVER (ORDER BY origin) AS fold, CAST(origin AS VARCHAR) AS origin, CAST(origin + 29 AS VARCHAR) AS test_end FROM r WHERE rk <= 6""")
def q_rolling_origin(spark, sf):
    """Origins every 90 days after 3 years, 30-day tests, last 6."""
    it = retail.items(spark, sf)
    return tidy(splits.rolling_origin(it, "ship_date"))


@register("split_integrity", LABELLED_SQL + """
SELECT 'train|validation' AS pair, (SELECT count(*) FROM (SELECT order_id FROM sp WHERE data_split = 'train' INTERSECT SELECT order_id FROM sp WHERE data_split = 'validation')) AS overlap_keys,
       (SELECT max(order_date) FROM sp WHERE data_split = 'train') < (SELECT min(order_date) FROM sp WHERE data_split = 'validation') AS ordered
UNION ALL SELECT 'train|test', (SELECT count(*) FROM (SELECT order_id FROM sp WHERE data_split = 'train' INTERSECT SELECT order_id FROM sp WHERE data_split = 'test')),
       (SELECT max(order_date) FROM sp WHERE data_split = 'train') < (SELECT min(order_date) FROM sp WHERE data_split = 'test')
UNION ALL SELECT 'validation|test', (SELECT count(*) FROM (SELECT order_id FROM sp WHERE data_split = 'validation' INTERSECT SELECT order_id FROM sp WHERE data_split = 'test')),
       (SELECT max(order_date) FROM sp WHERE data_split = 'validation') < (SELECT min(order_date) FROM sp WHERE data_split = 'test')""")
def q_split_integrity(spark, sf):
    """No key overlap and strictly ordered splits."""
    sp = splits.positional_cutoff_split(labelled_orders(spark, sf), "order_date")
    pairs, _dates = splits.split_integrity(sp, "data_split", "order_date", "order_id")
    return pairs


@register("holdout_tail", LABELLED_SQL + """,
p2 AS (SELECT (SELECT order_date FROM pos WHERE i = floor(n * 0.85)) AS c FROM pos LIMIT 1)
SELECT order_date >= c AS is_holdout, count(*) AS n_rows FROM lab, p2 GROUP BY 1""")
def q_holdout_tail(spark, sf):
    """Last 15% of rows by time as the internal holdout."""
    h = splits.holdout_tail(labelled_orders(spark, sf), "order_date", 0.15)
    return h.groupBy("is_holdout").agg(F.count(F.lit(1)).alias("n_rows"))
