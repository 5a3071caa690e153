"""Queries for §2.11 statistics and relations."""

from pyspark.sql import functions as F

from basketry.operators import stats
from basketry.plans.catalog import register, table, tidy

ORDER_FEATS_SQL = """
WITH s AS (SELECT l_orderkey, count(*)::DOUBLE AS n_lines, sum(l_quantity) AS total_quantity,
                  sum(l_extendedprice * l_discount) / nullif(sum(l_extendedprice), 0) AS discount_ratio,
                  max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned FROM lineitem GROUP BY 1),
of AS (SELECT o_orderkey, o_orderpriority, o_orderstatus, year(o_orderdate) AS year, o_totalprice, n_lines, total_quantity,
              discount_ratio, returned FROM orders LEFT JOIN s ON o_orderkey = l_orderkey)
"""
FEATS = ["o_totalprice", "n_lines", "total_quantity", "discount_ratio"]


def order_features(spark, sf):
    """Order-grain numeric features and the returned label."""
    s = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("total_quantity"),
        F.try_divide(F.sum(F.col("l_extendedprice") * F.col("l_discount")), F.nullif(F.sum("l_extendedprice"), F.lit(0.0))).alias("discount_ratio"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("returned"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("year"),
                                          "o_totalprice")
    return o.join(s, "o_orderkey", "left")


LONG_SQL = ORDER_FEATS_SQL + ", lg AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, year, CAST({f} AS DOUBLE) AS x, CAST(returned AS DOUBLE) AS y FROM of WHERE {f} IS NOT NULL AND returned IS NOT NULL"
    for f in FEATS) + """),
rk AS (SELECT *, (2 * rank() OVER (PARTITION BY feature ORDER BY x) + count(*) OVER (PARTITION BY feature, x) - 1) / 2.0 AS rx,
              (2 * rank() OVER (PARTITION BY feature ORDER BY y) + count(*) OVER (PARTITION BY feature, y) - 1) / 2.0 AS ry FROM lg)
"""


@register("pearson", ORDER_FEATS_SQL + """
SELECT round(CASE WHEN count(total_quantity * 0 + o_totalprice) >= 30 THEN corr(o_totalprice, total_quantity) END, 9) AS pearson FROM of""")
def q_pearson(spark, sf):
    """Pairwise-complete Pearson with the ≥ 30 pairs guard."""
    return tidy(order_features(spark, sf).agg(stats.pearson("o_totalprice", "total_quantity").alias("pearson")))


@register("spearman", ORDER_FEATS_SQL + """,
p AS (SELECT o_totalprice AS x, total_quantity AS y FROM of WHERE o_totalprice IS NOT NULL AND total_quantity IS NOT NULL),
r AS (SELECT (2 * rank() OVER (ORDER BY x) + count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
             (2 * rank() OVER (ORDER BY y) + count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM p)
SELECT 'o_totalprice' AS feature, round(corr(rx, ry), 9) AS spearman, count(*) AS n_pairs FROM r""")
def q_spearman(spark, sf):
    """Spearman = Pearson of tie-averaged ranks (pairwise complete)."""
    return tidy(stats.spearman(order_features(spark, sf), "o_totalprice", "total_quantity"))


@register("target_relation_report", LONG_SQL + """,
agg AS (SELECT feature, count(*) AS n_pairs, corr(x, y) AS p, corr(rx, ry) AS s, stddev_samp(x) AS sx FROM rk GROUP BY 1),
f AS (SELECT feature, n_pairs, CASE WHEN n_pairs >= 30 AND sx > 0 THEN p END AS pearson, CASE WHEN n_pairs >= 30 AND sx > 0 THEN s END AS spearman FROM agg)
SELECT feature, n_pairs, round(pearson, 9) AS pearson, round(spearman, 9) AS spearman,
       round(greatest(abs(pearson), abs(spearman)), 9) AS max_abs_corr,
       CASE WHEN greatest(abs(pearson), abs(spearman)) >= 0.6 THEN 'strong' WHEN greatest(abs(pearson), abs(spearman)) >= 0.3 THEN 'medium'
            WHEN greatest(abs(pearson), abs(spearman)) >= 0.1 THEN 'weak' ELSE 'unclear' END AS relation FROM f""")
def q_target_relation(spark, sf):
    """Pearson + Spearman of every feature with the label in one job."""
    return tidy(stats.target_relation_report(order_features(spark, sf), FEATS, "returned"))


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("corr_matrix", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 9) AS corr FROM lineitem" for a in LI_NUM for b in LI_NUM) + ")")
def q_corr_matrix(spark, sf):
    """Full pairwise correlation matrix in long form."""
    return tidy(stats.corr_matrix(table(spark, sf, "lineitem"), LI_NUM))


@register("high_corr_pairs", ORDER_FEATS_SQL + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr(CASE WHEN {b} IS NOT NULL THEN {a} END, CASE WHEN {a} IS NOT NULL THEN {b} END), 9) AS corr FROM of"
    for i, a in enumerate(FEATS) for b in FEATS[i + 1:]) + ") WHERE abs(corr) >= 0.5")
def q_high_corr(spark, sf):
    """Upper-triangle order-feature pairs with |r| ≥ 0.5."""
    return tidy(stats.high_corr_pairs(order_features(spark, sf), FEATS, 0.5))


TEMPORAL_SQL = LONG_SQL + """,
rk2 AS (SELECT *, (2 * rank() OVER (PARTITION BY year, feature ORDER BY x) + count(*) OVER (PARTITION BY year, feature, x) - 1) / 2.0 AS tx,
               (2 * rank() OVER (PARTITION BY year, feature ORDER BY y) + count(*) OVER (PARTITION BY year, feature, y) - 1) / 2.0 AS ty FROM lg),
tr AS (SELECT year AS period, feature, corr(tx, ty) AS spearman, count(*) AS n_pairs FROM rk2 GROUP BY 1, 2)
"""


@register("temporal_relation", TEMPORAL_SQL + """
SELECT period, feature, round(spearman, 9) AS spearman, n_pairs FROM tr""")
def q_temporal_relation(spark, sf):
    """Spearman per feature and year."""
    o = order_features(spark, sf)
    return tidy(stats.temporal_relation(o, FEATS, "returned", F.col("year")))


@register("sign_stability", TEMPORAL_SQL + """
SELECT feature, count(DISTINCT CASE WHEN spearman IS NOT NULL AND spearman <> 0 THEN sign(spearman) END) AS n_signs,
       count(spearman) AS n_periods, max(period >= 2000) AS recent_present,
       CASE WHEN count(spearman) = 0 THEN 'REVIEW'
            WHEN count(DISTINCT CASE WHEN spearman IS NOT NULL AND spearman <> 0 THEN sign(spearman) END) = 1 AND max(period >= 2000) THEN 'PASS'
            ELSE 'FLAG' END AS stability FROM tr GROUP BY 1""")
def q_sign_stability(spark, sf):
    """Sign of the yearly correlation constant (and recent year seen)."""
    rel = stats.temporal_relation(order_features(spark, sf), FEATS, "returned", F.col("year"))
    return stats.sign_stability(rel, recent=F.lit(2000))


@register("train_valid_direction", ORDER_FEATS_SQL + ", lg AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CASE WHEN year < 1999 THEN 'train' ELSE 'validation' END AS sp, CAST({f} AS DOUBLE) AS x, "
    f"CAST(returned AS DOUBLE) AS y FROM of WHERE {f} IS NOT NULL AND returned IS NOT NULL" for f in FEATS) + """)
SELECT feature, round(corr(x, y) FILTER (WHERE sp = 'train'), 9) AS train_corr, round(corr(x, y) FILTER (WHERE sp = 'validation'), 9) AS valid_corr,
       coalesce(sign(corr(x, y) FILTER (WHERE sp = 'train')) = sign(corr(x, y) FILTER (WHERE sp = 'validation'))
                AND abs(corr(x, y) FILTER (WHERE sp = 'train')) >= 0.05 AND abs(corr(x, y) FILTER (WHERE sp = 'validation')) >= 0.05, false) AS consistent
FROM lg GROUP BY 1""")
def q_train_valid_direction(spark, sf):
    """Correlation direction agrees between train and validation."""
    o = order_features(spark, sf).withColumn("sp", F.when(F.col("year") < 1999, "train").otherwise("validation"))
    return tidy(stats.train_valid_direction(o, FEATS, "returned", "sp"))


def _cramer_sql(col):
    return ORDER_FEATS_SQL + f""",
c AS (SELECT CAST({col} AS VARCHAR) AS a, CAST(returned AS VARCHAR) AS b, count(*) AS o FROM of WHERE {col} IS NOT NULL AND returned IS NOT NULL GROUP BY 1, 2),
ra AS (SELECT a, sum(o) AS ra FROM c GROUP BY 1), cb AS (SELECT b, sum(o) AS cb FROM c GROUP BY 1),
x AS (SELECT sum(o) AS n, sum(o * o * 1.0 / (ra * cb)) AS s, count(DISTINCT c.a) AS r, count(DISTINCT c.b) AS k
      FROM c JOIN ra USING (a) JOIN cb USING (b)),
y AS (SELECT n, r, k, n * (s - 1.0) AS chi2 FROM x)
SELECT '{col}' AS feature, n, r, k, round(chi2, 6) AS chi2,
       round(CASE WHEN r < 2 OR k < 2 OR n <= 1 OR least(k - (k - 1) * (k - 1) / (n - 1.0), r - (r - 1) * (r - 1) / (n - 1.0)) - 1 <= 0 THEN 0.0
             ELSE sqrt(greatest(0.0, chi2 / n - (k - 1) * (r - 1) / (n - 1.0))
                       / (least(k - (k - 1) * (k - 1) / (n - 1.0), r - (r - 1) * (r - 1) / (n - 1.0)) - 1)) END, 9) AS cramers_v FROM y"""


@register("cramers_v", _cramer_sql("o_orderpriority"))
def q_cramers_v(spark, sf):
    """Bias-corrected Cramér's V of priority vs returned."""
    v = stats.cramers_v(order_features(spark, sf), "o_orderpriority", "returned")
    return tidy(v.select(F.lit("o_orderpriority").alias("feature"), "n", "r", "k", "chi2", "cramers_v"), 9, {"chi2": 6})


def _chi2_sql(col):
    """χ² statistic, shape and n of ``col`` × returned, every expected cell."""
    return f"""d AS (SELECT CAST({col} AS VARCHAR) AS a, returned AS b FROM of WHERE {col} IS NOT NULL AND returned IS NOT NULL),
ra AS (SELECT a, count(*) AS ra FROM d GROUP BY 1), cb AS (SELECT b, count(*) AS cb FROM d GROUP BY 1),
o AS (SELECT a, b, count(*) AS o FROM d GROUP BY 1, 2), nn AS (SELECT count(*) AS n FROM d),
e AS (SELECT ra * cb * 1.0 / n AS e, coalesce(o, 0) AS o FROM ra, cb, nn LEFT JOIN o ON o.a = ra.a AND o.b = cb.b),
x AS (SELECT sum((o - e) * (o - e) / e) AS chi2, (SELECT count(*) FROM ra) AS r, (SELECT count(*) FROM cb) AS k, (SELECT n FROM nn) AS n FROM e)"""


def _t_tail_sql(source):
    """Two-sided t tail of every row of ``source`` (feature, n, r): one less
    twice Simpson's integral of the density from 0 to t."""
    return f"""tv AS (SELECT feature, n, r, n - 2.0 AS nu, abs(r) * sqrt((n - 2) / (1 - r * r)) AS t FROM {source}),
si AS (SELECT feature, n, r, nu, t, i, t * i / 4000.0 AS u, CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
       FROM tv, range(4001) q(i)),
tp AS (SELECT feature, n, r, 1 - 2 * max(t) / 4000 / 3 * sum(w * exp(lgamma((nu + 1) / 2) - lgamma(nu / 2) - 0.5 * ln(nu * pi())
              - (nu + 1) / 2 * ln(1 + u * u / nu))) AS p_value FROM si GROUP BY feature, n, r)"""


@register("chi2_test", ORDER_FEATS_SQL + ", " + _chi2_sql("o_orderstatus") + """
SELECT round(chi2, 6) AS chi2, CAST((r - 1) * (k - 1) AS INTEGER) AS dof, round(exp(-chi2 / 2), 9) AS p_value, n, false AS yates FROM x""")
def q_chi2_test(spark, sf):
    """χ² test (Yates on 2×2) of status vs returned; the statistic comes
    from Spark aggregates, the p-value from the χ² tail on the driver."""
    res = stats.chi2_test(order_features(spark, sf), "o_orderstatus", "returned")
    return tidy(spark.createDataFrame([(float(res["chi2"]), int(res["dof"]), float(res["p_value"]), int(res["n"]), bool(res["yates"]))],
                                      "chi2 double, dof int, p_value double, n long, yates boolean"), 9, {"chi2": 6})


@register("point_biserial", ORDER_FEATS_SQL + """,
g AS (SELECT 'discount_ratio' AS feature, corr(discount_ratio, returned) AS r, count_if(discount_ratio IS NOT NULL AND returned IS NOT NULL) AS n
      FROM of), """ + _t_tail_sql("g") + """
SELECT feature, n, round(r, 9) AS r, round(p_value, 6) AS p_value FROM tp""")
def q_point_biserial(spark, sf):
    """Point-biserial r and its t-distribution p-value."""
    return tidy(stats.point_biserial(order_features(spark, sf), "discount_ratio", "returned"), 9, {"p_value": 6})


@register("distribution_by_label", """
SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, count(l_discount) AS n, round(min(l_discount), 9) AS min,
       round(quantile_cont(l_discount, 0.05), 9) AS p05, round(quantile_cont(l_discount, 0.25), 9) AS p25,
       round(quantile_cont(l_discount, 0.5), 9) AS p50, round(quantile_cont(l_discount, 0.75), 9) AS p75,
       round(quantile_cont(l_discount, 0.95), 9) AS p95, round(max(l_discount), 9) AS max FROM lineitem GROUP BY 1""")
def q_distribution_by_label(spark, sf):
    """Score quantiles by label."""
    li = table(spark, sf, "lineitem").withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    return tidy(stats.distribution_by_label(li, "l_discount", "label"))


def _cramer_rows(col, tail):
    return f"""SELECT '{col}' AS feature, 'cramers_v' AS metric, v AS score, v AS effect_size, {tail} AS p_value FROM (
    SELECT chi2, CASE WHEN least(k - (k - 1) * (k - 1) / (n - 1.0), r - (r - 1) * (r - 1) / (n - 1.0)) - 1 <= 0 THEN 0.0
                ELSE sqrt(greatest(0.0, chi2 / n - (k - 1) * (r - 1) / (n - 1.0))
                          / (least(k - (k - 1) * (k - 1) / (n - 1.0), r - (r - 1) * (r - 1) / (n - 1.0)) - 1)) END AS v
    FROM ({ORDER_FEATS_SQL}, {_chi2_sql(col)} SELECT * FROM x))"""


@register("relevance_ranking", ORDER_FEATS_SQL + """,
g AS (SELECT 'o_totalprice' AS feature, corr(o_totalprice, returned) AS r, count_if(o_totalprice IS NOT NULL AND returned IS NOT NULL) AS n FROM of
      UNION ALL SELECT 'discount_ratio', corr(discount_ratio, returned), count_if(discount_ratio IS NOT NULL AND returned IS NOT NULL) FROM of),
""" + _t_tail_sql("g") + """,
al AS (SELECT feature, 'point_biserial_r' AS metric, r AS score, abs(r) AS effect_size, p_value FROM tp
       UNION ALL SELECT * FROM (""" + _cramer_rows("o_orderpriority", "exp(-chi2 / 2) * (1 + chi2 / 2)") + """)
       UNION ALL SELECT * FROM (""" + _cramer_rows("o_orderstatus", "exp(-chi2 / 2)") + """))
SELECT CAST(row_number() OVER (ORDER BY effect_size DESC, feature) AS INTEGER) AS place, feature, metric, round(score, 8) AS score,
       round(effect_size, 8) AS effect_size, round(p_value, 6) AS p_value FROM al""")
def q_relevance_ranking(spark, sf):
    """Effect sizes of numeric (point-biserial) and categorical
    (Cramér's V) features on the returned label, with p-values, best first."""
    o = order_features(spark, sf)
    r = stats.relevance_ranking(o, ["o_totalprice", "discount_ratio"], ["o_orderpriority", "o_orderstatus"], "returned")
    return tidy(r, 8, {"p_value": 6})
