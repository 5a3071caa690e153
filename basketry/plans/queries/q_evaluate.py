"""Queries for §2.17 evaluation and error analysis."""

from pyspark.sql import functions as F

from basketry.operators import evaluate as ev
from basketry.operators import timeseries as ts
from basketry.plans.catalog import register, table, tidy
from basketry.plans.queries.q_timeseries import DENSE_SQL, dense_daily

SCORES_SQL = """
WITH sc AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_discount AS s FROM lineitem),
g AS (SELECT s, sum(y) AS pos, sum(1 - y) AS neg FROM sc GROUP BY 1),
c AS (SELECT s, pos, neg, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
             coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM g),
t AS (SELECT s AS threshold, tp, fp, tp * 1.0 / (tp + fp) AS precision, tp * 1.0 / (SELECT sum(pos) FROM g) AS recall FROM c),
tt AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM t)
"""


def scores(spark, sf):
    """Line-level label (returned) and score (discount: heavy ties)."""
    return table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_discount").alias("s"))


@register("threshold_table", SCORES_SQL + """
SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM tt""")
def q_threshold_table(spark, sf):
    """Q07: precision / recall / F1 at every distinct score."""
    return tidy(ev.threshold_table(scores(spark, sf), "y", "s"))


@register("average_precision", SCORES_SQL + """
SELECT round(sum(pos * 1.0 / (SELECT sum(pos) FROM g) * tp / (tp + fp)), 9) AS average_precision FROM c""")
def q_average_precision(spark, sf):
    """Q04: step-sum average precision (tie-aware)."""
    return tidy(ev.average_precision(scores(spark, sf), "y", "s"))


@register("roc_auc", SCORES_SQL + """
SELECT round(sum(pos * (neg_below + 0.5 * neg)) / ((SELECT sum(pos) FROM g) * (SELECT sum(neg) FROM g)), 9) AS roc_auc FROM c""")
def q_roc_auc(spark, sf):
    """Q05: tie-aware ROC-AUC (Mann–Whitney)."""
    return tidy(ev.roc_auc(scores(spark, sf), "y", "s"))


@register("threshold_metrics", """
WITH sc AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END AS p FROM lineitem),
c AS (SELECT count_if(p = 1 AND y = 1) AS tp, count_if(p = 1 AND y = 0) AS fp, count_if(p = 0 AND y = 1) AS fn, count_if(p = 0 AND y = 0) AS tn FROM sc)
SELECT tp, fp, fn, tn, 0.05 AS threshold, round(coalesce(tp * 1.0 / nullif(tp + fp, 0), 0), 9) AS precision,
       round(coalesce(tp * 1.0 / nullif(tp + fn, 0), 0), 9) AS recall,
       round(CASE WHEN coalesce(tp * 1.0 / nullif(tp + fp, 0), 0) + coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) > 0
             THEN 2 * coalesce(tp * 1.0 / nullif(tp + fp, 0), 0) * coalesce(tp * 1.0 / nullif(tp + fn, 0), 0)
                  / (coalesce(tp * 1.0 / nullif(tp + fp, 0), 0) + coalesce(tp * 1.0 / nullif(tp + fn, 0), 0)) ELSE 0 END, 9) AS f1,
       round((coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) + coalesce(tn * 1.0 / nullif(tn + fp, 0), 0)) / 2, 9) AS balanced_accuracy FROM c""")
def q_threshold_metrics(spark, sf):
    """Q06: confusion-based metrics at threshold 0.05."""
    return tidy(ev.threshold_metrics(scores(spark, sf), "y", "s", 0.05))


@register("threshold_policy", SCORES_SQL + """
SELECT * FROM (SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, round(precision, 9) AS precision, round(recall, 9) AS recall,
                      round(f1, 9) AS f1, 'max_f1' AS policy FROM tt ORDER BY f1 DESC, threshold LIMIT 1)
UNION ALL
SELECT * FROM (SELECT threshold, tp::BIGINT, fp::BIGINT, round(precision, 9), round(recall, 9), round(f1, 9), 'recall_at_least_70pct'
               FROM tt WHERE recall >= 0.7 ORDER BY precision DESC, threshold DESC LIMIT 1)""")
def q_threshold_policy(spark, sf):
    """Q08: max-F1 and recall ≥ 70% threshold choices."""
    return tidy(ev.threshold_policy(ev.threshold_table(scores(spark, sf), "y", "s")))


@register("confusion_matrix", """
SELECT CASE WHEN s >= 0.05 AND y = 1 THEN 'TP' WHEN s < 0.05 AND y = 0 THEN 'TN' WHEN s >= 0.05 AND y = 0 THEN 'FP' ELSE 'FN' END AS outcome,
       count(*) AS n FROM (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_discount AS s FROM lineitem) GROUP BY 1""")
def q_confusion(spark, sf):
    """Q09: TP/TN/FP/FN tags and counts."""
    return ev.confusion_matrix(scores(spark, sf), "y", "s", 0.05)


QBINS_SQL = """
WITH sc AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_extendedprice / 110000.0 AS s FROM lineitem),
e AS (SELECT list_sort(list_distinct(quantile_cont(s, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]))) AS e FROM sc),
b AS (SELECT y, s, len(list_filter(e[2:len(e) - 1], lambda v: v < s)) AS bin FROM sc, e)
"""


def prob_scores(spark, sf):
    """Line-level label with a continuous score in [0, 1]."""
    return table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"),
                                               (F.col("l_extendedprice") / 110000.0).alias("s"))


@register("calibration_curve", QBINS_SQL + """
SELECT bin, count(*) AS n, round(avg(s), 9) AS mean_predicted, round(avg(y), 9) AS observed_rate FROM b GROUP BY 1""")
def q_calibration(spark, sf):
    """Q10: decile bins of probability, mean predicted vs observed."""
    return tidy(ev.calibration_curve(prob_scores(spark, sf), "y", "s"))


@register("decile_lift", QBINS_SQL + """
SELECT (SELECT max(bin) FROM b) - bin + 1 AS decile, count(*) AS n, sum(y)::BIGINT AS positives, round(avg(y), 9) AS rate,
       round(min(s), 9) AS min_score, round(max(s), 9) AS max_score, round(avg(y) / (SELECT avg(y) FROM sc), 9) AS lift FROM b GROUP BY bin""")
def q_decile_lift(spark, sf):
    """Q11: deciles of score with rate and lift (decile 1 = top scores)."""
    return tidy(ev.decile_lift(prob_scores(spark, sf), "y", "s"))


@register("probability_diagnostics", """
SELECT round(min(s), 9) AS min, round(quantile_cont(s, 0.5), 9) AS median, round(quantile_cont(s, 0.95), 9) AS p95, round(max(s), 9) AS max,
       count_if(s >= 0.5) AS n_pos_at_0_5, round(avg(CASE WHEN s >= 0.3 THEN 1.0 ELSE 0.0 END), 9) AS positive_rate_at_threshold
FROM (SELECT l_extendedprice / 110000.0 AS s FROM lineitem)""")
def q_probability_diagnostics(spark, sf):
    """Q19: probability distribution and positive rate at a threshold."""
    return tidy(ev.probability_diagnostics(prob_scores(spark, sf), "s", 0.3))


def detail(spark, sf):
    """Daily revenue: model = same weekday last week, baseline = yesterday."""
    d = dense_daily(spark, sf).select("sale_date", F.col("revenue").alias("y"))
    d = d.withColumn("model", ts.lag_col("y", 7, "sale_date")).withColumn("baseline", ts.lag_col("y", 1, "sale_date"))
    return ev.error_detail(d, "sale_date", "y", "model", "baseline")


DETAIL_SQL = DENSE_SQL + """,
p AS (SELECT sale_date, revenue AS y, lag(revenue, 7) OVER (ORDER BY sale_date) AS model, lag(revenue, 1) OVER (ORDER BY sale_date) AS baseline FROM dd),
det AS (SELECT sale_date, y, model, baseline, model - y AS error, abs(model - y) AS abs_error, baseline - y AS baseline_error,
               abs(baseline - y) AS baseline_abs_error, CAST(abs(model - y) < abs(baseline - y) AS INTEGER) AS model_wins,
               strftime(sale_date, '%Y-%m') AS month, isodow(sale_date) - 1 AS weekday FROM p)
"""


def _grp_sql(key, extra=""):
    return f"""SELECT {key}, count(error) AS n, round(avg(abs_error), 6) AS mae, round(sqrt(avg(error * error)), 4) AS rmse,
       round(sum(abs_error) / sum(CASE WHEN error IS NOT NULL THEN abs(y) END), 9) AS wape, round(avg(error), 6) AS mean_error,
       round(avg(model_wins), 9) AS win_rate{extra} FROM det GROUP BY {key}"""


@register("regression_metrics", DETAIL_SQL + """
SELECT 'same_weekday' AS model_name, count(error) AS n, round(avg(abs_error), 6) AS mae, round(sqrt(avg(error * error)), 4) AS rmse,
       round(sum(abs_error) / sum(CASE WHEN error IS NOT NULL THEN abs(y) END), 9) AS wape,
       round(avg(abs_error / nullif(y, 0)) * 100, 9) AS mape FROM det
UNION ALL
SELECT 'yesterday', count(baseline_error), round(avg(baseline_abs_error), 6), round(sqrt(avg(baseline_error * baseline_error)), 4),
       round(sum(baseline_abs_error) / sum(CASE WHEN baseline_error IS NOT NULL THEN abs(y) END), 9),
       round(avg(baseline_abs_error / nullif(y, 0)) * 100, 9) FROM det""")
def q_regression_metrics(spark, sf):
    """Q01 + Q02: MAE, RMSE, WAPE, MAPE for two naive forecasts."""
    d = detail(spark, sf)
    a = ev.regression_metrics(d, "y", "model").withColumn("model_name", F.lit("same_weekday"))
    a = a.select("*", d.select(ev.mape("y", "model")).scalar().alias("mape"))
    b = ev.regression_metrics(d, "y", "baseline").withColumn("model_name", F.lit("yesterday")).select(
        "*", d.select(ev.mape("y", "baseline")).scalar().alias("mape"))
    return tidy(a.unionByName(b), 9, {"mae": 6, "rmse": 4})


@register("extended_regression_metrics", DETAIL_SQL + """
SELECT count_if(model < 0) AS n_negative_pred, round(avg(model), 6) AS mean_pred, round(avg(y), 6) AS mean_actual,
       round(stddev_samp(model), 4) AS std_pred, round(stddev_samp(y), 4) AS std_actual, round(avg(model) / avg(y), 9) AS mean_ratio,
       round(stddev_samp(model) / stddev_samp(y), 9) AS std_ratio FROM det""")
def q_extended_regression(spark, sf):
    """Q03: prediction vs actual level and spread."""
    return tidy(ev.extended_regression_metrics(detail(spark, sf), "y", "model"), 9,
                {"mean_pred": 6, "mean_actual": 6, "std_pred": 4, "std_actual": 4})


@register("error_by_period", DETAIL_SQL + _grp_sql("month"))
def q_error_by_period(spark, sf):
    """Q12 + Q13: per-month MAE, RMSE, WAPE, bias, win rate."""
    return tidy(ev.error_by_group(detail(spark, sf), "month"), 9, {"mae": 6, "rmse": 4, "mean_error": 6})


@register("error_by_weekday", DETAIL_SQL + _grp_sql("weekday", ", ['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'][weekday + 1] AS weekday_name"))
def q_error_by_weekday(spark, sf):
    """Q14: per weekday in fixed order."""
    return tidy(ev.error_by_weekday(detail(spark, sf)), 9, {"mae": 6, "rmse": 4, "mean_error": 6})


@register("error_by_value_group", DETAIL_SQL + """,
e AS (SELECT list_sort(list_distinct(quantile_cont(y, [0, 1 / 3, 2 / 3, 1]))) AS e FROM det WHERE y IS NOT NULL),
det2 AS (SELECT det.*, len(list_filter(e[2:len(e) - 1], lambda v: v < y)) AS value_group FROM det, e WHERE y IS NOT NULL)
SELECT value_group, count(error) AS n, round(avg(abs_error), 6) AS mae, round(sqrt(avg(error * error)), 4) AS rmse,
       round(sum(abs_error) / sum(CASE WHEN error IS NOT NULL THEN abs(y) END), 9) AS wape, round(avg(error), 6) AS mean_error,
       round(avg(model_wins), 9) AS win_rate FROM det2 GROUP BY 1""")
def q_error_by_value_group(spark, sf):
    """Q15: per tercile of the actual value."""
    return tidy(ev.error_by_value_group(detail(spark, sf)), 9, {"mae": 6, "rmse": 4, "mean_error": 6})


@register("error_summary_worst", DETAIL_SQL + """
SELECT round(avg(abs_error), 6) AS mean_abs_error, round(quantile_cont(abs_error, 0.5), 6) AS median_abs_error,
       round(max(abs_error), 4) AS max_abs_error, CAST(arg_max(sale_date, (abs_error, sale_date)) FILTER (WHERE abs_error IS NOT NULL) AS VARCHAR) AS worst_date FROM det""")
def q_error_summary(spark, sf):
    """Q16: error summary and the worst date."""
    return tidy(ev.error_summary_worst(detail(spark, sf), "sale_date"), 6, {"max_abs_error": 4})


@register("top_error_context", DETAIL_SQL + """
SELECT CAST(det.sale_date AS VARCHAR) AS sale_date, round(abs_error, 4) AS abs_error, round(dd.cogs, 4) AS cogs
FROM (SELECT * FROM det ORDER BY abs_error DESC NULLS LAST, sale_date LIMIT 20) det LEFT JOIN dd USING (sale_date)""")
def q_top_error_context(spark, sf):
    """Q17: the 20 worst days with their feature values."""
    d = detail(spark, sf)
    feats = dense_daily(spark, sf).select("sale_date", "cogs")
    return tidy(ev.top_error_context(d, feats, "sale_date", 20).select("sale_date", "abs_error", "cogs"), 4)


@register("model_vs_model", DETAIL_SQL + """
SELECT year(sale_date) AS year, round(avg(abs_error), 6) AS model_mae, round(avg(baseline_abs_error), 6) AS baseline_mae,
       round(avg(model_wins), 9) AS win_rate FROM det WHERE error IS NOT NULL AND baseline_error IS NOT NULL GROUP BY 1""")
def q_model_vs_model(spark, sf):
    """Q18: paired comparison of two forecasts by year."""
    d = detail(spark, sf).filter(F.col("error").isNotNull() & F.col("baseline_error").isNotNull())
    return tidy(d.groupBy(F.year("sale_date").alias("year")).agg(
        F.avg("abs_error").alias("model_mae"), F.avg("baseline_abs_error").alias("baseline_mae"), F.avg("model_wins").alias("win_rate")),
        6, {"win_rate": 9})


@register("fold_stability", DETAIL_SQL + """,
f AS (SELECT 'same_weekday' AS model, year(sale_date) AS fold, sum(abs_error) / sum(abs(y)) AS wape FROM det WHERE error IS NOT NULL GROUP BY 1, 2
      UNION ALL SELECT 'yesterday', year(sale_date), sum(baseline_abs_error) / sum(abs(y)) FROM det WHERE baseline_error IS NOT NULL GROUP BY 1, 2)
SELECT model, round(avg(wape), 9) AS mean_wape, round(stddev_samp(wape), 9) AS std_wape, count(wape) AS n_folds FROM f GROUP BY 1""")
def q_fold_stability(spark, sf):
    """Q20: mean and std of a per-fold (year) metric per model."""
    d = detail(spark, sf)
    a = ev.regression_metrics(d.withColumn("fold", F.year("sale_date")), "y", "model", ["fold"]).withColumn("model", F.lit("same_weekday"))
    b = ev.regression_metrics(d.withColumn("fold", F.year("sale_date")), "y", "baseline", ["fold"]).withColumn("model", F.lit("yesterday"))
    return tidy(ev.fold_stability(a.unionByName(b), "model", "wape"))
