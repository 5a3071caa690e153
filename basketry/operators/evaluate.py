"""Evaluation and error analysis (§2.17).

Ranking metrics (AP, ROC-AUC, threshold table) work on the table of
*distinct scores* (positives and negatives per score — ties share a row)
and a distributed prefix sum over it, so they are exact and tie-aware
(sklearn semantics) without a global sort of the scored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.primitives import column_quantiles, prefix_sum
from basketry.operators.binning import qcut
from basketry.session import cut_lineage


def regression_metrics(df: DataFrame, y: str, yhat: str, group_by=()) -> DataFrame:
    """Q01: MAE, RMSE, WAPE = Σ|e| / Σ|y| (NULL when Σ|y| = 0), n."""
    e = F.col(yhat) - F.col(y)
    return df.groupBy(*group_by).agg(
        F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        F.try_divide(F.sum(F.when(e.isNotNull(), F.abs(e))), F.sum(F.when(e.isNotNull(), F.abs(F.col(y))))).alias("wape"))


def mape(y: str, yhat: str) -> Column:
    """Q02: mean |e| / y · 100 over rows with y ≠ 0."""
    return F.avg(F.try_divide(F.abs(F.col(yhat) - F.col(y)), F.nullif(F.col(y), F.lit(0)))) * 100.0


def extended_regression_metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """Q03: negative predictions, mean/std of predictions and actuals and
    their ratios."""
    return df.agg(F.count_if(F.col(yhat) < 0).alias("n_negative_pred"), F.avg(yhat).alias("mean_pred"),
                  F.avg(y).alias("mean_actual"), F.stddev_samp(yhat).alias("std_pred"), F.stddev_samp(y).alias("std_actual")) \
        .withColumn("mean_ratio", F.try_divide(F.col("mean_pred"), F.col("mean_actual"))) \
        .withColumn("std_ratio", F.try_divide(F.col("std_pred"), F.col("std_actual")))


def score_groups(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives / negatives per distinct score (rows with NULL score or
    label are not scored)."""
    d = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return d.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg"))


def threshold_table(df: DataFrame, label: str, score: str) -> DataFrame:
    """Q07: for each distinct score t (predict 1 when score ≥ t): TP, FP,
    precision, recall, F1 — precision_recall_curve semantics."""
    g = score_groups(df, label, score)
    ps = prefix_sum(g, "score", ["pos", "neg"], descending=True, inclusive=True)
    total_pos = g.select(F.sum("pos")).scalar()
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    prec = F.try_divide(tp * 1.0, tp + fp)
    rec = F.try_divide(tp * 1.0, total_pos)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return ps.select(F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"), prec.alias("precision"),
                     F.coalesce(rec, F.lit(0.0)).alias("recall"), f1.alias("f1"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Q04: AP = Σ_t (R_t − R_{t−1})·P_t over distinct scores (sklearn
    ``average_precision_score``; not MLlib's interpolated areaUnderPR)."""
    g = score_groups(df, label, score)
    ps = prefix_sum(g, "score", ["pos", "neg"], descending=True, inclusive=True)
    prec = F.try_divide(F.col("cum_pos") * 1.0, F.col("cum_pos") + F.col("cum_neg"))
    # R_t − R_{t−1} = positives at exactly this score / all positives, so
    # AP = Σ pos_t · P_t / Σ pos_t — one aggregate over the score table.
    return ps.agg(F.try_divide(F.sum(F.col("pos") * prec), F.sum("pos").cast("double")).alias("average_precision"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Q05: tie-aware ROC-AUC (Mann–Whitney): for each score, positives ×
    (negatives strictly below + ½ negatives tied), over P·N."""
    g = score_groups(df, label, score)
    ps = prefix_sum(g, "score", ["neg"], inclusive=False)
    u = ps.agg(F.sum(F.col("pos") * (F.col("cum_neg") + 0.5 * F.col("neg"))).alias("u"),
               F.sum("pos").cast("double").alias("P"), F.sum("neg").cast("double").alias("N"))
    return u.select(F.try_divide(F.col("u"), F.col("P") * F.col("N")).alias("roc_auc"))


def ranking_metrics(df: DataFrame, label: str, score: str, group_by=(), n: str | None = None, once: bool = False) -> DataFrame:
    """Q04 + Q05 of every group at once (trials and folds of a search): rows,
    positives, AP and ROC-AUC from one running sum over each group's distinct scores.
    A row stands for ``n`` rows; ``once`` checkpoints the counts per score, which are
    read for edges, totals and sums, so that scores are made once."""
    keys = [group_by] if isinstance(group_by, str) else list(group_by)
    times = F.col(n) if n else F.lit(1)
    d = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    g = d.groupBy(*keys, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long") * times).alias("pos"), F.sum((1 - F.col(label)).cast("long") * times).alias("neg"))
    g = cut_lineage(g) if once else g
    ps = prefix_sum(g, "score", ["pos", "neg"], descending=True, inclusive=True, partition_by=keys, few_groups=True)
    prec = F.try_divide(F.col("cum_pos") * 1.0, F.col("cum_pos") + F.col("cum_neg"))
    n_pos, n_neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    # negatives at or above a score count as lost, half of those tied are given back
    lost = F.sum(F.col("pos") * (F.col("cum_neg") - 0.5 * F.col("neg")))
    return ps.groupBy(*keys).agg(F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("n_positive"),
                                 F.try_divide(F.sum(F.col("pos") * prec), n_pos).alias("pr_auc"),
                                 (F.lit(1.0) - F.try_divide(lost, n_pos * n_neg)).alias("roc_auc"))


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Q06: precision, recall, F1, balanced accuracy at a threshold; zero
    division → 0."""
    pred = (F.col(score) >= threshold).cast("int")
    y = F.col(label)
    c = df.filter(y.isNotNull() & F.col(score).isNotNull()).agg(
        F.count_if((pred == 1) & (y == 1)).alias("tp"), F.count_if((pred == 1) & (y == 0)).alias("fp"),
        F.count_if((pred == 0) & (y == 1)).alias("fn"), F.count_if((pred == 0) & (y == 0)).alias("tn"))
    z = F.lit(0.0)
    prec = F.coalesce(F.try_divide(F.col("tp") * 1.0, F.col("tp") + F.col("fp")), z)
    rec = F.coalesce(F.try_divide(F.col("tp") * 1.0, F.col("tp") + F.col("fn")), z)
    spec = F.coalesce(F.try_divide(F.col("tn") * 1.0, F.col("tn") + F.col("fp")), z)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(z)
    return c.select("tp", "fp", "fn", "tn", F.lit(float(threshold)).alias("threshold"), prec.alias("precision"),
                    rec.alias("recall"), f1.alias("f1"), ((rec + spec) / 2).alias("balanced_accuracy"))


def threshold_policy(table: DataFrame, min_recall: float = 0.70) -> DataFrame:
    """Q08: ``max_f1`` (the lowest threshold among equal F1) and
    ``recall_at_least`` (best precision among recall ≥ min_recall, then the
    highest threshold; falls back to the max-recall row)."""
    best = table.orderBy(F.desc("f1"), F.asc("threshold")).limit(1).withColumn("policy", F.lit("max_f1"))
    cand = table.filter(F.col("recall") >= min_recall)
    fallback = table.orderBy(F.desc("recall"), F.asc("threshold")).limit(1)
    has = cand.limit(1).count() > 0
    rec = cand.orderBy(F.desc("precision"), F.desc("threshold")).limit(1)
    pick = rec if has else fallback
    return best.unionByName(pick.withColumn("policy", F.lit(f"recall_at_least_{int(min_recall * 100)}pct")))


def confusion_rows(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    """Q09: TP/TN/FP/FN tag per row."""
    pred = F.col(score) >= threshold
    y = F.col(label) == 1
    tag = F.when(pred & y, "TP").when(~pred & ~y, "TN").when(pred & ~y, "FP").when(~pred & y, "FN")
    return df.withColumn("outcome", tag)


def confusion_matrix(df: DataFrame, label: str, score: str, threshold: float) -> DataFrame:
    return confusion_rows(df, label, score, threshold).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def calibration_curve(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Q10: quantile bins of the probability; mean predicted vs observed."""
    b = qcut(df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()), score, bins, "bin")
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_predicted"),
                                F.avg(label).alias("observed_rate"))


def decile_lift(df: DataFrame, label: str, score: str, q: int = 10) -> DataFrame:
    """Q11: qcut deciles of score (highest decile = 1): n, positives, rate,
    min/max score and lift over the base rate."""
    from pyspark.sql import Window
    from basketry.operators.binning import quantile_edges, with_edges
    d = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    edges = quantile_edges(d, score, q)                      # literal array (fitted once)
    b = with_edges(d, edges, score, "_bin")
    g = b.groupBy("_bin").agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("positives"), F.avg(label).alias("rate"),
                              F.min(score).alias("min_score"), F.max(score).alias("max_score"))
    # ≤ q rows: the base rate and the top bin come from this tiny table
    whole = Window.partitionBy()
    base = F.sum("positives").over(whole) / F.sum("n").over(whole)
    return g.select((F.max("_bin").over(whole) - F.col("_bin") + 1).alias("decile"), "n", "positives", "rate", "min_score",
                    "max_score", F.try_divide(F.col("rate"), base).alias("lift"))


def error_detail(df: DataFrame, date_col: str, y: str, model: str, baseline: str) -> DataFrame:
    """Q12: signed/absolute errors of model and baseline, win flag, month,
    weekday."""
    return df.select(date_col, y, model, baseline, (F.col(model) - F.col(y)).alias("error"),
                     F.abs(F.col(model) - F.col(y)).alias("abs_error"), (F.col(baseline) - F.col(y)).alias("baseline_error"),
                     F.abs(F.col(baseline) - F.col(y)).alias("baseline_abs_error"),
                     (F.abs(F.col(model) - F.col(y)) < F.abs(F.col(baseline) - F.col(y))).cast("int").alias("model_wins"),
                     F.date_format(date_col, "yyyy-MM").alias("month"), F.weekday(date_col).alias("weekday"))


def error_by_group(detail: DataFrame, keys, y: str = "y") -> DataFrame:
    """Q13 / Q14 / Q15 / Q18: per group MAE, RMSE, WAPE (ratio of sums),
    mean error and model win rate."""
    k = [keys] if isinstance(keys, (str, Column)) else list(keys)
    return detail.groupBy(*k).agg(
        F.count("error").alias("n"), F.avg("abs_error").alias("mae"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.try_divide(F.sum("abs_error"), F.sum(F.when(F.col("error").isNotNull(), F.abs(F.col(y))))).alias("wape"),
        F.avg("error").alias("mean_error"), F.avg("model_wins").alias("win_rate"))


# Weekday names in Monday-first order.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def error_by_weekday(detail: DataFrame, y: str = "y") -> DataFrame:
    """Q14: per weekday in fixed Monday→Sunday order (names attached)."""
    g = error_by_group(detail, "weekday", y)
    return g.withColumn("weekday_name", F.element_at(F.array(*[F.lit(w) for w in WEEKDAYS]), F.col("weekday") + 1))


def error_by_value_group(detail: DataFrame, y: str = "y", q: int = 3) -> DataFrame:
    """Q15: per tercile of the actual value."""
    return error_by_group(qcut(detail.filter(F.col(y).isNotNull()), y, q, "value_group"), "value_group", y)


def error_summary_worst(detail: DataFrame, date_col: str, err: str = "abs_error") -> DataFrame:
    """Q16: mean / median / max absolute error and the worst date."""
    median = F.lit(column_quantiles(detail, err, [0.5])[err][0]).cast("double")
    return detail.agg(F.avg(err).alias("mean_abs_error"), median.alias("median_abs_error"),
                      F.max(err).alias("max_abs_error"), F.max_by(date_col, F.when(F.col(err).isNotNull(), F.struct(F.col(err), F.col(date_col)))).alias("worst_date"))


def top_error_context(detail: DataFrame, features: DataFrame, date_col: str, k: int = 20) -> DataFrame:
    """Q17: the k worst days joined to their feature values."""
    worst = detail.orderBy(F.desc_nulls_last("abs_error"), F.asc(date_col)).limit(k)
    return worst.join(features, date_col, "left")


def probability_diagnostics(df: DataFrame, score: str, threshold: float) -> DataFrame:
    """Q19: min, median, p95, max, positives at 0.5 and positive rate at the
    chosen threshold."""
    q = [F.lit(v).cast("double") for v in column_quantiles(df, score, [0.5, 0.95])[score]]
    return df.agg(F.min(score).cast("double").alias("min"), q[0].alias("median"), q[1].alias("p95"),
                  F.max(score).cast("double").alias("max"), F.count_if(F.col(score) >= 0.5).alias("n_pos_at_0_5"),
                  F.avg((F.col(score) >= threshold).cast("double")).alias("positive_rate_at_threshold"))


def fold_stability(metrics: DataFrame, model: str, metric: str) -> DataFrame:
    """Q20: mean and sample std of a fold metric per model."""
    return metrics.groupBy(model).agg(F.avg(metric).alias(f"mean_{metric}"), F.stddev_samp(metric).alias(f"std_{metric}"),
                                      F.count(metric).alias("n_folds"))
