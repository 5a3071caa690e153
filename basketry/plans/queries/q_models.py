"""Queries for §2.16 models. Fitted classifiers and searches return facts that
SQL can state (row counts of the split, ranges, consistency); closed forms are
checked against numpy in the tests."""

import json
from functools import reduce

from pyspark.sql import functions as F

from basketry.operators import batchfit as bf
from basketry.operators import evaluate as ev
from basketry.operators import models as md
from basketry.operators import splits
from basketry.operators.preprocess import Preprocessor, class_weight
from basketry.plans import features as ft
from basketry.plans.catalog import register, tidy
from basketry.plans.queries.q_features import master, spec
from basketry.plans.queries.q_timeseries import DENSE_SQL, dense_daily
from basketry.session import cut_lineage
from basketry.sources import retail

REG_FEATS = ["revenue_lag_1d", "revenue_lag_7d", "revenue_rolling_7d_mean"]


def daily_model_frame(spark, sf):
    d = ft.daily_target_table(ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf)), "sale_date", "revenue", "cogs",
                              lags=(1, 7), windows=(7,))
    return d.withColumn("is_train", F.col("sale_date") < F.lit("2000-01-01").cast("date")).na.drop(subset=REG_FEATS + ["revenue"])


@register("seasonal_trend_forecast", DENSE_SQL + """,
h AS (SELECT sale_date, revenue FROM daily WHERE sale_date < DATE '2001-01-01'),
fs AS (SELECT min(sale_date) AS a, max(sale_date) AS z FROM daily WHERE sale_date >= DATE '2001-01-01'),
fu AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM fs),
y AS (SELECT year(sale_date) AS yr, sum(revenue) AS total, min(sale_date) AS a, max(sale_date) AS b FROM h GROUP BY 1),
cy AS (SELECT * FROM y WHERE month(a) = 1 AND day(a) = 1 AND month(b) = 12 AND day(b) = 31),
g AS (SELECT total / lag(total) OVER (ORDER BY yr) AS r FROM cy), gr AS (SELECT coalesce(exp(avg(ln(r))), 1.0) AS growth FROM g),
lv AS (SELECT max(year(sale_date)) AS ly FROM h), le AS (SELECT avg(revenue) AS level FROM h, lv WHERE year(sale_date) = ly),
nm AS (SELECT sale_date, revenue / avg(revenue) OVER (PARTITION BY year(sale_date)) AS f FROM h),
pr AS (SELECT month(sale_date) AS m, day(sale_date) AS dd_, avg(f) AS f FROM nm GROUP BY 1, 2)
SELECT CAST(d AS VARCHAR) AS sale_date, round(level * pow(growth, year(d) - ly) * coalesce(f, 1.0), 2) AS forecast
FROM fu LEFT JOIN pr ON m = month(d) AND dd_ = day(d), gr, lv, le""")
def q_seasonal_trend(spark, sf):
    """Level × growth^(years ahead) × seasonal factor for the year after
    the history."""
    t = ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    hist = t.filter(F.col("sale_date") < F.lit("2001-01-01").cast("date"))
    fut = ts_spine(t.filter(F.col("sale_date") >= F.lit("2001-01-01").cast("date")))
    return tidy(md.seasonal_trend_forecast(hist, "sale_date", "revenue", fut, "sale_date"), 2)


def ts_spine(df):
    from basketry.operators.timeseries import daily_spine
    return daily_spine(df, "sale_date")


@register("naive_baselines", DENSE_SQL + """
SELECT CAST(a.sale_date AS VARCHAR) AS sale_date, round(a.revenue, 4) AS revenue,
       round((SELECT avg(revenue) FROM dd WHERE sale_date < DATE '2000-01-01'), 7) AS pred_mean,
       round(lag(a.revenue) OVER (ORDER BY a.sale_date), 4) AS pred_yesterday, round(b.revenue, 4) AS pred_same_weekday
FROM dd a LEFT JOIN dd b ON b.sale_date + 7 = a.sale_date""")
def q_naive_baselines(spark, sf):
    """Train mean, yesterday, same weekday last week."""
    d = dense_daily(spark, sf).select("sale_date", "revenue")
    return tidy(md.naive_forecasts(d, "sale_date", "revenue", "2000-01-01"), 4, {"pred_mean": 7})


REG_SQL = DENSE_SQL + """,
x AS (SELECT sale_date, revenue, lag(revenue, 1) OVER w AS a, lag(revenue, 7) OVER w AS b,
             avg(revenue) OVER (ORDER BY sale_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS c FROM dd WINDOW w AS (ORDER BY sale_date)),
d AS (SELECT CASE WHEN sale_date < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM x
      WHERE revenue IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL)
"""


def _reg_facts(pred, name, penalty=()):
    """Per split the rows and that the absolute error is below the total; on
    train the normal equations: residuals sum to zero and are orthogonal to
    each feature up to the ridge ``penalty`` (α times its coefficient)."""
    res = F.col("revenue") - F.col("prediction")
    scale = F.sum(F.abs(F.col("revenue")))
    aggs = [(F.abs(F.sum(res)) / scale < 1e-7).alias("_e0")]
    for i, f in enumerate(REG_FEATS):
        off = F.sum(res * F.col(f)) - F.lit(float(penalty[i]) if penalty else 0.0)
        aggs.append((F.abs(off) / F.sum(F.abs(F.col("revenue") * F.col(f))) < 1e-7).alias(f"_e{i + 1}"))
    g = pred.groupBy(F.when(F.col("is_train"), "train").otherwise("test").alias("split")).agg(
        F.count(F.lit(1)).alias("n"), (F.sum(F.abs(res)) < scale).alias("error_below_total"), *aggs)
    holds = reduce(lambda a, b: a & b, [F.col(f"_e{i}") for i in range(len(REG_FEATS) + 1)])
    return g.select(F.lit(name).alias("model"), "split", "n", "error_below_total",
                    F.when(F.col("split") == "train", holds).alias("normal_equations_hold"))


def _reg_facts_sql(name):
    return REG_SQL + f"""SELECT '{name}' AS model, split, count(*) AS n, true AS error_below_total,
       CASE WHEN split = 'train' THEN true END AS normal_equations_hold FROM d GROUP BY split"""


@register("ridge_closed_form", _reg_facts_sql("ridge_alpha_10"))
def q_ridge(spark, sf):
    """Closed-form ridge (α = 10) from one Gram aggregate; facts of the
    fit (the penalised normal equations hold on train)."""
    d = daily_model_frame(spark, sf)
    m = md.ridge_closed_form(d.filter("is_train"), REG_FEATS, "revenue", alpha=10.0)
    return _reg_facts(m.predict(d), "ridge_alpha_10", [10.0 * w for w in m.coef])


@register("linear_regression", _reg_facts_sql("linear"))
def q_linear(spark, sf):
    """MLlib OLS on the same features; facts of the fit (the normal
    equations hold on train)."""
    d = daily_model_frame(spark, sf)
    m = md.linear_regression(d.filter("is_train"), REG_FEATS, "revenue")
    return _reg_facts(m.transform(md.assemble(d, REG_FEATS)), "linear")


@register("gbt_regressor", REG_SQL + "SELECT 'gbt' AS model, split, count(*) AS n, true AS error_below_total FROM d GROUP BY split")
def q_gbt_regressor(spark, sf):
    """Boosted trees with early stopping on the last training year; facts
    of the predictions."""
    d = daily_model_frame(spark, sf).withColumn("is_valid", F.year("sale_date") == 1999)
    m = md.gbt_regressor(d.filter("is_train"), REG_FEATS, "revenue", valid_col="is_valid", maxIter=30, maxDepth=4)
    return _reg_facts(m.transform(md.assemble(d, REG_FEATS)), "gbt").drop("normal_equations_hold")


NUMERIC = ["customer_tenure_days", "total_quantity", "unique_product_count", "discount_ratio", "log_payment_value"]


KEEP = ["order_id", "order_date", "data_split", "label"]


def labelled_frame(spark, sf):
    """Labelled order features with date and positional split (nothing
    fitted yet; lineage cut, every later statistic scans the checkpoint) and
    a maker of unfitted preprocessors."""
    features = spec(spark, sf)
    feats = ft.serving_features(master(spark, sf), features).filter(F.col("label").isNotNull())
    feats = feats.join(retail.orders(spark, sf).select("order_id", "order_date"), "order_id")
    frame = splits.positional_cutoff_split(cut_lineage(feats), "order_date")  # the cut dates read the checkpoint, too
    return frame, lambda: Preprocessor(numeric=NUMERIC, binary=features.binary(), categorical=features.categorical_all())


def part(frame, *names):
    return frame.filter(F.col("data_split").isin(*names))


def classification_frame(spark, sf):
    """(train, validation, columns): preprocessing and class weights fitted on
    the train part."""
    frame, pre = labelled_frame(spark, sf)
    train, (validation,), columns = md.prepare(part(frame, "train"), [part(frame, "validation")], pre(), "label", KEEP)
    return train, validation, columns


def scored_facts(scored, name):
    """What must hold of scores on rows that were not fitted on: how many rows
    and positives, all scores and both ranking metrics in [0, 1]. (Labels of
    the test tables carry no signal, so metrics have no expected value.)"""
    ap = ev.average_precision(scored, "label", "probability_1").first()["average_precision"]
    roc = ev.roc_auc(scored, "label", "probability_1").first()["roc_auc"]
    return scored.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_scored"), F.sum("label").cast("long").alias("n_positive"),
                      F.coalesce(F.min(F.col("probability_1").between(0, 1)), F.lit(False)).alias("in_unit_interval"),
                      F.lit(0 <= ap <= 1 and 0 <= roc <= 1).alias("metrics_in_unit_interval"))


SPLIT_SQL = """
WITH lab AS (SELECT CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS label
             FROM orders WHERE o_orderstatus IN ('F', 'P')),
dc AS (SELECT d, sum(count(*)) OVER (ORDER BY d) AS cum FROM lab GROUP BY d), nn AS (SELECT count(*) AS n FROM lab),
cut AS (SELECT min(CASE WHEN cum > floor(n * 0.7) THEN d END) AS c1, min(CASE WHEN cum > floor(n * 0.85) THEN d END) AS c2 FROM dc, nn)
"""


def facts_sql(name, where, more=""):
    return SPLIT_SQL + f"""SELECT '{name}' AS model, count(*) AS n_scored, CAST(sum(label) AS BIGINT) AS n_positive, true AS in_unit_interval,
       true AS metrics_in_unit_interval{more} FROM lab, cut WHERE {where}"""


def _cls_eval(model, validation, feats, name):
    p = md.positive_probability(model.transform(md.assemble(validation, feats)))
    return scored_facts(p, name)


@register("logistic_regression", facts_sql("logistic", "d >= c1 AND d < c2"))
def q_logistic(spark, sf):
    """Class-weighted logistic regression fitted on train; facts of its
    validation scores."""
    train, valid, feats = classification_frame(spark, sf)
    return _cls_eval(md.logistic_regression(train, feats, "label", "weight", maxIter=50), valid, feats, "logistic")


@register("random_forest", facts_sql("random_forest", "d >= c1 AND d < c2"))
def q_random_forest(spark, sf):
    """Class-weighted random forest (√k features per split); facts of
    its validation scores."""
    train, valid, feats = classification_frame(spark, sf)
    return _cls_eval(md.random_forest(train, feats, "label", "weight", numTrees=30, maxDepth=6), valid, feats, "random_forest")


@register("gbt_classifier", facts_sql("gbt", "d >= c1 AND d < c2"))
def q_gbt_classifier(spark, sf):
    """Boosted-tree classifier; facts of its validation scores."""
    train, valid, feats = classification_frame(spark, sf)
    return _cls_eval(md.gbt_classifier(train, feats, "label", "weight", maxIter=20, maxDepth=3), valid, feats, "gbt")


GRID = {"regParam": [0.0, 0.1], "maxIter": [30]}


def _folds(frame, pre):
    tr = part(frame, "train")
    return md.prepared_folds(tr, splits.expanding_folds(tr, "order_date"), "order_date", pre, "label", KEEP)


def search_facts(results):
    """Facts of a search: candidates, fits, metrics in [0, 1], and a ranking
    whose first has the greatest mean."""
    ranked = md.champion_selection(results)
    best = ranked.filter("rank = 1").select("mean_pr_auc").scalar()
    fits = results.agg(F.count(F.lit(1)).alias("n_fits"), F.min(F.col("pr_auc").between(0, 1)).alias("metrics_in_unit_interval"))
    return ranked.agg(F.count(F.lit(1)).alias("n_candidates"), F.count_if(F.col("rank") == 1).alias("n_champions"),
                      F.min(best >= F.col("mean_pr_auc")).alias("champion_has_greatest_mean"),
                      F.max(fits.select("n_fits").scalar()).alias("n_fits"),
                      F.max(fits.select("metrics_in_unit_interval").scalar()).alias("metrics_in_unit_interval"))


def search_sql(candidates, folds=3):
    return f"""SELECT {candidates}::BIGINT AS n_candidates, 1::BIGINT AS n_champions, true AS champion_has_greatest_mean,
       ({candidates} * {folds})::BIGINT AS n_fits, count(*) > 0 AS metrics_in_unit_interval FROM orders"""


@register("grid_search_temporal", search_sql(2))
def q_grid_search(spark, sf):
    """P09 + P11 + P12: full grid on three expanding folds, each with
    preprocessing and weights of its own train part, ranked by mean PR-AUC
    then fold std; facts of the results."""
    frame, pre = labelled_frame(spark, sf)
    res = md.temporal_search(_folds(frame, pre), "label", "logistic", md.param_grid(GRID), "weight")
    return search_facts(res)


@register("random_search_temporal", search_sql(4))
def q_random_search(spark, sf):
    """P10: seeded sample of four of a grid's six candidates on the same folds;
    facts of the results."""
    frame, pre = labelled_frame(spark, sf)
    cands = md.sample_grid({"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5], "maxIter": [30]}, 4, seed=7)
    return search_facts(md.temporal_search(_folds(frame, pre), "label", "logistic", cands, "weight"))


@register("final_refit_once", facts_sql("logistic", "d >= c2", ", true AS champion_params"))
def q_final_refit(spark, sf):
    """P09 → P12 → P13: grid search on the train folds, its champion refitted
    once on train + validation, the test split scored once; facts of the
    test scores, fitted with the champion's parameters."""
    frame, pre = labelled_frame(spark, sf)
    res = md.temporal_search(_folds(frame, pre), "label", "logistic", md.param_grid(GRID), "weight")
    best, model, _columns, scored = md.refit_champion(res, part(frame, "train", "validation"), part(frame, "test"), pre(), "label", KEEP)
    used = all(model.getOrDefault(k) == v for k, v in json.loads(best["params"]).items())
    return scored_facts(scored, best["model"]).withColumn("champion_params", F.lit(used))


@register("feature_importance", """
SELECT true AS shares_sum_to_one, true AS ranks_without_gap, true AS none_negative, count(*) > 0 AS has_rows FROM orders""")
def q_feature_importance(spark, sf):
    """Tree importances with share, rank and running share; facts of the
    table."""
    train, _valid, feats = classification_frame(spark, sf)
    t = md.feature_importance(spark, md.gbt_classifier(train, feats, "label", "weight", maxIter=10, maxDepth=3), feats)
    return t.agg((F.abs(F.sum("share") - 1) < 1e-9).alias("shares_sum_to_one"), (F.max("rank") == F.count(F.lit(1))).alias("ranks_without_gap"),
                 F.min(F.col("importance") >= 0).alias("none_negative"), (F.count(F.lit(1)) > 0).alias("has_rows"))


@register("forecast_champion_rule", REG_SQL + """SELECT count_if(split = 'test') AS n_test, true AS rule_followed,
       true AS metrics_present FROM d""")
def q_forecast_champion(spark, sf):
    """P12 (forecast): a candidate replaces the reference forecast only with
    a WAPE gain ≥ 0.003 and a Sunday WAPE that is not worse — ridge vs the
    same-weekday baseline on the test years; facts of the decision."""
    d = daily_model_frame(spark, sf)
    ridge = md.ridge_closed_form(d.filter("is_train"), REG_FEATS, "revenue", alpha=10.0).predict(d)
    test = ridge.filter(~F.col("is_train")).withColumn("is_sunday", F.weekday("sale_date") == 6)

    def wape(pred, cond=F.lit(True)):
        e = F.when(cond, F.abs(F.col(pred) - F.col("revenue")))
        return F.try_divide(F.sum(e), F.sum(F.when(cond & F.col(pred).isNotNull(), F.abs("revenue"))))
    m = test.agg(wape("prediction").alias("candidate_wape"), wape("revenue_lag_7d").alias("reference_wape"),
                 wape("prediction", F.col("is_sunday")).alias("candidate_sunday_wape"),
                 wape("revenue_lag_7d", F.col("is_sunday")).alias("reference_sunday_wape"))
    rule = md.material_gain(F.col("candidate_wape"), F.col("reference_wape"), F.col("candidate_sunday_wape"),
                            F.col("reference_sunday_wape"))
    m = m.withColumn("switch", rule)
    gain = (F.col("reference_wape") - F.col("candidate_wape") >= 0.003) & (F.col("candidate_sunday_wape") <= F.col("reference_sunday_wape"))
    wapes = [F.col(c) for c in ("candidate_wape", "reference_wape", "candidate_sunday_wape", "reference_sunday_wape")]
    return m.select(F.lit(test.count()).alias("n_test"), (F.col("switch") == gain).alias("rule_followed"),
                    reduce(lambda a, b: a & b, [c.isNotNull() & (c > 0) for c in wapes]).alias("metrics_present"))


# ---- fits whose result SQL can state: one 0/1 feature has a closed form, a rule
# ---- of two 0/1 features is learned without error

BIN_SQL = """
WITH lab AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS label,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_cash, CASE WHEN o_totalprice > 150000 THEN 1 ELSE 0 END AS is_large
             FROM orders WHERE o_orderstatus IN ('F', 'P')),
dc AS (SELECT d, sum(count(*)) OVER (ORDER BY d) AS cum FROM lab GROUP BY d), nn AS (SELECT count(*) AS n FROM lab),
cut AS (SELECT min(CASE WHEN cum > floor(n * 0.7) THEN d END) AS c1, min(CASE WHEN cum > floor(n * 0.85) THEN d END) AS c2 FROM dc, nn),
sp AS (SELECT lab.*, CASE WHEN d < c1 THEN 'train' WHEN d < c2 THEN 'validation' ELSE 'test' END AS split FROM lab, cut)
"""


def _closed_form_sql(where):
    """Coefficients of a balanced-weight logistic fit on is_cash: log odds per value."""
    return f"""ct AS (SELECT sum(label) AS p, count(*) - sum(label) AS q, sum(label * is_cash) AS p1, sum((1 - label) * is_cash) AS q1, count(*) AS n FROM sp WHERE {where}),
cf AS (SELECT n, ln(((p - p1) / (q - q1)) * (q / p)) AS b0, ln((p1 / q1) * (q / p)) AS b1 FROM ct)"""


def binary_frame(spark, sf):
    """Labelled orders with two 0/1 features and the positional split."""
    o = retail.orders(spark, sf).filter(F.col("order_status").isin("F", "P"))
    d = o.select("order_id", "order_date", (F.col("order_status") == "P").cast("int").alias("label"),
                 (F.col("priority") == "1-URGENT").cast("int").alias("is_cash"), (F.col("payment_value") > 150000).cast("int").alias("is_large"))
    return cut_lineage(splits.positional_cutoff_split(d, "order_date"))


@register("logistic_closed_form", BIN_SQL + ", " + _closed_form_sql("split = 'train'") + """
SELECT f AS fit, n AS n_train, round(b0, 5) AS intercept, round(b1 - b0, 5) AS coefficient FROM cf, (VALUES ('mllib'), ('batch')) t(f)""")
def q_logistic_closed_form(spark, sf):
    """The class-weighted fit on one 0/1 feature, by MLlib and by the batch
    of Newton steps: its coefficients are log odds."""
    train = class_weight(part(binary_frame(spark, sf), "train"), "label")
    one = md.logistic_regression(train, ["is_cash"], "label", "weight", maxIter=200, tol=1e-14)
    rows, columns = bf.long_folds([(0, train, train, ["is_cash"])], "label", "weight")
    two = bf.batch_logistic(rows, columns, [{"regParam": 0.0}])[0, 0]
    n = train.count()
    fits = [("mllib", n, float(one.intercept), float(one.coefficients[0])), ("batch", n, two.intercept, float(two.coefficients[0]))]
    return tidy(spark.createDataFrame(fits, "fit string, n_train long, intercept double, coefficient double"), 5)


@register("planted_rule_trees", BIN_SQL + """
SELECT m AS model, count_if(is_cash * is_large = 1) AS tp, 0::BIGINT AS fp, 0::BIGINT AS fn, count_if(is_cash * is_large = 0) AS tn
FROM sp, (VALUES ('random_forest'), ('gbt')) t(m) WHERE split = 'validation' GROUP BY 1""")
def q_planted_rule_trees(spark, sf):
    """P07 + P08: a planted label (urgent and large) is learned without error:
    confusion on the validation rows."""
    frame = binary_frame(spark, sf).withColumn("label", F.col("is_cash") * F.col("is_large"))
    train, valid = class_weight(part(frame, "train"), "label"), part(frame, "validation")
    feats = ["is_cash", "is_large"]
    fitted = bf.run_trials(spark, {"random_forest": lambda: md.random_forest(train, feats, "label", "weight", numTrees=20, maxDepth=4),
                                   "gbt": lambda: md.gbt_classifier(train, feats, "label", "weight", maxIter=10, maxDepth=3)})
    out = []
    for name, model in fitted.items():
        p = md.positive_probability(model.transform(md.assemble(valid, feats)))
        out.append(ev.threshold_metrics(p, "label", "probability_1", 0.5).select(F.lit(name).alias("model"), "tp", "fp", "fn", "tn"))
    return out[0].unionByName(out[1])


@register("planted_importance", """
SELECT * FROM (VALUES ('is_large', 1.0, 1.0), ('is_cash', 0.0, 0.0), ('noise', 0.0, 0.0)) t(feature, importance, share)""")
def q_planted_importance(spark, sf):
    """Where one feature is the label, it has all of the importance."""
    frame = part(binary_frame(spark, sf), "train").withColumn("label", F.col("is_large")).withColumn(
        "noise", F.pmod(F.xxhash64("order_id"), F.lit(1000)).cast("double"))
    model = md.gbt_classifier(frame, ["is_cash", "is_large", "noise"], "label", maxIter=5, maxDepth=3)
    return tidy(md.feature_importance(spark, model, ["is_cash", "is_large", "noise"]).select("feature", "importance", "share"), 9)


def _fold_ap_sql(fractions=((0.55, 0.70), (0.70, 0.85), (0.85, 1.00)), rows="split = 'train'"):
    """Average precision per fold of scores with two values: the value with the
    greater train rate comes first."""
    values = ", ".join(f"({i}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), {str(i == len(fractions)).lower()})" for i, (a, b) in enumerate(fractions, start=1))
    return f"""fo AS (SELECT * FROM (VALUES {values}) t(fold, a, b, closed)),
dts AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT d FROM sp WHERE {rows})),
fb AS (SELECT fold, closed, max(CASE WHEN i = least(CAST(floor(n * a) AS BIGINT), n - 1) THEN d END) AS te,
              max(CASE WHEN i = least(CAST(floor(n * b) AS BIGINT), n - 1) THEN d END) AS ve FROM fo, dts GROUP BY ALL),
tr AS (SELECT fold, avg(label) FILTER (is_cash = 1) > avg(label) FILTER (is_cash = 0) AS one_first FROM sp JOIN fb ON d < te WHERE {rows} GROUP BY 1),
va AS (SELECT fold, sum(label) AS p, count(*) AS n, sum(label * is_cash) AS p1, sum(is_cash) AS n1 FROM sp JOIN fb ON d >= te AND (d < ve OR closed AND d = ve)
       WHERE {rows} GROUP BY 1),
hi AS (SELECT fold, p, n, CASE WHEN one_first THEN p1 ELSE p - p1 END AS ph, CASE WHEN one_first THEN n1 ELSE n - n1 END AS nh FROM va JOIN tr USING (fold)),
ap AS (SELECT fold, (CASE WHEN nh > 0 THEN ph * (ph / nh) ELSE 0 END + (p - ph) * (p / n)) / p AS ap FROM hi)"""


def _binary_folds(frame):
    train = part(frame, "train")
    folds = md.cache_folds(train, splits.expanding_folds(train, "order_date"), "order_date")
    return [(f, class_weight(tr, "label"), va, ["is_cash"]) for f, tr, va in folds]


@register("search_binary", BIN_SQL + ", " + _fold_ap_sql() + """
SELECT s AS search, c AS candidate, fold, round(ap, 9) AS pr_auc, c = 0 AS champion FROM ap, (VALUES ('grid', 0), ('grid', 1), ('grid', 2), ('sample', 0), ('sample', 1)) t(s, c)""")
def q_search_binary(spark, sf):
    """P09 + P10 + P11 + P12: a grid of three penalties (fitted together) and a
    sample of two boosted settings (jobs of their own) on three folds and one 0/1
    feature: every AP follows from counts; equal candidates rank in their order."""
    folds = _binary_folds(binary_frame(spark, sf))
    grid = md.param_grid({"regParam": [0.0, 0.01, 0.1]})
    sample = md.sample_grid({"maxIter": [1, 2], "maxDepth": [1, 2]}, 2, seed=3)
    out = []
    for name, model, candidates in (("grid", "logistic", grid), ("sample", "gbt", sample)):
        res = md.temporal_search(folds, "label", model, candidates, "weight")
        best = md.champion_selection(res).filter("rank = 1").first()["candidate"]
        out.append(res.select(F.lit(name).alias("search"), "candidate", "fold", "pr_auc", (F.col("candidate") == best).alias("champion")))
    return tidy(out[0].unionByName(out[1]), 9)


@register("final_refit_binary", BIN_SQL + ", " + _closed_form_sql("split <> 'test'") + """,
te AS (SELECT sum(label) AS p, count(*) AS nt, sum(label * is_cash) AS p1, sum(is_cash) AS n1 FROM sp WHERE split = 'test'),
hi AS (SELECT p, nt, CASE WHEN b1 > b0 THEN p1 ELSE p - p1 END AS ph, CASE WHEN b1 > b0 THEN n1 ELSE nt - n1 END AS nh FROM te, cf)
SELECT 0 AS candidate, round(b0, 4) AS intercept, round(b1 - b0, 4) AS coefficient, nt AS n_test,
       round((CASE WHEN nh > 0 THEN ph * (ph / nh) ELSE 0 END + (p - ph) * (p / nt)) / p, 9) AS test_pr_auc FROM cf, hi""")
def q_final_refit_binary(spark, sf):
    """The champion refitted once on train and validation: closed-form
    coefficients, and the AP of the one scoring of the test rows."""
    frame = binary_frame(spark, sf)
    grid = [{"regParam": r, "maxIter": 200, "tol": 1e-12} for r in (0.0, 0.1)]
    res = md.temporal_search(_binary_folds(frame), "label", "logistic", grid, "weight")
    best, model, _columns, scored = md.refit_champion(res, part(frame, "train", "validation"), part(frame, "test"),
                                                      Preprocessor(binary=["is_cash"]), "label", ["order_id", "label"])
    ap = ev.ranking_metrics(scored, "label", "probability_1")
    return tidy(ap.select(F.lit(best["candidate"]).alias("candidate"), F.lit(float(model.intercept)).alias("intercept"),
                          F.lit(float(model.coefficients[0])).alias("coefficient"), F.col("n").alias("n_test"), F.col("pr_auc").alias("test_pr_auc")),
                4, {"test_pr_auc": 9})


@register("constant_prior_baseline", BIN_SQL + """
SELECT (SELECT count(*) FROM sp WHERE split = 'test') AS n, round((SELECT avg(label) FROM sp WHERE split = 'train'), 9) AS prior,
       round((SELECT avg(label) FROM sp WHERE split = 'test'), 9) AS pr_auc, 0.5 AS roc_auc""")
def q_constant_prior(spark, sf):
    """P02 (classification): the train rate for every test row: its AP is the test
    rate and its ROC-AUC one half."""
    frame = binary_frame(spark, sf)
    scored = cut_lineage(md.constant_prior(part(frame, "train"), "label", part(frame, "test")))
    prior = scored.agg(F.max("probability_1")).first()[0]
    return tidy(ev.ranking_metrics(scored, "label", "probability_1").select("n", F.lit(prior).alias("prior"), "pr_auc", "roc_auc"))


FORECAST_CANDIDATES = {
    "reference": {"features": REG_FEATS, "early_stopping": False, "max_trees": 10, "stepSize": 0.1, "maxDepth": 4},
    "regularized": {"features": REG_FEATS, "early_stopping": True, "max_trees": 20, "stepSize": 0.1, "maxDepth": 4, "minInstancesPerNode": 20},
    "strong": {"features": REG_FEATS, "early_stopping": True, "max_trees": 20, "stepSize": 0.1, "maxDepth": 2, "minInstancesPerNode": 50},
    "slow": {"features": REG_FEATS, "early_stopping": True, "max_trees": 30, "stepSize": 0.05, "maxDepth": 4, "minInstancesPerNode": 20},
    "slow_calendar": {"features": [*REG_FEATS, "is_sunday", "is_monday", "dow_sin", "dow_cos"], "early_stopping": True, "max_trees": 30,
                      "stepSize": 0.05, "maxDepth": 4, "minInstancesPerNode": 20},
}


@register("forecast_candidates", REG_SQL.replace("SELECT CASE WHEN", "SELECT sale_date, CASE WHEN") + """,
dc AS (SELECT sale_date, row_number() OVER (ORDER BY sale_date) AS cum, count(*) OVER () AS n FROM d WHERE split = 'train'),
cut AS (SELECT min(CASE WHEN cum > floor(n * CAST(0.85 AS DOUBLE)) THEN sale_date END) AS c FROM dc)
SELECT c AS candidate, CASE WHEN c = 'reference' THEN 0 ELSE (SELECT count(*) FROM dc, cut WHERE sale_date >= cut.c) END AS n_eval,
       (SELECT count(*) FROM d WHERE split = 'test') AS n_valid, true AS refit_has_chosen_trees
FROM (VALUES ('reference'), ('regularized'), ('strong'), ('slow'), ('slow_calendar')) t(c)""")
def q_forecast_candidates(spark, sf):
    """Five configurations, four with early stopping on the last 15% of the
    training days and a refit of all of them; rows held out and the refit's trees."""
    from basketry.functions.calendar import cyclic_encoding
    d = daily_model_frame(spark, sf)
    day = F.weekday("sale_date")
    d = d.withColumns({"is_sunday": (day == 6).cast("int"), "is_monday": (day == 0).cast("int"), **cyclic_encoding(day, 7, "dow")})
    d = cut_lineage(d)
    r = md.forecast_candidates(d.filter("is_train"), d.filter(~F.col("is_train")), "sale_date", "revenue", FORECAST_CANDIDATES)
    return r.select("candidate", "n_eval", "n_valid", (F.col("chosen_trees") == F.col("model_trees")).alias("refit_has_chosen_trees"))
