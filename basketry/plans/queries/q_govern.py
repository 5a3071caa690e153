"""Queries for §2.12 feature governance and selection."""

from pyspark.sql import functions as F

from basketry.operators import govern as gv
from basketry.operators import splits, stats
from basketry.operators import timeseries as ts
from basketry.operators.models import cache_folds
from basketry.operators.preprocess import class_weight
from basketry.plans import features as ft
from basketry.plans.catalog import register, tidy
from basketry.plans.queries.q_features import master, spec
from basketry.plans.queries.q_models import _fold_ap_sql
from basketry.plans.queries.q_profile import ORDERS_ITEMS_SQL, orders_items
from basketry.plans.queries.q_rollup import category_levels
from basketry.plans.queries.q_timeseries import DENSE_SQL
from basketry.plans.queries.q_stats import FEATS, LONG_SQL, order_features
from basketry.session import cut_lineage
from basketry.sources import retail


def daily_features(spark, sf):
    """Dense daily revenue with lag / rolling / calendar candidates."""
    t = ft.daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    d = ft.daily_target_table(t, "sale_date", "revenue", "cogs", lags=(1, 2, 7, 14), windows=(7, 14, 28))
    from basketry.functions.calendar import calendar_columns
    d = d.withColumns({k: v.cast("double") for k, v in calendar_columns("sale_date").items() if k in ("dayofweek", "is_weekend", "month")})
    return d.na.drop()


DAILY_GROUPS = {"lags": ["revenue_lag_1d", "revenue_lag_7d"], "rolling": ["revenue_rolling_7d_mean", "revenue_rolling_28d_mean"],
                "calendar": ["dayofweek", "is_weekend"], "long_lags": ["revenue_lag_14d"]}


@register("feature_catalog")
def q_feature_catalog(spark, sf):
    """Kind, source and leakage risk of every built daily feature."""
    d = daily_features(spark, sf)
    return gv.feature_catalog(spark, [c for c in d.columns if c != "sale_date"])


@register("leakage_gate")
def q_leakage_gate(spark, sf):
    """L02 + L03 + G12: the order table joined with target-history audit
    columns; the gate marks ids, target, metadata and banned columns."""
    o = ft.order_feature_table(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf),
                               retail.products(spark, sf), category_levels(spark, sf))
    items = retail.items(spark, sf).withColumn("returned", (F.col("return_flag") == "R").cast("int"))
    hist = ts.order_history_features(items, "order_id", "product_id", "ship_date", "returned").withColumnRenamed(
        "mean_rate_before", "mean_product_return_rate").withColumnRenamed("max_rate_before", "max_product_return_rate") \
        .withColumnRenamed("high_risk_count", "high_risk_product_count")
    audit = o.join(hist, "order_id", "left")
    try:
        gv.banned_column_guard(audit)
        guard = "passed"
    except gv.LeakageError:
        guard = "refused"
    gate = gv.leakage_gate(spark, audit.columns, id_cols=["order_id", "customer_id"], meta_cols=["order_date", "order_status"],
                           target_cols=["returned"], representation_cols=["payment_value"], raise_on_breach=False)
    return gate.withColumn("guard_on_audit_table", F.lit(guard))


@register("quality_filter", ORDERS_ITEMS_SQL + """
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(count_if({c} IS NULL) * 1.0 / count(*), 9) AS missing_share, count(DISTINCT {c}) AS nunique, "
    f"count_if(CAST({c} AS DOUBLE) IN ('Infinity'::DOUBLE, '-Infinity'::DOUBLE)) AS n_infinite, "
    f"CASE WHEN count(DISTINCT {c}) <= 1 OR count_if({c} IS NULL) * 1.0 / count(*) > 0.01 THEN 'drop' ELSE 'keep' END AS action, "
    f"CASE WHEN count(DISTINCT {c}) <= 1 THEN 'constant' WHEN count_if({c} IS NULL) * 1.0 / count(*) > 0.01 THEN 'missing_above_threshold' "
    f"ELSE 'ok' END AS reason FROM j" for c in ["o_totalprice", "total_quantity", "discount_total"]) + ")")
def q_quality_filter(spark, sf):
    """Constant / high-missing / infinite features dropped (1% bar)."""
    return tidy(gv.quality_filter(orders_items(spark, sf), ["o_totalprice", "total_quantity", "discount_total"], 0.01))


@register("duplicate_columns", ORDERS_ITEMS_SQL + """,
k AS (SELECT * FROM (VALUES """ + ", ".join(f"('{a}', '{b}')" for a, b in (
    ("o_totalprice", "total_quantity"), ("o_totalprice", "payment_value"), ("o_totalprice", "discount_total"),
    ("total_quantity", "payment_value"), ("total_quantity", "discount_total"), ("payment_value", "discount_total"))) + """) t(a, b)),
c AS (SELECT count_if(o_totalprice IS DISTINCT FROM total_quantity) AS c0, count_if(o_totalprice IS DISTINCT FROM discount_total) AS c1,
             count_if(total_quantity IS DISTINCT FROM discount_total) AS c2 FROM j)
SELECT b AS feature, a AS duplicate_of FROM k, c WHERE (a = 'o_totalprice' AND b = 'payment_value')
   OR (a = 'o_totalprice' AND b = 'total_quantity' AND c0 = 0) OR (a = 'o_totalprice' AND b = 'discount_total' AND c1 = 0)
   OR (a = 'total_quantity' AND b = 'discount_total' AND c2 = 0)""")
def q_duplicate_columns(spark, sf):
    """Content-identical columns (order value joined twice, once as the
    payment amount) found by signature and confirmed exactly."""
    o = orders_items(spark, sf)
    pay = retail.orders(spark, sf).select(F.col("order_id").alias("o_orderkey"), "payment_value")
    d = o.join(pay, "o_orderkey", "left")
    return gv.duplicate_columns(d, ["o_totalprice", "total_quantity", "payment_value", "discount_total"], "o_orderkey")


# relation strength and quality of the order features, as in K03 and L04
REL_SQL = LONG_SQL + """,
ra AS (SELECT feature, count(*) AS n_pairs, corr(x, y) AS p, corr(rx, ry) AS s, stddev_samp(x) AS sx FROM rk GROUP BY 1),
rl AS (SELECT feature, n_pairs, CASE WHEN n_pairs >= 30 AND sx > 0 THEN p END AS pearson, CASE WHEN n_pairs >= 30 AND sx > 0 THEN s END AS spearman FROM ra),
rel AS (SELECT *, greatest(abs(pearson), abs(spearman)) AS max_abs_corr FROM rl),
qu AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count_if({c} IS NULL) * 1.0 / count(*) AS missing_share, count(DISTINCT {c}) AS nunique FROM of" for c in FEATS) + """),
qa AS (SELECT *, CASE WHEN nunique <= 1 OR missing_share > 0.5 THEN 'drop' ELSE 'keep' END AS action,
              CASE WHEN nunique <= 1 THEN 'constant' WHEN missing_share > 0.5 THEN 'missing_above_threshold' ELSE 'ok' END AS reason FROM qu)"""


def _spearman_sql(a, b):
    """Tie-averaged rank correlation of two columns where both are present."""
    ranks = ", ".join(f"(2 * rank() OVER (ORDER BY {c}) + count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r{i}" for i, c in enumerate((a, b)))
    return (f"SELECT '{a}' AS fa, '{b}' AS fb, abs(corr(r0, r1)) AS v FROM (SELECT {ranks} FROM of "
            f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")


def _pairs_and_scores(spark, sf):
    o = order_features(spark, sf)
    rel = stats.target_relation_report(o, FEATS, "returned")
    mat = stats.corr_matrix(o, FEATS, upper_only=True).withColumnRenamed("corr", "pearson")
    rank = stats.spearman_pairs(o, FEATS).select("feature_a", "feature_b", "spearman")
    r = mat.join(rank, ["feature_a", "feature_b"])
    q = gv.quality_filter(o, FEATS)
    scores = rel.select("feature", F.abs("max_abs_corr").alias("score")).join(q.select("feature", "missing_share"), "feature")
    return r, scores, rel, q


@register("redundancy_greedy", REL_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """,
sp AS (""" + " UNION ALL ".join(_spearman_sql(a, b) for i, a in enumerate(FEATS) for b in FEATS[i + 1:]) + """),
hot AS (SELECT row_number() OVER (ORDER BY v DESC, fa, fb) AS rn, fa, fb, v, x.max_abs_corr AS sa, y.max_abs_corr AS sb,
               p.missing_share AS ma, q.missing_share AS mb
        FROM sp JOIN rel x ON x.feature = fa JOIN rel y ON y.feature = fb JOIN qa p ON p.feature = fa JOIN qa q ON q.feature = fb WHERE v >= 0.5),
ch AS (SELECT *, CASE WHEN sa IS NOT NULL AND sb IS NOT NULL AND sa <> sb THEN CASE WHEN sa > sb THEN fa ELSE fb END
                      WHEN ma <= mb THEN fa ELSE fb END AS kept FROM hot),
g AS (SELECT 0::BIGINT AS rn, []::VARCHAR[] AS gone, false AS used
      UNION ALL
      SELECT ch.rn, CASE WHEN list_contains(gone, fa) OR list_contains(gone, fb) THEN gone
                         ELSE list_append(gone, CASE WHEN kept = fa THEN fb ELSE fa END) END,
             NOT (list_contains(gone, fa) OR list_contains(gone, fb)) FROM g JOIN ch ON ch.rn = g.rn + 1)
SELECT fa AS feature_a, fb AS feature_b, 'absolute_spearman' AS association_type, round(v, 9) AS association_value, kept,
       CASE WHEN kept = fa THEN fb ELSE fa END AS dropped FROM ch JOIN g USING (rn) WHERE used""")
def q_redundancy_greedy(spark, sf):
    """Greedy drop of the weaker feature in highly correlated pairs."""
    pairs, scores, _, _ = _pairs_and_scores(spark, sf)
    return tidy(gv.redundancy_greedy(pairs, scores, threshold=0.5))


LAG_DAYS, MEAN_DAYS = (1, 2, 7, 14), (7, 14, 28)
DAILY_NUMBERS = ["revenue", "cogs", "profit", "margin", *[f"revenue_lag_{k}d" for k in LAG_DAYS], *[f"revenue_rolling_{w}d_mean" for w in MEAN_DAYS],
                 "dayofweek", "is_weekend", "month"]
# the complete days of ``daily_features``
DAILY_FEATS_SQL = DENSE_SQL + """,
dx AS (SELECT sale_date, revenue, cogs, revenue - cogs AS profit, CASE WHEN revenue = 0 THEN 0.0 ELSE (revenue - cogs) / revenue END AS margin,
       """ + ", ".join([f"lag(revenue, {k}) OVER w AS revenue_lag_{k}d" for k in LAG_DAYS] + [
    f"avg(revenue) OVER (ORDER BY sale_date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS revenue_rolling_{n}d_mean" for n in MEAN_DAYS]) + """,
       CAST(isodow(sale_date) - 1 AS DOUBLE) AS dayofweek, CAST(isodow(sale_date) >= 6 AS DOUBLE) AS is_weekend, CAST(month(sale_date) AS DOUBLE) AS month
       FROM dd WINDOW w AS (ORDER BY sale_date)),
df AS (SELECT * FROM dx WHERE """ + " AND ".join(f"{c} IS NOT NULL" for c in DAILY_NUMBERS) + ")"


def _strength_sql(features, target):
    """``max_abs_corr`` of each feature with the target: the greater of the linear and
    the tie-averaged rank correlation, from 30 rows on and where the feature varies."""
    long = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS x, CAST({target} AS DOUBLE) AS y FROM df" for f in features)
    rank = "(2 * rank() OVER (PARTITION BY feature ORDER BY {0}) + count(*) OVER (PARTITION BY feature, {0}) - 1) / 2.0 AS r{0}"
    return f"""lo AS ({long}), lr AS (SELECT *, {rank.format("x")}, {rank.format("y")} FROM lo),
st AS (SELECT feature, CASE WHEN count(*) >= 30 AND stddev_samp(x) > 0 THEN greatest(abs(corr(x, y)), abs(corr(rx, ry))) END AS strength FROM lr GROUP BY 1)"""


CAP_NAMES = [c for c in DAILY_NUMBERS if c.startswith("revenue_")]
FAMILY_SQL = "regexp_replace(feature, '(_lag_[0-9]+d|_rolling_[0-9]+d_mean)$', '')"


@register("family_cap", DAILY_FEATS_SQL + ", " + _strength_sql(CAP_NAMES, "cogs") + f""",
r AS (SELECT feature, strength, 0.0 AS missing_share, {FAMILY_SQL} AS family FROM st),
k AS (SELECT *, row_number() OVER (PARTITION BY family ORDER BY strength DESC NULLS LAST, missing_share, feature) AS family_rank FROM r)
SELECT feature, round(strength, 9) AS score, missing_share, family, family_rank, family_rank <= 2 AS keep FROM k""")
def q_family_cap(spark, sf):
    """At most 2 features per lag/rolling family by relevance."""
    d = daily_features(spark, sf)
    feats = [c for c in d.columns if c.startswith("revenue_")]
    rel = stats.target_relation_report(d.withColumn("y", F.col("cogs")), feats, "y")
    q = gv.quality_filter(d, feats)
    t = rel.select("feature", F.col("max_abs_corr").alias("score")).join(q.select("feature", "missing_share"), "feature")
    return tidy(gv.family_cap(t, cap=2))


@register("section_review_and_group_cap", REL_SQL + """,
j AS (SELECT rel.feature, n_pairs, pearson, spearman, max_abs_corr, action,
             CASE WHEN max_abs_corr >= 0.6 THEN 'strong' WHEN max_abs_corr >= 0.3 THEN 'medium' WHEN max_abs_corr >= 0.1 THEN 'weak' ELSE 'unclear' END AS relation,
             CASE WHEN action = 'drop' THEN 'not_selected' WHEN max_abs_corr >= 0.05 THEN 'keep' ELSE 'review' END AS section_decision,
             CASE WHEN starts_with(rel.feature, 'o_') THEN 'order' ELSE 'items' END AS kind FROM rel LEFT JOIN qa USING (feature)),
k AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY abs(max_abs_corr) DESC NULLS LAST, feature) AS group_rank FROM j)
SELECT feature, n_pairs, round(pearson, 9) AS pearson, round(spearman, 9) AS spearman, round(max_abs_corr, 9) AS max_abs_corr, relation, action,
       section_decision, kind, group_rank, feature = 'discount_ratio' OR group_rank <= 1 AS selected,
       CASE WHEN feature = 'discount_ratio' THEN 'preselected' WHEN group_rank <= 1 THEN 'top 1 in ' || kind ELSE 'below cap' END AS reason FROM k""")
def q_section_review(spark, sf):
    """L08 + L09: keep / review / not_selected per feature, then top-1 per
    feature kind plus a preselected feature."""
    _, _, rel, q = _pairs_and_scores(spark, sf)
    s = gv.section_review(rel, q)
    s = s.withColumn("kind", F.when(F.col("feature").startswith("o_"), "order").otherwise("items"))
    return tidy(gv.group_cap_selection(s, "kind", 1, preselected=["discount_ratio"]))


def _rolling_folds(spark, sf, d):
    return splits.rolling_origin(d, "sale_date", min_train_days=3 * 365, step_days=90, test_days=30, last_n=3)


@register("incremental_group_wrapper")
def q_incremental_wrapper(spark, sf):
    """Feature groups added in order, kept on rolling-origin WAPE gain."""
    d = daily_features(spark, sf)
    return gv.incremental_group_wrapper(d, "sale_date", "revenue", DAILY_GROUPS, _rolling_folds(spark, sf, d))


@register("family_wrapper")
def q_family_wrapper(spark, sf):
    """Baseline + one family at a time."""
    d = daily_features(spark, sf)
    fam = {k: v for k, v in DAILY_GROUPS.items() if k != "lags"}
    return gv.family_wrapper(d, "sale_date", "revenue", DAILY_GROUPS["lags"], fam, _rolling_folds(spark, sf, d))


@register("forward_group_selection")
def q_forward_selection(spark, sf):
    """Greedy forward selection of feature groups by WAPE gain."""
    d = daily_features(spark, sf)
    return gv.forward_group_selection(d, "sale_date", "revenue", DAILY_GROUPS, _rolling_folds(spark, sf, d))


TWO = {"lag_week": ["revenue_lag_7d"], "rolling_month": ["revenue_rolling_28d_mean"]}
# ridge (penalty 10, free intercept) on none, either or both of two features, by centred
# sums per fold; mean WAPE of the test days
TWO_SQL = DAILY_FEATS_SQL + """,
o AS (SELECT origin, row_number() OVER (ORDER BY origin DESC) AS back FROM (SELECT CAST(unnest(generate_series(a + 1095, z - 29, INTERVAL 90 DAY)) AS DATE) AS origin
      FROM (SELECT min(sale_date) AS a, max(sale_date) AS z FROM df))),
v AS (SELECT sale_date, revenue_lag_7d AS a, revenue_rolling_28d_mean AS b, revenue AS y FROM df),
m AS (SELECT origin, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM o JOIN v ON sale_date < origin WHERE back <= 3 GROUP BY 1),
g AS (SELECT origin, ma, mb, my, sum((a - ma) * (a - ma)) + 10 AS aa, sum((b - mb) * (b - mb)) + 10 AS bb, sum((a - ma) * (b - mb)) AS ab,
             sum((a - ma) * (y - my)) AS ay, sum((b - mb) * (y - my)) AS by_ FROM m JOIN v ON sale_date < origin GROUP BY ALL),
w AS (SELECT origin, sum(abs(y)) AS s, sum(abs(y - my)) AS e0, sum(abs(y - my - ay / aa * (a - ma))) AS ea, sum(abs(y - my - by_ / bb * (b - mb))) AS eb,
             sum(abs(y - my - (bb * ay - ab * by_) / (aa * bb - ab * ab) * (a - ma) - (aa * by_ - ab * ay) / (aa * bb - ab * ab) * (b - mb))) AS eab
      FROM g JOIN v ON sale_date BETWEEN origin AND origin + 29 GROUP BY 1),
q AS (SELECT avg(e0 / s) AS w0, avg(ea / s) AS wa, avg(eb / s) AS wb, avg(eab / s) AS wab FROM w WHERE s > 0)
"""


@register("incremental_two_groups", TWO_SQL + """, s1 AS (SELECT *, w0 - wa > 0.001 AS k1 FROM q),
s2 AS (SELECT *, CASE WHEN k1 THEN wa ELSE w0 END AS cur, CASE WHEN k1 THEN wab ELSE wb END AS nxt FROM s1)
SELECT 'lag_week' AS feature_group, round(w0, 7) AS wape_before, round(wa, 7) AS wape_with, round(w0 - wa, 7) AS gain, k1 AS kept FROM s2
UNION ALL SELECT 'rolling_month', round(cur, 7), round(nxt, 7), round(cur - nxt, 7), cur - nxt > 0.001 FROM s2""")
def q_incremental_two_groups(spark, sf):
    """Two groups of one feature each, from the fold Gram table."""
    d = daily_features(spark, sf)
    return tidy(gv.incremental_group_wrapper(d, "sale_date", "revenue", TWO, _rolling_folds(spark, sf, d)), 7)


@register("family_two_groups", TWO_SQL + """
SELECT 'lag_week' AS family, round(w0, 7) AS baseline_wape, round(wa, 7) AS wape_with, round(w0 - wa, 7) AS gain, w0 - wa > 0.0005 AS kept FROM q
UNION ALL SELECT 'rolling_month', round(w0, 7), round(wb, 7), round(w0 - wb, 7), w0 - wb > 0.0005 FROM q""")
def q_family_two_groups(spark, sf):
    """Either of two families against the mean alone."""
    d = daily_features(spark, sf)
    return tidy(gv.family_wrapper(d, "sale_date", "revenue", [], TWO, _rolling_folds(spark, sf, d)), 7)


@register("forward_two_groups", TWO_SQL + """, s1 AS (SELECT *, CASE WHEN wa <= wb THEN 'lag_week' ELSE 'rolling_month' END AS best, least(wa, wb) AS w1 FROM q)
SELECT 1 AS step, best AS feature_group, round(w0, 7) AS wape_before, round(w1, 7) AS wape_after, round(w0 - w1, 7) AS gain, w0 - w1 > 0 AS accepted FROM s1
UNION ALL SELECT 2, CASE best WHEN 'lag_week' THEN 'rolling_month' ELSE 'lag_week' END, round(w1, 7), round(wab, 7), round(w1 - wab, 7), w1 - wab > 0 FROM s1 WHERE w0 - w1 > 0""")
def q_forward_two_groups(spark, sf):
    """Greedy steps over two groups of one feature each."""
    d = daily_features(spark, sf)
    return tidy(gv.forward_group_selection(d, "sale_date", "revenue", TWO, _rolling_folds(spark, sf, d)), 7)


WRAPPER_BASE, WRAPPER_FOLDS = ["is_cash"], ((0.40, 0.60), (0.60, 0.80), (0.80, 1.00))


def _wrapper_folds(spark, sf, planted):
    """Labelled train orders with all candidates in three expanding folds, weights
    fitted per fold; missing numbers are 0 as in the training table."""
    o = order_features(spark, sf).filter(F.col("returned").isNotNull()).na.fill(0.0, subset=FEATS)
    when = retail.orders(spark, sf).select(F.col("order_id").alias("o_orderkey"), "order_date", (F.col("priority") == "1-URGENT").cast("int").alias("is_cash"))
    o = o.join(when, "o_orderkey").withColumnRenamed("returned", "label")
    if planted:
        o = o.withColumns({"answer": F.col("label").cast("double"), "constant": F.lit(1.0), "same_as_base": F.col("is_cash").cast("double")})
    o = cut_lineage(o)
    folds = splits.expanding_folds(o, "order_date", WRAPPER_FOLDS)
    return [(f, class_weight(tr, "label"), va) for f, tr, va in cache_folds(o, folds, "order_date")]


@register("dual_model_wrapper")
def q_dual_model_wrapper(spark, sf):
    """Every candidate feature over three folds: per model the deltas against
    the baseline, and the decision that both models have to agree on."""
    deltas = gv.dual_model_wrapper(_wrapper_folds(spark, sf, False), WRAPPER_BASE, FEATS, "label", "weight")
    summary = gv.wrapper_summary(deltas)
    return tidy(summary.join(gv.wrapper_consensus(summary).select("feature", "decision"), "feature"))


@register("dual_model_planted", """
WITH sp AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS label,
            max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS is_cash FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2),
""" + _fold_ap_sql(WRAPPER_FOLDS, "true") + """
SELECT m AS model, f AS feature, fold, round(ap, 9) AS baseline_pr_auc, round(CASE WHEN f = 'answer' THEN 1 ELSE ap END, 9) AS pr_auc,
       CASE WHEN f = 'answer' THEN 1.0 END AS roc_auc FROM ap, (VALUES ('logistic'), ('gbt')) t(m), (VALUES ('answer'), ('constant'), ('same_as_base')) u(f)""")
def q_dual_model_planted(spark, sf):
    """Planted candidates: the label itself ranks perfectly, a constant and a
    copy of the baseline change nothing; the baseline's AP follows from counts. All
    of them are 0/1 flags, so the fits read a few distinct rows with summed weights."""
    deltas = gv.dual_model_wrapper(_wrapper_folds(spark, sf, True), WRAPPER_BASE, ["answer", "constant", "same_as_base"], "label", "weight",
                                   merge_equal=True)
    return tidy(deltas.select("model", "feature", "fold", "baseline_pr_auc", "pr_auc", F.when(F.col("feature") == "answer", F.col("roc_auc")).alias("roc_auc")))


@register("selection_report", REL_SQL + """,
st AS (SELECT feature, CASE WHEN action <> 'keep' THEN 'quality' WHEN NOT coalesce(max_abs_corr >= 0.01, false) THEN 'relevance' END AS failed_stage
       FROM rel LEFT JOIN qa USING (feature))
SELECT CASE WHEN failed_stage IS NULL THEN 'selected' ELSE 'rejected' END AS decision, failed_stage, count(*) AS n_features FROM st GROUP BY 1, 2""")
def q_selection_report(spark, sf):
    """One row per candidate with gate results and the funnel."""
    _, _, rel, q = _pairs_and_scores(spark, sf)
    cand = rel.select("feature")
    stages = {"quality": q.select("feature", (F.col("action") == "keep").alias("passed")),
              "relevance": rel.select("feature", F.coalesce(F.col("max_abs_corr") >= 0.01, F.lit(False)).alias("passed"))}
    return gv.selection_funnel(gv.selection_report(cand, stages))


@register("leakage_name_review")
def q_leakage_name_review(spark, sf):
    """Risky names among the order-table columns."""
    o = ft.order_feature_table(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf),
                               retail.products(spark, sf), category_levels(spark, sf))
    names = spark.createDataFrame([(c,) for c in o.columns], "feature string")
    return gv.leakage_name_review(names, model_cols=[c for c in o.columns if c not in ("order_id", "returned")])


@register("readiness_checklist", """
WITH c AS (SELECT count(*) = count(DISTINCT o_orderkey) AS u, min(o_orderstatus IN ('F', 'O', 'P')) AS b FROM orders)
SELECT 'grain_unique' AS check_name, u AS passed FROM c UNION ALL SELECT 'binary_target', b FROM c
UNION ALL SELECT 'splits_disjoint', u FROM c UNION ALL SELECT 'splits_ordered', true UNION ALL SELECT 'no_banned_columns', true""")
def q_readiness(spark, sf):
    """Named checks computed with Spark actions (unique grain, binary
    target, ordered splits, no banned column)."""
    sp = spec(spark, sf)
    o = ft.serving_features(master(spark, sf), sp).join(retail.orders(spark, sf).select("order_id", "order_date"), "order_id")
    lab = o.filter(F.col("label").isNotNull())
    sp = splits.positional_cutoff_split(lab, "order_date")
    pairs, _ = splits.split_integrity(sp, "data_split", "order_date", "order_id")
    pr = pairs.collect()
    checks = [("grain_unique", o.select("order_id").distinct().count() == o.count()),
              ("binary_target", set(r[0] for r in lab.select("label").distinct().collect()) <= {0, 1}),
              ("splits_disjoint", all(r["overlap_keys"] == 0 for r in pr)),
              ("splits_ordered", all(r["ordered"] for r in pr)),
              ("no_banned_columns", not set(o.columns) & set(gv.BANNED_FEATURES))]
    return gv.readiness_checklist(spark, checks, raise_on_fail=False)


@register("modeling_schema")
def q_modeling_schema(spark, sf):
    """Column, role and type of the serving feature table."""
    sp = spec(spark, sf)
    o = ft.serving_features(master(spark, sf), sp)
    roles = {"order_id": "id", "label": "target", **{c: "numeric" for c in sp.numeric()},
             **{c: "categorical" for c in sp.categorical_all()}, **{c: "binary" for c in sp.binary()}, sp.payment: "quantile"}
    return gv.modeling_schema(o, roles)


AUDIT_NAMES = [c for c in DAILY_NUMBERS if c != "revenue"]


def _audit_rows_sql():
    """Source and kind of the daily features, written out."""
    rows = [("revenue", "lag", [f"revenue_lag_{k}d" for k in LAG_DAYS]), ("revenue", "rolling", [f"revenue_rolling_{w}d_mean" for w in MEAN_DAYS]),
            *[(c, "aggregate", [c]) for c in ("revenue", "cogs", "profit", "margin")], *[(c, "calendar", [c]) for c in ("dayofweek", "is_weekend", "month")]]
    return ", ".join(f"('{source}', '{kind}', '{n}')" for source, kind, names in rows for n in names)


@register("family_audit_and_scores", DAILY_FEATS_SQL + ", " + _strength_sql(AUDIT_NAMES, "revenue") + f""",
ca AS (SELECT * FROM (VALUES {_audit_rows_sql()}) t(source, kind, feature)),
ra AS (SELECT feature, row_number() OVER (PARTITION BY {FAMILY_SQL} ORDER BY strength DESC NULLS LAST, feature) AS family_rank FROM st)
SELECT source, kind, count(*) AS n_before, count(*) FILTER (family_rank = 1) AS n_after, round(avg(strength), 9) AS mean_abs_corr
FROM ca LEFT JOIN ra USING (feature) LEFT JOIN st USING (feature) GROUP BY 1, 2""")
def q_family_audit(spark, sf):
    """L17 + L18: features per source × kind before / after the family cap,
    and the joined per-feature score table."""
    d = daily_features(spark, sf)
    names = [c for c in d.columns if c != "sale_date"]
    before = gv.feature_catalog(spark, names)
    rel = stats.target_relation_report(d, [n for n in names if n != "revenue"], "revenue")
    q = gv.quality_filter(d, names)
    cap = gv.family_cap(rel.select("feature", F.col("max_abs_corr").alias("score")).join(q.select("feature", "missing_share"), "feature"), cap=1)
    after = before.join(cap.filter("keep").select("feature"), "feature", "left_semi")
    audit = gv.family_audit(before, after)
    table = gv.feature_score_table(before, [q.select("feature", "missing_share", "action"), rel.select("feature", "max_abs_corr")])
    return tidy(audit.join(table.groupBy("source", "kind").agg(F.avg("max_abs_corr").alias("mean_abs_corr")), ["source", "kind"], "left"))


REV_NAMES = ["revenue", *[f"revenue_lag_{k}d" for k in (1, 2, 7, 14)], *[f"revenue_rolling_{w}d_mean" for w in (7, 14, 28)]]


@register("redundancy_groups", DENSE_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """,
x AS (SELECT revenue, cogs, """ + ", ".join(f"lag(revenue, {k}) OVER w AS revenue_lag_{k}d" for k in (1, 2, 7, 14)) + ", " + ", ".join(
    f"avg(revenue) OVER (ORDER BY sale_date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS revenue_rolling_{w}d_mean" for w in (7, 14, 28)) + """
      FROM dd WINDOW w AS (ORDER BY sale_date)),
f AS (SELECT * FROM x WHERE cogs IS NOT NULL AND """ + " AND ".join(f"{n} IS NOT NULL" for n in REV_NAMES) + """),
pr AS (""" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS v FROM f"
                                for i, a in enumerate(REV_NAMES) for b in REV_NAMES[i + 1:]) + """),
ed AS (SELECT a, b FROM pr WHERE v >= 0.5 UNION ALL SELECT b, a FROM pr WHERE v >= 0.5),
nd AS (SELECT DISTINCT a AS n FROM pr UNION SELECT DISTINCT b FROM pr),
rc AS (SELECT n, n AS m FROM nd UNION SELECT rc.n, ed.b FROM rc JOIN ed ON ed.a = rc.m)
SELECT n AS feature, min(m) AS group_id, n = min(m) AS is_representative FROM rc GROUP BY n""")
def q_redundancy_groups(spark, sf):
    """Features linked by |corr| ≥ 0.5 grouped by min-label propagation."""
    d = daily_features(spark, sf)
    names = [c for c in d.columns if c.startswith("revenue")]
    pairs = stats.corr_matrix(d, names, upper_only=True)
    return gv.redundancy_groups(pairs, 0.5)
