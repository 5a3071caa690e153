"""Queries for §2.18 batch and stream scoring."""

from pyspark.sql import functions as F

from basketry.operators import evaluate as ev
from basketry.operators.preprocess import class_weight
from basketry.plans import features as ft
from basketry.plans import scoring as sc
from basketry.plans.catalog import register, tidy
from basketry.plans.queries.q_features import master, spec
from basketry.plans.queries.q_models import BIN_SQL, NUMERIC, _closed_form_sql, binary_frame
from basketry.plans.queries.q_rollup import category_levels
from basketry.session import Workspace, cut_lineage, released_shuffles
from basketry.sources import io, retail
from basketry.streaming.stream_score import score_requests, start_stream_scoring

CATEG = ["priority", "segment", "tenure_group"]
BUNDLE_TABLES = ("order_items", "features", "split", "validation_scores", "thresholds")


def fitted_bundle(spark, sf, tables=None):
    """Order features → positional split → weighted LR pipeline fitted on
    train; threshold = max-F1 policy on validation (stored with the model).
    Features and validation scores are checkpointed: every fit, scan and score of
    the bundle reads them, none joins the tables or scores again. With ``tables`` they
    are tables of that workspace (``BUNDLE_TABLES``), which the caller drops."""
    from basketry.operators.preprocess import class_weight
    from basketry.operators.splits import positional_cutoff_split
    keep = tables.save if tables else lambda df, _name: cut_lineage(df)
    features = spec(spark, sf)
    feats = keep(ft.serving_features(master(spark, sf), features, tables=tables), "features")
    lab = feats.filter(F.col("label").isNotNull()).join(retail.orders(spark, sf).select("order_id", "order_date"), "order_id")
    sp = keep(positional_cutoff_split(lab, "order_date"), "split")
    train = class_weight(sp.filter(F.col("data_split") == "train"), "label")
    binary = features.binary()
    model = sc.fit_scoring_pipeline(train, NUMERIC, CATEG, binary, "label", "weight", maxIter=50, regParam=0.01)
    val = sc.batch_score(model, sp.filter(F.col("data_split") == "validation"), 0.5, binary=binary).join(
        sp.select("order_id", "label"), "order_id")
    val = keep(val.select("label", "return_probability"), "validation_scores")
    pol = ev.threshold_policy(keep(ev.threshold_table(val, "label", "return_probability"), "thresholds"))
    thr = pol.filter(F.col("policy") == "max_f1").first()["threshold"]
    return model, float(thr), feats, binary


SCORED_SQL = """SELECT count(*) AS n_scored, count(DISTINCT o_orderkey) AS n_orders, true AS in_unit_interval,
       true AS follows_threshold FROM orders"""


def score_facts(scored):
    """Facts of scores: one per order, in [0, 1], decided by the threshold."""
    p = F.col("return_probability")
    return scored.agg(F.count(F.lit(1)).alias("n_scored"), F.count_distinct("order_id").alias("n_orders"),
                      F.min(p.between(0, 1)).alias("in_unit_interval"),
                      F.min((p >= F.col("threshold")).cast("int") == F.col("prediction")).alias("follows_threshold"))


@register("batch_score", SCORED_SQL)
def q_batch_score(spark, sf):
    """Every order scored with the bundle at its locked threshold; facts
    of the scores."""
    model, thr, feats, binary = fitted_bundle(spark, sf)
    return score_facts(sc.batch_score(model, feats, thr, binary=binary))


@register("score_summary", """
SELECT count(*) AS n_scored, true AS range_ordered, true AS rate_is_mean_decision FROM orders""")
def q_score_summary(spark, sf):
    """N, positive rate, probability range, threshold; facts of the
    summary against the scores."""
    model, thr, feats, binary = fitted_bundle(spark, sf)
    scored = cut_lineage(sc.batch_score(model, feats, thr, binary=binary))
    rate = scored.agg(F.avg((F.col("return_probability") >= thr).cast("double")).alias("r")).first()["r"]
    return sc.score_summary(scored).select(
        "n_scored", ((F.col("min_probability") <= F.col("mean_probability")) & (F.col("mean_probability") <= F.col("max_probability"))).alias("range_ordered"),
        (F.abs(F.col("positive_rate") - F.lit(rate)) < 1e-12).alias("rate_is_mean_decision"))


ONE_FEATURE_SQL = BIN_SQL + ", " + _closed_form_sql("split = 'train'") + """,
sc AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS is_cash FROM orders),
pr AS (SELECT is_cash, 1 / (1 + exp(-CASE WHEN is_cash = 1 THEN b1 ELSE b0 END)) AS p FROM sc, cf)"""


def _one_feature_scores(spark, sf):
    """Scores of every order under a saved and reloaded bundle on one 0/1 feature."""
    frame = binary_frame(spark, sf)
    model = sc.fit_scoring_pipeline(class_weight(frame.filter("data_split = 'train'"), "label"), [], [], ["is_cash"], "label", "weight",
                                    maxIter=200, tol=1e-14, regParam=0.0)
    path = io.scratch_path(spark, "binary-bundle")
    sc.save_bundle(model, spark, path, 0.5, ["is_cash"], {})
    model, meta = sc.load_bundle(spark, path)
    orders = retail.orders(spark, sf).select("order_id", (F.col("priority") == "1-URGENT").cast("int").alias("is_cash"))
    return sc.batch_score(model, orders, meta["threshold"], binary=["is_cash"]).join(orders, "order_id")


@register("batch_score_closed_form", ONE_FEATURE_SQL + """
SELECT is_cash, count(*) AS n, round(min(p), 5) AS p_min, round(max(p), 5) AS p_max, max(CASE WHEN p >= 0.5 THEN 1 ELSE 0 END) AS prediction FROM pr GROUP BY 1""")
def q_batch_score_closed_form(spark, sf):
    """Probabilities and decisions of all orders per value of the one feature,
    as the closed form of the fit gives them."""
    s = _one_feature_scores(spark, sf)
    return tidy(s.groupBy("is_cash").agg(F.count(F.lit(1)).alias("n"), F.min("return_probability").alias("p_min"),
                                         F.max("return_probability").alias("p_max"), F.max("prediction").alias("prediction")), 5)


@register("score_summary_closed_form", ONE_FEATURE_SQL + """
SELECT count(*) AS n_scored, round(avg(CASE WHEN p >= 0.5 THEN 1.0 ELSE 0.0 END), 5) AS positive_rate, round(min(p), 5) AS min_probability,
       round(max(p), 5) AS max_probability, round(avg(p), 5) AS mean_probability, 0.5 AS threshold FROM pr""")
def q_score_summary_closed_form(spark, sf):
    """The summary of the same scores."""
    return tidy(sc.score_summary(_one_feature_scores(spark, sf)), 5)


@register("scoring_audit", """
SELECT count(*) AS n_compared, 0.0 AS max_abs_diff, 0::BIGINT AS n_decision_mismatch FROM orders""")
def q_scoring_audit(spark, sf):
    """Bundle saved, reloaded, re-scored; max |Δp| and mismatches."""
    model, thr, feats, binary = fitted_bundle(spark, sf)
    path = io.scratch_path(spark, "bundle")
    sc.save_bundle(model, spark, path, thr, feats.columns, {"n_train_cols": len(feats.columns)})
    m2, meta = sc.load_bundle(spark, path)
    a = sc.batch_score(model, feats, thr, binary=binary)
    b = sc.batch_score(m2, feats, meta["threshold"], binary=binary)
    return sc.scoring_audit(a, b)


@register("scoring_request_shapes", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'object' WHEN 'O' THEN 'wrapper' ELSE 'list' END AS shape, NULL::VARCHAR AS reject_reason,
       count(*) AS n_orders FROM orders GROUP BY 1""")
def q_request_shapes(spark, sf):
    """Object, list and wrapper payloads all parse to one row per
    order; rejects carry a reason."""
    req = sc.requests_from_tables(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf))
    shape = F.when(F.trim("payload").startswith("["), "list").when(F.col("payload").startswith('{"orders"'), "wrapper").otherwise("object")
    parsed = sc.parse_requests(req.withColumn("shape", shape))
    return parsed.join(req.select("request_id", shape.alias("shape")), "request_id").groupBy("shape", "reject_reason").agg(
        F.count(F.lit(1)).alias("n_orders"))


LANDING_ROWS = 20_000  # gzip files are not split, so a file is what one task reads at least


@register("stream_score", """
SELECT count(*) AS n_streamed, count(DISTINCT o_orderkey) AS n_matched, true AS same_scores, true AS same_decisions FROM orders""")
def q_stream_score(spark, sf):
    """Request files land in a folder, a Structured Streaming query
    (availableNow trigger, checkpoint in the shared folder) parses, builds
    features, scores and writes scores + rejects per micro-batch; facts of the
    streamed scores against batch scores of the same requests. Requests are made
    once and land gzipped in files of ``LANDING_ROWS``; a table, the landed files and
    the shuffles of a step go as soon as no later step reads them."""
    tables = Workspace(spark, "stream-score")
    with released_shuffles(spark):
        model, thr, _feats, binary = fitted_bundle(spark, sf, tables)
        tables.drop(*BUNDLE_TABLES)
        req = tables.save(sc.requests_from_tables(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf)), "requests")
        base = tables.base
        req.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", LANDING_ROWS).json(f"{base}/landing")
        q = start_stream_scoring(spark, f"{base}/landing", retail.products(spark, sf), model, thr, category_levels(spark, sf),
                                 binary, f"{base}/out", f"{base}/checkpoint", rename={"payment_method": "priority"})
        q.awaitTermination()
        tables.drop("landing")
        batch, _rejects = score_requests(req, retail.products(spark, sf), model, thr, category_levels(spark, sf), binary,
                                         rename={"payment_method": "priority"}, tables=tables)
        tables.drop("requests")
        batch = tables.save(batch, "batch_scores")
        tables.drop("orders")
    streamed = spark.read.parquet(f"{base}/out/scores").drop("batch_id")
    j = streamed.alias("s").join(batch.alias("b"), "order_id", "full")
    return j.agg(F.count("s.return_probability").alias("n_streamed"),
                 F.count_if(F.col("s.return_probability").isNotNull() & F.col("b.return_probability").isNotNull()).alias("n_matched"),
                 F.coalesce(F.max(F.abs(F.col("s.return_probability") - F.col("b.return_probability"))) < 1e-12, F.lit(False)).alias("same_scores"),
                 (F.count_if(F.col("s.prediction") != F.col("b.prediction")) == 0).alias("same_decisions"))
