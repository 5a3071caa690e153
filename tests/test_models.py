"""Closed forms vs numpy / MLlib, fit-on-train discipline, batch = stream."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators import models, preprocess


def _reg(spark, n=200, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 2.0 + x @ np.array([1.5, -2.0, 0.5]) + rng.normal(scale=0.1, size=n)
    return spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)], "a double, b double, c double, y double"), x, y


def test_ridge_matches_numpy(spark):
    df, x, y = _reg(spark)
    alpha = 5.0
    m = models.ridge_closed_form(df, ["a", "b", "c"], "y", alpha)
    xa = np.hstack([x, np.ones((len(x), 1))])
    pen = alpha * np.eye(4)
    pen[3, 3] = 0.0
    ref = np.linalg.solve(xa.T @ xa + pen, xa.T @ y)
    assert np.allclose(m.coef + [m.intercept], ref, atol=1e-8)


def test_ols_matches_mllib(spark):
    df, _, _ = _reg(spark)
    m = models.ridge_closed_form(df, ["a", "b", "c"], "y", 0.0)
    lr = models.linear_regression(df, ["a", "b", "c"], "y")
    assert np.allclose(m.coef, lr.coefficients.toArray(), atol=1e-6)
    assert m.intercept == pytest.approx(lr.intercept, abs=1e-6)


def test_fit_uses_train_only(spark):
    train = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    valid_a = spark.createDataFrame([(None,), (100.0,)], "x double")
    valid_b = spark.createDataFrame([(None,), (-5.0,), (7.0,)], "x double")
    p = preprocess.Preprocessor(numeric=["x"]).fit(train)
    a = p.transform(valid_a).first()["x"]
    b = p.transform(valid_b).first()["x"]
    assert a == b  # the NULL row is filled and scaled with train statistics only
    assert p.state["median"]["x"] == 2.0


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert preprocess.fit_mode(df, ["c"]).first()["c"] == "a"


def test_one_hot_unknown_is_all_zero(spark):
    df = spark.createDataFrame([("x",), ("y",), ("zz",)], "c string")
    out = preprocess.apply_one_hot(df, "c", ["x", "y"]).collect()
    assert [tuple(r) for r in out] == [(1, 0), (0, 1), (0, 0)]


def test_batch_equals_stream_features(spark):
    """M02 (master table) and M03 (nested requests) give the same features."""
    from basketry.plans import features as ft
    from basketry.plans.queries.q_features import master, spec
    from basketry.plans.queries.q_rollup import PART_TYPES
    from basketry.plans.scoring import parse_requests, requests_from_tables
    from basketry.sources import retail
    sf = "/root/testdata/sf0.001"
    batch = ft.serving_features(master(spark, sf), spec(spark, sf))
    req = requests_from_tables(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf))
    nested = ft.nested_order_features(parse_requests(req).filter("reject_reason IS NULL").select("order.*"),
                                      retail.products(spark, sf), {"category": PART_TYPES}, cash_value="1-urgent")
    nested = nested.withColumnRenamed("payment_method", "priority")
    cols = ["customer_tenure_days", "unique_product_count", "priority", "segment", "tenure_group", "is_cash", "is_discounted",
            *[f"category_{v.lower()}" for v in PART_TYPES]]
    j = batch.alias("b").join(nested.alias("n"), "order_id")
    assert j.count() == batch.count()
    for c in cols:
        assert j.filter(~F.col(f"b.{c}").eqNullSafe(F.col(f"n.{c}"))).count() == 0, c
    for c in ["total_quantity", "discount_ratio", "log_payment_value"]:
        diff = j.filter(F.col(f"b.{c}").isNotNull()).select(F.max(F.abs(F.col(f"b.{c}") - F.col(f"n.{c}")))).first()[0]
        assert diff is None or diff < 1e-9, c


def test_stream_scores_equal_batch_scores(spark, tmp_path):
    """R04 = R01: the Structured Streaming scorer gives the same scores as
    scoring the same nested requests in batch."""
    from basketry.plans import scoring as sc
    from basketry.plans.queries.q_rollup import PART_TYPES
    from basketry.plans.queries.q_scoring import fitted_bundle
    from basketry.sources import retail
    from basketry.streaming.stream_score import score_requests, start_stream_scoring
    sf = "/root/testdata/sf0.001"
    model, thr, _f, binary = fitted_bundle(spark, sf)
    req = sc.requests_from_tables(retail.orders(spark, sf), retail.items(spark, sf), retail.customers(spark, sf))
    req.write.mode("overwrite").json(str(tmp_path / "landing"))
    q = start_stream_scoring(spark, str(tmp_path / "landing"), retail.products(spark, sf), model, thr, {"category": PART_TYPES},
                             binary, str(tmp_path / "out"), str(tmp_path / "ckpt"), rename={"payment_method": "priority"})
    q.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out" / "scores")).drop("batch_id")
    batch, _rej = score_requests(req, retail.products(spark, sf), model, thr, {"category": PART_TYPES}, binary,
                                 rename={"payment_method": "priority"})
    j = streamed.alias("s").join(batch.alias("b"), "order_id", "full")
    assert j.filter(F.col("s.return_probability").isNull() | F.col("b.return_probability").isNull()).count() == 0
    assert j.select(F.max(F.abs(F.col("s.return_probability") - F.col("b.return_probability")))).first()[0] < 1e-12
    assert j.filter(F.col("s.prediction") != F.col("b.prediction")).count() == 0
