"""What several branches of a query read is made once."""

from pyspark.sql import functions as F

from basketry.plans import features as ft
from basketry.plans.scoring import parse_requests


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_nested_features_parse_requests_once(spark):
    body = '{"order_id": %d, "order_date": "2020-01-02", "items": [{"product_id": "%d", "quantity": 2, "unit_price": 3.0}]}'
    raw = spark.createDataFrame([(i, body % (i // 2, i % 2)) for i in range(4)], "request_id long, payload string")
    products = spark.createDataFrame([("0", "a"), ("1", "b")], "product_id string, category string")
    out = ft.nested_order_features(parse_requests(raw).select("order.*"), products, {"category": ["a", "b"]})
    assert "from_json" not in _plan(out).lower() and "jsontostructs" not in _plan(out).lower()
    rows = out.orderBy("order_id").collect()
    assert [(r.order_id, r.total_quantity, r.category_a, r.category_b) for r in rows] == [(0, 2.0, 1, 1)] * 2 + [(1, 2.0, 1, 1)] * 2


def test_bundle_features_are_joined_once(spark):
    from basketry.plans.queries.q_scoring import fitted_bundle
    from tests.conftest import SF_SMALL
    _model, threshold, feats, _binary = fitted_bundle(spark, SF_SMALL)
    assert "Join" not in _plan(feats) and "Relation" not in _plan(feats)
    assert 0 <= threshold <= 1 and feats.filter(F.col("order_id").isNull()).count() == 0
