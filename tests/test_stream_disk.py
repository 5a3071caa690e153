"""The stream query keeps on disk only what a later step reads."""

import os
from pathlib import Path

from pyspark.sql import functions as F

from basketry.plans import features as ft
from basketry.plans import scoring as sc
from basketry.plans.queries import q_scoring
from basketry.plans.queries.q_features import master
from basketry.session import Workspace, ensure_checkpoint_dir
from basketry.sources import retail
from basketry.streaming.stream_score import score_requests, start_stream_scoring
from tests.conftest import SF_SMALL


def _folder(spark):
    return Path(ensure_checkpoint_dir(spark).removeprefix("file:"))


def test_stream_takes_bounded_batches_and_drops_their_tables(spark, tmp_path):
    body = '{"order_id": %d, "order_date": "2020-01-02", "payment_value": %d.5, "items": [{"product_id": "%d", "quantity": %d, "unit_price": 3.0}]}'
    rows = [(i, body % (i, i, i % 2, 1 + i % 5)) for i in range(40)] + [(40, "no json")]
    raw = spark.createDataFrame(rows, "request_id long, payload string").repartition(4, "request_id")
    products = spark.createDataFrame([("0", "a"), ("1", "b")], "product_id string, category string")
    levels, binary = {"category": ["a", "b"]}, ["category_a", "category_b"]
    feats = ft.nested_order_features(sc.parse_requests(raw).filter("reject_reason IS NULL").select("order.*"), products, levels)
    model = sc.fit_scoring_pipeline(feats.withColumn("label", (F.col("order_id") % 3 == 0).cast("int")), ["total_quantity"], [], binary, "label", maxIter=5)
    raw.write.option("compression", "gzip").json(str(tmp_path / "landing"))
    files = list((tmp_path / "landing").glob("*.json.gz"))
    before = set(os.listdir(_folder(spark)))
    start_stream_scoring(spark, str(tmp_path / "landing"), products, model, 0.3, levels, binary, str(tmp_path / "out"),
                         str(tmp_path / "ckpt"), batch_bytes=1).awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "out" / "scores"))
    assert len(files) > 1 and streamed.select("batch_id").distinct().count() == len(files)
    assert set(os.listdir(_folder(spark))) <= before
    with_tables = Workspace(spark, "test-batch")
    batch, _rejects = score_requests(raw, products, model, 0.3, levels, binary, tables=with_tables)
    key = ["order_id", "return_probability", "prediction", "threshold"]
    assert sorted(map(tuple, streamed.select(key).collect())) == sorted(map(tuple, batch.select(key).collect()))
    assert [r.request_id for r in spark.read.parquet(str(tmp_path / "out" / "rejects")).collect()] == [40]
    with_tables.close()
    assert set(os.listdir(_folder(spark))) <= before


def test_stream_query_lands_gzipped_and_drops_what_is_read(spark, monkeypatch):
    made, landed = [], []

    class Noted(Workspace):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(Path(self.base.removeprefix("file:")))

    def noting(session, landing, *args, **kw):
        landed.extend(p.name for p in Path(landing.removeprefix("file:")).iterdir() if p.name.startswith("part-"))
        return start_stream_scoring(session, landing, *args, **kw)

    monkeypatch.setattr(q_scoring, "Workspace", Noted)
    monkeypatch.setattr(q_scoring, "start_stream_scoring", noting)
    n = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    out = q_scoring.q_stream_score(spark, SF_SMALL)
    assert landed and all(name.endswith(".json.gz") for name in landed)
    assert sorted(os.listdir(made[0])) == ["batch_scores", "checkpoint", "out"]
    assert tuple(out.first()) == (n, n, True, True)


def _top_join(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return next(line for line in plan.splitlines() if "Join " in line)


def test_item_rows_join_last_and_orders_before(spark):
    """Item rows meet orders last, so neither is shuffled by another key after that."""
    assert "order_id" in _top_join(master(spark, SF_SMALL))
    tables = [read(spark, SF_SMALL) for read in (retail.orders, retail.items, retail.customers)]
    assert "order_id" in _top_join(sc.requests_from_tables(*tables))


def test_requests_keep_repeated_and_missing_keys(spark):
    orders = spark.sql("""SELECT CAST(c[0] AS BIGINT) AS order_id, CAST(c[1] AS BIGINT) AS customer_id, date'2020-01-01' AS order_date, 'F' AS order_status,
        1.0D AS payment_value, 'x' AS priority FROM VALUES (array('1', '7')), (array('1', '7')), (array('2', NULL)), (array(NULL, '7')) AS t(c)""")
    items = spark.createDataFrame([(1, 5, 2.0, 3.0, 0.0), (1, 6, 1.0, 3.0, 0.0), (None, 6, 1.0, 3.0, 0.0)],
                                  "order_id long, product_id long, quantity double, unit_price double, discount_amount double")
    customers = spark.createDataFrame([(7, "a"), (7, "b"), (8, "c")], "customer_id long, segment string")
    got = sc.parse_requests(sc.requests_from_tables(orders, items, customers)).select(
        "request_id", "order.customer.segment", F.size("order.items").alias("n"), "reject_reason").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [
        (1, "a", 2, None), (1, "b", 2, None), (1, "a", 2, None), (1, "b", 2, None), (2, None, None, None),
        (None, "a", None, "missing_order_id"), (None, "b", None, "missing_order_id")]))
