"""Batch scoring, request parsing and model bundles (§2.18)."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.plans.features import ORDER_SCHEMA


def fit_scoring_pipeline(train: DataFrame, numeric: list[str], categorical: list[str], binary: list[str], label: str,
                         weight: str | None = None, **lr_params) -> PipelineModel:
    """Fitted bundle: median imputer → scaler (numeric), string index +
    one-hot with an unknown slot (categorical), assembler, weighted logistic
    regression. Fit touches train only; the bundle is a ``PipelineModel``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
    from basketry.operators.imputer import MedianImputer
    stages = []
    if numeric:
        imp_out = [f"{c}__imp" for c in numeric]
        stages.append(MedianImputer(inputCols=numeric, outputCols=imp_out))
        stages.append(VectorAssembler(inputCols=imp_out, outputCol="_num", handleInvalid="keep"))
        stages.append(StandardScaler(inputCol="_num", outputCol="_num_s", withMean=True, withStd=True))
    idx = [f"{c}__idx" for c in categorical]
    ohe = [f"{c}__ohe" for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=idx, handleInvalid="keep", stringOrderType="alphabetAsc"))
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep", dropLast=True))
    stages.append(VectorAssembler(inputCols=[*(["_num_s"] if numeric else []), *ohe, *binary], outputCol="features", handleInvalid="keep"))
    lr = LogisticRegression(featuresCol="features", labelCol=label, **lr_params)
    if weight:
        lr = lr.setWeightCol(weight)
    stages.append(lr)
    prep = train.na.fill(0, subset=binary) if binary else train
    return Pipeline(stages=stages).fit(prep)


def batch_score(model: PipelineModel, df: DataFrame, threshold: float, key: str = "order_id",
                binary: list[str] = ()) -> DataFrame:
    """One row per order: probability of the positive class and the
    0/1 decision at the locked threshold."""
    d = df.na.fill(0, subset=list(binary)) if binary else df
    s = model.transform(d)
    p = vector_to_array("probability")[1]
    return s.select(key, p.alias("return_probability"), (p >= threshold).cast("int").alias("prediction"),
                    F.lit(float(threshold)).alias("threshold"))


def score_summary(scored: DataFrame) -> DataFrame:
    """N, positive rate, min / max / mean probability, threshold."""
    return scored.agg(F.count(F.lit(1)).alias("n_scored"), F.avg("prediction").alias("positive_rate"),
                      F.min("return_probability").alias("min_probability"), F.max("return_probability").alias("max_probability"),
                      F.avg("return_probability").alias("mean_probability"), F.max("threshold").alias("threshold"))


def save_bundle(model: PipelineModel, spark: SparkSession, path: str, threshold: float, features: list[str], summary: dict):
    """Model bundle: PipelineModel directory + one-row metadata table
    (threshold stored with the model, not as a code constant)."""
    model.write().overwrite().save(f"{path}/model")
    meta = {"threshold": threshold, "features": features, "summary": summary}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").write.mode("overwrite").json(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str):
    model = PipelineModel.load(f"{path}/model")
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    return model, meta


def scoring_audit(original: DataFrame, reloaded: DataFrame, key: str = "order_id") -> DataFrame:
    """Scores of the reloaded bundle equal the original ones: rows
    compared, max |Δp| and decision mismatches."""
    j = original.alias("a").join(reloaded.alias("b"), key)
    return j.agg(F.count(F.lit(1)).alias("n_compared"),
                 F.max(F.abs(F.col("a.return_probability") - F.col("b.return_probability"))).alias("max_abs_diff"),
                 F.count_if(F.col("a.prediction") != F.col("b.prediction")).alias("n_decision_mismatch"))


WRAPPER_KEYS = ["orders", "records", "data"]


def parse_requests(raw: DataFrame, payload: str = "payload", request_id: str = "request_id") -> DataFrame:
    """Payloads may be one order object, a list of orders, or a wrapper
    with a list under "orders", "records" or "data" (the first of these that
    holds a list, wherever it stands in the object) — all become one row per
    order, with a ``reject_reason`` (empty request, missing order_id,
    unparseable). An object whose wrapper key holds no list is one order."""
    arr_t = T.ArrayType(ORDER_SCHEMA)
    txt = F.trim(F.col(payload))
    parsed = F.try_parse_json(txt)

    def holds_list(k):
        return F.coalesce(F.schema_of_variant(F.try_variant_get(F.col("_v"), f"$.{k}", "variant")).startswith("ARRAY"), F.lit(False))

    p = raw.select(request_id, txt.alias("_t"), parsed.alias("_v"))
    is_object = F.col("_t").startswith("{") & F.col("_v").isNotNull()
    listed = F.coalesce(F.when(F.col("_t").startswith("["), F.col("_t")),
                        *[F.when(is_object & holds_list(k), F.get_json_object("_t", f"$.{k}")) for k in WRAPPER_KEYS])
    p = p.select(request_id, "_t", listed.alias("_l"), is_object.alias("_o"))
    orders = F.when(F.col("_l").isNotNull(), F.from_json("_l", arr_t)).when(F.col("_o"), F.array(F.from_json("_t", ORDER_SCHEMA)))
    p = p.select(request_id, orders.alias("_orders"))
    # one pass: explode_outer keeps a single NULL row for empty / unparseable requests
    req_reason = F.when(F.col("_orders").isNull(), "unparseable").when(F.size("_orders") == 0, "empty_request")
    rows = p.select(request_id, req_reason.alias("_rr"), F.explode_outer("_orders").alias("order"))
    reason = F.coalesce(F.col("_rr"), F.when(F.col("order.order_id").isNull(), "missing_order_id"))
    return rows.select(request_id, "order", reason.alias("reject_reason"))


def requests_from_tables(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Stand-in request payloads in the nested schema built from the order
    tables: one JSON per order — finished orders as a bare object, open
    orders in an {"orders": [...]} wrapper, partial ones as a list. Item lists
    are joined last: no join shuffles them by another key."""
    it = items.groupBy("order_id").agg(F.collect_list(F.struct(
        F.col("product_id").cast("double").cast("string").alias("product_id"), F.col("quantity"), F.col("unit_price"),
        F.col("discount_amount"))).alias("items"))
    first = orders.groupBy("customer_id").agg(F.min("order_date").alias("first_order_date"))
    o = orders.join(first, "customer_id", "left").join(customers.select("customer_id", "segment"), "customer_id", "left").join(it, "order_id", "left")
    obj = F.struct(F.col("order_id"), F.col("order_date").cast("string").alias("order_date"),
                   F.col("first_order_date").cast("string").alias("first_order_date"),
                   F.struct(F.col("customer_id"), F.col("segment")).alias("customer"),
                   F.col("priority").alias("payment_method"), F.col("order_status").alias("device_type"),
                   F.struct(F.col("payment_value")).alias("payment"), F.col("items"))
    payload = F.when(F.col("order_status") == "F", F.to_json(obj)) \
        .when(F.col("order_status") == "O", F.to_json(F.struct(F.array(obj).alias("orders")))) \
        .otherwise(F.to_json(F.array(obj)))
    return o.select(F.col("order_id").alias("request_id"), payload.alias("payload"))
