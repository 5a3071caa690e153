"""Structured Streaming scoring.

Request payloads arrive as JSON text files in a landing folder (the same
code works for a Kafka ``value`` column). Each micro-batch is parsed
(R05), validated, turned into features (M03, a stream–static join to the
product table) and scored (R01) with the fitted bundle; scores and rejects
go to two parquet sinks through ``foreachBatch`` (idempotent per batch id,
with the checkpoint in the shared checkpoint folder so a restarted query
resumes exactly once). The scoring path is stateless. A micro-batch takes a
bounded amount of landed bytes and leaves nothing behind but its two outputs,
so the disk and memory of a run do not grow with what lies in the folder.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.plans.features import nested_order_features
from basketry.plans.scoring import batch_score, parse_requests
from basketry.session import Workspace, released_shuffles

#: Landed bytes of a micro-batch (as the files are, gzipped or not).
BATCH_BYTES = 256 << 20


def score_requests(raw: DataFrame, products: DataFrame, model: PipelineModel, threshold: float, multihot: dict,
                   binary: list[str], rename: dict | None = None, tables: Workspace | None = None):
    """Shared batch/stream body: raw payload rows → (scores, rejects).
    ``rename`` maps request field names to the model's feature names; ``tables``
    is a workspace for the parsed orders that the caller closes afterwards."""
    return score_parsed(parse_requests(raw), products, model, threshold, multihot, binary, rename, tables)


def score_parsed(parsed: DataFrame, products: DataFrame, model: PipelineModel, threshold: float, multihot: dict,
                 binary: list[str], rename: dict | None = None, tables: Workspace | None = None):
    """(scores, rejects) of parsed requests."""
    rejects = parsed.filter(F.col("reject_reason").isNotNull()).select(
        "request_id", F.col("order.order_id").alias("order_id"), "reject_reason")
    good = parsed.filter(F.col("reject_reason").isNull()).select("order.*")
    feats = nested_order_features(good, products, multihot, tables=tables)
    for src, dst in (rename or {}).items():
        feats = feats.withColumnRenamed(src, dst)
    return batch_score(model, feats, threshold, "order_id", binary), rejects


def start_stream_scoring(spark: SparkSession, landing: str, products: DataFrame, model: PipelineModel,
                         threshold: float, multihot: dict, binary: list[str], out: str, checkpoint: str,
                         available_now: bool = True, rename: dict | None = None, batch_bytes: int = BATCH_BYTES):
    """Start the scoring stream; returns the ``StreamingQuery``. All landed files
    are read, about ``batch_bytes`` of them (one file at least) in a micro-batch.
    Requests that repeat an order id share item categories within one micro-batch."""
    src = spark.readStream.schema("request_id long, payload string").option("maxBytesPerTrigger", batch_bytes).json(landing)

    def write_batch(batch: DataFrame, batch_id: int):
        tables = Workspace(batch.sparkSession, "stream-batch")
        parsed = parse_requests(batch).persist()  # both sinks read one parse
        try:
            with released_shuffles(batch.sparkSession):
                scores, rejects = score_parsed(parsed, products, model, threshold, multihot, binary, rename, tables)
                # A replayed batch id overwrites only its own partition (idempotent sink).
                for name, frame in (("scores", scores), ("rejects", rejects)):
                    frame.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite") \
                        .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{out}/{name}")
        finally:
            parsed.unpersist()
            tables.close()

    w = src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
