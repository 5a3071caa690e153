"""Corpus pipeline: quality rules, near duplicates, secrets, source mix, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents`` (extra columns stay, whatever their
names); every stage works on all rows that the one before kept.

Null and blank texts: they fail the quality rules; rows without words are linked
with nothing and stay in the near-duplicate stage; a null text stays null in the
secret scan; the mix takes no words of them, so they leave; BPE encodes a null as
empty. Repeated rows are one group to the near-duplicate stage and rows of their
own elsewhere; null ids order first but never name a group; an empty table stays
empty."""

from __future__ import annotations

import os
import sys

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.llm import bpe, minhash, mixing, quality, secrets  # noqa: E402
from basketry.llm.common import Workspace, documents  # noqa: E402

VOCABULARY = "byte_bpe_50k.json"
ORACLE_SQL = None  # no stage but the second can be told in SQL; tests hold all five against brute force


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are mostly content.
    The line model is fitted on labelled rows of the pipeline's input."""
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the least id."""
    return minhash.keep_one(docs, Workspace(spark, "pipeline-near"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words: a document of which it
    takes t of its s words stays floor(t / s) times, and once more with the
    chance of the rest (by a hash of its id and text, so reruns agree)."""
    placed, pieces, _ = mixing.mix(docs, Workspace(spark, "pipeline-mix"))
    taken = mixing.taken_words(placed, pieces)
    share = F.col("taken") / F.col("size")
    chance = F.pmod(F.xxhash64("doc_id", "place", F.lit(mixing.SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    times = (taken.where("size > 0").select(F.col("doc_id").alias("__mix_id"), F.col("place").alias("__mix_place"),
                                            F.floor(share + chance).cast("int").alias("__mix_times"))
             .groupBy("__mix_id", "__mix_place").agg(F.max("__mix_times").alias("__mix_times")).where("__mix_times > 0"))
    keyed = docs.withColumn("__mix_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    joined = keyed.join(times, F.col("doc_id").eqNullSafe(F.col("__mix_id")) & (F.col("__mix_hash") == F.col("__mix_place")))
    return (joined.withColumn("__mix_copy", F.explode(F.sequence(F.lit(1), F.col("__mix_times"))))
            .select(*docs.columns))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of every document."""
    return bpe.digests(bpe.round_trip(docs, public_tokenizers.path(VOCABULARY)))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("bpe_tokens", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    work = Workspace(spark, "pipeline")
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = work.save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
