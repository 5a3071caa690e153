"""The ``opN_*`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from pyspark.sql import functions as F

from basketry.llm import (bpe, chat, fim, minhash, mixing, quality, recompress, secrets, simhash, sql, suffix, tokenfile,
                          toxicity, trie)
from basketry.llm.common import Workspace, documents

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


@register("op1_suffix_dedup", sql.OP1)
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of repeated 200-byte strings."""
    found = suffix.repeated_bytes(documents(spark, sf_dir), Workspace(spark, "op1"))
    return suffix.remove_repeats(found).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_source_mix")
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    placed, pieces, _ = mixing.mix(documents(spark, sf_dir), Workspace(spark, "op2"))
    return mixing.taken_words(placed, pieces).select("doc_id", "size", "source_size", "target", "taken")


@register("op3_quality_rules")
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and line labels of every document."""
    docs = documents(spark, sf_dir)
    return quality.judge(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@register("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write token files of all documents and read every document back."""
    work = Workspace(spark, "op4")
    manifest = tokenfile.write(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), END_ID, work)
    return tokenfile.read(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@register("op5_bpe_round_trip")
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    return bpe.digests(bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY)))


@register("op6_near_duplicates", sql.OP6)
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(documents(spark, sf_dir), Workspace(spark, "op6"))


@register("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text; the number of
    fingerprints within three bits for documents whose id divides by 20."""
    work = Workspace(spark, "op7")
    prints = work.save(simhash.compare_with_edits(documents(spark, sf_dir), work), "prints")
    return simhash.with_neighbours(prints, F.col("doc_id") % 20 == 0, radius=3)


def held_out():
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


@register("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    model = toxicity.train(docs, labels, Workspace(spark, "op8"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@register("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and lexed secret spans of every document."""
    return secrets.scan_documents(documents(spark, sf_dir))


@register("op10_recompression", sql.OP10)
def op10_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 50-word windows of earlier ones."""
    found = recompress.repeated_words(documents(spark, sf_dir), Workspace(spark, "op10"))
    return recompress.remove_repeats(found).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@register("op11_prefix_trie", sql.OP11)
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations."""
    return trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), Workspace(spark, "op11"))


@register("op12_chat_format", sql.OP12)
def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted and read back from its format."""
    work = Workspace(spark, "op12")
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    formatted = chat.format_conversations(turns.unionByName(chat.probe(spark)), work)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chat.read_back(formatted).select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2(F.col("masked").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


@register("op13_fill_in_middle", sql.OP13)
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle example of every document, and its text rebuilt."""
    return fim.restored(fim.examples(documents(spark, sf_dir)))
