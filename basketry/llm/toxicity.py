"""Toxicity scores by FTRL-proximal logistic regression over hashed word
n-grams and skip-grams.

A text's features are its distinct lower-cased words, adjacent pairs and pairs
with one word between, hashed into ``2**BITS`` coordinates. FTRL-proximal keeps
a learning rate per coordinate and an L1 term that leaves most weights exactly
zero, so the fitted model is a small sparse vector that is safe to broadcast
(never more than ``2**BITS`` entries).

Training reads at most ``TRAIN_DOCS`` labelled rows (smallest hash of the id).
Their features stay in Spark: in each epoch every shard continues from the same
state, and the coordinate states of the shards are averaged by a Spark
aggregate. Scoring is one pass without shuffle. Null texts count as empty and
score as the bias says; repeated rows each get a result.
"""

from __future__ import annotations

import re
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Workspace, map_rows, released_shuffles

BITS = 20
TRAIN_DOCS, SHARDS, EPOCHS = 24_000, 4, 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 1.0
TOXIC_WEIGHT = 4.0  # toxic rows are the rarer class
BIAS = 0  # coordinate that every text has
_TOKEN = re.compile(r"\w+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class _WordHashes(dict):
    """crc32 of words, remembered up to a bound."""

    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        v = self[word] = crc32(word.encode("utf-8", "replace"))
        return v


_HASHES = _WordHashes()


def features(text: str | None) -> np.ndarray:
    """Sorted distinct coordinates of a text, the bias among them."""
    words = _TOKEN.findall(text.lower()) if text else []
    h = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))

    def place(x, salt):
        x = (x + np.uint64(salt)) * _A
        x ^= x >> np.uint64(32)
        return ((x * _B) >> np.uint64(64 - BITS)).astype(np.int64)

    found = [np.array([BIAS], dtype=np.int64), place(h, 1)]
    if len(h) > 1:
        found.append(place(h[:-1] * _B + h[1:], 2))
    if len(h) > 2:
        found.append(place(h[:-2] * _B + h[2:], 3))
    return np.unique(np.concatenate(found))


class Model(NamedTuple):
    index: np.ndarray
    weight: np.ndarray

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS)
        w[self.index] = self.weight
        return w


def weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights of coordinate states; zero where L1 wins."""
    return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))


def ftrl_pass(rows, z: np.ndarray, n: np.ndarray) -> None:
    """One pass of per-coordinate updates over (coordinates, label) rows."""
    for idx, y in rows:
        zi, ni = z[idx], n[idx]
        w = weights(zi, ni)
        g = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - y
        if y:
            g *= TOXIC_WEIGHT
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
        z[idx] = zi + g - sigma * w
        n[idx] = ni + g * g


def train(documents: DataFrame, labels: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_docs: int = TRAIN_DOCS) -> Model:
    """Fit on at most ``max_docs`` rows of ``labels`` (id, 0/1 label); an id
    labelled twice counts once, as toxic if any row says so. Without rows the
    model is empty and every score is one half."""
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(id_col).agg(F.max(label_col).alias("_label"))
              .orderBy(F.xxhash64(id_col), id_col).limit(max_docs))
    rows = (documents.select(id_col, text_col).join(F.broadcast(chosen), id_col)
            .select((F.pmod(F.xxhash64(id_col), F.lit(SHARDS))).cast("int").alias("shard"),
                    F.xxhash64(id_col, text_col).alias("place"), "_label", text_col))

    def make():
        return lambda shards, places, ys, texts: [shards, places, ys, [features(t).astype("<i4").tobytes() for t in texts]]

    rows = work.save(map_rows(rows, ["shard", "place", "_label", text_col],
                              "shard int, place long, label int, coords binary", make), "train")
    index, z0, n0 = np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(0)
    spark = documents.sparkSession
    for _ in range(EPOCHS):
        state = spark.sparkContext.broadcast((index, z0, n0))  # at most 2**BITS coordinates

        def shard_pass(pdf: pd.DataFrame) -> pd.DataFrame:
            at, zs, ns = state.value
            z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
            z[at], n[at] = zs, ns
            pdf = pdf.sort_values("place")
            ftrl_pass(((np.frombuffer(c, "<i4"), y) for c, y in zip(pdf["coords"], pdf["label"])), z, n)
            live = np.flatnonzero(n)
            return pd.DataFrame({"coord": live, "z": z[live], "n": n[live]})

        with released_shuffles(spark):
            merged = (rows.groupBy("shard").applyInPandas(shard_pass, "coord long, z double, n double")
                      .groupBy("coord").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow())
        state.destroy()
        index, z0, n0 = (merged[c].to_numpy() for c in ("coord", "z", "n"))
        order = np.argsort(index)
        index, z0, n0 = index[order], z0[order] / SHARDS, n0[order] / SHARDS
    w = weights(z0, n0)
    live = np.flatnonzero(w)
    work.drop("train")
    return Model(index[live], w[live])


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``score`` in [0, 1] for every row."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        w = shared.value.dense()

        def step(ids, texts):
            s = [float(w[features(t)].sum()) for t in texts]
            return [ids, [1.0 / (1.0 + np.exp(-min(max(x, -35.0), 35.0))) for x in s]]
        return step

    id_type = df.schema[id_col].dataType.simpleString()
    return map_rows(df, [id_col, text_col], f"{id_col} {id_type}, score double", make)
