"""Mixing sources to target weights in fixed-length token blocks.

1. Pack: the documents of a source, by id, form one stream of words that is cut
   into blocks of ``block`` words; a block is (source, index).
2. Targets: sources in code-point order (null last) weigh 3, 1, 2, repeating,
   and share ``factor`` times all words; a target stops at ``max_epochs`` times
   the source's words and its excess is shared again by weight until none is
   above.
3. Draw: each output shard gets its share of slots; every source receives the
   whole part of its expected count, and the shard's remaining slots are drawn
   from a multinomial over the fractional parts, seeded by (seed, shard).
4. Map: the slots of a source are numbered across shards; slot ``k`` is place
   ``k mod n`` of epoch ``k div n``, and a keyed permutation of the ``n``
   block indices (a Feistel network with cycle walking) says which block that
   is. So no block is used again before all others of its source were.
5. Join slots and blocks by (source, index).

Positions in a source come from sums per (source, id bucket) and a window
inside each bucket, so a source that holds a third of all rows is spread over
many tasks. Targets and draws need one row per source and shard. The same
input and seed give the same mix. Null texts have no words: they are never in a
block and take nothing. Null ids order first; repeated rows are separate
documents. An empty table, or one without words, gives an empty mix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import SPACE_CLASS, Workspace, partitions, ship_package

BLOCK, SHARDS, SEED, FACTOR, MAX_EPOCHS = 128, 64, 20, 1.5, 2
WEIGHT_CYCLE = (3, 1, 2)  # fixed value


def n_words(col):
    """Number of words of a text column (null: 0)."""
    return F.coalesce(F.length(F.regexp_replace(
        F.regexp_replace(col, r"[^\x20\x09-\x0D]+", "x"), SPACE_CLASS, "")), F.lit(0)).cast("long")


def water_fill(sizes: np.ndarray, weights: np.ndarray, total: float, cap: float) -> np.ndarray:
    """Targets in proportion to ``weights`` that stop at ``cap * sizes``; the
    excess is shared again by weight until none is above."""
    target, capped = np.zeros(len(sizes)), np.zeros(len(sizes), dtype=bool)
    while True:
        free = ~capped
        rest = total - cap * sizes[capped].sum()
        if not free.any():
            return target
        target[free] = rest * weights[free] / weights[free].sum()
        over = free & (target > cap * sizes)
        if not over.any():
            return target
        target[over] = cap * sizes[over]
        capped |= over


def source_targets(docs: DataFrame, factor: float = FACTOR, cap: float = MAX_EPOCHS) -> DataFrame:
    """One row per source: ``source, source_no, source_size, weight, target``.
    Names and sizes of the sources are gathered once (one row per source)."""
    spark = docs.sparkSession
    totals = docs.groupBy("source").agg(F.sum("size").alias("source_size")).toPandas()
    rows = sorted(zip(totals["source"], totals["source_size"]), key=lambda r: (r[0] is None, r[0] or ""))
    sizes = np.array([int(r[1]) for r in rows], dtype=float)
    weights = np.array([WEIGHT_CYCLE[i % len(WEIGHT_CYCLE)] for i in range(len(rows))], dtype=float)
    target = water_fill(sizes, weights, factor * sizes.sum(), cap) if len(rows) else sizes
    data = [(r[0], i, int(sizes[i]), float(weights[i]), float(target[i])) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "source string, source_no int, source_size long, weight double, target double")


def positions(sized: DataFrame, buckets: int, order: list[str]) -> DataFrame:
    """Add ``offset``: the words before each document in its source, in
    ``order`` (the first key decides the bucket)."""
    key = F.coalesce(F.col(order[0]).cast("double"), F.lit(float("-inf")))
    if buckets > 1:
        edges = sized.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets)], 1000 * buckets)).first()[0]
        edges = sorted(set(edges or []))
    else:
        edges = []
    edge_array = F.array(*[F.lit(float(e)) for e in edges]) if edges else F.array().cast("array<double>")
    placed = sized.withColumn("_bucket", F.aggregate(edge_array, F.lit(0), lambda n, e: n + F.when(e < key, 1).otherwise(0)))
    per = placed.groupBy("source_no", "_bucket").agg(F.sum("size").alias("_in"))
    w = Window.partitionBy("source_no").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = per.select("source_no", "_bucket", F.coalesce(F.sum("_in").over(w), F.lit(0)).alias("_before"))
    inside = (Window.partitionBy("source_no", "_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order])
              .rowsBetween(Window.unboundedPreceding, -1))
    return (placed.withColumn("_own", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(before, ["source_no", "_bucket"])
            .withColumn("offset", F.col("_before") + F.col("_own")).drop("_bucket", "_before", "_own"))


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutation of 0..n-1 (per element): a four-round Feistel network
    on the next even number of bits, walked until it falls below ``n``."""
    bits = np.maximum(np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64), 2)
    half = ((bits + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.ones(len(index), dtype=bool)
    limit = n.astype(np.uint64)
    while todo.any():
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = x >> h, x & m
        for r in range(4):
            f = (right + k + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15)
            f ^= f >> np.uint64(31)
            f *= np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(29)
            left, right = right, left ^ (f & m)
        out[todo] = (left << h) | right
        todo[todo] = out[todo] >= limit[todo]
    return out.astype(np.int64)


def draw_counts(targets: DataFrame, block: int, shards: int, seed: int, cap: int) -> DataFrame:
    """Slots per (shard, source) with the source's first slot number:
    ``shard, source_no, first_slot, n_slots, n_blocks``. A draw never takes a
    source past ``cap`` whole epochs."""
    spark = targets.sparkSession
    rows = targets.where("source_size > 0").orderBy("source_no").collect()  # one row per source
    if not rows:
        return spark.createDataFrame([], "shard int, source_no int, first_slot long, n_slots long, n_blocks long")
    expected = np.array([r.target / block for r in rows])
    n_blocks = np.array([-(-r.source_size // block) for r in rows], dtype=np.int64)
    total = expected.sum()
    # a short last block makes epochs of a capped source fall short of its words; whole epochs are right there
    whole = np.array([r.target >= cap * r.source_size for r in rows])
    expected = np.where(whole, n_blocks * cap, np.minimum(expected, n_blocks * cap))
    counts = np.zeros((shards, len(rows)), dtype=np.int64)
    done = np.zeros(len(rows))
    for s in range(shards):
        due = expected * (s + 1) / shards - done   # what the shard owes, with what earlier shards left over
        base = np.maximum(np.floor(due + 1e-9), 0).astype(np.int64)
        part = np.clip(due - base, 0, 1)
        n_left = int(round(part.sum()))
        if n_left and s + 1 < shards and part.sum() > 0:
            base = base + np.random.default_rng([seed, s]).multinomial(n_left, part / part.sum())
        elif s + 1 == shards:
            base = np.maximum(np.rint(due), 0).astype(np.int64)
        base = np.minimum(base, n_blocks * cap - done.astype(np.int64))
        counts[s] = base
        done += base
    first = np.cumsum(counts, axis=0) - counts
    data = [(s, r.source_no, int(first[s, i]), int(counts[s, i]), int(n_blocks[i]))
            for s in range(shards) for i, r in enumerate(rows) if counts[s, i]]
    return spark.createDataFrame(data, "shard int, source_no int, first_slot long, n_slots long, n_blocks long")


def slots(counts: DataFrame, seed: int) -> DataFrame:
    """One row per slot: ``shard, source_no, slot, block_no``."""
    ship_package(counts.sparkSession)

    @F.pandas_udf("long")
    def block_of(source_no: pd.Series, slot: pd.Series, n: pd.Series) -> pd.Series:
        n_, s = n.to_numpy(np.int64), slot.to_numpy(np.int64)
        key = (source_no.to_numpy(np.int64) * 1_000_003 + s // n_) * 7_919 + seed
        return pd.Series(permute(s % n_, n_, key))

    step = 65_536
    pieces = counts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_slots") - 1) / step))).alias("_piece"))
    pieces = pieces.repartition(partitions(counts.sparkSession), "shard", "source_no", "_piece")
    lo = F.col("_piece") * step
    each = pieces.select("shard", "source_no", "n_blocks", F.explode(F.sequence(
        F.col("first_slot") + lo, F.col("first_slot") + F.least(lo + step, F.col("n_slots")) - 1)).alias("slot"))
    return each.select("shard", "source_no", "slot", block_of("source_no", "slot", "n_blocks").alias("block_no"))


def mix(docs: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        block: int = BLOCK, shards: int = SHARDS, seed: int = SEED, factor: float = FACTOR,
        max_epochs: int = MAX_EPOCHS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, pieces, slots) of the mix.

    ``documents``: ``doc_id, place, source, size, source_no, source_size,
    target, offset``, a written table with one row per input row. ``pieces``:
    one row per (document, block) overlap with ``n_words`` and ``n_taken``
    (times the block is in the mix). ``slots``: shard, source_no, slot,
    block_no of the whole mix."""
    sized = work.save(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                                  n_words(F.col(text_col)).alias("size"),
                                  F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("place")), "sized")
    targets = source_targets(sized, factor, max_epochs)
    numbered = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = work.save(positions(numbered, partitions(docs.sparkSession), ["doc_id", "place"]), "placed")
    work.drop("sized")
    all_slots = slots(draw_counts(targets, block, shards, seed, max_epochs), seed)
    used = all_slots.groupBy("source_no", "block_no").agg(F.count(F.lit(1)).alias("n_taken"))
    first, last = F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("size") - 1) / block)
    overlap = (placed.where("size > 0")
               .select("doc_id", "place", "source_no", "offset", "size", F.explode(F.sequence(first, last)).alias("block_no"))
               .withColumn("n_words", F.least(F.col("offset") + F.col("size"), (F.col("block_no") + 1) * block)
                           - F.greatest(F.col("offset"), F.col("block_no") * block)))
    pieces = overlap.join(used, ["source_no", "block_no"])
    return placed, pieces, all_slots


def taken_words(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """``taken`` per document (words in the mix, repeats counted), added to
    the rows of ``placed``. A row is told apart by source and offset."""
    per = (pieces.groupBy("source_no", "offset", "doc_id", "place", "size")
           .agg(F.sum(F.col("n_words") * F.col("n_taken")).alias("taken")))
    return (placed.join(per.select("source_no", "offset", F.col("size").alias("_size"), "taken")
                        .withColumnsRenamed({"source_no": "_s", "offset": "_o"}),
                        (F.col("source_no") == F.col("_s")) & (F.col("offset") == F.col("_o")) & (F.col("size") == F.col("_size")),
                        "left")
            .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")).drop("_s", "_o", "_size"))
