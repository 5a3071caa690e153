"""The prefix trie of conversations, with count-min screening.

Conversations of a family share opening turns: conversation c takes the first h
turns of its family's head c - c % ``FAMILY`` in place of its own, h being drawn
from its id. A node is a distinct sequence of first turns (role, text).

1. Turns become two 64-bit names and a byte count; texts go no further. They are
   gathered in segments of ``TURNS_PER_SEGMENT`` turn numbers, so a conversation
   of very many turns is many rows.
2. A prefix is named by the sum, over its turns, of a hash of place and names (two
   sums of 64 bits); sums of earlier segments are added to later ones.
3. Screen: every task counts the names of its prefixes in ``ROWS`` rows of cells;
   the merged cells that were hit twice are one bit each. A count is never too
   small, so a prefix with a cell that was hit once is in one conversation only, and
   so is all that follows it: those tails are emitted where they are found.
4. Only prefixes that may be shared are shuffled and grouped exactly (members, least
   member, greatest length, combined before the shuffle), and joined back to their
   rows. A member that is not the least one of a node adds the bytes of the node to
   ``saved_tokens``; it stops to do so at the node from where it is the least, and
   every distinct last node is counted by its least member. So all figures of a
   subtree are sums over the members of its top, and no round per depth is needed.
5. Ids of the members that end at a node are joined into runs by ranges of ids, and
   the runs are hashed in order as they stream by.

The screen has 2^``MIN_BITS`` to 2^``MAX_BITS`` cells a row, about two for each prefix;
it is broadcast as bits (at most 2^``MAX_BITS`` * ``ROWS`` / 8 bytes, 32 MB). With more
prefixes than that more of them are grouped exactly; results do not change.

Null roles and texts are empty; a null turn is first; rows of equal turn are in the
order of their names, and repeated rows are turns of their own. Rows without a
conversation id belong to no conversation and make no nodes. An empty table has no
nodes, not even a root. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import tokens
from basketry.llm.common import Workspace, leave_others, partitions, ship_package

# How families share their opening turns.
FAMILY, HEADS = 5, 9

TURNS_PER_SEGMENT = 512
ROWS, MIN_BITS, MAX_BITS = 4, 12, 26
_BLOCK = 1 << 16                     # cells whose counts travel together
_HELD = 1 << 20                      # cells that a task holds before it sends them
IDS_PER_RUN = 4_096
_NODE = ["depth", "a", "b"]


def heads_taken(conv: Column) -> Column:
    """How many opening turns a conversation takes from its family's head."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def segments(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, segment, before, total, items``: the turns of a range of turn
    numbers in order, how many come before them and how many there are in all."""
    known = turns.where(F.col(conv).isNotNull())
    part = F.coalesce(F.floor(F.col(turn) / TURNS_PER_SEGMENT), F.lit(-(1 << 62))).alias("segment")
    said = [F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))]
    names = [F.xxhash64(F.lit(seed), *said).alias(n) for seed, n in ((1, "x"), (2, "y"))]
    item = F.struct(F.col(turn).alias("turn"), *names, F.octet_length(said[1]).cast("long").alias("bytes"))
    sizes = known.select(F.col(conv).alias("conv"), part).groupBy("conv", "segment").agg(F.count(F.lit(1)).alias("n"))
    of = Window.partitionBy("conv")
    earlier = of.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select("conv", "segment", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(of).alias("total"))
    items = known.select(F.col(conv).alias("conv"), part, item.alias("item")).groupBy("conv", "segment").agg(
        F.sort_array(F.collect_list("item")).alias("items"))
    return items.join(placed, ["conv", "segment"]).select(
        "conv", "segment", "before", "total", F.transform("items", lambda i: i.dropFields("turn")).alias("items"))


def rebuilt(parts: DataFrame) -> DataFrame:
    """``conv, segment, length, at, items``: segments of the conversations with
    their family's opening turns; ``at`` counts the turns before the segment."""
    family = F.col("conv") - F.col("conv") % FAMILY
    openings = (parts.where((F.col("conv") % FAMILY == 0) & (F.col("before") < HEADS - 1))
                .select("conv", "segment", F.slice("items", 1, HEADS - 1).alias("items"))
                .groupBy(F.col("conv").alias("family")).agg(F.sort_array(F.collect_list(F.struct("segment", "items"))).alias("found"))
                .select("family", F.flatten("found.items").alias("opening")))
    own = parts.withColumn("family", family).withColumn("h", heads_taken(F.col("conv")).cast("int")).join(openings, "family", "left")
    taken = F.when(F.col("opening").isNull(), F.slice("items", 1, 0)).otherwise(F.slice("opening", F.lit(1), F.col("h")))
    own = own.withColumn("taken", taken)
    skip = F.least(F.greatest(F.col("h") - F.col("before"), F.lit(0)), F.size("items")).cast("int")
    left = F.slice("items", skip + 1, F.size("items"))
    n_taken = F.size("taken").cast("long")
    first = F.col("before") == 0
    return own.select(
        "conv", "segment", (n_taken + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("length"),
        F.when(first, F.lit(0).cast("long")).otherwise(n_taken + F.greatest(F.col("before") - F.col("h"), F.lit(0))).alias("at"),
        F.when(first, F.concat("taken", left)).otherwise(left).alias("items"))


def _names(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """Of a batch with ``at`` and ``items``: offsets of the rows' turns, the place
    of every turn, its bytes, and its summand of either name."""
    items = batch.column(batch.schema.get_field_index("items"))
    offsets = items.offsets.to_numpy()
    inner = items.values
    x, y, size = (inner.field(k).to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]] for k in range(3))
    offsets = offsets - offsets[0]
    at = batch.column(batch.schema.get_field_index("at")).to_numpy()
    place = np.arange(offsets[-1], dtype=np.int64) + np.repeat(at - offsets[:-1], np.diff(offsets)) + 1
    salt = tokens.mix(place.astype(np.uint64))
    return offsets, place, size, tokens.mix(x.view(np.uint64) ^ salt), tokens.mix(y.view(np.uint64) + salt)


def _running(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at every offset."""
    sums = np.cumsum(values)
    starts = offsets[:-1][np.diff(offsets) > 0]
    if not len(starts):
        return sums
    base = np.concatenate([sums[:1] - sums[:1], sums])[starts]
    return sums - np.repeat(base, np.diff(np.append(starts, len(values))))


def prefixes(paths: DataFrame) -> DataFrame:
    """``conv, length, at, path``: per segment the prefixes that end in it, as
    arrays of the two names (``a, b``) and of the bytes so far, and the bytes of
    each last turn. Earlier segments' sums are added to later ones'."""
    def totals(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            offsets, _, size, x, y = _names(batch)
            ends = [np.concatenate([v[:1] - v[:1], np.cumsum(v)]) for v in (x, y, size.astype(np.uint64))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array((e[offsets[1:]] - e[offsets[:-1]]).view(np.int64)) for e in ends)],
                names=["conv", "segment", "a", "b", "bytes"])

    several = paths.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("conv")
    ship_package(paths.sparkSession)
    sums = paths.join(several, "conv", "left_semi").select("conv", "segment", "at", "items").mapInArrow(
        totals, "conv long, segment long, a long, b long, bytes long")
    earlier = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)

    def carried(name):
        turn = F.expr(f"cast('{1 << 64}' as decimal(38,0))")
        wrapped = F.pmod(F.sum(F.col(name).cast("decimal(38,0)")).over(earlier), turn)
        signed = F.when(wrapped >= F.expr(f"cast('{1 << 63}' as decimal(38,0))"), wrapped - turn).otherwise(wrapped)
        return F.coalesce(signed.cast("long"), F.lit(0)).alias(f"carry_{name}")

    carry = sums.select("conv", "segment", carried("a"), carried("b"), carried("bytes"))
    whole = paths.join(carry, ["conv", "segment"], "left").select(
        "conv", "length", "at", "items", *(F.coalesce(f"carry_{n}", F.lit(0)).alias(f"carry_{n}") for n in ("a", "b", "bytes")))

    def run(batches: Iterator[pa.RecordBatch]):
        leave_others()
        for batch in batches:
            offsets, _, size, x, y = _names(batch)
            out = []
            for values, col in ((x, 4), (y, 5), (size.astype(np.uint64), 6)):
                start = np.repeat(batch.column(col).to_numpy().view(np.uint64), np.diff(offsets))
                out.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array((_running(values, offsets) + start).view(np.int64))))
            out.append(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(size)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *out], names=["conv", "length", "at", "a", "b", "upto", "bytes"])

    return whole.mapInArrow(run, "conv long, length long, at long, a array<long>, b array<long>, upto array<long>, bytes array<long>")


def _cells(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """The cells of prefixes, one line per row of the screen."""
    a, b = a.view(np.uint64), b.view(np.uint64)
    hashed = np.stack([tokens.mix(a + np.uint64(2 * r + 1) * b) for r in range(ROWS)])
    return (hashed >> np.uint64(64 - bits)).astype(np.int64) + (np.arange(ROWS, dtype=np.int64) << bits)[:, None]


def screen(paths: DataFrame, n_prefixes: int) -> tuple[int, dict[int, bytes]]:
    """``bits`` and, by number of the block, one bit per cell that was hit twice
    or more (blocks without such a cell are left out)."""
    bits = min(MAX_BITS, max(MIN_BITS, (2 * n_prefixes).bit_length()))

    def count(batches: Iterator[pa.RecordBatch]):
        leave_others()

        def send(held):
            cells, times = np.unique(np.concatenate(held), return_counts=True)
            block, starts = np.unique(cells // _BLOCK, return_index=True)
            parts = np.split(np.arange(len(cells)), starts[1:])
            inner = (cells % _BLOCK).astype(np.uint16)
            return pa.RecordBatch.from_arrays(
                [pa.array(block, pa.int64()), pa.array([inner[p].tobytes() for p in parts], pa.binary()),
                 pa.array([np.packbits(times[p] > 1).tobytes() for p in parts], pa.binary())], names=["block", "cells", "twice"])

        held, n = [], 0
        for batch in batches:
            a, b = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in range(2))
            if len(a):
                held.append(_cells(a, b, bits).ravel())
                n += held[-1].size
            if n > _HELD:
                yield send(held)
                held, n = [], 0
        if held:
            yield send(held)

    def merge(batches: Iterator[pa.RecordBatch]):
        now, counts = None, None
        for batch in batches:
            for block, cells, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    if now is not None and (counts > 1).any():
                        yield _block_row(now, counts)
                    now, counts = block, np.zeros(_BLOCK, dtype=np.uint8)
                at = np.frombuffer(cells, dtype=np.uint16)
                more = np.unpackbits(np.frombuffer(twice, dtype=np.uint8), count=len(at))
                counts[at] = np.minimum(counts[at] + 1 + more, 2)  # cells of a row differ
        if now is not None and (counts > 1).any():
            yield _block_row(now, counts)

    ship_package(paths.sparkSession)
    sent = paths.select("a", "b").mapInArrow(count, "block long, cells binary, twice binary")
    blocks = sent.repartition(partitions(paths.sparkSession), "block").sortWithinPartitions("block").mapInArrow(merge, "block long, hit binary")
    return bits, {r["block"]: bytes(r["hit"]) for r in blocks.collect()}  # at most 2^MAX_BITS * ROWS bits


def _block_row(block: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([np.packbits(counts > 1).tobytes()], pa.binary())],
                                      names=["block", "hit"])


def screened(paths: DataFrame, n_prefixes: int) -> DataFrame:
    """``paths`` with ``shared``: how many of a segment's prefixes may be shared (those before the first proven singleton)."""
    bits, hit = screen(paths, n_prefixes)
    known = paths.sparkSession.sparkContext.broadcast((bits, hit))

    def run(batches: Iterator[pa.RecordBatch]):
        leave_others()
        bits, hit = known.value
        flags = np.zeros(ROWS << bits, dtype=bool)
        for block, packed in hit.items():
            part = np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(bool)[:len(flags) - block * _BLOCK]
            flags[block * _BLOCK:block * _BLOCK + len(part)] = part
        for batch in batches:
            a, b = batch.column(3), batch.column(4)
            offsets = a.offsets.to_numpy() - a.offsets.to_numpy()[0]
            names = [c.flatten().to_numpy(zero_copy_only=False) for c in (a, b)]
            single = ~flags[_cells(*names, bits)].all(axis=0) if len(names[0]) else np.zeros(0, dtype=bool)
            at = np.append(np.flatnonzero(single), len(single))
            first = np.minimum(at[np.searchsorted(at, offsets[:-1])], offsets[1:]) - offsets[:-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(first, pa.int32())], names=[*batch.schema.names, "shared"])

    return paths.mapInArrow(run, "conv long, length long, at long, a array<long>, b array<long>, upto array<long>, bytes array<long>, shared int")


def ends_hash(ended: DataFrame) -> DataFrame:
    """``depth, a, b, ends``: SHA-256 of the ids of ``conv`` per node, ascending
    and joined by commas. Runs of ids are joined first, then hashed as they
    stream by in order, so a node's ids are never held together."""
    runs = (ended.groupBy(*_NODE, F.floor(F.col("conv") / IDS_PER_RUN).alias("run"))
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")))
    ordered = runs.repartition(partitions(ended.sparkSession), *_NODE).sortWithinPartitions(*_NODE, "run")

    def run(batches: Iterator[pa.RecordBatch]):
        leave_others()
        now, state = None, None
        for batch in batches:
            done = []
            for *node, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield _ends(done)
        if now is not None:
            yield _ends([(*now, state.hexdigest())])

    ship_package(ended.sparkSession)
    return ordered.select(*_NODE, "run", "ids").mapInArrow(run, "depth long, a long, b long, ends string")


def _ends(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[*_NODE, "ends"])


def nodes(paths: DataFrame, work: Workspace) -> DataFrame:
    """One row per node of the trie of ``prefixes``."""
    n_prefixes = paths.agg(F.coalesce(F.sum(F.size("a")), F.lit(0))).first()[0]
    paths = work.save(screened(paths, n_prefixes), "screened")
    work.drop("prefixes")
    lone = F.sha2(F.col("conv").cast("string").cast("binary"), 256)
    nobody = F.sha2(F.lit("").cast("binary"), 256)

    # exact grouping of what may be shared
    some = paths.where("shared > 0").select("conv", "length", "at", F.posexplode(F.slice(F.arrays_zip("a", "b", "upto", "bytes"), F.lit(1), F.col("shared"))).alias("i", "p"))
    posts = some.select((F.col("at") + F.col("i") + 1).alias("depth"), "p.a", "p.b", "conv", "length", "p.upto", "p.bytes")
    groups = work.save(posts.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("owner"), F.max("length").alias("longest")), "groups")
    seen = work.save(posts.join(groups, _NODE), "seen")
    work.drop("groups")

    # what every member adds to the nodes on its path
    convs = paths.groupBy("conv").agg(F.max("length").alias("length"))
    everybody = convs.agg(F.min("conv").alias("first"), F.max("length").alias("deepest")).first()
    foreign = F.col("owner") < F.col("conv")
    own = seen.groupBy("conv").agg(F.max(F.when(foreign, F.col("depth"))).alias("last"), F.max(F.when(foreign, F.col("upto"))).alias("lent"),
                                   F.max_by("owner", F.when(foreign, F.col("depth"))).alias("above"),
                                   F.max(F.when(F.col("depth") == F.col("length"), F.col("longest"))).alias("beyond"))
    first = F.col("conv") == F.lit(everybody["first"])
    ends_at = F.coalesce("beyond", F.when(F.col("length") == 0, F.lit(everybody["deepest"])).otherwise(F.col("length")))
    last = F.coalesce("last", F.when(first, F.lit(-1)).otherwise(F.lit(0))).cast("long")
    mine = convs.join(own, "conv", "left").select(
        "conv", "length", last.alias("last"), F.coalesce("lent", F.lit(0)).alias("lent"),
        F.when(~first, F.coalesce(F.when(F.col("last").isNotNull(), F.col("above")), F.lit(everybody["first"]))).alias("above"),
        ((last < F.col("length")) & (ends_at == F.col("length"))).cast("long").alias("leaf"))
    mine = work.save(mine, "members")
    has_child = ((F.col("length") > F.col("depth")) & (F.col("last") <= F.col("depth"))).cast("long")
    parent = F.when(F.col("depth") - 1 == F.col("last"), F.col("above")).otherwise(F.col("conv"))

    shared = (seen.join(mine.drop("length"), "conv").groupBy(*_NODE).agg(
        F.max("owner").alias("conv_id"), F.max(F.when(F.col("conv") == F.col("owner"), parent)).alias("parent_conv_id"),
        F.max("n_convs").alias("n_convs"), F.sum(has_child).alias("n_children"), F.sum("leaf").alias("n_leaves"),
        F.sum(F.when(F.col("last") >= F.col("depth"), F.col("lent") - F.col("upto") + F.col("bytes")).otherwise(F.lit(0))).alias("saved_tokens")))
    root = [F.lit(0).cast("long").alias(n) for n in _NODE]
    top = mine.agg(F.min("conv").alias("conv_id"), F.lit(None).cast("long").alias("parent_conv_id"), F.count(F.lit(1)).alias("n_convs"),
                   F.sum(((F.col("length") > 0) & (F.col("last") <= 0)).cast("long")).alias("n_children"),
                   F.sum("leaf").alias("n_leaves"), F.sum("lent").alias("saved_tokens")).where("n_convs > 0").select(*root, "*")
    ended = seen.where("depth = length").select(*_NODE, "conv").unionByName(mine.where("length = 0").select(*root, "conv"))
    exact = (shared.unionByName(top).join(ends_hash(ended), _NODE, "left")
             .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", nobody).alias("ends_sha256")))

    # tails of one conversation, as they are
    tails = (paths.where(F.size("a") > F.col("shared")).select("conv", (F.col("at") + F.col("shared") + 1).alias("lo"), (F.col("at") + F.size("a")).alias("hi"))
             .join(mine, "conv").withColumn("depth", F.explode(F.sequence("lo", "hi")))
             .select(F.col("conv").alias("conv_id"), "depth", parent.alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"),
                     (F.col("depth") < F.col("length")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                     F.lit(0).cast("long").alias("saved_tokens"), F.when(F.col("depth") == F.col("length"), lone).otherwise(nobody).alias("ends_sha256")))
    return exact.unionByName(tails)


def conversation_trie(turns: DataFrame, work: Workspace) -> DataFrame:
    """The nodes of ``turns`` (conv_id, turn, role, text) after the families'
    opening turns are put in place."""
    parts = work.save(segments(turns), "segments")
    paths = work.save(rebuilt(parts), "rebuilt")
    work.drop("segments")
    named = work.save(prefixes(paths), "prefixes")
    work.drop("rebuilt")
    return nodes(named, work)
