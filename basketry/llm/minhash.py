"""Near-duplicate documents by an inverted join on MinHash coordinates.

1. Sets: the distinct five-word shingles of every text (letters A-Z lowered;
   a text of fewer words is one shingle). Texts with equal sets become one
   node with members.
2. Signatures: ``COORDS`` coordinates, each the least value of the set under
   one multiplication; two sets of similarity s agree on a share of about s.
3. Postings: every node is posted under each (coordinate, value); postings
   without a partner go. Two nodes that agree on ``MATCHES`` coordinates must
   share one of the first ``COORDS - MATCHES + 1`` postings when each node's
   are ordered from rare to common, so only that prefix is kept: very common
   values drop out of it, and nodes with fewer than ``MATCHES`` shared
   postings altogether are skipped.
4. Merge: along every list the collisions of its pairs are counted over all
   coordinates, from one byte of each (never too few); pairs below ``MATCHES``
   are skipped. Lists longer than ``LIST_NODES`` are cut into blocks and every pair of
   blocks is a unit. No text or set takes part: a posting carries 64 bytes.
5. Confirm: nodes that such pairs connect form a group; its nodes are dealt into
   blocks and every pair of blocks is one unit of work of bounded size, which
   gets the full sets, counts collisions on whole coordinates and confirms
   100 * shared >= 75 * union. A unit returns links that span what it found
   connected, so copies never become all pairs. There are at most as many blocks
   as nodes, so a few very long texts are written a few times only.
6. Components of the links; every document gets the least id of its component.

At similarity 0.75 the chance that a link has fewer than 26 of 64 agreements
is 1.3e-9 (binomial tail; 28 would give 2.5e-8, 32 4.6e-6), and such a link is
only lost if no other path joins its ends; of 20,000 pairs made at similarity 0.75
the fewest agreements are far above 26 (tests). Texts that share passages but are no
near copies meet in lists only: what is written for them is in proportion to
their number as long as no list is longer than ``LIST_NODES``, and grows with the
square of a longer list divided by it.

Nulls and texts without words have empty sets and are linked with nothing; a null
id is never a component's name; repeated rows are members of the same node; an
empty table gives an empty result; a unit holds the sets of two blocks, so memory is
bounded by the block or by the two longest texts; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm import tokens
from basketry.llm.common import Workspace, map_rows, partitions, ship_package
from basketry.llm.components import components

SHINGLE, COORDS, MATCHES = 5, 64, 26
SIMILARITY = 75                      # percent
LIST_NODES = 512
BLOCK_NODES, BLOCK_SHINGLES = 64, 256_000
_FACTORS = tokens.mix(np.arange(1, COORDS + 1, dtype=np.uint64)) | np.uint64(1)
_STEP = 4_096


def shingle_sets(texts: list[str | None], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle names of each text."""
    data = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    out = []
    for lo, hi in tokens.buffers(data):
        names, _, _, bounds = tokens.words(data[lo:hi])
        shingles = tokens.window_names(names, width)
        for a, z in zip(bounds[:-1], bounds[1:]):
            if z - a >= width:
                out.append(np.unique(shingles[a:z - width + 1]))
            else:
                out.append(tokens.window_names(names[a:z], int(z - a)) if z > a else np.zeros(0, dtype=np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(COORDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(shingles), _STEP):
        np.minimum(least, (shingles[i:i + _STEP, None] * _FACTORS).min(axis=0), out=least)
    return least


def sketch(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, place, set_hash, n_shingles, sig`` of every row, and ``tag``, the
    low byte of every coordinate."""
    def make():
        def step(ids, places, texts):
            sets = shingle_sets(texts)
            sigs = [signature(s) if len(s) else None for s in sets]
            return [ids, places, [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], [len(s) for s in sets],
                    [None if s is None else s.view(np.int64) for s in sigs], [None if s is None else s.astype(np.uint8).tobytes() for s in sigs]]
        return step

    placed = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("place"), F.col(text_col).alias("text"))
    id_type = df.schema[id_col].dataType.simpleString()
    return map_rows(placed, ["doc_id", "place", "text"],
                    f"doc_id {id_type}, place long, set_hash binary, n_shingles long, sig array<long>, tag binary", make)


def prefix_postings(nodes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """``key, node, n``: each node's rarest shared postings, as many as a pair
    with ``matches`` agreements cannot avoid having in common; ``n`` nodes are posted
    under the key."""
    posts = nodes.select("node", F.posexplode("sig").alias("coord", "value")).select(
        "node", F.xxhash64("coord", "value").alias("key"))
    shared = posts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    lists = (posts.join(shared, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("keys"))
             .where(F.size("keys") >= matches))
    return lists.select("node", F.explode(F.slice("keys", F.lit(1), F.size("keys") - matches + 1)).alias("k")).select(
        F.col("k.key").alias("key"), "node", F.col("k.n").alias("n"))


def in_units(rows: DataFrame, order: list[str], payload: list[str]) -> DataFrame:
    """Rows with a number of ``blocks`` dealt into all units (i, j) of two blocks,
    i <= j, of their group; side 1 is block j. Sorted by unit within partitions."""
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    units = (rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*order, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
                     (F.col("_own") > F.col("_other")).cast("int").alias("side"), "node", *payload))
    by = [*order, "i", "j"]
    return units.repartition(partitions(rows.sparkSession), *by).sortWithinPartitions(*by, "side", "node")


def agreeing(tags: np.ndarray, side: np.ndarray, matches: int) -> list[tuple[int, int]]:
    """Index pairs (first, other) that connect what agrees on ``matches`` bytes
    between the two sides (or among all where there is one side)."""
    n = len(tags)
    if n == 2:
        return [(0, 1)] if np.count_nonzero(tags[0] == tags[1]) >= matches else []
    hit = np.zeros((n, n), dtype=bool)
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(right):
        right = left
    for lo in range(0, len(left), 64):
        rows = left[lo:lo + 64]
        hit[np.ix_(rows, right)] = (tags[rows, None, :] == tags[None, right, :]).sum(axis=2, dtype=np.uint8) >= matches
    hit |= hit.T
    free, out = np.ones(n, dtype=bool), []
    for first in range(n):
        if not free[first]:
            continue
        free[first], front = False, np.array([first])
        while len(front):
            front = np.flatnonzero(hit[front].any(axis=0) & free)
            free[front] = False
            out += [(first, int(k)) for k in front]
    return out


def candidates(postings: DataFrame, nodes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """``u, v``: pairs that connect all nodes whose counted collisions along some
    list reach ``matches``."""
    rows = postings.join(nodes.select("node", "tag"), "node").withColumn("blocks", F.ceil(F.col("n") / LIST_NODES).cast("int"))
    units = in_units(rows, ["key"], ["tag"])

    def merge(batches: Iterator[pa.RecordBatch]):
        def flush(unit):
            if len(unit) < 2:
                return []
            tags = np.frombuffer(b"".join(t for _, _, t in unit), dtype=np.uint8).reshape(len(unit), -1)
            return [(unit[a][0], unit[b][0]) for a, b in agreeing(tags, np.array([s for _, s, _ in unit]), matches)]

        now, unit, found = None, [], []
        for batch in batches:
            for key, i, j, side, node, tag in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, i, j) != now:
                    found += flush(unit)
                    now, unit = (key, i, j), []
                unit.append((node, side, tag))
            if len(found) > 4_096:
                yield _pairs(found)
                found = []
        found += flush(unit)
        if found:
            yield _pairs(found)

    ship_package(postings.sparkSession)
    return units.mapInArrow(merge, "u long, v long").distinct()


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int64()) for k in zip(*found)], names=["u", "v"])


def count_and_confirm(sigs: np.ndarray, sets: list[np.ndarray], side: np.ndarray, matches: int,
                      percent: int) -> list[tuple[int, int]]:
    """Index pairs that span the links between the two sides of a unit (or
    among all of it where there is one side)."""
    n = len(sets)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1)
    if not len(left):
        return []
    one_side = not len(right)
    if one_side:
        right = left
    agree = np.stack([(sigs[i] == sigs[right]).sum(axis=1) for i in left])
    hit = agree >= matches
    if one_side:
        hit &= left[:, None] < right[None, :]
    a, b = np.nonzero(hit)
    if not len(a):
        return []
    a, b = left[a], right[b]
    used = np.unique(np.concatenate([a, b]))
    row = np.full(n, -1)
    row[used] = np.arange(len(used))
    sizes = np.array([len(sets[i]) for i in used])
    flat = np.concatenate([sets[i] for i in used])
    owner = np.repeat(np.arange(len(used)), sizes)
    _, column, times = np.unique(flat, return_inverse=True, return_counts=True)
    keep = times[column] > 1
    dense = np.cumsum(times > 1) - 1
    column, owner = dense[column[keep]], owner[keep]
    width = int((times > 1).sum())
    common = np.zeros((len(used), len(used)), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for lo in range(0, width, _STEP):  # counts stay exact: below 2**24 in all
        s, e = np.searchsorted(column, [lo, lo + _STEP])
        part = np.zeros((len(used), _STEP), dtype=np.float32)
        part[owner[s:e], column[s:e] - lo] = 1
        common += part @ part.T
    ra, rb = row[a], row[b]
    inter = common[ra, rb].astype(np.int64)
    ok = 100 * inter >= percent * (sizes[ra] + sizes[rb] - inter)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for i, j in zip(a[ok].tolist(), b[ok].tolist()):
        p, q = find(i), find(j)
        if p != q:
            parent[q] = p
            links.append((i, j))
    return links


def links_of(nodes: DataFrame, docs: DataFrame, work: Workspace, matches: int = MATCHES,
             percent: int = SIMILARITY) -> DataFrame:
    """``u, v``: links that connect what is similar among ``nodes``."""
    postings = work.save(prefix_postings(nodes, matches), "postings")
    pairs = work.save(candidates(postings, nodes, matches), "pairs")
    work.drop("postings")
    groups = work.save(components(pairs, work, "groups"), "groups")
    work.drop("pairs")
    n, shingles = F.count(F.lit(1)), F.sum("n_shingles")
    blocks = F.least(n, F.greatest(F.ceil(n / BLOCK_NODES), F.ceil(shingles / BLOCK_SHINGLES)))
    sizes = groups.join(nodes.select("node", "n_shingles"), "node").groupBy("root").agg(blocks.cast("int").alias("blocks"))
    member = (groups.join(sizes, "root").join(nodes.select("node", "rep", "sig"), "node")
              .select("root", "node", "blocks", F.col("rep.doc_id").alias("_id"), F.col("rep.place").alias("_place"),
                      F.transform("sig", lambda x: x.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).alias("sig")))
    texts = docs.select(F.col("doc_id").alias("_doc"), "place", "text")
    rows = member.join(texts, F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_place") == F.col("place")))

    def make():
        return lambda root, node, blocks, sig, texts_: [
            root, node, blocks, sig, [s.tobytes() for s in shingle_sets(texts_)]]

    with_sets = map_rows(rows, ["root", "node", "blocks", "sig", "text"],
                         "root long, node long, blocks int, sig array<int>, shingles binary", make)
    units = in_units(with_sets, ["root"], ["sig", "shingles"])

    def merge(batches: Iterator[pa.RecordBatch]):
        def flush(key, unit):
            if len(unit) < 2 or (key[1] < key[2] and len({u[3] for u in unit}) < 2):
                return None  # pairs inside one block belong to its own unit
            found = count_and_confirm(np.array([u[1] for u in unit]), [np.frombuffer(u[2], dtype=np.uint64) for u in unit],
                                      np.array([u[3] for u in unit]), matches, percent)
            if not found:
                return None
            return _pairs([(unit[a][0], unit[b][0]) for a, b in found])

        now, unit = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in range(3)]
            sig = batch.column(5)
            width = sig.values.to_numpy(zero_copy_only=False).reshape(-1, COORDS)
            first = sig.offsets.to_numpy() // COORDS
            sides, node, shingles = batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(6)
            for r in range(batch.num_rows):
                key = (cols[0][r], cols[1][r], cols[2][r])
                if key != now:
                    if (out := flush(now, unit)) is not None:
                        yield out
                    now, unit, seen = key, [], set()
                if node[r] not in seen:  # a repeated row gives its node's text twice
                    seen.add(node[r])
                    unit.append((node[r], width[first[r]], shingles[r].as_py(), sides[r]))
        if (out := flush(now, unit)) is not None:
            yield out

    ship_package(docs.sparkSession)
    return units.mapInArrow(merge, "u long, v long")


def clustered(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
              matches: int = MATCHES, percent: int = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: ``doc_id, place`` (hash of the text),
    ``n_shingles`` and ``root``, the component (null for an empty set)."""
    rows = work.save(sketch(df, id_col, text_col), "rows")
    nodes = work.save(
        rows.where(F.col("set_hash").isNotNull()).groupBy("set_hash")
        .agg(F.min(F.struct("doc_id", "place")).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("tag").alias("tag"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    docs = df.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("place"), F.col(text_col).alias("text"))
    links = work.save(links_of(nodes, docs, work, matches, percent), "links")
    roots = work.save(components(links, work, "roots"), "roots")
    placed = (rows.select("doc_id", "place", "n_shingles", "set_hash")
              .join(nodes.select("set_hash", "node"), "set_hash", "left").join(roots, "node", "left")
              .select("doc_id", "place", "n_shingles", F.coalesce("root", "node").alias("root")))
    return work.save(placed, "placed")


def near_duplicates(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
                    matches: int = MATCHES, percent: int = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: ``id, n_shingles, component_id, kept``."""
    placed = clustered(df, work, id_col, text_col, matches, percent)
    names = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("_least"))
    out = placed.join(names, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("_least"))
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep_one(df: DataFrame, work: Workspace, id_col: str = "doc_id", text_col: str = "text",
             matches: int = MATCHES, percent: int = SIMILARITY) -> DataFrame:
    """Rows of ``df``, with all their columns: of every component the one with
    the least id (null ids last; of equal ids the least hash of the text; of
    repeated rows any one), and every row with an empty set."""
    placed = clustered(df, work, id_col, text_col, matches, percent)
    best = (placed.where("root is not null").groupBy("root")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id"), F.col("place"))).alias("b"))
            .select(F.col("b.doc_id").alias("__near_id"), F.col("b.place").alias("__near_place"), F.lit(True).alias("__near_one")))
    empty = placed.where("root is null").select(F.col("doc_id").alias("__near_id"), F.col("place").alias("__near_place"),
                                                F.lit(False).alias("__near_one")).distinct()
    keyed = df.withColumn("__near_hash", F.xxhash64(text_col))
    kept = keyed.join(best.unionAll(empty), F.col(id_col).eqNullSafe(F.col("__near_id")) & (F.col("__near_hash") == F.col("__near_place")))
    turn = Window.partitionBy(id_col, "__near_hash").orderBy("__near_hash")
    return (kept.withColumn("__near_turn", F.row_number().over(turn)).where(~F.col("__near_one") | (F.col("__near_turn") == 1))
            .select(*df.columns))
