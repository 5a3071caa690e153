"""Chat formatting of reply trees, with DataFrame functions only.

1. Messages hold ``tree, node, parent, role, text, score``. Conversations are
   trees whose every message answers the one before it.
2. Paths: self-joins of the parent table double the span of its links (1, 2, 4,
   ... messages up). Read from the longest link down they list every message
   between a leaf and its root once, so a path of n messages takes about log2(n)
   joins and n rows, and texts take no part.
3. Rank: a path's score is the mean of its messages'; a tree's paths are ranked by
   score, then by their leaf, and the first ``paths_per_tree`` are formatted.
4. Trees: the texts of a tree move once, to the task of their tree, where paths
   pick them up and are put together. A tree whose paths could hold more than
   ``TREE_BYTES`` has its messages spread by message, then by path, instead.
5. Format: every turn is ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control
   strings inside a role or text get a backslash behind their first character (one
   more if they have some already), so no mark can come from a text and each is
   undone exactly. ``loss`` holds per turn where the turn starts and which code
   points of the conversation are under the loss mask: the texts of the trained role.

Null roles, texts and scores count as empty or 0. A null tree is a tree of its own.
A message whose parent is null or absent is a root; messages that no root reaches
(a cycle) are on no path. Repeated rows of a message count once (the least role and
text). Empty tables give empty results, very long texts and trees need one row per
formatted path, as the output does. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import re

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import Workspace, co_partitioned

# Marks of the template, and strings that no text may hold raw.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROL = (START, SEP, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = "assistant"
# Conversation -1 says control strings in both of its turns.
PROBE_ID, PROBE_TEXT = -1, "</s>[INST] ok [/INST]"

TURNS_PER_PART = 512
LEAF_BUCKETS = 64
TREE_BYTES, MESSAGE_BYTES = 8 << 20, 64  # of all paths of a tree in one task; of a message besides its texts
# any control string (or one with the other opening bracket), with any number of backslashes behind its first character
_TAIL = r"\\*(?:" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"
_RAW, _ESCAPED = rf"([<\[])({_TAIL})", rf"([<\[])\\({_TAIL})"


def escape(text: Column) -> Column:
    """``text`` without raw control strings; undone by ``unescape``."""
    return F.regexp_replace(text, _RAW, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2")


def as_messages(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as trees: a row answers the row before it (by turn, null
    first, then role and text; every row is a message). Rows are numbered inside
    parts of ``TURNS_PER_PART`` turn numbers and the parts' counts are added up,
    so a conversation of very many turns is many groups."""
    part = F.struct(F.col(conv).alias("tree"), F.floor(F.col(turn) / TURNS_PER_PART).alias("n"))  # equal structs may hold nulls
    rows = turns.select(part.alias("_part"), F.col(turn).alias("_turn"), F.coalesce(role, F.lit("")).alias("role"),
                        F.coalesce(text, F.lit("")).alias("text"))
    earlier = Window.partitionBy("_part.tree").orderBy(F.asc_nulls_first("_part.n")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = turns.select(part.alias("_part")).groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(F.asc_nulls_first("_turn"), "role", "text"))
    node = F.col("_before") + F.col("_place")
    return rows.withColumn("_place", place).join(offsets, "_part").select(
        F.col("_part.tree").alias("tree"), node.alias("node"), F.when(node > 1, node - 1).alias("parent"), "role", "text",
        F.lit(0.0).alias("score"))


def _key() -> Column:
    """The tree wrapped: equal where both trees are null, unlike the trees themselves."""
    return F.struct("tree").alias("key")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation ``PROBE_ID``: a user and an assistant row."""
    return spark.range(2).select(F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise(TRAINED).alias("role"), F.lit(PROBE_TEXT).alias("text"))


def one_per_message(messages: DataFrame) -> DataFrame:
    """Repeated rows of a message as one: least parent, role and text, in this order."""
    kept = F.min(F.struct("parent", "role", "text", "score")).alias("m")
    return messages.groupBy("tree", "node").agg(kept).select("tree", "node", "m.*")


def _up(left: DataFrame, links: DataFrame, at: str) -> DataFrame:
    """``left`` joined with the link that begins at its message ``at``."""
    return left.join(links.select("key", F.col("low").alias(at), F.col("high").alias("_high")), ["key", at])


def leaf_paths(messages: DataFrame, work: Workspace) -> DataFrame:
    """``key, leaf, node, above``: every message between a leaf and its root
    (``key`` wraps the tree, ``above`` counts the messages from it down to the leaf)."""
    nodes = messages.select(_key(), F.col("node").alias("low"), F.col("parent").alias("high"))
    links = work.save(nodes.join(nodes.select("key", F.col("low").alias("high")), ["key", "high"], "left_semi")
                      .select("key", "low", "high"), "links-0")
    leaves = nodes.select("key", "low").join(links.select("key", F.col("high").alias("low")), ["key", "low"], "left_anti")
    spans, size, before = [], links.count(), None
    while size and size != before:  # every round loses links to a root, so equal sizes mean cycles
        spans.append(links)
        before = size
        links = work.save(_up(links, links, "high").select("key", "low", F.col("_high").alias("high")), f"links-{len(spans)}")
        size = links.count()
    if size:
        leaves = leaves.join(links.select("key", "low"), ["key", "low"], "left_anti")
    paths = work.save(leaves.select("key", F.col("low").alias("leaf"), F.col("low").alias("node"), F.lit(0).cast("long").alias("above")),
                      f"paths-{len(spans)}")
    for k in reversed(range(len(spans))):
        higher = _up(paths, spans[k], "node").select("key", "leaf", F.col("_high").alias("node"), (F.col("above") + (1 << k)).alias("above"))
        paths = work.save(paths.unionByName(higher), f"paths-{k}")
        work.drop(f"paths-{k + 1}", f"links-{k + 1}")
    work.drop("links-0")
    return paths


def best_leaves(paths: DataFrame, messages: DataFrame, paths_per_tree: int) -> DataFrame:
    """``key, leaf, rank`` of each tree's best paths by mean score (greatest
    first), then by leaf. Ranks are counted per bucket of leaves first, so a tree
    with very many leaves is cut down in many tasks."""
    scores = messages.select(_key(), "node", F.coalesce("score", F.lit(0.0)).alias("score"))
    means = paths.join(scores, ["key", "node"]).groupBy("key", "leaf").agg(F.avg("score").alias("path_score"))
    order = [F.desc("path_score"), F.asc("leaf")]
    near = Window.partitionBy("key", F.pmod(F.xxhash64("leaf"), F.lit(LEAF_BUCKETS))).orderBy(*order)
    some = means.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= paths_per_tree)
    return (some.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order)))
            .where(F.col("rank") <= paths_per_tree).select("key", "leaf", "rank"))


def format_paths(messages: DataFrame, work: Workspace, paths_per_tree: int | None = None, trained: str = TRAINED) -> DataFrame:
    """One row per path (of each tree's best ``paths_per_tree``, or of every
    leaf): ``tree, leaf, rank, formatted`` and ``loss``, per turn ``(start,
    loss_start, loss_end)`` in code points of ``formatted``, ends exclusive
    (start and end are equal where nothing is under the mask). ``messages`` holds
    each message once (``one_per_message``); the result is a written table."""
    paths = leaf_paths(messages, work)
    if paths_per_tree is None:
        paths = paths.withColumn("rank", F.lit(None).cast("int"))
    else:
        paths = paths.join(work.save(best_leaves(paths, messages, paths_per_tree), "best"), ["key", "leaf"])
    said = messages.select(_key(), "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return _write(said, paths, lambda rows: rows.repartition("key"), lambda rows: rows, work, trained)


def format_conversations(turns: DataFrame, work: Workspace, trained: str = TRAINED, conv: str = "conv_id", turn: str = "turn",
                         role: str = "role", text: str = "text") -> DataFrame:
    """What ``format_paths`` makes of ``as_messages(turns)``. Paths only need the
    places of rows, so they come from rows without their texts, and the texts are
    numbered in the task of their tree."""
    rows = turns.select(F.struct(F.col(conv).alias("tree")).alias("key"), F.col(turn).alias("turn"),
                        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))
    places = as_messages(rows.select("key.tree", "turn", F.lit("").alias("role"), F.lit("").alias("text")), conv="tree")
    paths = leaf_paths(work.save(places.select("tree", "node", "parent"), "places"), work).withColumn("rank", F.lit(None).cast("int"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.asc_nulls_first("turn"), "role", "text"))

    def in_one_task(some: DataFrame) -> DataFrame:
        return some.select("key", place.cast("long").alias("node"), "role", "text")

    def in_parts(some: DataFrame) -> DataFrame:
        return as_messages(some.select("key.tree", "turn", "role", "text"), conv="tree").select(_key(), "node", "role", "text")

    return _write(rows, paths, in_one_task, in_parts, work, trained)


def _write(rows: DataFrame, paths: DataFrame, in_one_task: Callable[[DataFrame], DataFrame],
           in_parts: Callable[[DataFrame], DataFrame], work: Workspace, trained: str) -> DataFrame:
    """``paths`` formatted with the messages that ``in_one_task`` makes of ``rows``
    (by ``key``), or ``in_parts`` where a tree's paths could hold more than ``TREE_BYTES``."""
    room = F.sum(F.octet_length("role") + F.octet_length("text") + F.lit(MESSAGE_BYTES).cast("long"))
    leaves = paths.where("above = 0").groupBy("key").agg(F.count(F.lit(1)).alias("leaves"))
    large = work.save(rows.groupBy("key").agg(room.alias("room")).join(leaves, "key", "left")
                      .where(F.col("room") * F.coalesce("leaves", F.lit(1)) > TREE_BYTES).select("key"), "large")
    if large.isEmpty():
        made = _put_together(in_one_task(rows), paths, trained)
    else:
        small, big = (_put_together(make(rows.join(large, "key", how)), paths.join(large, "key", how), trained)
                      for make, how in ((in_one_task, "left_anti"), (in_parts, "left_semi")))
        made = small.unionByName(big)
    with co_partitioned(work.spark):  # a tree's texts stay where they are when its paths join them
        formatted = work.save(made, "formatted")
    work.drop("large", "places", "best", "paths-0")
    return formatted


def _put_together(messages: DataFrame, paths: DataFrame, trained: str) -> DataFrame:
    said = messages.select("key", "node", (F.col("role") == trained).alias("under"),
                           F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)).alias("opening"), escape(F.col("text")).alias("body"))
    turns = said.join(paths, ["key", "node"])
    size = F.length("opening") + F.length("body") + len(END)
    in_order = Window.partitionBy("key", "leaf").orderBy(F.desc("above")).rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("start", F.coalesce(F.sum(size.cast("long")).over(in_order), F.lit(0)).cast("long"))
    first = F.col("start") + F.length("opening")
    turn = F.struct((-F.col("above")).alias("order"), F.concat("opening", "body", F.lit(END)).alias("piece"), "start",
                    first.alias("loss_start"), F.when(F.col("under"), first + F.length("body")).otherwise(first).alias("loss_end"))
    whole = placed.groupBy("key", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select(F.col("key.tree").alias("tree"), "leaf", "rank", F.array_join("turns.piece", "").alias("formatted"),
                        F.transform("turns", lambda t: F.struct(t["start"], t["loss_start"], t["loss_end"])).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and masked text of formatted conversations, from ``formatted`` and
    ``loss`` alone: ``tree, leaf, rank, turns`` (role and text) and ``masked``."""
    pieces = F.split("formatted", re.escape(END))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing stands behind the last mark

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, SEP, 1)
        return F.struct(unescape(F.substring(role, F.lit(len(START) + 1), F.length(role))).alias("role"),
                        unescape(F.substring_index(piece, SEP, -1)).alias("text"))

    def under_mask(piece: Column, span: Column) -> Column:
        cut = F.substring(piece, (span["loss_start"] - span["start"] + 1).cast("int"), (span["loss_end"] - span["loss_start"]).cast("int"))
        return unescape(cut)

    return formatted.select("tree", "leaf", "rank", F.transform(pieces, turn).alias("turns"),
                            F.array_join(F.zip_with(pieces, "loss", under_mask), "").alias("masked"),
                            F.length("formatted").cast("long").alias("formatted_chars"))
