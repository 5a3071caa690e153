"""Connected components of an edge table by alternating large and small stars.

Each round points every node at the least node it knows, with a grouped
minimum (combined map-side) and a join that adaptive execution can split, so
a node with very many neighbours is never gathered in one task. Rounds are
written tables; the loop ends when a round changes nothing, after about the
logarithm of the longest path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import Workspace


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    hi, lo = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    if large:
        each = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = each.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = each.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        each = edges.select(hi, lo)
        least = each.groupBy("u").agg(F.min("v").alias("m"))
        out = each.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u, v``, any
    orderable type); ``root`` is the least node of its component. Nodes only
    in edges to themselves are left out, as are edges with a null end."""
    now = work.save(edges.where("u is not null and v is not null and u <> v")
                    .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        digest = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if digest[0] == 0 or tuple(digest) == state:
            break
        state, step = tuple(digest), step + 1
        half = work.save(_stars(now, large=True), f"{name}-{step}-large")
        now = work.save(_stars(half, large=False), f"{name}-{step}")
        work.drop(f"{name}-{step}-large", f"{name}-{step - 1}")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())
