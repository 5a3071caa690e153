"""Sort, limit, top-k and set operations (§2.8).

``top_k`` compiles to TakeOrderedAndProject (each task keeps its own k best,
the driver merges ≤ tasks·k rows), never a full sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(by, ascending):
    by = [by] if isinstance(by, str) else list(by)
    asc = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    return [F.col(c).asc_nulls_last() if a else F.col(c).desc_nulls_last() for c, a in zip(by, asc)]


def top_k(df: DataFrame, by, k: int, ascending=False, tiebreak=(), dropna: bool = True) -> DataFrame:
    """Nlargest / nsmallest with NULLs of the sort key dropped; ties
    broken by ``tiebreak`` ascending so the result is deterministic."""
    first = by if isinstance(by, str) else by[0]
    src = df.filter(F.col(first).isNotNull()) if dropna else df
    return src.orderBy(*_order(by, ascending), *[F.col(t).asc_nulls_last() for t in tiebreak]).limit(k)


def top_k_min_support(df: DataFrame, by: str, support: str, min_support: int, k: int,
                      ascending=False, tiebreak=()) -> DataFrame:
    """Top k by a rate among groups with at least ``min_support``."""
    return top_k(df.filter(F.col(support) >= min_support), by, k, ascending, tiebreak)


def top_extremes_union(df: DataFrame, specs: list[tuple]) -> DataFrame:
    """Several top-k slices ``(tag, by, k, ascending)`` tagged and
    unioned."""
    parts = [top_k(df, by, k, asc, tiebreak=[c for c in df.columns if c != by][:1]).withColumn("slice", F.lit(tag))
             for tag, by, k, asc in specs]
    return reduce(DataFrame.unionByName, parts)


def per_group_head(df: DataFrame, group, by, n: int, ascending=False, tiebreak=(), salt_buckets: int = 16) -> DataFrame:
    """First n rows of each group in sort order; salted two-stage top-n
    so a hot group is never sorted inside one task."""
    from basketry.functions.primitives import top_n_per_group
    order = [*_order(by, ascending), *[F.col(t).asc_nulls_last() for t in tiebreak]]
    return top_n_per_group(df, group, order, n, salt_buckets)


def ordered_categories(df: DataFrame, col: str, levels: list, fill: dict | None = None) -> DataFrame:
    """Custom category order; absent levels kept (reindex) with
    ``fill`` values; unknown levels sort last. Adds ``level_order``."""
    spark = df.sparkSession
    order = spark.createDataFrame([(v, i) for i, v in enumerate(levels)], f"{col} string, level_order int")
    src = df.withColumn(col, F.col(col).cast("string"))
    out = order.join(src, col, "full")
    if fill:
        out = out.na.fill(fill)
    return out.withColumn("level_order", F.coalesce("level_order", F.lit(len(levels))))


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Concat frames with differing columns (missing → NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def set_overlap(frames: dict[str, DataFrame], key) -> DataFrame:
    """Pairwise distinct-key overlap counts between named frames."""
    names = list(frames)
    k = [key] if isinstance(key, str) else list(key)
    parts = []
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            inter = frames[a].select(*k).intersect(frames[b].select(*k))
            parts.append(inter.agg(F.count(F.lit(1)).alias("overlap_keys"))
                         .select(F.lit(a).alias("left_set"), F.lit(b).alias("right_set"), "overlap_keys"))
    return reduce(DataFrame.unionByName, parts)


def set_difference(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Distinct keys of ``left`` not in ``right``."""
    k = [key] if isinstance(key, str) else list(key)
    return left.select(*k).distinct().join(right.select(*k), k, "left_anti")


def melt(df: DataFrame, ids, values, var: str = "variable", val: str = "value") -> DataFrame:
    """Wide → long (values cast to double)."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    cast = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in values])
    return cast.unpivot(ids, list(values), var, val)


def sample_rows(df: DataFrame, n: int, seed: int = 42, key=None) -> DataFrame:
    """Seeded sample of at most n rows, ordered by a hash of the key
    (or the whole row): deterministic under any partitioning, unlike
    ``sample``. A top-n, so only n rows per task travel."""
    cols = [key] if isinstance(key, str) else (list(key) if key else df.columns)
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in cols]))
    return df.withColumn("_h", h).orderBy("_h", *[F.col(f"`{c}`") for c in cols]).limit(n).drop("_h")
