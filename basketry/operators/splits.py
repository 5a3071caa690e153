"""Splits and validation folds (§2.14).

Cut points are found on the *date axis* (a table with one row per distinct
date), never by sorting all rows: counts per date → running count →
first date whose running count passes the position.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _lit_like(df: DataFrame, col: str, v):
    return F.lit(v).cast(df.schema[col].dataType)


def time_split(df: DataFrame, date_col: str, valid_start, test_start=None, out: str = "data_split") -> DataFrame:
    """Train (< valid_start) / validation (< test_start) / test."""
    c = F.col(date_col)
    lab = F.when(c < _lit_like(df, date_col, valid_start), "train")
    if test_start is not None:
        lab = lab.when(c < _lit_like(df, date_col, test_start), "validation").otherwise("test")
    else:
        lab = lab.otherwise("validation")
    return df.withColumn(out, F.when(c.isNotNull(), lab))


def date_counts(df: DataFrame, date_col: str) -> DataFrame:
    """Rows per distinct date with the running count (date axis only)."""
    g = df.filter(F.col(date_col).isNotNull()).groupBy(date_col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return g.withColumn("cum_n", F.sum("n").over(w)).withColumn("date_idx", F.row_number().over(Window.orderBy(date_col)) - 1)


def positional_cut_dates(df: DataFrame, date_col: str, fractions=(0.70, 0.85)):
    """N02 cut dates: the date of the row at position ⌊p·n⌋ (0-based) of the
    rows sorted by date — the first date whose running count exceeds it.
    Fitted once on the date axis (one row per distinct date) and returned
    as literal columns, like any fitted split boundary."""
    dc = date_counts(df, date_col)
    n = dc.select(F.sum("n")).first()[0] or 0
    row = dc.agg(*[F.min(F.when(F.col("cum_n") > int(n * p), F.col(date_col))).alias(f"c{i}")
                   for i, p in enumerate(fractions)]).first()
    return [F.lit(row[f"c{i}"]) for i in range(len(fractions))]


def positional_cutoff_split(df: DataFrame, date_col: str, fractions=(0.70, 0.85), out: str = "data_split") -> DataFrame:
    """Train < cut1 ≤ validation < cut2 ≤ test."""
    c1, c2 = positional_cut_dates(df, date_col, fractions)
    c = F.col(date_col)
    return df.withColumn(out, F.when(c < c1, "train").when(c < c2, "validation").when(c.isNotNull(), "test"))


def expanding_folds(df: DataFrame, date_col: str, fractions=((0.55, 0.70), (0.70, 0.85), (0.85, 1.00))) -> DataFrame:
    """Fold bounds on the distinct-date axis: train_end =
    dates[min(⌊n·f1⌋, n−1)], valid_end likewise; the last fold's validation
    is closed on the right. One row per fold: fold, train_end, valid_end,
    closed_right."""
    dc = date_counts(df, date_col)
    nd = dc.select(F.count(F.lit(1))).scalar()
    rows = []
    for i, (a, b) in enumerate(fractions, start=1):
        ia = F.least(F.floor(nd * F.lit(a)), nd - 1)
        ib = F.least(F.floor(nd * F.lit(b)), nd - 1)
        rows.append(dc.agg(F.min(F.when(F.col("date_idx") == ia, F.col(date_col))).alias("train_end"),
                           F.min(F.when(F.col("date_idx") == ib, F.col(date_col))).alias("valid_end"))
                    .select(F.lit(i).alias("fold"), "train_end", "valid_end",
                            F.lit(i == len(fractions)).alias("closed_right")))
    return reduce(DataFrame.unionByName, rows)


def fold_membership(df: DataFrame, folds: DataFrame, date_col: str) -> DataFrame:
    """Rows × folds they belong to, with ``role`` train / validation. The
    fold table has a handful of rows; its bounds become literal conditions,
    so each row is tagged with the folds it belongs to and exploded — no
    join and no row × fold product beyond real memberships."""
    c = F.col(date_col)
    tags = []
    for f in folds.orderBy("fold").collect():
        te, ve = F.lit(f["train_end"]), F.lit(f["valid_end"])
        in_valid = (c >= te) & ((c < ve) | (F.lit(bool(f["closed_right"])) & (c == ve)))
        tags.append(F.when(c < te, F.struct(F.lit(f["fold"]).alias("fold"), F.lit("train").alias("role")))
                    .when(in_valid, F.struct(F.lit(f["fold"]).alias("fold"), F.lit("validation").alias("role"))))
    m = df.withColumn("_tags", F.filter(F.array(*tags), lambda t: t.isNotNull()))
    return m.withColumn("_t", F.explode("_tags")).select("*", "_t.fold", "_t.role").drop("_tags", "_t")


def fold_audit(df: DataFrame, folds: DataFrame, date_col: str, target: str | None = None) -> DataFrame:
    """N03 audit: per fold and role: rows, first/last date, target rate."""
    m = fold_membership(df, folds, date_col)
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.min(date_col).alias("start_date"), F.max(date_col).alias("end_date")]
    if target:
        aggs.append(F.avg(target).alias("target_rate"))
    return m.groupBy("fold", "role").agg(*aggs)


def rolling_origin(df: DataFrame, date_col: str, min_train_days: int = 3 * 365, step_days: int = 90,
                   test_days: int = 30, last_n: int = 6) -> DataFrame:
    """Origins every ``step_days`` after ``min_train_days`` from the
    first date, each with a ``test_days`` window inside the data; the last
    ``last_n`` origins. One row per fold: fold, origin, test_end."""
    b = df.agg(F.min(date_col).alias("_a"), F.max(date_col).alias("_b"))
    o = b.select(F.explode(F.sequence(F.date_add("_a", min_train_days), F.date_sub("_b", test_days - 1),
                                      F.expr(f"interval {step_days} days"))).alias("origin"))
    w = Window.orderBy(F.desc("origin"))
    o = o.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= last_n)
    w2 = Window.orderBy("origin")
    return o.select(F.row_number().over(w2).alias("fold"), "origin",
                    F.date_add("origin", test_days - 1).alias("test_end"))


SPLITS = ("train", "validation", "test")


def split_integrity(df: DataFrame, split_col: str, date_col: str, key: str) -> DataFrame:
    """Per split pair key overlap (must be 0), date ordering (max of
    earlier < min of later) and dense dates per split. Every key carries one bit per
    split it appears in; overlaps and date bounds come from that one aggregate."""
    s = df.groupBy(split_col).agg(F.min(date_col).alias("d_min"), F.max(date_col).alias("d_max"),
                                  F.count_distinct(date_col).alias("n_dates"))
    s = s.withColumn("dense", F.datediff("d_max", "d_min") + 1 == F.col("n_dates"))
    here = [F.col(split_col) == name for name in SPLITS]
    bit = sum((F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(here)), F.lit(0))
    bounds = [f(F.when(c, F.col(date_col))).alias(f"{n}{i}") for i, c in enumerate(here) for n, f in (("a", F.min), ("z", F.max))]
    per_key = df.groupBy(key).agg(F.bit_or(bit).alias("_bits"), *bounds)
    known = F.col(key).isNotNull()

    def both(i, j):
        pair = (1 << i) | (1 << j)
        return F.count_if(known & (F.col("_bits").bitwiseAND(F.lit(pair)) == pair))

    pairs = [(i, j) for i in range(len(SPLITS)) for j in range(i + 1, len(SPLITS))]
    one = per_key.agg(*[both(i, j).alias(f"n{i}{j}") for i, j in pairs],
                      *[f(f"{n}{i}").alias(f"{n}{i}") for i in range(len(SPLITS)) for n, f in (("a", F.min), ("z", F.max))])
    rows = [F.struct(F.lit(f"{SPLITS[i]}|{SPLITS[j]}").alias("pair"), F.col(f"n{i}{j}").alias("overlap_keys"),
                     (F.col(f"z{i}") < F.col(f"a{j}")).alias("ordered")) for i, j in pairs]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*"), s


def holdout_tail(df: DataFrame, date_col: str, fraction: float = 0.15, out: str = "is_holdout") -> DataFrame:
    """The last ``fraction`` of rows by time (one cut at 1 − fraction)."""
    (cut,) = positional_cut_dates(df, date_col, (1.0 - fraction,))
    return df.withColumn(out, F.col(date_col) >= cut)
