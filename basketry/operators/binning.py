"""Binning and segmentation (§2.10).

Quantile edges are exact linear-interpolated percentiles (pandas ``qcut``),
computed once as an array (scalar subquery) and applied as a plain
expression; nothing is collected per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.primitives import exact_quantiles, prefix_sum, with_group_quantiles


def cut_fixed(x, edges: list[float], labels: list | None = None, right: bool = True,
              include_lowest: bool = False) -> Column:
    """Fixed-edge bins; right-closed (e_i, e_{i+1}] or left-closed
    [e_i, e_{i+1}); out of range → NULL. Labels default to bin index."""
    c = F.col(x) if isinstance(x, str) else x
    labels = labels if labels is not None else list(range(len(edges) - 1))
    out = None
    for i in range(len(edges) - 1):
        lo, hi = edges[i], edges[i + 1]
        if right:
            cond = ((c >= lo) if (include_lowest and i == 0) else (c > lo)) & (c <= hi)
        else:
            cond = (c >= lo) & ((c <= hi) if (include_lowest and i == len(edges) - 2) else (c < hi))
        out = F.when(cond, F.lit(labels[i])) if out is None else out.when(cond, F.lit(labels[i]))
    return out


def quantile_edges(df: DataFrame, col: str, q: int | None = None, probs=None) -> Column:
    """J02 edges: exact interpolated percentiles at 0, 1/q, …, 1 with
    duplicates dropped. Computed with the distributed exact quantile (no
    task holds all distinct values) and returned as a literal array."""
    probs = probs or [i / q for i in range(q + 1)]
    vals = [v for v in exact_quantiles(df, col, probs) if v is not None]
    uniq = sorted(set(vals))
    return F.array(*[F.lit(float(v)) for v in uniq]) if uniq else F.array().cast("array<double>")


def bin_by_edges(x, edges: Column, right: bool = True) -> Column:
    """Bin index (0-based) against an ascending edge array: right-closed
    with the first bin including its lower edge (pandas ``qcut``), or
    left-closed (``Bucketizer`` / sklearn). NULL stays NULL."""
    c = F.col(x) if isinstance(x, str) else x
    inner = F.slice(edges, 2, F.greatest(F.size(edges) - 2, F.lit(0)))
    if right:
        idx = F.size(F.filter(inner, lambda e: e < c))
    else:
        idx = F.size(F.filter(inner, lambda e: e <= c))
    return F.when(c.isNotNull(), idx)


def with_edges(df: DataFrame, edges: Column, col: str, out: str, right: bool = True) -> DataFrame:
    """Attach the bin index for an edge array that may be a scalar subquery
    (projected to a column first: higher-order functions may not contain
    subqueries)."""
    return df.withColumn("_edges", edges).withColumn(out, bin_by_edges(col, F.col("_edges"), right)).drop("_edges")


def qcut(df: DataFrame, col: str, q: int, out: str = "bin", labels: list | None = None) -> DataFrame:
    """Quantile bins (not ``ntile``: equal values share a bin)."""
    d = with_edges(df, quantile_edges(df, col, q), col, out)
    if labels:
        d = d.withColumn(out, F.element_at(F.array(*[F.lit(v) for v in labels]), F.col(out) + 1))
    return d


def qcut_on_rank(df: DataFrame, col: str, q: int, tiebreak, out: str = "bin", labels: list | None = None) -> DataFrame:
    """Qcut over rank(method="first") — near-equal groups even with
    ties. The rank is ``rank_first`` (skew-safe: a hot value is split on the
    tiebreak); rank edges are 1 + k/q·(n − 1), so no second percentile pass."""
    from basketry.functions.primitives import rank_first
    tb = tiebreak[0] if isinstance(tiebreak, (list, tuple)) else tiebreak
    r = rank_first(df, col, tb, "_rank")
    n = df.filter(F.col(col).isNotNull()).select(F.count(F.lit(1))).scalar()
    edges = F.array(*[F.lit(1.0) + F.lit(k / q) * (n - 1) for k in range(q + 1)])
    r = with_edges(r.withColumn("_rank", F.col("_rank").cast("double")), edges, "_rank", out)
    r = r.withColumn(out, F.when(F.col(col).isNotNull(), F.col(out)))
    if labels:
        r = r.withColumn(out, F.element_at(F.array(*[F.lit(v) for v in labels]), F.col(out) + 1))
    return r.drop("_rank")


def train_fitted_edges(train: DataFrame, col: str, q: int) -> Column:
    """Quantile edges fitted on train only; outer edges → ±inf."""
    vals = [v for v in exact_quantiles(train, col, [i / q for i in range(q + 1)]) if v is not None]
    inner = sorted(set(vals[1:-1])) if len(vals) > 2 else []
    return F.array(*[F.lit(float(v)) for v in [float("-inf"), *inner, float("inf")]])


def apply_train_bins(df: DataFrame, col: str, edges: Column, out: str = "bin", right: bool = True) -> DataFrame:
    return with_edges(df, edges, col, out, right)


# Value-segment labels (five near-equal groups by net revenue).
VALUE_SEGMENTS = ["very_low", "low", "mid", "high", "very_high"]


def value_segment_summary(orders: DataFrame, key: str, revenue: str, cost: str | None = None) -> DataFrame:
    """Orders in 5 rank-based segments → orders, revenue, AOV, profit,
    true margin (ratio of sums)."""
    s = qcut_on_rank(orders, revenue, 5, [key], "segment", VALUE_SEGMENTS)
    aggs = [F.count(F.lit(1)).alias("n_orders"), F.sum(revenue).alias("revenue"),
            F.avg(revenue).alias("aov")]
    if cost:
        aggs += [F.sum(F.col(revenue) - F.col(cost)).alias("profit"),
                 F.try_divide(F.sum(F.col(revenue) - F.col(cost)), F.sum(revenue)).alias("margin")]
    return s.groupBy("segment").agg(*aggs)


# Discount buckets on the order discount rate (right-closed).
DISCOUNT_EDGES = [-0.001, 0.0, 0.05, 0.1, 0.2, 0.5, float("inf")]
DISCOUNT_LABELS = ["0%", "0-5%", "5-10%", "10-20%", "20-50%", ">50%"]


def discount_bucket_summary(orders: DataFrame, rate: str, gross: str, discount: str) -> DataFrame:
    """Six discount buckets (missing rate → 0) with orders, sums and
    true discount rate; empty buckets are kept via a bucket dimension."""
    b = orders.withColumn("discount_bucket", cut_fixed(F.coalesce(F.col(rate), F.lit(0.0)), DISCOUNT_EDGES, DISCOUNT_LABELS))
    g = b.groupBy("discount_bucket").agg(F.count(F.lit(1)).alias("n_orders"), F.sum(gross).alias("gross"),
                                         F.sum(discount).alias("discount"))
    dim = orders.sparkSession.createDataFrame([(lab, i) for i, lab in enumerate(DISCOUNT_LABELS)],
                                              "discount_bucket string, bucket_order int")
    out = F.broadcast(dim).join(g, "discount_bucket", "left")  # fixed 6-row dimension
    return out.select("discount_bucket", "bucket_order", F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
                      F.coalesce("gross", F.lit(0.0)).alias("gross"), F.coalesce("discount", F.lit(0.0)).alias("discount"),
                      F.try_divide(F.col("discount"), F.col("gross")).alias("discount_rate"))


# Tenure-group presets (edges, labels, closedness) per stage.
TENURE_PRESETS = {
    # exploration: < 30, ≤ 180, ≤ 365, above
    "eda": ("ladder", ["< 30 days (New)", "30-180 days", "180-365 days", "> 365 days (Loyal)"]),
    # training: right-closed bins (-1, 29], (29, 179], (179, 364], (364, inf)
    "train": ([-1, 29, 179, 364, float("inf")], ["new_lt_30d", "30_179d", "180_364d", "loyal_365d_plus"], True),
    # serving: left-closed bins [0, 30), [30, 180), [180, 365), [365, inf); negative → NULL
    "serve": ([0, 30, 180, 365, float("inf")], ["new_lt_30d", "30_179d", "180_364d", "loyal_365d_plus"], False),
}


def tenure_group(days, preset: str = "train") -> Column:
    """Tenure groups under the named preset."""
    c = F.col(days) if isinstance(days, str) else days
    p = TENURE_PRESETS[preset]
    if p[0] == "ladder":
        labels = p[1]
        return (F.when(c < 30, labels[0]).when(c <= 180, labels[1]).when(c <= 365, labels[2])
                .when(c.isNotNull(), labels[3]))
    edges, labels, right = p
    return cut_fixed(c, edges, labels, right=right)


def binned_mean(df: DataFrame, x: str, y: str, q: int = 10) -> DataFrame:
    """Quantile-bin x; per bin the median x, mean y and count."""
    b = qcut(df, x, q, "bin").filter(F.col("bin").isNotNull())
    rows = b.groupBy("bin").agg(F.avg(y).alias("y_mean"), F.count(F.lit(1)).alias("n"))
    return with_group_quantiles(rows, b, "bin", {"x_median": (x, 0.5)}).select("bin", "x_median", "y_mean", "n")
