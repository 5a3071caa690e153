"""Statistics and relations (§2.11).

Feature × target loops of the reference become one long (feature, x, y)
frame and grouped aggregates; Spearman uses tie-averaged ranks (AR) so it
equals pandas ``corr(method="spearman")`` on pairwise-complete data.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.expr import relation_label
from basketry.functions.primitives import null_safe_join, prefix_sum, unpivot_numeric, with_group_quantiles

MIN_PAIRS = 30


def pearson(a: str, b: str, min_pairs: int = MIN_PAIRS) -> Column:
    """K01 (aggregate): pairwise-complete Pearson, NULL below ``min_pairs``
    pairs or when either side is constant."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
    n = F.count(x)
    return F.when((n >= min_pairs) & (F.stddev_samp(x) > 0) & (F.stddev_samp(y) > 0), F.corr(x, y))


def _pairs_long(df: DataFrame, features: list[str], target: str, group_by=()) -> DataFrame:
    """Long (group…, feature, x, y) with pairwise-complete rows only."""
    g = list(group_by)
    base = df.select(*g, F.col(target).cast("double").alias("_y"), *[F.col(f).cast("double").alias(f) for f in features])
    long = base.unpivot([*g, "_y"], features, "feature", "x")
    return long.filter(F.col("x").isNotNull() & F.col("_y").isNotNull()).withColumnRenamed("_y", "y")


def spearman_long(long: DataFrame, keys: list[str]) -> DataFrame:
    """Spearman per ``keys`` on a long (keys…, x, y) frame: tie-averaged
    ranks of x and y inside each key group, then Pearson of the ranks.

    Rows are first reduced to (keys, x, y) cells with counts (map-side
    combined); ranks come from the distinct values and are joined to cells,
    never to rows. Ranks have the known mean (n + 1) / 2, so the sums are of
    deviations."""
    cells = long.groupBy(*keys, "x", "y").agg(F.count(F.lit(1)).alias("_c"))

    def ranks(col, out):
        counts = cells.groupBy(*keys, col).agg(F.sum("_c").alias("_n"))
        placed = prefix_sum(counts, col, "_n", partition_by=keys, inclusive=False)
        return placed.select(*keys, col, (F.col("cum__n") + (F.col("_n") + 1) / 2.0).alias(out))

    total = cells.groupBy(*keys).agg(F.sum("_c").alias("n_pairs"))
    r = null_safe_join(null_safe_join(cells, ranks("x", "_rx"), [*keys, "x"]), ranks("y", "_ry"), [*keys, "y"])
    r = null_safe_join(r, total, keys) if keys else r.withColumn("n_pairs", total.select("n_pairs").scalar())
    dx, dy = F.col("_rx") - (F.col("n_pairs") + 1) / 2.0, F.col("_ry") - (F.col("n_pairs") + 1) / 2.0
    c = F.col("_c")
    g = r.groupBy(*keys).agg(F.sum(c * dx * dy).alias("_xy"), F.sum(c * dx * dx).alias("_xx"),
                             F.sum(c * dy * dy).alias("_yy"), F.max("n_pairs").alias("n_pairs"))
    rho = F.when((F.col("_xx") > 0) & (F.col("_yy") > 0), F.col("_xy") / F.sqrt(F.col("_xx") * F.col("_yy")))
    return g.select(*keys, rho.alias("spearman"), F.coalesce("n_pairs", F.lit(0)).cast("long").alias("n_pairs"))


def spearman_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Spearman of every two columns: ``feature_a,
    feature_b, spearman, n_pairs``."""
    both = [F.when(F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull(), F.struct(
        F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"`{a}`").cast("double").alias("x"),
        F.col(f"`{b}`").cast("double").alias("y"))) for i, a in enumerate(cols) for b in cols[i + 1:]]
    long = df.select(F.explode(F.array(*both)).alias("_p")).filter(F.col("_p").isNotNull()).select("_p.*")
    return spearman_long(long, ["feature_a", "feature_b"])


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pairwise-complete Spearman of two columns (one-row frame)."""
    long = df.select(F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) \
        .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    return spearman_long(long, []).select(F.lit(a).alias("feature"), "spearman", "n_pairs")


def target_relation_report(df: DataFrame, features: list[str], target: str, min_pairs: int = MIN_PAIRS) -> DataFrame:
    """Per feature: pair count, Pearson, Spearman, max |r|, label."""
    long = _pairs_long(df, features, target)
    p = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n_pairs"), F.corr("x", "y").alias("pearson"),
                                    F.stddev_samp("x").alias("_sx"))
    s = spearman_long(long, ["feature"]).drop("n_pairs")
    j = p.join(s, "feature", "left")
    ok = (F.col("n_pairs") >= min_pairs) & (F.col("_sx") > 0)
    j = j.select("feature", "n_pairs", F.when(ok, F.col("pearson")).alias("pearson"), F.when(ok, F.col("spearman")).alias("spearman"))
    mx = F.greatest(F.abs("pearson"), F.abs("spearman"))
    return j.withColumn("max_abs_corr", mx).withColumn("relation", relation_label(mx))


def corr_matrix(df: DataFrame, cols: list[str], upper_only: bool = False) -> DataFrame:
    """Pairwise-complete Pearson for every pair in one aggregate
    (k·(k−1)/2 accumulators), long form (feature_a, feature_b, corr)."""
    pairs = [(a, b) for i, a in enumerate(cols) for j, b in enumerate(cols) if (j > i if upper_only else True)]
    one = df.agg(*[F.corr(F.when(F.col(b).isNotNull(), F.col(a)).cast("double"),
                          F.when(F.col(a).isNotNull(), F.col(b)).cast("double")).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    structs = [F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(f"c{i}").alias("corr"))
               for i, (a, b) in enumerate(pairs)]
    return one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def high_corr_pairs(df: DataFrame, cols: list[str], threshold: float = 0.9) -> DataFrame:
    """Upper-triangle pairs with |corr| ≥ threshold."""
    return corr_matrix(df, cols, upper_only=True).filter(F.abs("corr") >= threshold)


def temporal_relation(df: DataFrame, features: list[str], target: str, period: Column) -> DataFrame:
    """Spearman per feature × period."""
    long = _pairs_long(df.withColumn("period", period), features, target, ["period"])
    return spearman_long(long, ["period", "feature"])


def sign_stability(rel: DataFrame, feature: str = "feature", value: str = "spearman", period: str = "period",
                   recent=None) -> DataFrame:
    """PASS when the correlation sign is constant over periods (and a
    recent period is present), FLAG when it flips, REVIEW when empty."""
    nz = F.when(F.col(value).isNotNull() & (F.col(value) != 0), F.signum(value))
    aggs = [F.count_distinct(nz).alias("n_signs"), F.count(value).alias("n_periods")]
    if recent is not None:
        aggs.append(F.max(F.col(period) >= recent).alias("recent_present"))
    g = rel.groupBy(feature).agg(*aggs)
    rp = F.col("recent_present") if recent is not None else F.lit(True)
    return g.withColumn("stability", F.when(F.col("n_periods") == 0, "REVIEW")
                        .when((F.col("n_signs") == 1) & rp, "PASS").otherwise("FLAG"))


def train_valid_direction(df: DataFrame, features: list[str], target: str, split_col: str,
                          min_abs: float = 0.05) -> DataFrame:
    """Pearson in train and validation per feature; keep when signs
    agree and both |r| ≥ ``min_abs``."""
    long = _pairs_long(df, features, target, [split_col])
    g = long.groupBy("feature").agg(
        F.corr(F.when(F.col(split_col) == "train", F.col("x")), F.when(F.col(split_col) == "train", F.col("y"))).alias("train_corr"),
        F.corr(F.when(F.col(split_col) == "validation", F.col("x")),
               F.when(F.col(split_col) == "validation", F.col("y"))).alias("valid_corr"))
    same = F.signum("train_corr") == F.signum("valid_corr")
    strong = (F.abs("train_corr") >= min_abs) & (F.abs("valid_corr") >= min_abs)
    return g.withColumn("consistent", F.coalesce(same & strong, F.lit(False)))


def contingency_stats(df: DataFrame, a: str, b: str, group_by=()) -> DataFrame:
    """χ² statistic (no Yates) of a × b from cell and margin counts:
    χ² = n·(Σ O²/(row·col) − 1). Only non-empty cells are materialised."""
    g = list(group_by)
    d = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*g, F.col(a).cast("string").alias("_a"),
                                                                     F.col(b).cast("string").alias("_b"))
    cells = d.groupBy(*g, "_a", "_b").agg(F.count(F.lit(1)).alias("o"))
    ra = cells.groupBy(*g, "_a").agg(F.sum("o").alias("ra"))
    cb = cells.groupBy(*g, "_b").agg(F.sum("o").alias("cb"))
    j = cells.join(ra, [*g, "_a"]).join(cb, [*g, "_b"])
    return j.groupBy(*g).agg(F.sum("o").alias("n"), F.sum(F.col("o") * F.col("o") / (F.col("ra") * F.col("cb"))).alias("_s"),
                             F.count_distinct("_a").alias("r"), F.count_distinct("_b").alias("k"),
                             F.max(F.struct(F.col("o").alias("o"), (F.col("ra") * F.col("cb")).alias("m"))).alias("_cell")) \
        .withColumn("chi2", F.col("n") * (F.col("_s") - 1.0)) \
        .withColumn("deviation", F.abs(F.col("_cell.o") - F.col("_cell.m") / F.col("n"))).drop("_s", "_cell")


def cramers_v(df: DataFrame, a: str, b: str, group_by=()) -> DataFrame:
    """Bias-corrected Cramér's V (no Yates); 0 for fewer than two
    levels on a side or n ≤ 1."""
    return _cramers_from(contingency_stats(df, a, b, group_by)).drop("deviation")


def _cramers_from(c: DataFrame) -> DataFrame:
    n, r, k = F.col("n").cast("double"), F.col("r").cast("double"), F.col("k").cast("double")
    phi2 = F.col("chi2") / n
    phi2c = F.greatest(F.lit(0.0), phi2 - (k - 1) * (r - 1) / (n - 1))
    rc, kc = r - (r - 1) * (r - 1) / (n - 1), k - (k - 1) * (k - 1) / (n - 1)
    den = F.least(kc - 1, rc - 1)
    v = F.when((F.col("r") < 2) | (F.col("k") < 2) | (F.col("n") <= 1) | (den <= 0), F.lit(0.0)).otherwise(F.sqrt(phi2c / den))
    return c.withColumn("cramers_v", v)


def chi2_sf(x: float, dof: int) -> float:
    """Upper tail of the χ² distribution (regularised upper incomplete
    gamma Q(dof/2, x/2)); driver-side on a scalar."""
    if x is None or x != x:
        return float("nan")
    if x <= 0:
        return 1.0
    s, z = dof / 2.0, x / 2.0
    if dof == 1:
        return math.erfc(math.sqrt(z))
    if z < s + 1:  # series for P, then Q = 1 − P
        term = total = 1.0 / s
        a = s
        for _ in range(1000):
            a += 1
            term *= z / a
            total += term
            if term < total * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-z + s * math.log(z) - math.lgamma(s)))
    b, c, d = z + 1 - s, 1e300, 1.0 / (z + 1 - s)  # continued fraction for Q
    h = d
    for i in range(1, 1000):
        an = -i * (i - s)
        b += 2
        d = an * d + b
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = b + an / c
        c = c if abs(c) > 1e-300 else 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return math.exp(-z + s * math.log(z) - math.lgamma(s)) * h


def chi2_test(df: DataFrame, a: str, b: str, yates_2x2: bool = True) -> dict:
    """χ² independence test; Yates correction on 2×2 tables. Statistic,
    shape and correction are Spark aggregates; one row reaches the driver,
    where the p-value is computed."""
    row = chi2_table(df, a, b, (), yates_2x2).first()
    n, r, k = (row["n"] or 0), row["r"], row["k"]
    dof = max(0, (r - 1) * (k - 1))
    stat = row["chi2"] if row["chi2"] is not None else 0.0
    return {"chi2": stat, "dof": dof, "p_value": chi2_sf(stat, dof) if dof > 0 else 1.0, "n": n, "yates": bool(row["yates"])}


def chi2_table(df: DataFrame, a: str, b: str, group_by=(), yates_2x2: bool = True) -> DataFrame:
    """χ² per group with shape (r × k), ``yates`` and the corrected statistic:
    in a 2×2 table all four deviations are equal, so the correction scales the
    statistic by ((d − ½) / d)²."""
    c = contingency_stats(df, a, b, group_by)
    yates = (F.col("r") == 2) & (F.col("k") == 2) & F.lit(yates_2x2)
    d = F.col("deviation")
    scale = F.when(yates & (d > 0), F.pow(F.greatest(F.lit(0.0), d - 0.5) / d, F.lit(2.0))).otherwise(F.lit(1.0))
    return c.withColumn("chi2_raw", F.col("chi2")).withColumn("chi2", F.col("chi2") * scale).withColumn("yates", F.coalesce(yates, F.lit(False)))


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| > t) of Student's t: the regularised incomplete beta function
    I(dof / (dof + t²); dof / 2, ½), by its continued fraction."""
    if t is None or t != t:
        return float("nan")
    x, a, b = dof / (dof + t * t), dof / 2.0, 0.5

    def fraction(x, a, b):
        tiny = 1e-300
        c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
        d = 1.0 / (d if abs(d) > tiny else tiny)
        h = d
        for m in range(1, 10_000):
            for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1.0 + num * d
                c = 1.0 + num / c
                d = 1.0 / (d if abs(d) > tiny else tiny)
                c = c if abs(c) > tiny else tiny
                h *= d * c
            if abs(d * c - 1) < 1e-15:
                break
        return h

    if x >= 1.0:
        return 1.0
    if x <= 0.0:
        return 0.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * fraction(x, a, b) / a if x < (a + 1) / (a + b + 2) else 1.0 - front * fraction(1 - x, b, a) / b


def biserial_moments(df: DataFrame, numeric: list[str], label: str) -> DataFrame:
    """``feature, n, r, n_values`` of every numeric feature against a binary
    label, in one pass over the long form."""
    long = _pairs_long(df, numeric, label)
    cells = long.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("r"), F.min("x").alias("_a"), F.max("x").alias("_z"))
    return cells.select("feature", "n", "r", (F.col("_a") < F.col("_z")).alias("varies"))


def _biserial(row, min_pairs: int) -> tuple[float, float]:
    """(r, p) of a moments row; 0 and 1 below the guard."""
    if row is None or row["n"] <= min_pairs or not row["varies"]:
        return 0.0, 1.0
    r = float("nan") if row["r"] is None else float(row["r"])
    return r, (0.0 if abs(r) >= 1 else t_two_sided(r * math.sqrt((row["n"] - 2) / (1 - r * r)), row["n"] - 2))


def point_biserial(df: DataFrame, x: str, label: str, min_pairs: int = MIN_PAIRS) -> DataFrame:
    """Correlation of a numeric feature with a binary label and its
    p-value (t distribution, n − 2 degrees of freedom). One row of moments
    reaches the driver."""
    row = biserial_moments(df, [x], label).first()
    r, p = _biserial(row, min_pairs)
    return df.sparkSession.createDataFrame([(x, row["n"] if row else 0, r, p)], "feature string, n long, r double, p_value double")


def relevance_ranking(df: DataFrame, numeric: list[str], categorical: list[str], label: str,
                      min_pairs: int = MIN_PAIRS) -> DataFrame:
    """Per feature metric, score, effect size and p-value — point-biserial
    r for numeric features, Cramér's V with the χ² test for categorical ones —
    by effect size descending. One pass each over the numeric and categorical
    long forms; a row per feature reaches the driver for its p-value."""
    rows = []
    if numeric:
        moments = {m["feature"]: m for m in biserial_moments(df, numeric, label).collect()}
        for f in numeric:
            r, p = _biserial(moments.get(f), min_pairs)
            rows.append((f, "point_biserial_r", r, abs(r), p))
    if categorical:
        long = df.select(F.col(label).alias("_label"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("_level")) for c in categorical])).alias("_r"))
        table = chi2_table(long.select("_label", "_r.*"), "_level", "_label", ["feature"])
        found = {c["feature"]: c for c in _cramers_from(table.withColumn("_chi2", F.col("chi2")).withColumn("chi2", F.col("chi2_raw"))).collect()}
        for f in categorical:
            c = found.get(f)
            two = c is not None and c["r"] > 1 and c["k"] > 1
            v = float(c["cramers_v"]) if two else 0.0
            rows.append((f, "cramers_v", v, v, chi2_sf(c["_chi2"], (c["r"] - 1) * (c["k"] - 1)) if two else 1.0))
    rows.sort(key=lambda r: (-r[3], r[0]))
    return df.sparkSession.createDataFrame(
        [(i + 1, *r) for i, r in enumerate(rows)], "place int, feature string, metric string, score double, effect_size double, p_value double")


def distribution_by_label(df: DataFrame, score: str, label: str) -> DataFrame:
    """Score quantiles 5/25/50/75/95, min, max, n per label."""
    g = df.groupBy(label).agg(F.count(score).alias("n"), F.min(score).cast("double").alias("min"),
                              F.max(score).cast("double").alias("max"))
    spec = {f"p{p:02d}": (score, p / 100) for p in (5, 25, 50, 75, 95)}
    return with_group_quantiles(g, df, label, spec).select(label, "n", "min", *spec, "max")
