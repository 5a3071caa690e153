"""Queries for §2.15 preprocessing (fit on train, apply anywhere)."""

from pyspark.sql import functions as F

from basketry.operators import preprocess as pp
from basketry.plans.catalog import register, table, tidy
from basketry.plans.queries.q_profile import ORDERS_ITEMS_SQL, orders_items

TRAIN_END = "1999-01-01"


def split_frame(spark, sf):
    """Orders ⟕ item totals with an is_train flag (order date < 1999)."""
    j = orders_items(spark, sf).join(table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority"), "o_orderkey")
    return j.withColumn("is_train", F.col("o_orderdate") < F.lit(TRAIN_END).cast("timestamp_ntz"))


SPLIT_SQL = ORDERS_ITEMS_SQL + f""",
sp AS (SELECT j.*, o.o_orderdate, o.o_orderpriority, o.o_orderdate < TIMESTAMP '{TRAIN_END}' AS is_train FROM j JOIN orders o USING (o_orderkey))
"""


@register("median_impute", SPLIT_SQL + """,
m AS (SELECT quantile_cont(total_quantity, 0.5) AS med FROM sp WHERE is_train)
SELECT is_train, count_if(total_quantity IS NULL) AS n_filled, round(sum(coalesce(total_quantity, med)), 4) AS sum_filled FROM sp, m GROUP BY 1""")
def q_median_impute(spark, sf):
    """Train median fills NULLs in every split."""
    d = split_frame(spark, sf)
    st = pp.fit_median(d.filter("is_train"), ["total_quantity"])
    f = pp.apply_fill(d.withColumn("was_null", F.col("total_quantity").isNull()), st, ["total_quantity"])
    return tidy(f.groupBy("is_train").agg(F.count_if("was_null").alias("n_filled"), F.sum("total_quantity").alias("sum_filled")), 4)


@register("mode_impute", """
WITH f AS (SELECT l_orderkey, min(l_returnflag) AS flag FROM lineitem GROUP BY 1),
sp AS (SELECT o_orderkey, flag, o_orderdate < TIMESTAMP '1999-01-01' AS is_train FROM orders LEFT JOIN f ON o_orderkey = l_orderkey),
m AS (SELECT flag FROM sp WHERE is_train AND flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, flag LIMIT 1)
SELECT is_train, coalesce(sp.flag, m.flag) AS flag, count(*) AS n FROM sp, m GROUP BY 1, 2""")
def q_mode_impute(spark, sf):
    """Most frequent train value (ties → smallest) fills NULLs."""
    f = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_returnflag").alias("flag"))
    d = table(spark, sf, "orders").join(f, "o_orderkey", "left").withColumn(
        "is_train", F.col("o_orderdate") < F.lit(TRAIN_END).cast("timestamp_ntz"))
    st = pp.fit_mode(d.filter("is_train"), ["flag"])
    return pp.apply_fill(d, st, ["flag"]).groupBy("is_train", "flag").agg(F.count(F.lit(1)).alias("n"))


@register("constant_and_token_impute", SPLIT_SQL + """,
m AS (SELECT quantile_cont(discount_total, 0.5) AS med FROM sp WHERE is_train)
SELECT 'total_quantity' AS column_name, 'zero' AS rule, count_if(total_quantity IS NULL) AS nulls_before, 0::BIGINT AS nulls_after FROM sp
UNION ALL SELECT 'discount_total', 'median', count_if(discount_total IS NULL), 0::BIGINT FROM sp""")
def q_token_impute(spark, sf):
    """O03 + O04: count-like names → 0, others → train median; audit."""
    d = split_frame(spark, sf)
    _, audit = pp.token_impute(d.filter("is_train"), d, ["total_quantity", "discount_total"])
    return audit


@register("standard_scale", SPLIT_SQL + """,
sc AS (SELECT avg(o_totalprice) AS mu, stddev_pop(o_totalprice) AS sd FROM sp WHERE is_train)
SELECT is_train, round(avg((o_totalprice - mu) / sd), 9) + 0.0 AS mean_scaled, round(stddev_pop((o_totalprice - mu) / sd), 9) AS std_scaled FROM sp, sc GROUP BY 1""")
def q_standard_scale(spark, sf):
    """(x − train mean) / train population std."""
    d = split_frame(spark, sf)
    st = pp.fit_scaler(d.filter("is_train"), ["o_totalprice"], ddof=0)
    s = pp.apply_scaler(d, st, ["o_totalprice"])
    out = tidy(s.groupBy("is_train").agg(F.avg("o_totalprice").alias("mean_scaled"), F.stddev_pop("o_totalprice").alias("std_scaled")))
    # the train mean is 0 up to float noise of either sign: + 0.0 drops the sign of a rounded zero
    return out.withColumn("mean_scaled", F.col("mean_scaled") + F.lit(0.0))


@register("one_hot_train_levels", SPLIT_SQL + """
SELECT is_train, """ + ", ".join(f"sum(CASE WHEN o_orderpriority = '{v}' THEN 1 ELSE 0 END) AS \"o_orderpriority_{v}\""
                                 for v in ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]) + " FROM sp GROUP BY 1")
def q_one_hot(spark, sf):
    """One column per train level; unseen levels → all zeros."""
    d = split_frame(spark, sf)
    levels = pp.fit_levels(d.filter("is_train"), "o_orderpriority")
    oh = pp.apply_one_hot(d, "o_orderpriority", levels)
    return oh.groupBy("is_train").agg(*[F.sum(f"`o_orderpriority_{lv}`").alias(f"o_orderpriority_{lv}") for lv in levels])


@register("kbins_quantile_onehot", SPLIT_SQL + """,
e AS (SELECT quantile_cont(o_totalprice, [0, 0.25, 0.5, 0.75, 1]) AS e FROM sp WHERE is_train),
b AS (SELECT is_train, len(list_filter(e[2:4], lambda v: v <= o_totalprice)) AS k FROM sp, e)
SELECT is_train, """ + ", ".join(f"sum(CASE WHEN k = {i} THEN 1 ELSE 0 END) AS o_totalprice_bin_{i}" for i in range(4)) + " FROM b GROUP BY 1")
def q_kbins(spark, sf):
    """4 train-fitted quantile bins (left-closed), one-hot."""
    d = split_frame(spark, sf)
    k = pp.kbins_quantile_onehot(d.filter("is_train"), d, "o_totalprice", 4)
    return k.groupBy("is_train").agg(*[F.sum(f"o_totalprice_bin_{i}").alias(f"o_totalprice_bin_{i}") for i in range(4)])


@register("column_type_split", """
SELECT * FROM (VALUES ('l_quantity', 'numeric'), ('l_returnflag', 'categorical'), ('is_returned', 'binary'), ('l_discount', 'numeric'))
  t(column_name, kind)""")
def q_column_type_split(spark, sf):
    """Binary / numeric / categorical from the data."""
    li = table(spark, sf, "lineitem").withColumn("is_returned", (F.col("l_returnflag") == "R").cast("int"))
    return pp.column_type_split(li, ["l_quantity", "l_returnflag", "is_returned", "l_discount"])


@register("class_weight", """
WITH y AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)
SELECT y, count(*) AS n, round(max(CASE WHEN y = 1 THEN (SELECT count(*) FROM y) / (2.0 * (SELECT sum(y) FROM y))
                               ELSE (SELECT count(*) FROM y) / (2.0 * ((SELECT count(*) FROM y) - (SELECT sum(y) FROM y))) END), 9) AS weight
FROM y GROUP BY 1""")
def q_class_weight(spark, sf):
    """Balanced class weights n / (2·n_c)."""
    li = table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("int").alias("y"))
    w = pp.class_weight(li, "y")
    return tidy(w.groupBy("y").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("weight")))


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@register("preprocess_pipeline", SPLIT_SQL + """,
m AS (SELECT quantile_cont(o_totalprice, 0.5) AS m0, quantile_cont(total_quantity, 0.5) AS m1, quantile_cont(discount_total, [0.25, 0.5, 0.75]) AS e
      FROM sp WHERE is_train),
f AS (SELECT is_train, coalesce(o_totalprice, m0) AS x0, coalesce(total_quantity, m1) AS x1, o_orderpriority AS p,
             CASE WHEN discount_total IS NOT NULL THEN len(list_filter(list_distinct(e), lambda v: v <= discount_total)) END AS k FROM sp, m),
c AS (SELECT avg(x0) AS a0, stddev_pop(x0) AS s0, avg(x1) AS a1, stddev_pop(x1) AS s1 FROM f WHERE is_train)
SELECT is_train, round(sum((x0 - a0) / s0), 4) + 0.0 AS o_totalprice, round(sum((x1 - a1) / s1), 4) + 0.0 AS total_quantity,
       """ + ", ".join(f"count_if(p = '{v}') AS \"o_orderpriority_{v}\"" for v in PRIORITIES) + ", " + ", ".join(
    f"count_if(k = {i}) AS discount_total_bin_{i}" for i in range(4)) + " FROM f, c GROUP BY 1")
def q_preprocess_pipeline(spark, sf):
    """Per-group chains fitted once on train, applied to all rows."""
    d = split_frame(spark, sf)
    p = pp.Preprocessor(numeric=["o_totalprice", "total_quantity"], categorical=["o_orderpriority"], quantile=["discount_total"])
    p.fit(d.filter("is_train"))
    out = p.transform(d, keep=["o_orderkey", "is_train"])
    sums = tidy(out.groupBy("is_train").agg(*[F.sum(f"`{c}`").alias(c) for c in p.output_columns()]), 4)
    return sums.withColumns({c: F.col(c) + F.lit(0.0) for c in p.numeric})  # a sum near 0 has no sign


@register("level_vectors", SPLIT_SQL + """,
lv AS (SELECT DISTINCT o_totalprice FROM sp WHERE is_train AND o_totalprice IS NOT NULL),
x AS (SELECT is_train, o_totalprice IN (SELECT o_totalprice FROM sp WHERE is_train) AS hit FROM sp)
SELECT is_train, count(*) AS n_rows, (SELECT count(*) FROM lv) AS n_levels, count_if(hit) AS n_ones FROM x GROUP BY 1""")
def q_level_vectors(spark, sf):
    """Sparse vectors over a column with a level for almost every row (the
    order value as text), from the fitted level table."""
    d = split_frame(spark, sf).select("is_train", F.col("o_totalprice").cast("string").alias("price_text"))
    levels = pp.fit_level_table(d.filter("is_train"), ["price_text"])
    out = pp.apply_level_vectors(d, ["price_text"], levels)
    n = pp.level_counts(levels)["price_text"]
    ones = pp.vector_nonzeros(out, "price_text_vec", ["is_train"])
    hits = ones.groupBy("is_train").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_nonzero").alias("n_ones"))
    return hits.select("is_train", "n_rows", F.lit(n).cast("long").alias("n_levels"), "n_ones")


@register("pca_95", SPLIT_SQL + """,
t AS (SELECT avg(o_totalprice) AS a0, stddev_pop(o_totalprice) AS s0, avg(coalesce(total_quantity, m)) AS a1, stddev_pop(coalesce(total_quantity, m)) AS s1,
             corr(o_totalprice, coalesce(total_quantity, m)) AS r, max(m) AS m
      FROM sp, (SELECT quantile_cont(total_quantity, 0.5) AS m FROM sp WHERE is_train) WHERE is_train),
z AS (SELECT o_orderkey, is_train, (o_totalprice - a0) / s0 AS x, (coalesce(total_quantity, m) - a1) / s1 AS y, r FROM sp, t)
SELECT o_orderkey, is_train, CASE WHEN (1 + abs(r)) / 2 >= 0.95 THEN 1 ELSE 2 END AS n_components,
       round((x + sign(r) * y) / sqrt(2), 6) + 0.0 AS pc1, round((x - sign(r) * y) / sqrt(2), 6) + 0.0 AS pc2, round((1 + abs(r)) / 2, 9) AS explained_1 FROM z""")
def q_pca(spark, sf):
    """Principal components of two scaled columns, fitted on train: their
    values per order (both, for the check), how many reach 95% and the first's share."""
    d = split_frame(spark, sf)
    p = pp.Preprocessor(numeric=["o_totalprice", "total_quantity"])
    p.fit(d.filter("is_train"))
    scaled = p.transform(d, keep=["o_orderkey", "is_train"])
    kept = pp.principal_components(scaled.filter("is_train"), p.numeric)
    both, _ = pp.pca_95(scaled.filter("is_train"), scaled, p.numeric, var=1.0)
    out = tidy(both.select("o_orderkey", "is_train", F.lit(len(kept.components)).alias("n_components"), "pc1", "pc2",
                           F.lit(kept.explained[0]).alias("explained_1")), 6, {"explained_1": 9})
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in ("pc1", "pc2")})
