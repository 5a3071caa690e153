"""Queries for §2.3 profiling and data-quality reports."""

from pyspark.sql import functions as F

from basketry.operators import profile
from basketry.plans.catalog import register, table, tidy
from basketry.plans.queries.q_rollup import LINES_SQL, lines
from basketry.sources import retail

SPARK_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz"}
CUSTOMER_COLS = [("c_custkey", "BIGINT"), ("c_name", "VARCHAR"), ("c_nationkey", "INTEGER"), ("c_acctbal", "DOUBLE"),
                 ("c_mktsegment", "VARCHAR")]


def _union(parts):
    return "SELECT * FROM (" + "\nUNION ALL ".join(parts) + ")"


@register("schema_report", _union([
    f"SELECT '{c}' AS column_name, '{SPARK_TYPE[t]}' AS dtype, count({c}) AS non_null, count(*) - count({c}) AS missing, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 9) AS missing_pct, count(DISTINCT {c}) AS nunique, "
    f"CAST(min({c}) AS VARCHAR) AS example FROM customer" for c, t in CUSTOMER_COLS]))
def q_schema_report(spark, sf):
    """Per-column type, null counts, distinct count, example (one scan)."""
    return tidy(profile.schema_report(table(spark, sf, "customer")))


ORDERS_ITEMS_SQL = """
WITH s AS (SELECT l_orderkey, sum(l_quantity) AS total_quantity, sum(l_extendedprice * l_discount) AS discount_total,
                  min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1),
j AS (SELECT o_orderkey, o_orderstatus, o_totalprice, total_quantity, discount_total, first_ship FROM orders LEFT JOIN s ON o_orderkey = l_orderkey)
"""
J_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice", "total_quantity", "discount_total", "first_ship"]


def orders_items(spark, sf):
    """Orders ⟕ per-order item totals: orders without items carry NULLs."""
    s = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum("l_quantity").alias("total_quantity"), F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_total"),
        F.min("l_shipdate").alias("first_ship"))
    return table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").join(s, "o_orderkey", "left")


MISSING_SQL = ORDERS_ITEMS_SQL + ", m AS (" + _union([
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count_if({c} IS NULL) AS missing, "
    f"count_if({c} IS NULL) * 100.0 / count(*) AS missing_pct FROM j" for c in J_COLS]) + ")\n"


@register("missing_report", MISSING_SQL + """
SELECT column_name, n_rows, missing, round(missing_pct, 9) AS missing_pct,
       CASE WHEN missing_pct / 100 = 0 THEN 'none' WHEN missing_pct / 100 < 0.05 THEN 'low' WHEN missing_pct / 100 < 0.30 THEN 'medium'
            ELSE 'high' END AS missing_level FROM m""")
def q_missing_report(spark, sf):
    """C02 + C03: missing count/pct per column with its level."""
    r = profile.missing_report(orders_items(spark, sf))
    return tidy(r.withColumn("missing_level", profile.missing_level()))


MISSING_RULES = [("o_orderkey", "critical_key_drop_rows"), ("total_quantity", "no_items_fill_zero"),
                 ("discount_total", "valid_null_keep"), ("first_ship", "placeholder_unshipped")]


@register("missing_decision", MISSING_SQL + """,
r(column_name, rule) AS (VALUES """ + ", ".join(f"('{c}', '{r}')" for c, r in MISSING_RULES) + """)
SELECT m.column_name, missing, r.rule, CASE WHEN missing = 0 THEN 'no_action' ELSE coalesce(r.rule, 'flag') END AS decision
FROM m LEFT JOIN r USING (column_name)""")
def q_missing_decision(spark, sf):
    """Business rule per missing column."""
    rules = spark.createDataFrame(MISSING_RULES, "column_name string, rule string")
    r = profile.missing_decision(profile.missing_report(orders_items(spark, sf)), rules)
    return r.select("column_name", "missing", "rule", "decision")


@register("missing_pattern", ORDERS_ITEMS_SQL + """
SELECT CAST(total_quantity IS NULL AS INTEGER) AS total_quantity_null, CAST(first_ship IS NULL AS INTEGER) AS first_ship_null,
       CAST(o_totalprice IS NULL AS INTEGER) AS o_totalprice_null, count(*) AS n_rows FROM j GROUP BY 1, 2, 3""")
def q_missing_pattern(spark, sf):
    """Frequency of each null / not-null combination."""
    return profile.missing_pattern(orders_items(spark, sf), ["total_quantity", "first_ship", "o_totalprice"])


@register("duplicate_report", """
SELECT count(*) AS n_rows, count(*) - count(DISTINCT (l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS duplicate_full_rows,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_key_rows FROM lineitem""")
def q_duplicate_report(spark, sf):
    """Duplicate full rows and duplicate key rows."""
    return profile.duplicate_report(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("key_uniqueness", _union([
    f"SELECT '{t}' AS table_name, '{','.join(k)}' AS key_columns, count(*) AS n_rows, count(DISTINCT ({', '.join(k)}, 0)) AS unique_key_count, "
    f"count(*) - count(DISTINCT ({', '.join(k)}, 0)) AS duplicate_key_rows, "
    f"round((count(*) - count(DISTINCT ({', '.join(k)}, 0))) * 100.0 / count(*), 9) AS duplicate_pct, "
    f"CASE WHEN count(*) = count(DISTINCT ({', '.join(k)}, 0)) THEN 'unique' ELSE 'duplicates' END AS status FROM {src}"
    for t, src, k in [("orders", "orders", ["o_orderkey"]), ("lineitem_line", "lineitem", ["l_orderkey", "l_linenumber"]),
                      ("lineitem_part", "lineitem", ["l_orderkey", "l_partkey"]), ("customer", "customer", ["c_custkey"])]]))
def q_key_uniqueness(spark, sf):
    """Candidate keys of several tables."""
    li = table(spark, sf, "lineitem")
    return tidy(profile.key_uniqueness({"orders": (table(spark, sf, "orders"), ["o_orderkey"]),
                                        "lineitem_line": (li, ["l_orderkey", "l_linenumber"]),
                                        "lineitem_part": (li, ["l_orderkey", "l_partkey"]),
                                        "customer": (table(spark, sf, "customer"), ["c_custkey"])}))


@register("duplicate_examples", """
WITH d AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE (l_orderkey, l_linenumber) IN (SELECT (l_orderkey, l_linenumber) FROM d)
ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity LIMIT 20""")
def q_duplicate_examples(spark, sf):
    """First rows of duplicated keys in key order."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return profile.duplicate_examples(li, ["l_orderkey", "l_linenumber"], 20)


def _num_summary_sql(src, cols):
    parts = []
    for c in cols:
        q = f"quantile_cont({c}, [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])"
        pcts = ", ".join(f"round({q}[{j + 1}], 4) AS p{int(p * 100):02d}" for j, p in enumerate([0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]))
        parts.append(f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, "
                     f"round(min({c}), 4) AS min, {pcts}, round(max({c}), 4) AS max, "
                     f"round((count(*) - count({c})) * 100.0 / count(*), 4) AS missing_pct, round(skewness({c}), 9) AS skew FROM {src}")
    return _union(parts)


@register("numeric_summary", _num_summary_sql("orders", ["o_totalprice", "o_custkey"]))
def q_numeric_summary(spark, sf):
    """describe() + percentiles + bias-adjusted skew."""
    s = profile.numeric_summary(table(spark, sf, "orders"), ["o_totalprice", "o_custkey"])
    return tidy(s, 4, {"skew": 9})


@register("iqr_outlier_report", _union([
    f"SELECT '{c}' AS column_name, round(q[1], 4) AS q1, round(q[2], 4) AS q3, round(q[2] - q[1], 4) AS iqr, "
    f"round(q[1] - 1.5 * (q[2] - q[1]), 4) AS lower_bound, round(q[2] + 1.5 * (q[2] - q[1]), 4) AS upper_bound, "
    f"count_if({c} < q[1] - 1.5 * (q[2] - q[1]) OR {c} > q[2] + 1.5 * (q[2] - q[1])) AS n_outliers, "
    f"round(count_if({c} < q[1] - 1.5 * (q[2] - q[1]) OR {c} > q[2] + 1.5 * (q[2] - q[1])) * 100.0 / count(*), 9) AS outlier_pct "
    f"FROM lineitem, (SELECT quantile_cont({c}, [0.25, 0.75]) AS q FROM lineitem) GROUP BY q"
    for c in ["l_quantity", "l_extendedprice", "l_discount"]]))
def q_iqr_outliers(spark, sf):
    """IQR fences and outlier counts, all columns in one pass each."""
    r = profile.iqr_outlier_report(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return tidy(r, 4, {"outlier_pct": 9})


def _tail_sql(t, cols):
    out = []
    for c in cols:
        out.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, round(q[1], 4) AS q01, round(q[2], 4) AS q25, round(q[3], 4) AS q50, "
                   f"round(q[4], 4) AS q75, round(q[5], 4) AS q99, count_if({c} < q[2] - 1.5 * (q[4] - q[2])) AS n_low, "
                   f"count_if({c} > q[4] + 1.5 * (q[4] - q[2])) AS n_high FROM {t}, "
                   f"(SELECT quantile_cont({c}, [0.01, 0.25, 0.5, 0.75, 0.99]) AS q FROM {t}) GROUP BY q")
    return out


@register("outlier_tail_profile", _union(_tail_sql("customer", ["c_custkey", "c_nationkey", "c_acctbal"])
                                         + _tail_sql("part", ["p_partkey", "p_size", "p_retailprice"])))
def q_outlier_tail(spark, sf):
    """C11: tails and low/high outliers for every numeric column."""
    return tidy(profile.outlier_tail_profile({"customer": table(spark, sf, "customer"), "part": table(spark, sf, "part")}), 4)


@register("outlier_business_context", LINES_SQL + """,
u AS (SELECT order_id, line_number, product_id, unit_price, price FROM lines)
SELECT order_id, round(unit_price, 6) AS unit_price, round(price, 6) AS price, round((unit_price - price) / unit_price, 9) AS margin,
       CASE WHEN price IS NULL THEN 'no_cost_reference' WHEN unit_price < price THEN 'below_cost'
            WHEN (unit_price - price) / unit_price > 0.8 THEN 'extreme_markup' WHEN (unit_price - price) / unit_price >= 0.2 THEN 'premium_consistent'
            ELSE 'thin_margin' END AS context
FROM u WHERE unit_price > (SELECT quantile_cont(unit_price, 0.99) FROM u) ORDER BY unit_price DESC, order_id LIMIT 50""")
def q_outlier_business(spark, sf):
    """Top unit prices above p99 labelled by the cost rule."""
    r = profile.outlier_business_context(lines(spark, sf), "unit_price", "price", "order_id", 50)
    return tidy(r, 6, {"margin": 9})


@register("categorical_summary", """
WITH long AS (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value FROM orders
              UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
c AS (SELECT column_name, value, count(*) AS n FROM long GROUP BY 1, 2),
t AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS rk FROM c WHERE value IS NOT NULL)
SELECT column_name, count(value) AS nunique, round(sum(CASE WHEN value IS NULL THEN n ELSE 0 END) * 100.0 / sum(n), 9) AS missing_pct,
       (SELECT string_agg(value || ':' || n, ', ' ORDER BY rk) FROM t WHERE t.column_name = c.column_name AND rk <= 3) AS top_values
FROM c GROUP BY column_name""")
def q_categorical_summary(spark, sf):
    """Nunique, missing pct and top-3 value:count per column."""
    return tidy(profile.categorical_summary(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], 3))


@register("date_range_report", _union([
    f"SELECT '{c}' AS column_name, CAST(min(CAST({c} AS DATE)) AS VARCHAR) AS min_date, CAST(max(CAST({c} AS DATE)) AS VARCHAR) AS max_date, "
    f"count_if({c} IS NULL) AS missing, count(DISTINCT CAST({c} AS DATE)) AS unique_dates FROM lineitem" for c in ["l_shipdate"]]))
def q_date_range(spark, sf):
    """C14: min/max/missing/unique dates."""
    return tidy(profile.date_range_report(table(spark, sf, "lineitem"), ["l_shipdate"]))


@register("numeric_value_check", _union([
    f"SELECT '{c}' AS column_name, count_if(isnan({c}::DOUBLE)) AS n_nan, count_if({c} < 0) AS n_negative, count_if({c} = 0) AS n_zero, "
    f"round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(avg({c}), 9) AS mean FROM lineitem"
    for c in ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]]))
def q_numeric_value_check(spark, sf):
    """NaN / negative / zero counts, min, max, mean."""
    r = profile.numeric_value_check(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_extendedprice"])
    return tidy(r, 4, {"mean": 9})


ORDER_COLS = [("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "VARCHAR"), ("o_totalprice", "DOUBLE"),
              ("o_orderdate", "TIMESTAMP"), ("o_orderpriority", "VARCHAR")]


@register("dtype_audit", "WITH r AS (" + _union([
    f"SELECT '{c}' AS column_name, '{SPARK_TYPE[t]}' AS dtype, count(DISTINCT {c}) AS nunique FROM orders" for c, t in ORDER_COLS]) + """)
SELECT column_name, dtype, nunique,
  CASE WHEN dtype IN ('date', 'timestamp', 'timestamp_ntz') OR regexp_matches(lower(column_name), '(date|_at)$') THEN 'date'
       WHEN regexp_matches(lower(column_name), '(^id$|_id$|key$)') THEN 'id'
       WHEN nunique <= 2 THEN 'boolean'
       WHEN dtype IN ('tinyint', 'smallint', 'int', 'bigint', 'float', 'double') AND nunique <= 20 THEN 'numeric_discrete'
       WHEN dtype IN ('tinyint', 'smallint', 'int', 'bigint', 'float', 'double') THEN 'numeric_continuous'
       WHEN nunique <= 30 THEN 'categorical_low' ELSE 'categorical_high' END AS semantic_type,
  NULL::VARCHAR AS note FROM r""")
def q_dtype_audit(spark, sf):
    """Semantic type from name, type and cardinality."""
    return profile.dtype_audit(table(spark, sf, "orders"))


@register("feature_view_type", _union([
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS nunique, CASE WHEN count(DISTINCT {c}) <= 2 THEN 'binary' "
    f"WHEN count(DISTINCT {c}) <= 12 THEN 'low_cardinality' ELSE '{kind}' END AS view_type FROM lineitem"
    for c, kind in [("l_returnflag", "other"), ("l_linestatus", "other"), ("l_quantity", "continuous"), ("l_tax", "continuous"),
                    ("l_discount", "continuous")]]))
def q_feature_view_type(spark, sf):
    """C17: binary / low-cardinality / continuous / other."""
    return profile.feature_view_type(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_quantity", "l_tax", "l_discount"])


@register("date_continuity", """
WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_shipdate IS NOT NULL),
b AS (SELECT min(d) AS a, max(d) AS z, count(*) AS actual_days FROM d),
s AS (SELECT CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS d FROM b),
m AS (SELECT d FROM s WHERE d NOT IN (SELECT d FROM d))
SELECT CAST(a AS VARCHAR) AS min_date, CAST(z AS VARCHAR) AS max_date, date_diff('day', a, z) + 1 AS expected_days, actual_days,
       (SELECT count(*) FROM m) AS missing_days, CAST((SELECT min(d) FROM m) AS VARCHAR) AS first_missing,
       CAST((SELECT max(d) FROM m) AS VARCHAR) AS last_missing FROM b""")
def q_date_continuity(spark, sf):
    """Expected vs actual days and the missing ones."""
    return tidy(profile.date_continuity(table(spark, sf, "lineitem"), "l_shipdate"))


@register("date_coverage", """
WITH t AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT 'shipments' AS source, count(*) AS target_days, count_if(d IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)) AS covered_days,
       round(count_if(d IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)) * 1.0 / count(*), 9) AS coverage,
       CASE WHEN count_if(d IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)) * 1.0 / count(*) >= 0.6 THEN 'use' ELSE 'skip' END AS decision FROM t
UNION ALL
SELECT 'events', count(*), count_if(d IN (SELECT CAST(ts AS DATE) FROM events)),
       round(count_if(d IN (SELECT CAST(ts AS DATE) FROM events)) * 1.0 / count(*), 9),
       CASE WHEN count_if(d IN (SELECT CAST(ts AS DATE) FROM events)) * 1.0 / count(*) >= 0.6 THEN 'use' ELSE 'skip' END FROM t""")
def q_date_coverage(spark, sf):
    """Share of order days present in each source; skip below 60%."""
    o = table(spark, sf, "orders").select(F.col("o_orderdate").alias("d"))
    srcs = {"shipments": table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("d")),
            "events": table(spark, sf, "events").select(F.col("ts").alias("d"))}
    return tidy(profile.date_coverage(o, srcs, "d"))


@register("issue_log_action_plan", MISSING_SQL + """,
v AS (SELECT 'lineitem' AS table_name, 'l_discount' AS column_name, 'rule_violation' AS issue,
             count_if(l_discount > 0.08) AS issue_count, 'medium' AS severity, 'review_discount_policy' AS action FROM lineitem),
mi AS (SELECT 'orders_items' AS table_name, column_name, 'missing' AS issue, missing AS issue_count,
              CASE WHEN missing_pct >= 30 THEN 'high' ELSE 'low' END AS severity, 'impute_or_flag' AS action FROM m),
log AS (SELECT * FROM mi UNION ALL SELECT * FROM v)
SELECT severity, issue, action, sum(issue_count)::BIGINT AS total_count, count(*) AS n_checks,
       CASE WHEN severity = 'high' THEN 0 WHEN severity = 'medium' THEN 1 ELSE 2 END AS severity_order
FROM log WHERE issue_count > 0 GROUP BY 1, 2, 3""")
def q_issue_log(spark, sf):
    """C21 + C22: failing checks unioned into an issue log, then grouped
    into an action plan."""
    m = profile.missing_report(orders_items(spark, sf)).select(
        F.lit("orders_items").alias("table_name"), "column_name", F.lit("missing").alias("issue"), F.col("missing").alias("issue_count"),
        F.when(F.col("missing_pct") >= 30, "high").otherwise("low").alias("severity"), F.lit("impute_or_flag").alias("action"))
    li = table(spark, sf, "lineitem")
    v = li.agg(F.count_if(F.col("l_discount") > 0.08).alias("issue_count")).select(
        F.lit("lineitem").alias("table_name"), F.lit("l_discount").alias("column_name"), F.lit("rule_violation").alias("issue"),
        "issue_count", F.lit("medium").alias("severity"), F.lit("review_discount_policy").alias("action"))
    return profile.action_plan(profile.issue_log([m, v]))


@register("promo_usage_summary", ORDERS_ITEMS_SQL + """
SELECT count(*) AS n_lines, round(avg(CAST(total_quantity IS NULL AS DOUBLE)), 9) AS total_quantity_null_share,
       round(avg(CAST(first_ship IS NULL AS DOUBLE)), 9) AS first_ship_null_share,
       round(avg(CAST(discount_total > 0 AS DOUBLE)), 9) AS discounted_share FROM j""")
def q_promo_usage(spark, sf):
    """Null shares of optional columns and discounted share."""
    return tidy(profile.promo_usage_summary(orders_items(spark, sf), ["total_quantity", "first_ship"], "discount_total"))


@register("percentile_outlier_days", LINES_SQL + """,
daily AS (SELECT ship_date, sum(net) AS revenue, sum(cost) AS cogs FROM lines WHERE ship_date IS NOT NULL GROUP BY 1),
q AS (SELECT quantile_cont(revenue, [0.01, 0.99]) AS q FROM daily),
r AS (SELECT CASE WHEN revenue <= q[1] THEN 'revenue_le_p01' WHEN revenue >= q[2] THEN 'revenue_ge_p99'
                  WHEN cogs > revenue THEN 'cogs_gt_revenue' WHEN (revenue - cogs) / revenue < 0 THEN 'negative_margin' END AS reason FROM daily, q)
SELECT reason, count(*) AS n_days, round(count(*) * 1.0 / (SELECT count(*) FROM daily), 9) AS share_of_days FROM r WHERE reason IS NOT NULL GROUP BY 1""")
def q_percentile_outlier_days(spark, sf):
    """Extreme or inconsistent days by first matching reason."""
    from basketry.plans.features import daily_sales
    d = daily_sales(retail.items(spark, sf), retail.products(spark, sf))
    return tidy(profile.percentile_outlier_days(d, "sale_date", "revenue", "cogs"))


def _quick_eda_sql():
    from basketry.plans.queries.q_stats import ORDER_FEATS_SQL
    cols = ["o_orderkey", "o_orderpriority", "o_orderstatus", "year", "o_totalprice", "n_lines", "total_quantity", "discount_ratio", "returned"]
    num = [c for c in cols if c not in ("o_orderpriority", "o_orderstatus")]
    add = " + ".join
    parts = {"schema": (9, add(f"count(DISTINCT {c})" for c in cols)), "missing": (9, add(f"count_if({c} IS NULL)" for c in cols)),
             "duplicates": (1, "count(*) - count(DISTINCT o_orderkey)"), "numeric": (len(num), add(f"count({c})" for c in num)),
             "categorical": (2, "count(DISTINCT o_orderpriority) + count(DISTINCT o_orderstatus)"),
             "target_relation": (len(num) - 1, add(f"count_if({c} IS NOT NULL AND returned IS NOT NULL)" for c in num if c != "returned"))}
    return ORDER_FEATS_SQL + " UNION ALL ".join(
        f"SELECT '{k}' AS report, {n}::BIGINT AS n_rows, CAST({v} AS BIGINT) AS total FROM of" for k, (n, v) in parts.items())


@register("quick_eda", _quick_eda_sql())
def q_quick_eda(spark, sf):
    """C20: the one-call bundle (schema, missing, duplicates, numeric,
    categorical, target relation) for the order table: per report its rows and
    the total of its counts."""
    from functools import reduce
    from basketry.plans.queries.q_stats import order_features
    o = order_features(spark, sf)
    bundle = profile.quick_eda(o, target="returned", keys=["o_orderkey"], categorical=["o_orderpriority", "o_orderstatus"])
    counts = {"schema": "nunique", "missing": "missing", "duplicates": "duplicate_key_rows", "numeric": "count",
              "categorical": "nunique", "target_relation": "n_pairs"}
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(counts[name]).cast("long").alias("total"))
             .select(F.lit(name).alias("report"), "n_rows", "total") for name, df in bundle.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
