"""Queries for §2.1 sources, scans and sinks (plus the flagship)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.plans import flagship
from basketry.plans.catalog import register, table, tidy
from basketry.sources import io, retail


@register("return_rate_by_segment", flagship.ORACLE)
def q_flagship(spark, sf):
    return tidy(flagship.return_rate_by_segment(spark, sf))


CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


@register("csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_csv_roundtrip(spark, sf):
    """A01 + A05: customer written as header CSV, read back with an explicit
    schema (no inference pass), names cleaned."""
    path = io.scratch_path(spark, "csv_roundtrip")
    io.csv_sink(table(spark, sf, "customer"), path)
    return io.read_csv(spark, path, schema=CUSTOMER_SCHEMA)


@register("csv_infer_roundtrip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q_csv_infer(spark, sf):
    """A01 with whole-file type inference (the reference's default)."""
    path = io.scratch_path(spark, "csv_infer")
    io.csv_sink(table(spark, sf, "nation"), path)
    df = io.read_csv(spark, path)
    return df.select(F.col("n_nationkey").cast("int"), "n_name", F.col("n_regionkey").cast("int"))


@register("multi_table_load", """
SELECT 'customer' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'region', count(*) FROM region""")
def q_multi_table_load(spark, sf):
    """Listed tables that exist are loaded, the missing one skipped."""
    files = {"customer": "customer.parquet", "nation": "nation.parquet", "region": "region.parquet",
             "returns": "returns.parquet"}
    tables = io.multi_table_load(spark, files, sf)
    from functools import reduce
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("load_contract_report", """
SELECT 'orders' AS table_name, 'orders.parquet' AS file, true AS required, 'loaded' AS status,
       count(*) AS n_rows, 6::BIGINT AS n_columns FROM orders
UNION ALL SELECT 'lineitem', 'lineitem.parquet', true, 'loaded', count(*), 11::BIGINT FROM lineitem
UNION ALL SELECT 'customer', 'customer.parquet', true, 'loaded', count(*), 5::BIGINT FROM customer
UNION ALL SELECT 'returns', 'returns.parquet', false, 'skipped_missing', NULL::BIGINT, NULL::BIGINT""")
def q_load_contract(spark, sf):
    """Required tables load (missing would raise), optional missing is
    reported as skipped; one count per loaded table."""
    _, report = io.load_contract(
        spark, {"orders": "orders.parquet", "lineitem": "lineitem.parquet", "customer": "customer.parquet"},
        {"returns": "returns.parquet"}, base_dir=sf)
    return report.drop("error")


ORDERS_CONTRACT = {"orders": {"o_orderkey": "id", "o_custkey": "id", "o_orderdate": "date",
                              "o_totalprice": "numeric", "o_orderstatus": "str", "o_shipmode": "str"},
                   "customer": {"c_custkey": "id", "c_acctbal": "numeric", "c_mktsegment": "str",
                                "c_nationkey": "id"}}


@register("schema_contract_report", """
WITH exp(table_name, column_name, expected_group) AS (VALUES
  ('orders','o_orderkey','id'),('orders','o_custkey','id'),('orders','o_orderdate','date'),
  ('orders','o_totalprice','numeric'),('orders','o_orderstatus','str'),('orders','o_shipmode','str'),
  ('customer','c_custkey','id'),('customer','c_acctbal','numeric'),('customer','c_mktsegment','str'),
  ('customer','c_nationkey','id')),
act AS (
  SELECT table_name, column_name,
    CASE WHEN data_type LIKE 'TIMESTAMP%' OR data_type = 'DATE' THEN 'date'
         WHEN data_type IN ('BIGINT','INTEGER','SMALLINT','TINYINT') THEN
              CASE WHEN column_name LIKE '%key' OR column_name LIKE '%\\_id' ESCAPE '\\' THEN 'id' ELSE 'numeric' END
         WHEN data_type IN ('DOUBLE','FLOAT','BOOLEAN') OR data_type LIKE 'DECIMAL%' THEN 'numeric'
         ELSE 'str' END AS actual_group
  FROM information_schema.columns WHERE table_name IN ('orders','customer'))
SELECT coalesce(e.table_name, a.table_name) AS table_name, coalesce(e.column_name, a.column_name) AS column_name,
       e.expected_group, a.actual_group, a.actual_group IS NOT NULL AS column_exists,
       coalesce(e.expected_group = a.actual_group, false) AS matches
FROM exp e FULL JOIN act a ON e.table_name = a.table_name AND e.column_name = a.column_name""")
def q_schema_contract(spark, sf):
    """Expected column groups vs actual schema, from metadata only."""
    tables = {"orders": table(spark, sf, "orders"), "customer": table(spark, sf, "customer")}
    return io.schema_contract(spark, tables, ORDERS_CONTRACT)


@register("summary_sidecar", retail.with_roles("orders") + """
SELECT count(*) AS n_rows, CAST(min(order_date) AS VARCHAR) AS date_min, CAST(max(order_date) AS VARCHAR) AS date_max,
       count(*) - count(DISTINCT customer_id) AS duplicate_key_rows, 6::BIGINT AS n_columns,
       'order_id,customer_id,order_date,order_status,payment_value,priority' AS columns
FROM r_orders""")
def q_summary_sidecar(spark, sf):
    """JSON sidecar (rows, date range, columns, key deficit) written
    and read back."""
    path = io.scratch_path(spark, "summary")
    io.summary_sink(retail.orders(spark, sf), path, date_col="order_date", key_cols=["customer_id"])
    return spark.read.json(path).select("n_rows", "date_min", "date_max", "duplicate_key_rows", "n_columns", "columns")


@register("materialize_splits", """
SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-01-01' THEN 'train'
            WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'validation' ELSE 'test' END AS data_split,
       count(*) AS n_rows, round(sum(l_quantity), 2) AS total_quantity
FROM lineitem GROUP BY 1""")
def q_materialize_splits(spark, sf):
    """Split tables written as one partitioned output sharing a schema,
    then read back and summarised per split folder."""
    from basketry.operators.splits import time_split
    li = table(spark, sf, "lineitem")
    labelled = time_split(li, "l_shipdate", "1998-01-01", "2000-01-01")
    path = io.scratch_path(spark, "splits")
    io.materialize_splits(labelled, path)
    back = spark.read.parquet(path)
    return tidy(back.groupBy("data_split").agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.sum("l_quantity").alias("total_quantity")), 2)


@register("dataset_fingerprint", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, {n}::BIGINT AS n_columns, true AS same_when_shuffled, true AS changes_with_a_row FROM {t}"
    for t, n in (("region", 2), ("nation", 3), ("customer", 5), ("orders", 6))))
def q_fingerprint(spark, sf):
    """Order-insensitive content hash + row count per table; facts of the
    hash: the same for shuffled rows, another one without the first key."""
    names = ["region", "nation", "customer", "orders"]
    tables = {t: table(spark, sf, t) for t in names}
    prints = io.dataset_fingerprint(tables)
    shuffled = io.dataset_fingerprint({t: df.repartition(5) for t, df in tables.items()})
    fewer = io.dataset_fingerprint({t: df.filter(F.col(df.columns[0]) != df.select(F.min(df.columns[0])).scalar()) for t, df in tables.items()})
    both = prints.join(shuffled.select("table_name", F.col("content_hash").alias("s")), "table_name").join(
        fewer.select("table_name", F.col("content_hash").alias("f")), "table_name")
    return both.select("table_name", "n_rows", "n_columns", (F.col("content_hash") == F.col("s")).alias("same_when_shuffled"),
                       (~F.col("content_hash").eqNullSafe(F.col("f"))).alias("changes_with_a_row"))


@register("clean_column_names", """
SELECT n_nationkey AS nation_key, n_name AS nation_name, n_regionkey AS region_key FROM nation""")
def q_clean_column_names(spark, sf):
    """A CSV whose header carries a BOM, padding and mixed case is read
    back with trimmed, lower-cased names."""
    path = io.scratch_path(spark, "dirty_header")
    n = table(spark, sf, "nation")
    dirty = n.select(F.col("n_nationkey").alias("﻿ Nation_Key "), F.col("n_name").alias("  Nation_Name"),
                     F.col("n_regionkey").alias("Region_Key  "))
    io.csv_sink(dirty, path)
    back = io.read_csv(spark, path, lower_names=True)
    return back.select(F.col("nation_key").cast("int"), "nation_name", F.col("region_key").cast("int"))
