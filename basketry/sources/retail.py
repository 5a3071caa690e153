"""Retail roles over the given star-schema tables.

Each builder only renames/derives columns of one table; it does none of an
operator's work. ``SQL`` holds the same projections as DuckDB CTE bodies so
oracle queries read identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _t(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("payment_value"), F.col("o_orderpriority").alias("priority"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"), F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("gross"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
        F.col("l_discount").alias("discount_rate"), F.col("l_tax").alias("tax_rate"),
        F.col("l_returnflag").alias("return_flag"), F.col("l_linestatus").alias("line_status"),
        F.to_date("l_shipdate").alias("ship_date"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("nation_id"), F.col("c_acctbal").alias("account_balance"),
        F.col("c_mktsegment").alias("segment"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select(
        "event_id", "ts", F.to_date("ts").alias("event_date"), "user_id", "event_type", "value", "props")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "labels")


# DuckDB CTE bodies with the same projections.
SQL = {
    "orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
        CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status,
        o_totalprice AS payment_value, o_orderpriority AS priority FROM orders""",
    "items": """SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
        l_linenumber AS line_number, l_quantity AS quantity,
        CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS unit_price,
        l_extendedprice AS gross, l_extendedprice * l_discount AS discount_amount,
        l_discount AS discount_rate, l_tax AS tax_rate, l_returnflag AS return_flag,
        l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem""",
    "customers": """SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey AS nation_id,
        c_acctbal AS account_balance, c_mktsegment AS segment FROM customer""",
    "products": """SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
        p_brand AS brand, p_size AS size, p_retailprice AS price FROM part""",
    "events": """SELECT event_id, ts, CAST(ts AS DATE) AS event_date, user_id, event_type, value, props
        FROM events""",
}


def with_roles(*names: str) -> str:
    """``WITH`` clause defining the named roles for an oracle query."""
    return "WITH " + ",\n".join(f"r_{n} AS ({SQL[n]})" for n in names) + "\n"
