"""Sources, scans and sinks (§2.1)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import ensure_checkpoint_dir


def clean_column_names(df: DataFrame, lower: bool = False) -> DataFrame:
    """Strip a leading BOM and surrounding blanks from every column
    name; optionally lower-case."""
    names = []
    for c in df.columns:
        n = c.replace("﻿", "").strip()
        names.append(n.lower() if lower else n)
    return df.toDF(*names)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             lower_names: bool = False, **options) -> DataFrame:
    """Header CSV, UTF-8, BOM stripped from the first name, names
    trimmed. With ``schema`` there is no inference pass (the scale path);
    without it types are inferred from the whole file like the reference."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", True).option("samplingRatio", 1.0)
    return clean_column_names(reader.csv(path), lower=lower_names)


def read_table(spark: SparkSession, path: str, fmt: str | None = None, **options) -> DataFrame:
    """Format by extension (parquet default, csv, json)."""
    fmt = fmt or ("csv" if path.endswith(".csv") else "json" if path.endswith(".json") else "parquet")
    if fmt == "csv":
        return read_csv(spark, path, **options)
    if fmt == "json":
        return spark.read.options(**options).json(path)
    return spark.read.options(**options).parquet(path)


def try_read(spark: SparkSession, path: str, fmt: str | None = None, **options):
    """Lazy read; returns (df, None) or (None, error text) when the path is
    missing. Works for any Hadoop filesystem (object stores included)."""
    try:
        return read_table(spark, path, fmt, **options), None
    except AnalysisException as exc:  # PATH_NOT_FOUND and friends
        return None, str(exc).splitlines()[0][:200]


def multi_table_load(spark: SparkSession, files: dict[str, str], base_dir: str = "",
                     fmt: str | None = None) -> dict[str, DataFrame]:
    """Load every listed table that exists, silently skip the rest."""
    out = {}
    for name, f in files.items():
        path = f"{base_dir.rstrip('/')}/{f}" if base_dir else f
        df, _err = try_read(spark, path, fmt)
        if df is not None:
            out[name] = df
    return out


LOAD_REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("file", T.StringType()),
    T.StructField("required", T.BooleanType()), T.StructField("status", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n_columns", T.LongType()),
    T.StructField("error", T.StringType()),
])


def load_contract(spark: SparkSession, required: dict[str, str], optional: dict[str, str] | None = None,
                  base_dir: str = "", fmt: str | None = None):
    """Missing required tables raise, missing optional ones are
    skipped. Returns (tables, report); the report is a lazy union of one
    ``count(*)`` row per loaded table plus a row per skipped table."""
    optional = optional or {}
    tables, rows = {}, []
    for req, spec in ((True, required), (False, optional)):
        for name, f in spec.items():
            path = f"{base_dir.rstrip('/')}/{f}" if base_dir else f
            df, err = try_read(spark, path, fmt)
            if df is None:
                if req:
                    raise FileNotFoundError(f"required table {name} missing: {path}")
                rows.append(spark.createDataFrame(
                    [(name, f, req, "skipped_missing", None, None, err)], LOAD_REPORT_SCHEMA))
                continue
            tables[name] = df
            rows.append(df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("table_name"), F.lit(f).alias("file"), F.lit(req).alias("required"),
                F.lit("loaded").alias("status"), F.col("n_rows"),
                F.lit(len(df.columns)).cast("long").alias("n_columns"),
                F.lit(None).cast("string").alias("error")))
    report = reduce(DataFrame.unionByName, rows) if rows else spark.createDataFrame([], LOAD_REPORT_SCHEMA)
    return tables, report


def dtype_group(dt: T.DataType, name: str = "") -> str:
    """Classify a Spark type into the contract groups id/date/numeric/str."""
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "date"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "id" if name.endswith("key") or name.endswith("_id") else "numeric"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "numeric"
    if isinstance(dt, T.BooleanType):
        return "numeric"
    return "str"


CONTRACT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()), T.StructField("column_name", T.StringType()),
    T.StructField("expected_group", T.StringType()),
])


def schema_contract(spark: SparkSession, tables: dict[str, DataFrame],
                    expected: dict[str, dict[str, str]]) -> DataFrame:
    """Expected column → dtype group per table, compared with the
    actual schema. One row per expected column plus unexpected extras:
    table_name, column_name, expected_group, actual_group, column_exists,
    matches. Built from schema metadata only (no data scan)."""
    exp_rows = [(t, c, g) for t, cols in expected.items() for c, g in cols.items()]
    exp = spark.createDataFrame(exp_rows, CONTRACT_SCHEMA)
    act_rows = [(t, f.name, dtype_group(f.dataType, f.name))
                for t, df in tables.items() for f in df.schema.fields]
    act = spark.createDataFrame(act_rows, CONTRACT_SCHEMA).withColumnRenamed("expected_group", "actual_group")
    j = exp.join(act, ["table_name", "column_name"], "full")
    return j.select(
        "table_name", "column_name", "expected_group", "actual_group",
        F.col("actual_group").isNotNull().alias("column_exists"),
        F.coalesce(F.col("expected_group") == F.col("actual_group"), F.lit(False)).alias("matches"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared checkpoint location (never machine-local
    on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/basketry-out/{name}-{uuid.uuid4().hex[:12]}"


def csv_sink(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Header CSV without index; parent folders are created by Spark."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def parquet_sink(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def summary_frame(df: DataFrame, date_col: str | None = None, key_cols=None) -> DataFrame:
    """One-row summary: n_rows, n_columns, column list, date range and
    the distinct-key deficit (rows minus distinct keys)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if date_col:
        aggs += [F.min(date_col).cast("string").alias("date_min"),
                 F.max(date_col).cast("string").alias("date_max")]
    if key_cols:
        aggs.append((F.count(F.lit(1)) - F.count_distinct(F.struct(*key_cols))).alias("duplicate_key_rows"))
    return df.agg(*aggs).select(
        "*", F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"))


def summary_sink(df: DataFrame, path: str, date_col=None, key_cols=None) -> str:
    """JSON sidecar written next to the data output."""
    summary_frame(df, date_col, key_cols).coalesce(1).write.mode("overwrite").json(path)
    return path


def materialize_splits(df: DataFrame, path: str, split_col: str = "data_split") -> str:
    """One output per split sharing one schema (partition folders)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return path


def submission_frame(df: DataFrame, date_col: str, renames: dict[str, str],
                     out_date: str = "Date") -> DataFrame:
    """Rename prediction columns, format the date as yyyy-MM-dd."""
    cols = [F.date_format(F.col(date_col), "yyyy-MM-dd").alias(out_date)]
    cols += [F.col(src).alias(dst) for src, dst in renames.items()]
    return df.select(*cols)


def dataset_fingerprint(tables: dict[str, DataFrame]) -> DataFrame:
    """Order-insensitive content hash per table: Σ xxhash64(row) as an
    exact decimal plus the row count; equal under any partitioning."""
    parts = []
    for name, df in tables.items():
        h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
        parts.append(df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(h).cast("string").alias("content_hash"))
                     .select(F.lit(name).alias("table_name"), "n_rows",
                             F.lit(len(df.columns)).cast("long").alias("n_columns"), "content_hash"))
    return reduce(DataFrame.unionByName, parts)
