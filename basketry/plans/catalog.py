"""Registry of named queries (Spark callables) and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``; ``oracle``
    is the equivalent DuckDB SQL over the pre-registered table views."""
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def round_binary(c, digits: int):
    """Round the binary double half away from zero (what DuckDB's and C's
    ``round`` do); Spark's ``round`` rounds the decimal rendering instead,
    which differs on values such as 1037.0821875. Huge or non-finite values
    pass through unchanged."""
    m = float(10 ** digits)
    finite = ~F.isnan(c) & (F.abs(c) < F.lit(1e15 / m))
    r = F.signum(c) * F.floor(F.abs(c) * m + F.lit(0.5)).cast("double") / F.lit(m)
    return F.when(c.isNull(), F.lit(None).cast("double")).when(finite, r).otherwise(c.cast("double"))


def tidy(df: DataFrame, digits: int = 9, digits_by: dict | None = None) -> DataFrame:
    """Presentation for exact comparison: doubles rounded, dates and
    timestamps rendered as ISO strings (the oracle SQL does the same)."""
    digits_by = digits_by or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = round_binary(c, digits_by.get(f.name, digits))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)
