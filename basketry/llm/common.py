"""Helpers shared by the corpus operators: word rules, Arrow row batches and
intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.session import Workspace, released_shuffles, setting  # noqa: F401 (the operators take them from here)

# Fixed value: a word is a run of characters other than these six.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
SPACE_CLASS = r"[\x20\x09-\x0D]+"

BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"
CO_PARTITION_CONF = "spark.sql.requireAllClusterKeysForCoPartition"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (as ``--py-files`` would), once per
    application, so that functions sent to them can import it anywhere. Arrow
    batches of texts are bounded by bytes, since rows say little about size
    (a session that sets its own bound keeps it)."""
    if spark.conf.get(BATCH_CONF, None) in (None, "67108864b", "64MB"):
        spark.conf.set(BATCH_CONF, BATCH_BYTES)
    sc = spark.sparkContext
    if getattr(sc, "_basketry_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="basketry-"), "basketry_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(path)
    sc._basketry_shipped = True


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text) if text else []


_LEAVING: dict[str, Callable[[], None]] = {}
_IDLE: dict[str, Callable[[], None]] = {}


def when_leaving(tables: str, forget: Callable[[], None], idle: Callable[[], None] | None = None) -> None:
    """Have this Python worker call ``forget`` before it runs a step that does
    not use ``tables``: workers outlive operators, their memory should not.
    ``idle`` is called at the end of each task: there may be more workers than
    running tasks, and tasks go to them in turn."""
    _LEAVING[tables] = forget
    if idle:
        _IDLE[tables] = idle


def leave_others(tables: str | None = None) -> None:
    """Drop the tables of other operators and give freed memory back, which
    allocators otherwise keep for the life of the worker."""
    for name, forget in _LEAVING.items():
        if name != tables:
            forget()
    give_back()


def give_back() -> None:
    """Freed memory goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)


def map_rows(df: DataFrame, columns: list[str], schema: str, make: Callable[[], Callable],
             rows_per_step: int = 512, tables: str | None = None) -> DataFrame:
    """Run ``make()`` once per task and its result on steps of at most
    ``rows_per_step`` rows (``columns`` as Python lists, in order); each step
    returns a list of columns for ``schema``. Only one step is held at a time,
    so memory is bounded by the step and the longest text."""
    ship_package(df.sparkSession)
    out_schema = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]):
        leave_others(tables)
        step = make()
        for batch in batches:
            for lo in range(0, batch.num_rows, rows_per_step):
                part = batch.slice(lo, rows_per_step)
                out = step(*(part.column(i).to_pylist() for i in range(part.num_columns)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, type=f.type) for v, f in zip(out, out_schema)], schema=out_schema)
        if tables in _IDLE:
            _IDLE[tables]()
            give_back()

    return df.select(*columns).mapInArrow(run, schema)


def _arrow_schema(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(ddl))


def co_partitioned(spark: SparkSession):
    """A side that is hashed by some of the join keys already is not shuffled
    again by all of them; the other side comes to it."""
    return setting(spark, CO_PARTITION_CONF, "false")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))
