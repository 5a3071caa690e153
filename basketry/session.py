"""Session construction, lineage cutting and intermediate tables."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every basketry job wants: AQE (runtime coalescing, skew-join
# splitting, runtime broadcast choice), UTC session time, Arrow transfer,
# and no web UI.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "basketry", extra: dict | None = None, driver_memory: str | None = None) -> SparkSession:
    """Session with the basketry defaults. ``driver_memory`` only matters in
    local mode (the driver JVM runs the executors)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables: what
    ``spark.checkpoint.dir`` names, else the folder the application has set.
    Only a local master gets a scratch folder of its own (deleted when the
    session ends); on a cluster an unset folder is an error, because executors
    could not read each other's files."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = sc.getCheckpointDir()  # set by the application, or here before
        if path:
            return path
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="basketry-ckpt-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives lost
    executors, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def released_shuffles(spark: SparkSession):
    """Spark deletes the shuffle files of each execution inside when it ends."""
    return setting(spark, CLEANUP_CONF, "true")


class Workspace:
    """Intermediate tables of one operator run, written as Parquet below
    ``spark.checkpoint.dir`` so that a lost executor only costs its running
    tasks. Shuffle files of a finished write are released at once; a table is
    deleted by ``drop`` as soon as no later step reads it, and whatever the
    returned (lazy) result still reads goes when the session's file system
    closes."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        root = self._path(self.base)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(root)
        self._fs.deleteOnExit(root)

    def save(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.base}/{name}"
        with released_shuffles(self.spark):
            w = df.write.mode("overwrite").option("compression", "zstd")
            (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return self.load(name, df)

    def load(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs.delete(self._path(f"{self.base}/{name}"), True)

    def close(self) -> None:
        """Delete all tables, of which nothing is read any more."""
        root = self._path(self.base)
        self._fs.delete(root, True)
        self._fs.cancelDeleteOnExit(root)
