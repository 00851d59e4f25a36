"""Session settings and the shared folder jobs may write intermediate tables to."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    # Stored timestamps carry no zone; a fixed zone keeps formatting and parsing free of DST gaps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Streaming state on executor disks instead of the heap: one row per open hour, endpoint and user.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "tallyworks", master: str | None = None, **conf: str) -> SparkSession:
    """Get or create a session with the defaults above; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the one setting results depend on to a session somebody else created."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_DEFAULTS["spark.sql.session.timeZone"])
    return spark


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str | int | None) -> Iterator[None]:
    """Change a session setting for the moment of one call that takes it from nowhere else.

    A streaming query keeps the settings it was started with. ``None`` changes nothing.
    """
    before = spark.conf.get(key)
    if value is not None:
        spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder all executors can reach: below ``spark.checkpoint.dir``, else the checkpoint folder set on the
    context, else the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = base or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tallyworks/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder a job wrote for itself."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a shared folder; none if it does not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isDirectory())


@contextlib.contextmanager
def scratch(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A shared folder for the time of a job; it goes once the result is stored, and after an error."""
    path = shared_dir(spark, purpose)
    try:
        yield path
    finally:
        remove(spark, path)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` to ``path`` and read it back.

    Cuts the lineage in a way that survives lost executors, computes the frame once for several readers, and gives the
    planner its true size, on which broadcast decisions then rest. What the job shuffled goes when it is written, not
    when the driver happens to collect its garbage.
    """
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_folders(spark: SparkSession, schema: str, paths: Sequence[str]) -> DataFrame:
    """Parquet rows of many folders or files, listed by as many tasks as run at once and not by one task each."""
    tasks = max(1, spark.sparkContext.defaultParallelism)
    with setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", tasks):
        return spark.read.schema(schema).parquet(*paths)


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """``written`` to a shared folder of its own, which stays for as long as the caller's frames may be read."""
    return written(df, shared_dir(df.sparkSession, purpose))
