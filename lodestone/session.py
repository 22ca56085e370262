"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# First number of shuffle partitions per core; small ones are merged again at run time.
PARTITIONS_PER_CORE = 4

# Every setting here can be changed on a live session, so `tune` works on a session somebody else built.
RUNTIME_CONF = {
    # Join sides are broadcast only when their measured size allows it; a hot key is split at run time, also
    # where the split costs one more shuffle further up a chain of joins on the same key.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Catalog rows repeat the same names, so files are far smaller than their rows. Without this factor the planner
    # takes a relation of millions of rows for a small one by its file size and broadcasts it. Sides that turn out
    # small when measured are still broadcast at run time.
    "spark.sql.sources.fileCompressionFactor": "20",
    # For the same reason 16 MB of shuffle data are already a few hundred MB of rows: enough for a task, and for a file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16MB",
    # Where every partition of one side is measured to be that small, hash it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16MB",
    # Rows that lie together by table are joined by column where they are: a table has few thousand columns at most, so that
    # moving the widest relation once more would even out nothing.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A stored catalog has one sorted file a bucket; a join by table need not sort its rows again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # A task that writes a few connections keeps their files open instead of sorting its lines by connection.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session and return it.

    On a cluster, shuffles also get several partitions per core, unless the session already asks for more. Where an
    input is so large that these would not fit in memory, set `spark.sql.shuffle.partitions` to its size over 128 MB.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if not _is_local(spark):
        wanted = PARTITIONS_PER_CORE * _cores(spark)
        if int(spark.conf.get("spark.sql.shuffle.partitions")) < wanted:
            spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


# Removes the shuffle files of a query when it ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in here go when it ends, instead of when the driver happens to collect its garbage. Not for a
    DataFrame that runs again: it would look for them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def _cores(spark: SparkSession) -> int:
    """Cores the application has, or may grow to."""
    conf = spark.sparkContext.getConf()
    executors = int(conf.get("spark.dynamicAllocation.maxExecutors", "0"))
    return max(spark.sparkContext.defaultParallelism, executors * int(conf.get("spark.executor.cores", "1")))


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder all executors can reach, below the one the cluster names; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="lodestone-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def local_session(app: str = "lodestone", cpus: int | None = None, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; on a cluster, bring your own and call `tune`."""
    cpus = cpus or os.cpu_count() or 1
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
