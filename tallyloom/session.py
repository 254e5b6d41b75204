"""Session helpers: where shared intermediate tables live and how they are written."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BATCH_ROWS = 1000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_BYTES = 1 << 20
BYTES_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
SHUFFLE_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}
_scratch: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Spark needs that folder to be shared for its own checkpoints, so a named one is taken as it is, whatever its
    scheme: a path without one or with ``file:`` may be mounted on all machines. Only a local master may run without
    that setting; it then gets a folder of its own that is removed when the process ends. On a cluster a missing
    setting is an error, because a machine-local folder would not survive the loss of that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    context = spark.sparkContext
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_roots:
        folder = tempfile.mkdtemp(prefix="tallyloom-")
        _local_roots[context.applicationId] = folder
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    _scratch.append(f"{shared_folder(spark)}/tallyloom/{label}-{uuid.uuid4().hex}")
    return _scratch[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Remove this process's intermediate tables. Results that were not stored elsewhere go with them."""
    while _scratch:
        remove_path(spark, _scratch.pop())


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, cutting its lineage.

    Used where a result feeds several plans or an iteration. Unlike a cache it outlives executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, the shuffle files of a write go when it ends, not when the driver happens to collect its garbage.

    Without it, jobs that write many tables one after the other keep the shuffles of most of them on disk. A write has a
    plan of its own, so nothing reads its shuffles again; a plan that is collected twice would make them twice.
    """
    before = spark.conf.get(SHUFFLE_SETTING)
    spark.conf.set(SHUFFLE_SETTING, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_SETTING, before)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows over the session's shuffle partitions before heavy work on each row, evenly or by ``keys``."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def by_batches(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` over rows with long texts, at most ``BATCH_ROWS`` of them or about ``BATCH_BYTES`` at once, a longer row alone.

    Spark sends 10,000 rows of any size at once by default, and keeps each such batch several times, in the executor's buffers
    outside its heap and in the Python process. The settings stay for the session, since the plan runs later; smaller ones are kept.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(BATCH_SETTING, BATCH_ROWS)
    if df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(BYTES_SETTING)) > BATCH_BYTES:
        conf.set(BYTES_SETTING, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system that serves ``path`` and the path object for it."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = filesystem(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = filesystem(spark, path)
    fs.delete(target, True)
