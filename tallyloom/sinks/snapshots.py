"""Tables kept as numbered snapshots that can be listed and read as of a time.

A table is a directory of ``version=N`` data directories and a ``log`` with one row per finished
version. Readers use logged versions only, so a snapshot that failed halfway is never seen. One
writer at a time is assumed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import path_exists

LOG = "version bigint, committed_at timestamp, operation string, n_rows bigint"


def history(spark: SparkSession, path: str) -> DataFrame:
    """Finished versions: version, committed_at, operation, n_rows."""
    if not path_exists(spark, f"{path}/log"):
        return spark.createDataFrame([], LOG)
    return spark.read.schema(LOG).parquet(f"{path}/log")


def _latest(spark: SparkSession, path: str, until: dt.datetime | None = None) -> int | None:
    log = history(spark, path)
    if until is not None:
        log = log.where(F.col("committed_at") <= F.lit(until))
    return log.agg(F.max("version")).first()[0]


def commit(df: DataFrame, path: str, operation: str, at: dt.datetime | None = None) -> int:
    """Store ``df`` as the next version and log it; returns the version."""
    spark = df.sparkSession
    latest = _latest(spark, path)
    version = 0 if latest is None else latest + 1
    data = f"{path}/version={version}"
    df.write.mode("overwrite").parquet(data)
    moment = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    row = spark.read.schema(df.schema).parquet(data).agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(version).cast("bigint").alias("version"),
        moment.alias("committed_at"),
        F.lit(operation).alias("operation"),
        "n_rows",
    )
    row.write.mode("append").parquet(f"{path}/log")
    return version


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version's rows, the latest by default."""
    chosen = _latest(spark, path) if version is None else version
    if chosen is None or history(spark, path).where(F.col("version") == chosen).isEmpty():
        raise LookupError(f"no version {version} of {path}")
    return spark.read.parquet(f"{path}/version={chosen}")


def read_as_of(spark: SparkSession, path: str, moment: dt.datetime) -> DataFrame:
    """The rows as they were at ``moment``."""
    version = _latest(spark, path, moment)
    if version is None:
        raise LookupError(f"{path} did not exist at {moment}")
    return read_version(spark, path, version)


def update(spark: SparkSession, path: str, changes: dict[str, Column], at: dt.datetime | None = None) -> int:
    """Set columns of all rows; the result becomes the next version."""
    return commit(read_version(spark, path).withColumns(changes), path, "UPDATE", at)
