"""Incremental landing: files of a growing folder into a table, each file once.

A file source with a checkpoint is run until nothing is left (``availableNow``) and ends, so it is scheduled as a batch job
is. The checkpoint lists the files of every batch before it runs: a repeated job takes new files only, and a job that
failed repeats the same batch. The sink's own log names the files of finished batches, so what a failed batch has left
behind is not read. Checkpoint and table belong together and lie in the shared store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import shuffles_removed


def land(
    spark: SparkSession,
    source: str,
    target: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    """Append the lines of files in ``source`` that have not landed yet, and return the whole table.

    ``transform`` takes (value, filename) lines and may parse, filter and explode them, but keep no state between
    rows. ``files_per_batch`` bounds a batch, not what lands: batches follow each other until no file is left.
    """
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(source)
    rows = lines.select("value", F.col("_metadata.file_path").alias("filename"))
    rows = transform(rows) if transform else rows
    writer = rows.writeStream.format("parquet").option("checkpointLocation", f"{target}/_checkpoint")
    run = writer.trigger(availableNow=True).outputMode("append").start(f"{target}/rows")
    run.awaitTermination()
    return read_landed(spark, target, rows)


def write_lines(lines: DataFrame, path: str) -> None:
    """Write text lines (``value``) compressed, one file for each partition.

    JSON repeats its field names on every line and takes a tenth of the space so. All readers of text and JSON know the files
    by their ending. One task reads a file, so the rows should lie in as many partitions as tasks are to read them.
    """
    with shuffles_removed(lines.sparkSession):
        lines.select("value").write.option("compression", "gzip").text(path)


def read_landed(spark: SparkSession, target: str, like: DataFrame) -> DataFrame:
    """The landed rows, with the columns of ``like``."""
    return spark.read.schema(like.schema).parquet(f"{target}/rows")
