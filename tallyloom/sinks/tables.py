"""Writing tables: declared columns, full refresh, dated runs, publishing, compaction."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.operators.quality import assert_passed
from tallyloom.session import filesystem
from tallyloom.sinks import versions

# Of the tables that are kept beside each other for every run; Spark's default takes a quarter more for pages.
CODEC = "zstd"


def create_table(spark: SparkSession, name: str, schema: StructType, path: str | None = None) -> None:
    """Register a Parquet table with declared columns unless it exists."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``df`` by name in the declared order and type, with NOT NULL enforced.

    The check is part of the projection: a missing required value fails the writing task, so nothing
    is committed and no extra pass over the data is needed.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    columns = []
    for field in schema.fields:
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"{field.name} must not be NULL")).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def read_current(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The current version of a table that :func:`refresh` wrote."""
    return spark.read.schema(schema).parquet(versions.current(spark, path))


def refresh(df: DataFrame, path: str, schema: StructType | None = None) -> DataFrame:
    """Replace a table by a query result and return the stored table.

    The result is written once, as a new version that becomes current when it is complete, so the query
    may read the table itself and a failed run leaves it untouched.
    """
    spark = df.sparkSession
    result = df if schema is None else conform(df, schema)
    version = versions.fresh(path)
    result.write.option("compression", CODEC).parquet(version)
    versions.commit(spark, path, version)
    return spark.read.schema(result.schema).parquet(version)


def _run_path(path: str, run: str) -> str:
    return f"{path}/run-{quote(str(run), safe='')}"


def _run_folder(run: str) -> str:
    """Partition directory of a run inside a batch; hexadecimal, so no character needs escaping."""
    return f"_run=r{str(run).encode().hex()}"


def _run_place(path: str, run: str) -> Callable[[str], str]:
    return lambda name: f"{path}/{name}/{_run_folder(run)}"


def _write_runs(df: DataFrame, path: str, runs: Sequence[str], run_column: str) -> None:
    """Write the rows of runs once, where they stay, and make each run's part of the batch its current version."""
    spark = df.sparkSession
    batch = f"{path}/batch-{uuid.uuid4().hex}"
    key = F.concat(F.lit("r"), F.lower(F.hex(F.encode(F.col(run_column).cast("string"), "UTF-8"))))
    df.withColumn("_run", key).write.option("compression", CODEC).partitionBy("_run").parquet(batch)
    for run in runs:
        fs, folder = filesystem(spark, f"{batch}/{_run_folder(run)}")
        fs.mkdirs(folder)  # a run without rows has a folder too
        versions.commit(spark, _run_path(path, run), batch, _run_place(path, run))


def refresh_run(df: DataFrame, path: str, runs: Sequence[str], run_column: str = "run_date") -> DataFrame:
    """Replace the given dated runs by their rows in ``df``, a run without rows included; returns all runs.

    Every run has a pointer of its own to its part of the batch it was written with, so a re-run does not duplicate, and a
    re-run that finds nothing leaves nothing of the earlier one. Nothing is moved after it is written, which would copy
    it on an object store. Rows of other runs are an error, since they would be lost.
    """
    spark = df.sparkSession
    named = F.col(run_column).cast("string")
    foreign = ~F.coalesce(named.isin([str(r) for r in runs]), F.lit(False))
    checked = F.when(foreign, F.raise_error(F.concat(F.lit("row of another run: "), F.coalesce(named, F.lit("NULL")))).cast(df.schema[run_column].dataType))
    _write_runs(df.withColumn(run_column, checked.otherwise(F.col(run_column))), path, runs, run_column)
    return read_runs(spark, path, df.schema)


def stored_runs(spark: SparkSession, path: str) -> list[str]:
    """Runs of a dated table, in order; a run without rows is one of them."""
    return sorted(unquote(name.removeprefix("run-")) for name in versions.children(spark, path) if name.startswith("run-"))


def read_runs(spark: SparkSession, path: str, schema: StructType, runs: Sequence[str] | None = None) -> DataFrame:
    """The current rows of all or some runs of a dated table."""
    wanted = stored_runs(spark, path) if runs is None else [str(r) for r in runs]
    paths = [versions.current(spark, _run_path(path, run), _run_place(path, run)) for run in wanted]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def store_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> None:
    """Replace a named table, its rows dealt into ``buckets`` by hash of ``keys`` and sorted by them.

    Tables of as many buckets of the same key join, and group by the key, without a shuffle. Rows are dealt before they
    are written, so a bucket is one file. Choose ``buckets`` for the largest of the tables, a bucket being one task.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).mode("overwrite").option("path", path).saveAsTable(name)


def store_sorted(df: DataFrame, path: str, keys: Sequence[str], lookups: Mapping[str, int] | None = None, group_bytes: int = 16 << 20) -> None:
    """Write rows in ranges of ``keys``, sorted, with Bloom filters for columns that are looked up in no order.

    A lookup by key or by a prefix of a text key then reads the row groups whose range has it, and a lookup by one
    of ``lookups`` (column to number of distinct values in a file) those whose filter has it.
    """
    writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.option("parquet.block.size", group_bytes)
    for column, distinct in (lookups or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True).option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(path)


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create a table from a query unless it exists."""
    writer = df.write.mode("ignore")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def register_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    target: str,
    results: DataFrame | None = None,
    gate: bool = True,
    renames: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Copy checked tables to ``target`` and return name -> path.

    All tables go to one new release, which becomes current as a whole when the last is complete.
    With ``gate`` a failed check stops everything before the first table is written; without it the
    results are informative only.
    """
    if gate and results is not None:
        assert_passed(results)
    release, stored = versions.fresh(target), {}
    for name, df in tables.items():
        df.write.option("compression", CODEC).parquet(f"{release}/{(renames or {}).get(name, name)}")
        stored[(renames or {}).get(name, name)] = f"{release}/{(renames or {}).get(name, name)}"
    versions.commit(spark, target, release)
    return stored


def read_published(spark: SparkSession, target: str, name: str, schema: StructType) -> DataFrame:
    """A table of the current release."""
    return spark.read.schema(schema).parquet(f"{versions.current(spark, target)}/{name}")


def write_jdbc(df: DataFrame, url: str, table: str, connections: int = 8, **options: str) -> None:
    """Overwrite the rows of a database table, keeping its definition."""
    limited = df.repartition(connections)  # the stages before keep their own width
    limited.write.format("jdbc").mode("overwrite").option("truncate", True).options(url=url, dbtable=table, **options).save()


def results_path(path: str) -> str:
    """Where results go beside an input: ``a/b.csv`` gives ``a/b_results.csv``."""
    stem, extension = os.path.splitext(path)
    return f"{stem}_results{extension}"


def save_results(df: DataFrame, input_path: str, kind: str = "parquet") -> str:
    """Save results beside the input and return their path."""
    path = results_path(input_path)
    writer = df.write.mode("overwrite").format(kind)
    (writer.option("header", True) if kind == "csv" else writer).save(path)
    return path


def _fragmented(spark: SparkSession, folder: str, file_bytes: int) -> bool:
    """Would files of ``file_bytes`` be half as many or fewer?"""
    fs, target = filesystem(spark, folder)
    sizes = [f.getLen() for f in fs.listStatus(target) if not f.getPath().getName().startswith(("_", "."))]
    return len(sizes) >= 2 * max(1, -(-sum(sizes) // file_bytes))


def compact(spark: SparkSession, path: str, schema: StructType, run_column: str = "run_date", file_bytes: int = 128 << 20) -> list[str]:
    """Rewrite a refreshed table, or the runs of a dated one, of many small files as few large ones; returns what was rewritten.

    File sizes decide: what is compact already keeps its version. All other runs are rewritten by one job, side by side, and
    each is switched when that is complete. A path of neither layout is refused, since its readers would not see the new files.
    """
    runs = stored_runs(spark, path)
    if not runs and not versions.exists(spark, path):
        raise LookupError(f"{path} is no refreshed or dated table")
    if not runs:
        if not _fragmented(spark, versions.current(spark, path), file_bytes):
            return []
        version = versions.fresh(path)
        read_current(spark, path, schema).hint("rebalance").write.option("compression", CODEC).parquet(version)
        versions.commit(spark, path, version)
        return [path]
    chosen = [run for run in runs if _fragmented(spark, versions.current(spark, _run_path(path, run), _run_place(path, run)), file_bytes)]
    if chosen:
        _write_runs(read_runs(spark, path, schema, chosen).hint("rebalance", run_column), path, chosen, run_column)
    return chosen


def inspect(df: DataFrame, rows: int = 20) -> None:
    """Print the first rows; for people, not for jobs."""
    df.show(rows)

