"""Checks over many dated runs from stored states, without reading the runs again.

A run's state is its row count, its missing values by column, and the number of rows of every key that a check names. States of
runs add up: counts are summed, key counts are summed by key. A new or repeated run replaces its own state
only, and the checks of the whole table follow from the states, keys repeated across runs included.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tallyloom.operators.quality import Check, check_rows
from tallyloom.sinks import tables

COUNTS = "run string, measure string, n bigint"


def _named(check: Check) -> str:
    return "-".join(check.columns)


def _key_sets(checks: Sequence[Check]) -> dict[str, tuple[str, ...]]:
    """Key columns of all uniqueness and reference checks; two checks of the same columns share a state."""
    return {_named(c): c.columns for c in checks if c.kind in ("unique", "reference")}


def count_state(df: DataFrame, run: str, checks: Sequence[Check]) -> DataFrame:
    """(run, measure, n): rows, and missing values of every column that must be complete."""
    columns = [c.columns[0] for c in checks if c.kind == "complete"]
    measures = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"missing {c}") for c in columns]]
    row = df.agg(*measures)
    pairs = [F.struct(F.lit(run).alias("run"), F.lit(c).alias("measure"), F.col(f"`{c}`").alias("n")) for c in row.columns]
    return row.select(F.inline(F.array(*pairs)))


def key_state(df: DataFrame, run: str, columns: Sequence[str]) -> DataFrame:
    """(run, keys, n): rows of every key; a missing key part is a value as others."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).select(F.lit(run).alias("run"), *columns, "n")


def store_state(df: DataFrame, path: str, run: str, checks: Sequence[Check]) -> None:
    """Replace the state of one run."""
    tables.refresh_run(count_state(df, run, checks), f"{path}/counts", [run], "run")
    for name, columns in _key_sets(checks).items():
        tables.refresh_run(key_state(df, run, columns), f"{path}/keys-{name}", [run], "run")


def _keys(spark: SparkSession, path: str, name: str, columns: Sequence[str], schema: StructType) -> DataFrame:
    typed = StructType([*[f for f in schema.fields if f.name in columns], StructField("n", LongType())])
    rows = tables.read_runs(spark, f"{path}/keys-{name}", typed)
    return rows.groupBy(*columns).agg(F.sum("n").alias("n"))


def checks_from_states(spark: SparkSession, table: str, path: str, schema: StructType, checks: Sequence[Check], parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows of ``run_checks`` for all stored runs of a table.

    ``schema`` declares the table's columns; ``parents`` may name, by check, another table's keys to check references
    against, such as the key state of the parent.
    """
    counts = tables.read_runs(spark, f"{path}/counts", spark.createDataFrame([], COUNTS).schema)
    total = counts.groupBy("measure").agg(F.sum("n").alias("n"))
    counted = lambda measure: F.coalesce(F.sum(F.when(F.col("measure") == measure, F.col("n"))), F.lit(0))
    parts = []
    for check in checks:
        if check.kind in ("size", "complete"):
            bad = (counted("rows") == 0).cast("bigint") if check.kind == "size" else counted(f"missing {check.columns[0]}")
            parts.append(total.agg(F.lit(check.name).alias("constraint"), counted("rows").alias("n_rows"), bad.alias("n_bad")))
            continue
        keys = _keys(spark, path, _named(check), check.columns, schema)
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in check.columns])
        if check.kind == "unique":
            keys, wrong = keys.where(present), F.col("n") > 1
        else:
            parent = (parents or {}).get(check.name, check.parent)
            known = parent.select(*[F.col(p).alias(f"_{c}") for c, p in zip(check.columns, check.parent_columns)]).distinct()
            same = reduce(lambda a, b: a & b, [keys[c] == known[f"_{c}"] for c in check.columns])
            keys, wrong = keys.join(known, same, "left"), F.col(f"_{check.columns[0]}").isNull()
        n, bad = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(wrong, F.col("n"))), F.lit(0))
        parts.append(keys.agg(F.lit(check.name).alias("constraint"), n.alias("n_rows"), bad.alias("n_bad")))
    return check_rows(table, reduce(DataFrame.union, parts))
