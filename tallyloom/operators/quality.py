"""Declared checks on tables, answered as one DataFrame of results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCESS, FAILURE = "Success", "Failure"


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...] = ()
    parent: DataFrame | None = None
    parent_columns: tuple[str, ...] = ()
    name: str = field(default="")


def has_size() -> Check:
    """At least one row."""
    return Check("size", name="Size")


def is_complete(column: str) -> Check:
    """No missing value."""
    return Check("complete", (column,), name=f"Completeness({column})")


def is_unique(*columns: str) -> Check:
    """No key twice. Rows with a missing key part are the business of ``is_complete``."""
    return Check("unique", columns, name=f"Uniqueness({','.join(columns)})")


def refers_to(keys: Mapping[str, str], parent: DataFrame, parent_name: str) -> Check:
    """Every row has a parent; ``keys`` maps child to parent columns. A missing key has none."""
    return Check(
        "reference", tuple(keys), parent, tuple(keys.values()), f"Reference({','.join(keys)} -> {parent_name})"
    )


def _count_row(name: str, rows: str, bad: str) -> str:
    literal = name.replace("\\", "\\\\").replace("'", "\\'")
    return f"named_struct('constraint', '{literal}', 'n_rows', {rows}, 'n_bad', {bad})"


def _scalar_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Size and completeness checks of a table in a single aggregate."""
    measures = [F.count(F.lit(1)).alias("n")]
    measures += [
        F.count_if(F.col(c.columns[0]).isNull()).alias(f"m{i}") for i, c in enumerate(checks) if c.kind == "complete"
    ]
    bad = ["CAST(n = 0 AS BIGINT)" if c.kind == "size" else f"m{i}" for i, c in enumerate(checks)]
    rows = ", ".join(_count_row(c.name, "n", b) for c, b in zip(checks, bad))
    return df.agg(*measures).selectExpr(f"inline(array({rows}))")


def _unique_check(df: DataFrame, check: Check) -> DataFrame:
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in check.columns])
    counts = df.where(present).groupBy(*check.columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.lit(check.name).alias("constraint"),
        F.expr("coalesce(sum(n), 0)").alias("n_rows"),
        F.expr("coalesce(sum(n) FILTER (WHERE n > 1), 0)").alias("n_bad"),
    )


def _reference_check(df: DataFrame, check: Check) -> DataFrame:
    """Child and parent keys are counted in one partial aggregate: no join, and a hot key is one row."""
    keys = [f"k{i}" for i in range(len(check.columns))]
    child = df.select(*[F.col(c).alias(k) for c, k in zip(check.columns, keys)], F.lit(1).alias("n"), F.lit(0).alias("known"))
    parent = check.parent.select(*[F.col(c).alias(k) for c, k in zip(check.parent_columns, keys)], F.lit(0).alias("n"), F.lit(1).alias("known"))
    counts = child.union(parent).groupBy(*keys).agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    missing = " OR ".join(["known = 0", *[f"{k} IS NULL" for k in keys]])
    return counts.agg(
        F.lit(check.name).alias("constraint"),
        F.expr("coalesce(sum(n), 0)").alias("n_rows"),
        F.expr(f"coalesce(sum(n) FILTER (WHERE {missing}), 0)").alias("n_bad"),
    )


def run_checks(table: str, df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: table, constraint, status, n_rows, n_bad, message."""
    scalar = [c for c in checks if c.kind in ("size", "complete")]
    parts = [_scalar_checks(df, scalar)] if scalar else []
    parts += [_unique_check(df, c) for c in checks if c.kind == "unique"]
    parts += [_reference_check(df, c) for c in checks if c.kind == "reference"]
    return check_rows(table, reduce(DataFrame.union, parts))


def check_rows(table: str, counts: DataFrame) -> DataFrame:
    """Results from (constraint, n_rows, n_bad)."""
    return counts.select(
        F.lit(table).alias("table"),
        "constraint",
        F.expr(f"if(n_bad > 0, '{FAILURE}', '{SUCCESS}')").alias("status"),
        "n_rows",
        "n_bad",
        F.expr("if(n_bad > 0, concat(n_bad, ' of ', n_rows, ' rows break the constraint'), NULL)").alias("message"),
    )


def overall_status(results: DataFrame) -> DataFrame:
    """Per table: Success only when no check failed."""
    failures = F.count_if(F.col("status") == FAILURE)
    return results.groupBy("table").agg(
        F.when(failures > 0, FAILURE).otherwise(SUCCESS).alias("status"), failures.alias("failed_checks")
    )


class ChecksFailed(Exception):
    """Raised by a publishing gate; carries the failed constraints."""


def assert_passed(results: DataFrame) -> None:
    """Raise with every failed constraint. There is one row per declared check, so this is small."""
    failed = results.where(F.col("status") == FAILURE).collect()
    if failed:
        raise ChecksFailed("; ".join(f"{r.table}: {r.constraint}: {r.message}" for r in failed))


def profile_nested(flat: DataFrame, documents: DataFrame, key: str, levels: Sequence[str]) -> DataFrame:
    """Profile of a flattened table as (measure, value) rows.

    Missing values and distinct values per level, documents with and without rows. Rows are counted by the combination of
    their levels first, so that the distinct counts copy combinations and not rows.
    """
    combined = flat.groupBy(*levels).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(key).isNull()).alias("_keyless"))
    zero = F.lit(0).cast("bigint")
    measures = [F.coalesce(F.sum("_keyless"), zero).alias(f"missing {key}")]
    measures += [F.coalesce(F.sum(F.when(F.col(c).isNull(), F.col("_n"))), zero).alias(f"missing {c}") for c in levels]
    measures += [F.count_distinct(c).alias(f"distinct {c}") for c in levels]
    counts = combined.agg(*measures)
    covered = flat.select(F.col(key).alias("_covered")).distinct()
    ids = documents.select(F.col(key).alias("_id")).distinct()
    presence = ids.join(covered, F.col("_id") == F.col("_covered"), "left").agg(
        F.count("_covered").alias("documents with rows"),
        F.count_if(F.col("_covered").isNull()).alias("documents without rows"),
    )

    def rows(df: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").alias("value")) for c in df.columns]
        return df.select(F.inline(F.array(*pairs)))

    return rows(counts).unionByName(rows(presence))
