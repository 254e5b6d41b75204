"""Nested data to rows, wide rows to long ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_items(df: DataFrame, array: Column, into: str, keep_empty: bool = False) -> DataFrame:
    """One row per array element. Rows with a NULL or empty array vanish unless ``keep_empty``."""
    return df.withColumn(into, F.explode_outer(array) if keep_empty else F.explode(array))


def explode_parallel(
    df: DataFrame, keep: Sequence[Column], arrays: dict[str, Column], strict: bool = True
) -> DataFrame:
    """Rows from parallel arrays, matched by position inside the row.

    With ``strict`` a row whose arrays differ in length fails the job; otherwise the shorter ones
    are filled with NULL.
    """
    sizes = F.array(*[F.coalesce(F.size(array), F.lit(0)) for array in arrays.values()])
    positions = F.sequence(F.lit(0), F.array_max(sizes) - 1)
    items = F.when(
        F.array_max(sizes) > 0,
        F.transform(
            positions,
            lambda i: F.struct(*[F.get(array, i).alias(name) for name, array in arrays.items()]),
        ),
    )
    if strict:
        items = F.when(F.array_max(sizes) == F.array_min(sizes), items).otherwise(
            F.raise_error(F.lit("parallel arrays differ in length"))
        )
    return df.select(*keep, F.inline(items))


def _quoted(columns: Sequence[str]) -> list[str]:
    return [f"`{c}`" for c in columns]


def unpivot_present(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Listed columns to rows; missing values are left out."""
    long = df.unpivot(_quoted(ids), _quoted(columns), name, value)
    return long.where(F.col(f"`{value}`").isNotNull())


def unpivot_rest(df: DataFrame, ids: Sequence[str], name: str = "Test", value: str = "value") -> DataFrame:
    """All columns other than ``ids`` to rows as text; missing values are kept."""
    rest = [c for c in df.columns if c not in ids]
    as_text = df.select(*_quoted(ids), *[F.col(c).cast("string").alias(c.strip("`")) for c in _quoted(rest)])
    return as_text.unpivot(_quoted(ids), _quoted(rest), name, value)


def split_wide(
    df: DataFrame, key: str, dimension: Sequence[str], name: str = "Test", value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """A wide sheet as a dimension (key and descriptive columns) and long results (key, name, value)."""
    described = [c for c in dimension if c != key]
    return df.select(*_quoted([key, *described])), unpivot_rest(df.drop(*described), [key], name, value)
