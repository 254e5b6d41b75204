"""Cell-level expressions: sheet letters, numbers in text, labels, dates."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

DAY_MICROS = 24 * 60 * 60 * 1_000_000


def column_number(letters: str) -> int:
    """One-based position of a sheet column: A is 1, Z is 26, AA is 27."""
    if not re.fullmatch("[A-Z]+", letters):
        raise ValueError(f"not a sheet column: {letters!r}")
    return reduce(lambda left, letter: left * 26 + ord(letter) - 64, letters, 0)


def cell(df: DataFrame, letters: str) -> Column:
    """Column of ``df`` at a sheet address."""
    position = column_number(letters)
    if position > len(df.columns):
        raise ValueError(f"column {letters} is beyond the last of {len(df.columns)} columns")
    return F.col(f"`{df.columns[position - 1]}`")


def rename_positions(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename all columns by position; the counts must agree."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number(text: Column) -> Column:
    """The number written in a cell, NULL when it holds something else.

    The pattern keeps out spellings a cast would accept, such as ``12D`` or ``nan``.
    """
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def is_number(text: Column) -> Column:
    """True when the cell holds a number; an empty cell does not."""
    return number(text).isNotNull()


def label(code: Column, labels: Mapping[str, str]) -> Column:
    """Label of a code; NULL for a code without one."""
    chain = None
    for key, value in labels.items():
        chain = (F if chain is None else chain).when(code == key, value)
    return chain


def open_access_label(flag: Column) -> Column:
    return F.when(flag, "Open Access").otherwise("Not Open Access")


def day_or_null(text: Column) -> Column:
    """Date written in a text; display dates such as ``July 2021`` become NULL instead of failing."""
    return text.try_cast("date")


def micros(moment: Column) -> Column:
    """Microseconds since 1970 on the wall clock, so no daylight-saving shift enters day gaps."""
    wall = moment.cast("timestamp_ntz")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, wall)


def whole_days(start: Column, end: Column) -> Column:
    """Completed 24-hour days from ``start`` to ``end``, rounded down also when negative."""
    gap = micros(end) - micros(start)
    return ((gap - F.pmod(gap, F.lit(DAY_MICROS))) / DAY_MICROS).cast("bigint")


def year_window(year: Column, as_of_year: int, years: int = 26) -> Column:
    """Years from ``years`` before the end of the window to next year, the window's end."""
    last = as_of_year + 1
    return year.between(last - years, last)


def scaled(value: Column, factor: float = 1.5) -> Column:
    return value * F.lit(factor)


def text_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Listed columns (all by default) as text; a missing value stays NULL."""
    chosen = set(df.columns if columns is None else columns)
    return df.select(
        [F.col(f"`{c}`").cast("string").alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns]
    )


def register_scaled(spark: SparkSession, name: str = "converted_value", factor: float = 1.5) -> None:
    """Register the scaling function for SQL as a SQL function, which the optimiser inlines."""
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"not a function name: {name!r}")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v DOUBLE) RETURNS FLOAT "
        f"RETURN CAST(v * {float(factor)}D AS FLOAT)"
    )


def register_python(
    spark: SparkSession, name: str, function: Callable[[pd.Series], pd.Series], returns: DataType | str
) -> None:
    """Register a user's Python function for SQL; it works on whole Arrow batches."""
    spark.udf.register(name, F.pandas_udf(function, returns))
