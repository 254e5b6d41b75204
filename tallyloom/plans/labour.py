"""Labour-force tour: filters, counts and sums over an all-text CSV table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.cells import number, scaled
from tallyloom.sinks import snapshots
from tallyloom.sources.files import read_csv
from tallyloom.sources.schemas import LABOUR_FORCE

# The characteristic and the industry total the reports refer to.
FULL_TIME = "Full-time employment"
ALL_INDUSTRIES = "Total, all industries"


def above(df: DataFrame, limit: float = 6000) -> DataFrame:
    return df.select("GEO", "VALUE", "Date").where(number(F.col("VALUE")) > limit)


def with_value(df: DataFrame) -> DataFrame:
    return df.where(F.col("VALUE").isNotNull())


def rows_per_characteristic(df: DataFrame) -> DataFrame:
    return with_value(df).groupBy("Labour_force_characteristics").agg(F.count(F.lit(1)).alias("count"))


def full_time(df: DataFrame, characteristic: str = FULL_TIME) -> DataFrame:
    return with_value(df).where(F.col("Labour_force_characteristics") == characteristic)


def employment_by_industry(df: DataFrame, total: str = ALL_INDUSTRIES) -> DataFrame:
    """Employment per industry without the total line, largest first."""
    rows = df.where(F.col("NAICS") != total).groupBy("NAICS")
    return rows.agg(F.sum(number(F.col("VALUE"))).alias("Employment")).orderBy(F.desc("Employment"), "NAICS")


def scaled_values(df: DataFrame, factor: float = 1.5) -> DataFrame:
    return df.select("NAICS", scaled(number(F.col("VALUE")), factor).cast("float").alias("new_value"))


def load_labour(spark: SparkSession, csv: str, path: str, at: dt.datetime, updated_at: dt.datetime) -> None:
    """From the CSV to a stored table of full-time rows, then an update of all its rows; both stay readable."""
    rows = full_time(read_csv(spark, csv, LABOUR_FORCE))
    snapshots.commit(rows, path, "CREATE TABLE AS SELECT", at)
    snapshots.update(spark, path, {"Labour_force_characteristics": F.lit("Full Time")}, updated_at)
