"""Project tracker: positional sheet to named, labelled rows and a specialisation bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.cells import label
from tallyloom.operators.relational import full_outer_lookup, number_rows
from tallyloom.operators.reshape import unpivot_present
from tallyloom.sinks.tables import refresh, write_jdbc
from tallyloom.sources.files import read_block
from tallyloom.sources.schemas import TRACKER_DESCRIPTIVE, TRACKER_INDICATORS

FIRST_ROW = 5
COLUMNS = [*TRACKER_DESCRIPTIVE, *TRACKER_INDICATORS]

# Labels of province codes and deadline bands.
PROVINCES = {
    "MB": "Manitoba",
    "MA": "Manitoba",
    "ON": "Ontario",
    "QC": "Quebec",
    "AB": "Alberta",
    "BC": "British Columbia",
    "NL": "Newfoundland and Labrador",
    "YK": "Yukon",
    "SK": "Saskatchewan",
    "NS": "Nova Scotia",
    "NU": "Nunavut",
}
DEADLINES = {
    "1": "Within 15 days",
    "2": "15 - 60 days",
    "3": "60 - 180 days",
    "4": "180 - 360 days",
    "5": "+1 year",
    "6": "No Deadline",
}


def labelled(block: DataFrame, fiscal_year: str) -> DataFrame:
    """Fiscal year, province and deadline labels added to the block's rows."""
    return block.withColumns(
        {
            "FISCAL_YEAR": F.lit(fiscal_year),
            "PROVINCE_DESC": label(F.col("PROVINCE_LBL"), PROVINCES),
            "NEXT_DEADLINE_DESC": label(F.col("NEXT_DEADLINE_LBL"), DEADLINES),
        }
    )


def projects(block: DataFrame, fiscal_year: str) -> DataFrame:
    """Labelled rows numbered in sheet order. Stored once, so all later writes share the ids."""
    return number_rows(labelled(block, fiscal_year), ["file", "row"], "PROJECT_ID", unique=True).drop("file", "row")


def documentation_counts(block: DataFrame) -> DataFrame:
    return block.groupBy("EA_IA_DOCUMENTATION_ISSUED_LBL").agg(F.count(F.lit(1)).alias("count"))


def specializations(project: DataFrame) -> DataFrame:
    """One row per project and indicator that has a value."""
    ids = ["PROJECT_ID", "PROJECT_NM"]
    return unpivot_present(project, ids, TRACKER_INDICATORS, "SPECIALIZATION_CD", "SPECIALIZATION_CNT")


def project_specializations(long: DataFrame, lookup: DataFrame) -> DataFrame:
    """Bridge of projects and specialisations; unused lookup codes keep a row without a project."""
    codes = lookup.withColumnRenamed("Specialization_CD", "SPECIALIZATION_CD")
    return full_outer_lookup(long, codes, "SPECIALIZATION_CD").select("PROJECT_ID", "SPECIALIZATION_CD")


def tracker_tables(project: DataFrame, lookup: DataFrame, bridge: DataFrame) -> dict[str, DataFrame]:
    """The three target tables by name."""
    return {"EA_PROJECT_TRACKER": project, "EA_SPECIALIZATION": lookup, "EA_PROJECT_SPECIALIZATION": bridge}


def write_tracker(project: DataFrame, lookup: DataFrame, bridge: DataFrame, url: str, **options: str) -> None:
    """Overwrite the three database tables."""
    for table, df in tracker_tables(project, lookup, bridge).items():
        write_jdbc(df, url, table, **options)


def load_tracker(spark: SparkSession, sheets: str, lookup: DataFrame, target: str, fiscal_year: str) -> dict[str, DataFrame]:
    """From sheet files to the three stored tables, refreshed below ``target``; returns them."""
    project = projects(read_block(spark, sheets, COLUMNS, FIRST_ROW), fiscal_year)
    bridge = project_specializations(specializations(project), lookup)
    return {name: refresh(df, f"{target}/{name}") for name, df in tracker_tables(project, lookup, bridge).items()}
