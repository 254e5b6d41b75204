"""Lab samples: wide sheets to one long table of test results."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyloom.functions.cells import number
from tallyloom.operators.quality import assert_passed, is_unique, run_checks
from tallyloom.operators.reshape import split_wide, unpivot_rest
from tallyloom.sinks.tables import append, conform, create_table
from tallyloom.sources.files import read_sheets, read_table
from tallyloom.sources.schemas import SAMPLE_DIMENSION, SAMPLE_RESULT


def sample_results(sheets: DataFrame) -> DataFrame:
    """Long results with their sample's description.

    Description and results come from the same wide row, so they are unpivoted together and need no
    join. Only columns that hold tests are unpivoted; a missing result stays NULL.
    """
    return unpivot_rest(sheets, SAMPLE_DIMENSION).toDF(*SAMPLE_RESULT.names)


def rejoined_results(sheets: DataFrame, by_sheet: bool = True) -> DataFrame:
    """The same through a separate dimension and long table, joined again.

    ``by_sheet=False`` joins by sample id alone, which multiplies ids that occur on several sheets.
    """
    keyed = ["Sample ID", "Sample Type"] if by_sheet else ["Sample ID"]
    if by_sheet:
        dimension = sheets.select(*[f"`{c}`" for c in SAMPLE_DIMENSION])
        facts = unpivot_rest(sheets.drop(*[c for c in SAMPLE_DIMENSION if c not in keyed]), keyed)
    else:
        dimension, facts = split_wide(sheets, "Sample ID", SAMPLE_DIMENSION)
    joined = dimension.join(facts, keyed, "left")
    return joined.select(*[f"`{c}`" for c in [*SAMPLE_DIMENSION, "Test", "value"]]).toDF(*SAMPLE_RESULT.names)


def sample_checks(sheets: DataFrame) -> DataFrame:
    """Is every sample listed once per sheet?"""
    ids = sheets.select(F.col("Sample ID").alias("sample_id"), F.col("Sample Type").alias("sample_type"))
    return run_checks("samples", ids, [is_unique("sample_id", "sample_type")])


def projects_and_types(results: DataFrame) -> DataFrame:
    return results.select("Project_NM", "Sample_Type_LBL").distinct()


def rows_per_project(results: DataFrame) -> DataFrame:
    named = results.where(F.col("Project_NM").isNotNull())
    return named.groupBy("Project_NM").agg(F.count(F.lit(1)).alias("count")).orderBy("count", "Project_NM")


def results_above(results: DataFrame, sample_type: str, test: str, limit: float) -> DataFrame:
    """Results of one test on one kind of sample above a limit, compared as numbers."""
    return results.where(
        (F.col("Sample_Type_LBL") == sample_type) & (F.col("Test_NM") == test) & (number(F.col("Value_SRT")) > limit)
    )


def load_samples(spark: SparkSession, base: str, headers: Mapping[str, StructType], name: str, path: str) -> DataFrame:
    """From workbook directories to the declared result table ``name``; returns the stored table.

    A sample listed twice on a sheet stops the run before the table is created.
    """
    sheets = read_sheets(spark, base, headers)
    assert_passed(sample_checks(sheets))
    create_table(spark, name, SAMPLE_RESULT, path)
    append(conform(sample_results(sheets), SAMPLE_RESULT), path)
    spark.catalog.refreshTable(name)
    return read_table(spark, name)
