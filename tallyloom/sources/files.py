"""Readers. Every one takes a declared schema; none infers one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallyloom.functions.cells import rename_positions
from tallyloom.sources.sheet_parts import sheet_lines, sheet_records

# One sheet record: text without line breaks, or quoted text with any. A lone quote is plain text.
_RECORD = r'((?:[^"\r\n]++|"[^"]*+"|")*+)(?:\r\n|\n|\r|\z)'


def read_csv(spark: SparkSession, path: str, columns: StructType, by_position: bool = False) -> DataFrame:
    """CSV with a header line; all columns are text.

    The header must match ``columns``, unless they name the columns by position.
    """
    return spark.read.schema(columns).option("header", True).option("enforceSchema", by_position).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType, whole_files: bool = False) -> DataFrame:
    """A directory of JSON documents, one per line, or one per file with ``whole_files``.

    What is no document becomes a row of NULLs; read lines and :func:`parse_json_lines` to report it.
    """
    return spark.read.schema(schema).option("multiLine", whole_files).json(path)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with the file they come from, as ``value`` and ``filename``."""
    return spark.read.text(path).withColumn("filename", F.col("_metadata.file_path"))


def parse_once(parsed: Column) -> Column:
    """A parsed value that later filters and projections share instead of parsing again.

    The optimiser moves filters below a projection by copying its expressions, which would repeat
    the parser for every predicate. It does not move them below a generator.
    """
    return F.explode(F.array(parsed))


def parse_json_lines(lines: DataFrame, schema: StructType, value: str = "value", into: str = "page") -> DataFrame:
    """Parse one JSON document per line. A line that is no document gets a NULL ``into``.

    Count or list those with :func:`malformed_lines` before exploding drops them.
    """
    marked = StructType([*schema.fields, StructField("_malformed", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    parsed = lines.withColumn("_parsed", parse_once(F.from_json(value, marked, options)))
    fields = F.struct(*[F.col("_parsed")[f.name].alias(f.name) for f in schema.fields])
    whole = F.col("_parsed").isNotNull() & F.col("_parsed._malformed").isNull()
    return parsed.withColumn(into, F.when(whole, fields)).drop("_parsed")


def malformed_lines(parsed: DataFrame, into: str = "page") -> DataFrame:
    """Lines that held something else than a document; blank lines do not count."""
    return parsed.where(F.col(into).isNull() & (F.length(F.trim("value")) > 0))


def read_sheets(
    spark: SparkSession, base: str, sheets: Mapping[str, StructType], sheet_column: str = "Sample Type", key: str = "Sample ID"
) -> DataFrame:
    """Workbooks laid out as ``base/<workbook>/<sheet>/*.csv``, all sheets below each other.

    ``sheets`` declares the header of each sheet name. The name becomes a column, rows without a
    key are left out, and a column some sheets lack is NULL there.
    """
    frames = [
        read_csv(spark, f"{base}/*/{name}", header).withColumn(sheet_column, F.lit(name))
        for name, header in sheets.items()
    ]
    return stack_sheets(frames, key)


def stack_sheets(frames: Sequence[DataFrame], key: str = "Sample ID") -> DataFrame:
    """Sheets below each other, rows without a key left out."""
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return together.where(F.col(f"`{key}`").isNotNull())


def read_block(
    spark: SparkSession, path: str, columns: Sequence[str], first_row: int = 1, first_column: int = 1, in_parts: bool = False
) -> DataFrame:
    """A headerless cell block of sheet files, all text; ``A5`` is row 5, column 1.

    A file is read as one text, which suits sheets of the size a sheet program opens. ``in_parts`` lets several tasks
    read a file, with the same rows, for exports of any size (their numbers are of type long).
    """
    if in_parts:
        records = sheet_records(sheet_lines(spark, path))
        return parse_block(records, columns, first_row, first_column, "text", start="row")
    sheets = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    return parse_block(sheets, columns, first_row, first_column)


def parse_block(
    sheets: DataFrame,
    columns: Sequence[str],
    first_row: int = 1,
    first_column: int = 1,
    content: str = "value",
    file: str = "file",
    start: str | None = None,
) -> DataFrame:
    """Cell block of sheet texts. ``file`` and ``row`` (one-based sheet row) tell where a row is from.

    Rows whose cells are all empty are left out. ``start`` names the column that holds the number of a text's first row,
    where texts are parts of sheets.
    """
    width = first_column - 1 + len(columns)
    cells = ", ".join(f"`_c{i}` STRING" for i in range(width))
    lines = sheets.select(
        F.col(file).alias("file"),
        (F.col(start) if start else F.lit(1)).alias("start"),
        F.posexplode(F.regexp_extract_all(content, F.lit(_RECORD), F.lit(1))).alias("at", "line"),
    )
    parsed = lines.where(F.col("start") + F.col("at") >= first_row).select(
        "file",
        (F.col("start") + F.col("at")).alias("row"),
        parse_once(F.from_csv("line", cells, {"multiLine": "true", "escape": '"'})).alias("cells"),
    )
    chosen = parsed.select("file", "row", *[f"cells._c{i}" for i in range(first_column - 1, width)])
    return drop_empty(rename_positions(chosen, ["file", "row", *columns]), columns)


def drop_empty(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Leave out rows in which every one of ``columns`` (all by default) is NULL."""
    return df.where(F.coalesce(*[F.col(f"`{c}`").cast("string") for c in columns or df.columns]).isNotNull())


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_jdbc(spark: SparkSession, url: str, table: str, split: tuple[str, int, int, int] | None = None, **options: str) -> DataFrame:
    """A database table. ``split`` (column, low, high, parts) reads it with that many connections."""
    return spark.read.format("jdbc").options(**jdbc_options(url, table, split, **options)).load()


def jdbc_options(url: str, table: str, split: tuple[str, int, int, int] | None = None, **options: str) -> dict[str, str]:
    chosen = {"url": url, "dbtable": table, **options}
    if split:
        column, low, high, parts = split
        chosen |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
    return chosen


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType) -> DataFrame:
    """A small table written out in code, as constants the optimiser can size and fold."""
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, schema.fields)])
        for row in rows
    ]
    return spark.sql("SELECT 1").select(F.inline(F.array(*structs)))


def from_pandas(spark: SparkSession, frame: pd.DataFrame, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(frame, schema)


def head_as_pandas(df: DataFrame, rows: int = 5) -> pd.DataFrame:
    """The first rows as a local frame; the limit bounds what reaches the driver."""
    return df.limit(rows).toPandas()


def require_inputs(inputs: Mapping[str, DataFrame], names: Sequence[str]) -> None:
    """Stop with a message before anything is planned when an input is missing."""
    missing = [name for name in names if name not in inputs]
    if missing:
        raise ValueError(f"missing inputs: {', '.join(missing)}")


def run_rows(df: DataFrame, run_date: str | None = None, run_type: str = "prod", id_column: str | None = None, test_id: str | None = None) -> DataFrame:
    """Rows of one dated run; a ``test`` run keeps a single fixed id."""
    if run_type not in ("prod", "test"):
        raise ValueError(f"run type must be 'prod' or 'test', not {run_type!r}")
    keep: Column = F.lit(True)
    if run_date is not None:
        keep = keep & (F.col("run_date") == run_date)
    if run_type == "test":
        keep = keep & (F.col(id_column) == test_id)
    return df.where(keep)
