"""Schemas from sample documents, and fields in which documents differ from a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, NullType, StringType, StructField, StructType, _parse_datatype_string

from tallyloom.sources.files import literal_rows, read_json
from tallyloom.sources.schemas import TEXT, record


def _settled(kind: DataType) -> DataType:
    """Fields that are never anything but null are text."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _settled(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType))
    return StringType() if isinstance(kind, NullType) else kind


def sample_schema(lines: DataFrame, value: str = "value") -> StructType:
    """The schema that all JSON documents of a sample fit, one to a line; what is no document is left out.

    Documents become variants whose schemas merge in one aggregate, so the sample may be any table; only
    the merged schema reaches the driver.
    """
    parsed = lines.select(F.try_parse_json(F.col(value)).alias("_v")).where("_v IS NOT NULL")
    merged = parsed.agg(F.schema_of_variant_agg("_v").alias("kind")).first()["kind"]
    kind = _settled(_parse_datatype_string(merged.replace("OBJECT<", "STRUCT<"))) if merged else None
    if not isinstance(kind, StructType):
        raise ValueError("the sample holds no JSON objects of one shape")
    return kind


def read_json_like(spark: SparkSession, sample: str, path: str) -> DataFrame:
    """Documents of ``path`` under the schema of the documents in ``sample``."""
    return read_json(spark, path, sample_schema(spark.read.text(sample)))


def field_types(kind: DataType, prefix: str = "") -> dict[str, str]:
    """Paths of all fields with the type of each; elements of an array are below its own path."""
    if isinstance(kind, ArrayType):
        return field_types(kind.elementType, prefix)
    if not isinstance(kind, StructType):
        return {}
    found = {}
    for field in kind.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        inner = field.dataType
        while isinstance(inner, ArrayType):
            inner = inner.elementType
        found[path] = "object" if isinstance(inner, StructType) else inner.simpleString()
        found |= field_types(field.dataType, path)
    return found


def field_drift(lines: DataFrame, declared: StructType, value: str = "value") -> DataFrame:
    """(field, status, kind): fields that documents have and the schema lacks, ``extra``, or the reverse, ``missing``.

    A missing field is one that no document has a value or a null for; below a missing object its fields are listed too.
    """
    found, known = field_types(sample_schema(lines, value)), field_types(declared)
    rows = [(f, "extra", found[f]) for f in sorted(found.keys() - known.keys())]
    rows += [(f, "missing", known[f]) for f in sorted(known.keys() - found.keys())]
    schema = record(field=TEXT, status=TEXT, kind=TEXT)
    spark = lines.sparkSession
    return literal_rows(spark, rows, schema) if rows else spark.createDataFrame([], schema)
