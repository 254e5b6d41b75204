"""Records of sheet files that are read in parts, by several tasks a file.

A record may hold line breaks between quotes, so whether a line begins a record depends on all quotes before it.
Each file block reports how many quotes it holds; a sum over the blocks of a file, one row each, tells every block how
many came before, and a running sum inside the block does the same for its lines. Records are numbered in the same way,
by what each block begins. Lines move once, to the lines of their block; only lines of records with breaks
are grouped, by record.

Defined results: records, their numbers and their text are those of the file read whole, a lone quote (the last of an
odd number) being plain text. A record is one text of one task, however the file is cut; so is a file that is compressed
or has no line feeds, which cannot be cut. An empty file has no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.session import materialize

BLOCK = ("file", "block")


def sheet_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of sheet files as file, block (offset of the part they were read in), at (order in the part), value."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value",
    )


def quotes_in(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def breaks_in(value: Column, inside: Column, stays_open: Column) -> Column:
    """Carriage returns that end a record in the middle of a line: not between quotes, not the line's last character."""
    text = F.concat(F.when(inside, F.lit('"')).otherwise(F.lit("")), value, F.when(stays_open, F.lit('"')).otherwise(F.lit("")))
    plain = F.regexp_replace(text, r'"[^"]*+"', '""')
    return F.regexp_count(plain, F.lit(r"\r(?!\z)"))


def before(rows: DataFrame, *sums: str) -> DataFrame:
    """One row a block: for each column the sum over the file's blocks before it, and the file's total."""
    blocks = rows.groupBy(*BLOCK).agg(*[F.sum(c).alias(c) for c in sums])
    file = Window.partitionBy("file")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    columns = [x for c in sums for x in (F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before"), F.sum(c).over(file).alias(f"{c}_total"))]
    return blocks.select(*BLOCK, *columns)


def sheet_records(lines: DataFrame) -> DataFrame:
    """file, row (number of the first record) and text: one record, or several that lone carriage returns part.

    ``lines`` has file, block, at and value, as :func:`sheet_lines` gives them.
    """
    order = Window.partitionBy(*BLOCK).orderBy("at")
    here = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = lines.withColumn("quotes", quotes_in(F.col("value")).cast("long"))
    known = counted.join(before(counted, "quotes"), list(BLOCK))
    closed = F.col("quotes_before") + F.sum("quotes").over(here)
    marked = known.withColumn("closed", closed).withColumn("opened", F.col("closed") - F.col("quotes"))
    within = lambda n: (F.col(n) % 2 == 1) & (F.col(n) < F.col("quotes_total"))
    marked = marked.select(*BLOCK, "at", "value", within("opened").alias("inside"), within("closed").alias("stays_open"))
    marked = marked.withColumn("starts", F.when(F.col("inside"), 0).otherwise(1).cast("long"))
    marked = marked.withColumn("records", F.col("starts") + breaks_in(F.col("value"), F.col("inside"), F.col("stays_open")))
    stored = materialize(marked, "sheet-lines")
    placed = stored.join(before(stored, "starts", "records"), list(BLOCK))
    placed = placed.withColumn("group", F.col("starts_before") + F.sum("starts").over(here))
    placed = placed.withColumn("row", F.col("records_before") + F.sum("records").over(here) - F.col("records") + 1)
    alone = placed.where(~F.col("inside") & ~F.col("stays_open")).select("file", "row", F.col("value").alias("text"))
    parts = placed.where(F.col("inside") | F.col("stays_open")).groupBy("file", "group").agg(
        F.min("row").alias("row"), F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("lines")
    )
    return alone.unionByName(parts.select("file", "row", F.array_join(F.col("lines.value"), "\n").alias("text")))
