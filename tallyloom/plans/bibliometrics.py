"""Bibliometric jobs: landed JSON pages to checked, published tables and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.cells import day_or_null, open_access_label
from tallyloom.functions.text import after_colon, in_parentheses, suffix_from
from tallyloom.operators import relational
from tallyloom.operators.quality import has_size, is_complete, is_unique, refers_to, run_checks
from tallyloom.operators.reshape import explode_items, explode_parallel
from tallyloom.session import scratch_path, shuffles_removed
from tallyloom.sinks.tables import append, conform, publish, read_runs, refresh, refresh_run
from tallyloom.sources import schemas
from tallyloom.sources.files import literal_rows, parse_json_lines, read_csv, read_text_lines

# Fixed values: (sector, text in the name), the fallback sector, and the sector table.
SECTOR_RULES = [(1, "FOREST"), (2, "LAND")]
SECTOR_FALLBACK = 3
SECTORS = [(1, "CFS", ""), (2, "LMS", ""), (3, "TBD", "")]
INDICATORS = [(60031860, "DRF3")]
CITATION_CATEGORY = "citation"

# Fixed value: the one table whose published name differs.
PUBLISHED_NAMES = {"CITATION_COUNT_BY_YEAR": "CITATIONS_BY_YEAR"}


def entries(pages: DataFrame, fields: Sequence[str] = ()) -> DataFrame:
    """One row per entry of a search page; pages with an empty entry list give none.

    With ``fields`` an ``item`` holds those alone, and a Parquet scan reads only them: pruning sees
    through the zipped field arrays, but not through a generator of whole entries.
    """
    entry = F.col("`search-results`.entry")
    if fields:
        entry = F.arrays_zip(*[F.col(f"`search-results`.entry.`{field}`") for field in fields])
    return explode_items(pages, entry, "item")


def affiliations(pages: DataFrame) -> DataFrame:
    """AFFILIATION rows from affiliation pages."""
    item = entries(pages).select("item.*")
    rows = item.select(
        suffix_from(F.col("`dc:identifier`"), 16).try_cast("int").alias("AFFILIATION_ID"),
        F.col("eid").alias("ELECTRONIC_ID"),
        F.col("`prism:url`").alias("PRISM_URL"),
        F.col("`affiliation-name`").alias("AFFILIATION_NM"),
        F.col("`document-count`").try_cast("int").alias("DOCUMENT_CNT"),
    )
    return conform(rows, schemas.AFFILIATION)


def with_id_prefix(affiliation: DataFrame, prefix: str = "600") -> DataFrame:
    """Affiliations whose id starts with ``prefix``."""
    return affiliation.where(F.col("AFFILIATION_ID").cast("string").startswith(prefix))


def publication_entries(pages: DataFrame, fields: Sequence[str] = ()) -> DataFrame:
    """One row per listed publication: affiliation searched for, document id and the entry's fields."""
    terms = F.col("`search-results`.`opensearch:Query`.`@searchTerms`")
    return entries(pages, fields).select(
        in_parentheses(terms).alias("AFFILIATION_ID"),
        after_colon(F.col("item.`dc:identifier`")).alias("DOCUMENT_ID"),
        "item",
    )


def _publication_column(name: str, source: str):
    value = F.col(f"item.`{source}`")
    if name in ("PRISM_COVER_DT", "PRISM_COVER_DISPLAY_DT"):
        value = day_or_null(value)
    elif name == "OPEN_ACCESS_IND":
        value = value.cast("int")
    elif name == "OPEN_ACCESS_IND_LBL":
        value = open_access_label(value)
    return value.alias(name)


def publications(pages: DataFrame) -> DataFrame:
    """PUBLICATION: one row per document, the first by cover date and then by all columns."""
    fields = ["dc:identifier", *dict.fromkeys(schemas.PUBLICATION_FIELDS.values())]
    rows = publication_entries(pages, fields).select(
        "DOCUMENT_ID", *[_publication_column(c, s) for c, s in schemas.PUBLICATION_FIELDS.items()]
    )
    return conform(relational.keep_first(rows, ["DOCUMENT_ID"], ["PRISM_COVER_DT"]), schemas.PUBLICATION)


def affiliation_publications(pages: DataFrame) -> DataFrame:
    """Distinct document and affiliation pairs. Reads two fields of each page only."""
    pairs = publication_entries(pages).select("DOCUMENT_ID", "AFFILIATION_ID").distinct()
    return conform(pairs, schemas.AFFILIATION_PUBLICATION)


def author_entries(pages: DataFrame) -> DataFrame:
    """One row per author of each listed publication, duplicates included."""
    listed = entries(pages, ["dc:identifier", "author"]).select(
        suffix_from(F.col("item.`dc:identifier`"), 11).alias("DOCUMENT_ID"), F.explode("item.author").alias("author")
    )
    return listed.select(
        F.col("author.authid").alias("AUTHOR_ID"),
        F.col("author.`given-name`").alias("FIRST_NM"),
        F.col("author.surname").alias("LAST_NM"),
        F.col("author.authname").alias("FULLNAME"),
        "DOCUMENT_ID",
    )


def authors(staged: DataFrame) -> DataFrame:
    """AUTHOR: one row per author id, the first by name."""
    rows = staged.select("AUTHOR_ID", "FIRST_NM", "LAST_NM", "FULLNAME")
    return conform(relational.keep_first(rows, ["AUTHOR_ID"], ["FULLNAME"]), schemas.AUTHOR)


def author_publications(staged: DataFrame) -> DataFrame:
    return conform(staged.select("AUTHOR_ID", "DOCUMENT_ID").distinct(), schemas.AUTHOR_PUBLICATION)


def name_discrepancies(staged: DataFrame) -> DataFrame:
    """Author entries whose id comes with more than one full name, a missing one included."""
    return relational.variants(staged.select("AUTHOR_ID", "FIRST_NM", "LAST_NM", "FULLNAME"), "AUTHOR_ID", "FULLNAME")


def citations_by_year(overviews: DataFrame) -> DataFrame:
    """CITATION_COUNT_BY_YEAR: years and counts of a document matched by position."""
    body = F.col("`abstract-citations-response`")
    totals = body["citeColumnTotalXML"]["citeCountHeader"]
    per_id = overviews.select(
        F.explode(body["identifier-legend"]["identifier"]["scopus_id"]).alias("DOCUMENT_ID"),
        totals["columnHeading"]["$"].alias("years"),
        totals["columnTotal"]["$"].alias("counts"),
    )
    rows = explode_parallel(
        per_id, [F.col("DOCUMENT_ID")], {"YEAR_LBL": F.col("years"), "CITATION_CNT": F.col("counts")}
    ).withColumn("CITATION_CNT", F.col("CITATION_CNT").try_cast("int"))
    return conform(rows, schemas.CITATION_COUNT_BY_YEAR)


def impact_counts(documents: DataFrame) -> DataFrame:
    """One row per document, category and subcategory entry, its sources still nested."""
    by_category = documents.select(F.col("id_value").alias("DOCUMENT_ID"), F.explode("count_categories").alias("c"))
    by_type = by_category.select("DOCUMENT_ID", F.col("c.name").alias("CATEGORY_LBL"), F.explode("c.count_types").alias("t"))
    return by_type.select(
        "DOCUMENT_ID",
        "CATEGORY_LBL",
        F.col("t.name").alias("SUB_CATEGORY_LBL"),
        F.col("t.total").alias("METRIC_CNT"),
        F.col("t.sources").alias("sources"),
    )


def impact_flat(documents: DataFrame) -> DataFrame:
    """Fully flattened metrics; a subcategory without sources keeps one row with no source."""
    rows = explode_items(impact_counts(documents), F.col("sources"), "source", keep_empty=True)
    flat = rows.withColumns(
        {"CITATION_SOURCE_LBL": F.col("source.name"), "CITATION_SOURCE_CNT": F.col("source.total")}
    )
    return conform(flat, schemas.IMPACT_FLAT)


def impact_metrics(documents: DataFrame) -> DataFrame:
    """Largest count per document, category and subcategory, taken before sources multiply rows."""
    keys = ["DOCUMENT_ID", "CATEGORY_LBL", "SUB_CATEGORY_LBL"]
    counts = impact_counts(documents).groupBy(*keys).agg(F.max("METRIC_CNT").alias("METRIC_CNT"))
    return conform(counts, schemas.IMPACT_METRIC)


def impact_sources(flat: DataFrame) -> DataFrame:
    """Distinct named sources of the citation category."""
    named = flat.where((F.col("CATEGORY_LBL") == CITATION_CATEGORY) & F.col("CITATION_SOURCE_LBL").isNotNull())
    rows = named.select(
        "DOCUMENT_ID",
        "CATEGORY_LBL",
        "SUB_CATEGORY_LBL",
        "CITATION_SOURCE_LBL",
        F.col("CITATION_SOURCE_CNT").alias("METRIC_CNT"),
    ).distinct()
    return conform(rows, schemas.IMPACT_CITATION_SOURCE)


def affiliation_sectors(affiliation: DataFrame) -> DataFrame:
    """Sectors of each affiliation by words in its name; several may apply."""
    rows = relational.classify(affiliation, "AFFILIATION_NM", SECTOR_RULES, SECTOR_FALLBACK, "SECTOR_ID")
    return conform(rows, schemas.AFFILIATION_SECTOR)


def sector_table(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, SECTORS, schemas.SECTOR)


def indicator_table(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, INDICATORS, schemas.AFFILIATION_INDICATOR)


def acknowledgements(spark: SparkSession, path: str) -> DataFrame:
    """ACKNOWLEDGEMENTS_BY_YEAR from a CSV whose two columns are taken by position."""
    return read_csv(spark, path, schemas.ACKNOWLEDGEMENTS_BY_YEAR, by_position=True)


def load_reference(spark: SparkSession, affiliation: DataFrame, acknowledgements_csv: str, target: str) -> dict[str, DataFrame]:
    """Sector, indicator and acknowledgement tables, stored by full refresh below ``target``."""
    plans = {
        "AFFILIATION_SECTOR": affiliation_sectors(affiliation),
        "SECTOR": sector_table(spark),
        "AFFILIATION_INDICATOR": indicator_table(spark),
        "ACKNOWLEDGEMENTS_BY_YEAR": acknowledgements(spark, acknowledgements_csv),
    }
    return {name: refresh(df, f"{target}/{name}") for name, df in plans.items()}


def sector_summary(assigned: DataFrame, sectors: DataFrame) -> DataFrame:
    """Affiliations per sector. Counting first leaves one row per sector for the join."""
    counts = assigned.groupBy("SECTOR_ID").agg(F.count(F.lit(1)).alias("AFFILIATION_CNT"))
    return counts.join(sectors, "SECTOR_ID").groupBy("SECTOR_ID", "SECTOR_LBL").agg(
        F.sum("AFFILIATION_CNT").alias("AFFILIATION_CNT")
    )


# ---- reports on published citations ----


def citations_per_year(citations: DataFrame) -> DataFrame:
    return citations.groupBy("YEAR_LBL").agg(F.sum("CITATION_CNT").alias("CITATION_CNT")).orderBy("YEAR_LBL")


def citations_per_document(citations: DataFrame) -> DataFrame:
    totals = citations.groupBy("DOCUMENT_ID").agg(F.sum("CITATION_CNT").alias("CITATION_CNT"))
    return totals.orderBy(F.desc("CITATION_CNT"), "DOCUMENT_ID")


def cited_years_per_document(citations: DataFrame) -> DataFrame:
    """Number of years with citations, for documents that have any."""
    years = citations.where("CITATION_CNT > 0").groupBy("DOCUMENT_ID").agg(F.count(F.lit(1)).alias("YEARS"))
    return years.orderBy(F.desc("YEARS"), "DOCUMENT_ID")


def cited_rows(citations: DataFrame) -> DataFrame:
    return citations.where("CITATION_CNT > 0").orderBy(F.desc("CITATION_CNT"), "DOCUMENT_ID", "YEAR_LBL")


def document_counts(citations: DataFrame) -> DataFrame:
    """Distinct documents, and those with a citation count other than zero."""
    documents = citations.where("DOCUMENT_ID IS NOT NULL").groupBy("DOCUMENT_ID").agg(F.max(F.col("CITATION_CNT") != 0).alias("cited"))
    return documents.agg(F.count(F.lit(1)).alias("DOCUMENTS"), F.count_if("cited").alias("CITED_DOCUMENTS"))


# ---- checks ----


def table_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All declared checks of the eight published tables, one row each."""
    return reduce(DataFrame.union, check_plans(tables))


def check_plans(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The same checks as one plan for each table."""
    publication = tables["PUBLICATION"]

    def document(parent: str = "PUBLICATION"):
        return refers_to({"DOCUMENT_ID": "DOCUMENT_ID"}, publication, parent)

    declared = {
        "AFFILIATION": [has_size(), is_complete("AFFILIATION_ID"), is_complete("ELECTRONIC_ID"), is_unique("AFFILIATION_ID")],
        "PUBLICATION": [has_size(), is_complete("DOCUMENT_ID"), is_unique("DOCUMENT_ID")],
        "AFFILIATION_PUBLICATION": [
            has_size(),
            is_complete("DOCUMENT_ID"),
            document(),
            is_complete("AFFILIATION_ID"),
            refers_to({"AFFILIATION_ID": "AFFILIATION_ID"}, _text_ids(tables["AFFILIATION"]), "AFFILIATION"),
        ],
        "AUTHOR": [has_size(), is_complete("AUTHOR_ID"), is_unique("AUTHOR_ID")],
        "AUTHOR_PUBLICATION": [
            has_size(),
            is_complete("DOCUMENT_ID"),
            document(),
            is_complete("AUTHOR_ID"),
            refers_to({"AUTHOR_ID": "AUTHOR_ID"}, tables["AUTHOR"], "AUTHOR"),
        ],
        "CITATION_COUNT_BY_YEAR": [has_size(), is_complete("DOCUMENT_ID"), document(), is_unique("DOCUMENT_ID", "YEAR_LBL")],
        "IMPACT_METRIC": [has_size(), is_complete("DOCUMENT_ID"), document(), is_unique("DOCUMENT_ID", "SUB_CATEGORY_LBL")],
        "IMPACT_CITATION_SOURCE": [
            has_size(),
            is_complete("DOCUMENT_ID"),
            document(),
            is_unique("DOCUMENT_ID", "CITATION_SOURCE_LBL"),
        ],
    }
    return [run_checks(name, tables[name], checks) for name, checks in declared.items() if name in tables]


def _text_ids(affiliation: DataFrame) -> DataFrame:
    return affiliation.select(F.col("AFFILIATION_ID").cast("string").alias("AFFILIATION_ID"))


def silver_tables(
    affiliation_pages: DataFrame, publication_pages: DataFrame, overviews: DataFrame, metric_documents: DataFrame
) -> dict[str, DataFrame]:
    """The eight tables as plans. Write them (``refresh``) before checking and publishing."""
    staged = author_entries(publication_pages)
    return {
        "AFFILIATION": affiliations(affiliation_pages),
        "PUBLICATION": publications(publication_pages),
        "AFFILIATION_PUBLICATION": affiliation_publications(publication_pages),
        "AUTHOR": authors(staged),
        "AUTHOR_PUBLICATION": author_publications(staged),
        "CITATION_COUNT_BY_YEAR": citations_by_year(overviews),
        "IMPACT_METRIC": impact_metrics(metric_documents),
        "IMPACT_CITATION_SOURCE": impact_sources(impact_flat(metric_documents)),
    }


# Landed kinds of pages and their declared schemas.
PAGE_SCHEMAS = {
    "affiliations": schemas.AFFILIATION_PAGE,
    "publications": schemas.PUBLICATION_PAGE,
    "citations": schemas.CITATION_OVERVIEW,
    "metrics": schemas.METRIC_DOCUMENT,
}


def bronze_pages(spark: SparkSession, landing: str, lake: str, run_date: str, kind: str) -> DataFrame:
    """Parse one landed kind of a run once and store it as Parquet under its run date.

    Later plans read only the nested fields they need from there. A line that is no document keeps
    its text and has no page. Storing a run again replaces that run alone.
    """
    lines = read_text_lines(spark, f"{landing}/{kind}/run_date={run_date}")
    parsed = parse_json_lines(lines, PAGE_SCHEMAS[kind]).where((F.length(F.trim("value")) > 0))
    kept = parsed.select(
        "page",
        "filename",
        F.when(F.col("page").isNull(), F.col("value")).alias("malformed"),
        F.lit(run_date).alias("run_date"),
    )
    refresh_run(kept, f"{lake}/bronze/{kind}", [run_date])
    return read_runs(spark, f"{lake}/bronze/{kind}", kept.schema, [run_date])


def load_run(spark: SparkSession, landing: str, lake: str, run_date: str, gate: bool = True) -> DataFrame:
    """One dated run from landed pages to published tables; returns the check results.

    Every stage is a stored table: ``bronze/<kind>``, ``silver/<table>``, ``gold/<table>``. With
    ``gate`` nothing is published when a check fails. The checks of each table are a job of their own, so that
    the disk holds the shuffles of one at a time.
    """
    with shuffles_removed(spark):
        return _load_run(spark, landing, lake, run_date, gate)


def _load_run(spark: SparkSession, landing: str, lake: str, run_date: str, gate: bool) -> DataFrame:
    bronze = {kind: bronze_pages(spark, landing, lake, run_date, kind) for kind in PAGE_SCHEMAS}
    pages = {kind: df.where(F.col("page").isNotNull()).select("page.*") for kind, df in bronze.items()}
    plans = silver_tables(pages["affiliations"], pages["publications"], pages["citations"], pages["metrics"])
    silver = {name: refresh(df, f"{lake}/silver/{name}") for name, df in plans.items()}
    results = check_plans(silver) + [run_checks(kind, df, [has_size(), is_complete("page")]) for kind, df in bronze.items()]
    path = scratch_path(spark, "checks")
    for checks in results:
        append(checks, path)
    stored = spark.read.schema(results[0].schema).parquet(path)
    publish(spark, silver, f"{lake}/gold", stored, gate, PUBLISHED_NAMES)
    return stored
