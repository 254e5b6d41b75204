"""Queries for the bibliometric jobs, on JSON pages that Spark derives from the test tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.operators.quality import profile_nested
from tallyloom.plans import bibliometrics as plan
from tallyloom.session import spread
from tallyloom.sources import schemas
from tallyloom.sources.files import literal_rows, parse_json_lines


def _nested(fields):
    """A struct from (name, column) pairs."""
    return F.struct(*[column.alias(name) for name, column in fields])


def _parsed(lines, schema):
    return parse_json_lines(lines, schema).where(F.col("page").isNotNull()).select("page.*")


def affiliation_lines(spark, sf):
    """Pages of up to a hundred suppliers; every affiliation is named after a part."""
    supplier, part = table(spark, sf, "supplier"), table(spark, sf, "part")
    words = part.select("p_partkey", "p_name")
    named = supplier.join(words, F.col("s_suppkey") == F.col("p_partkey"))
    entry = _nested(
        [
            ("dc:identifier", F.concat(F.lit("AFFILIATION_ID:600"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0"))),
            ("eid", F.concat(F.lit("10-s2.0-"), "s_suppkey")),
            ("prism:url", F.concat(F.lit("https://example.org/"), "s_suppkey")),
            ("affiliation-name", F.regexp_replace(F.regexp_replace("p_name", "ring", "forest"), "red", "land")),
            ("document-count", F.col("s_nationkey").cast("string")),
        ]
    )
    listed = named.groupBy(F.floor(F.col("s_suppkey") / 100).alias("at")).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    page = _nested([("search-results", _nested([("entry", F.col("entries"))]))])
    return listed.select(F.to_json(page).alias("value"))


def publication_entry(of=F.col):
    """An entry of an order line with all its fields and two authors; ``of`` gives a column of the line."""
    line, part = of("l_linenumber"), of("l_partkey")
    labelled = lambda name, column: F.concat(F.lit(name), column.cast("string"))
    author_names = F.concat(F.lit("Name "), part)
    first = _nested(
        [
            ("authid", part.cast("string")),
            ("given-name", F.concat(F.lit("G"), part)),
            ("surname", F.concat(F.lit("S"), part)),
            ("authname", F.when(of("l_returnflag") == "R", author_names).when(of("l_returnflag") == "A", F.concat(author_names, F.lit(" Jr")))),
        ]
    )
    second = _nested(
        [
            ("authid", (of("l_suppkey") + 10000000).cast("string")),
            ("given-name", F.lit("Pat")),
            ("surname", F.concat(F.lit("Q"), of("l_suppkey"))),
            ("authname", F.concat(F.lit("Pat Q"), of("l_suppkey"))),
        ]
    )
    entry = _nested(
        [
            ("dc:identifier", F.concat(F.lit("SCOPUS_ID:"), of("l_orderkey"))),
            ("dc:title", F.concat(F.lit("Title "), line)),
            ("eid", F.concat(F.lit("2-s2.0-"), part)),
            ("subtype", of("l_returnflag")),
            ("subtypeDescription", of("l_linestatus")),
            ("prism:coverDate", F.date_format(of("l_shipdate"), "yyyy-MM-dd")),
            ("prism:coverDisplayDate", F.date_format(of("l_shipdate"), "MMMM yyyy")),
            ("citedby-count", of("l_quantity").cast("int").cast("string")),
            ("openaccessFlag", F.when(of("l_discount") > 0.05, True).when(of("l_discount") < 0.02, False)),
            ("prism:volume", of("l_suppkey").cast("string")),
            ("prism:aggregationType", F.lit("Journal")),
            ("dc:description", labelled("About ", of("l_orderkey"))),
            ("article-number", labelled("a", line)),
            ("prism:issn", labelled("issn", part % 10)),
            ("@_fa", F.lit("true")),
            ("prism:doi", labelled("10.1/", part)),
            ("authkeywords", labelled("k", line)),
            ("dc:creator", labelled("C", part)),
            ("prism:pageRange", labelled("1-", line)),
            ("prism:url", labelled("https://example.org/p/", part)),
            ("source-id", part.cast("string")),
            ("prism:publicationName", labelled("Journal ", line)),
            ("pii", labelled("S", part)),
            ("fund-no", labelled("F", of("l_orderkey"))),
            ("author", F.array(first, second)),
        ]
    )
    return entry


def _search_terms():
    return _nested([("@searchTerms", F.concat(F.lit("AF-ID(600"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0"), F.lit(")")))])


def publication_lines(spark, sf):
    """One page of one entry per order line; every seventh page is empty."""
    line, entry = F.col("l_linenumber"), publication_entry()
    entries = F.when(F.col("l_partkey") % 7 != 0, F.array(entry)).otherwise(F.slice(F.array(entry), 1, 0))
    page = _nested([("search-results", _nested([("opensearch:Query", _search_terms()), ("entry", entries)]))])
    return spread(table(spark, sf, "lineitem")).select(F.to_json(page).alias("value"), line.alias("line"))


#: The order line's columns that an entry is made of.
LINE_COLUMNS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_quantity", "l_discount",
)


def paged_publication_lines(spark, sf):
    """The same entries on pages of up to 25 for one supplier, without empty pages.

    Pages collect the columns of their order lines; entries, which are ten times as large, are made from them afterwards,
    so no sort or aggregate holds any. Rows are dealt over all shuffle partitions, since adaptive execution would
    join partitions by their size before that growth.
    """
    listed = spread(table(spark, sf, "lineitem").where("l_partkey % 7 <> 0").select(*LINE_COLUMNS), "l_suppkey")
    place = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey"))
    paged = listed.withColumn("at", F.floor((place - 1) / 25)).groupBy("l_suppkey", "at").agg(F.collect_list(F.struct(*LINE_COLUMNS)).alias("lines"))
    entries = F.transform("lines", lambda line: publication_entry(lambda name: line[name]))
    page = _nested([("search-results", _nested([("opensearch:Query", _search_terms()), ("entry", entries)]))])
    return paged.select(F.to_json(page).alias("value"))


def citation_lines(spark, sf):
    """One overview of four years per order; every third customer's is of two documents."""
    steps = F.sequence(F.lit(0), F.lit(3))
    years = F.transform(steps, lambda i: _nested([("$", (F.year("o_orderdate") + i).cast("string"))]))
    counts = F.transform(steps, lambda i: _nested([("$", ((F.col("o_custkey") + i) % 5).cast("string"))]))
    header = _nested([("columnHeading", years), ("columnTotal", counts)])
    named = lambda column: _nested([("scopus_id", column)])
    own, other = named(F.col("o_orderkey").cast("string")), named(F.concat(F.lit("x"), "o_orderkey"))
    ids = F.when(F.col("o_custkey") % 3 == 0, F.array(own, other)).otherwise(F.array(own))
    body = _nested(
        [
            ("identifier-legend", _nested([("identifier", ids)])),
            ("citeColumnTotalXML", _nested([("citeCountHeader", header)])),
        ]
    )
    return spread(table(spark, sf, "orders")).select(F.to_json(_nested([("abstract-citations-response", body)])).alias("value"))


def metric_lines(spark, sf):
    """One metrics document per order: two categories, one of them with two sources."""
    source = lambda name, total: _nested([("name", F.lit(name)), ("total", total)])
    key = F.col("o_custkey")
    cited = _nested(
        [
            ("name", F.lit("Citation Indexes")),
            ("total", key % 50),
            ("sources", F.array(source("Index A", key % 11), source("Index B", key % 7))),
        ]
    )
    policy = _nested([("name", F.lit("Policy Citations")), ("total", key % 3), ("sources", F.lit(None))])
    readers = _nested([("name", F.lit("Readers")), ("total", key % 90), ("sources", F.array(source("Shelf", key % 13)))])
    categories = F.array(
        _nested([("name", F.lit("citation")), ("count_types", F.array(cited, policy))]),
        _nested([("name", F.lit("capture")), ("count_types", F.array(readers))]),
    )
    document = _nested([("id_value", F.col("o_orderkey").cast("string")), ("count_categories", categories)])
    return spread(table(spark, sf, "orders")).select(F.to_json(document).alias("value"))


def affiliation_pages(spark, sf):
    return _parsed(affiliation_lines(spark, sf), schemas.AFFILIATION_PAGE)


def publication_pages(spark, sf):
    return _parsed(paged_publication_lines(spark, sf), schemas.PUBLICATION_PAGE)


def overviews(spark, sf):
    return _parsed(citation_lines(spark, sf), schemas.CITATION_OVERVIEW)


def metric_documents(spark, sf):
    return _parsed(metric_lines(spark, sf), schemas.METRIC_DOCUMENT)


AFFILIATION_SQL = """
    aff AS (SELECT CAST(60000000 + s_suppkey AS INTEGER) AS AFFILIATION_ID, '10-s2.0-' || s_suppkey AS ELECTRONIC_ID,
        'https://example.org/' || s_suppkey AS PRISM_URL,
        replace(replace(p_name, 'ring', 'forest'), 'red', 'land') AS AFFILIATION_NM, s_nationkey AS DOCUMENT_CNT
      FROM supplier JOIN part ON s_suppkey = p_partkey)
"""
ENTRY_SQL = """
    en AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS DOCUMENT_ID, '600' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS AFFILIATION_ID
      FROM lineitem WHERE l_partkey % 7 <> 0)
"""
AUTHOR_SQL = f"""
    {ENTRY_SQL}, au AS (
      SELECT CAST(l_partkey AS VARCHAR) AS AUTHOR_ID, 'G' || l_partkey AS FIRST_NM, 'S' || l_partkey AS LAST_NM,
        CASE l_returnflag WHEN 'R' THEN 'Name ' || l_partkey WHEN 'A' THEN 'Name ' || l_partkey || ' Jr' END AS FULLNAME, DOCUMENT_ID
      FROM en UNION ALL
      SELECT CAST(l_suppkey + 10000000 AS VARCHAR), 'Pat', 'Q' || l_suppkey, 'Pat Q' || l_suppkey, DOCUMENT_ID FROM en)
"""
# The remaining fields of an entry as SQL.
PUBLICATION_REST = {
    "dc:description": "'About ' || l_orderkey",
    "article-number": "'a' || l_linenumber",
    "prism:issn": "'issn' || (l_partkey % 10)",
    "@_fa": "'true'",
    "prism:doi": "'10.1/' || l_partkey",
    "authkeywords": "'k' || l_linenumber",
    "dc:creator": "'C' || l_partkey",
    "prism:pageRange": "'1-' || l_linenumber",
    "prism:url": "'https://example.org/p/' || l_partkey",
    "source-id": "CAST(l_partkey AS VARCHAR)",
    "prism:publicationName": "'Journal ' || l_linenumber",
    "pii": "'S' || l_partkey",
    "fund-no": "'F' || l_orderkey",
}


def _column_of(field):
    return next(column for column, source in schemas.PUBLICATION_FIELDS.items() if source == field)


CITATION_SQL = """
    ov AS (SELECT CAST(o_orderkey AS VARCHAR) AS DOCUMENT_ID, o_orderdate, o_custkey FROM orders
        UNION ALL SELECT 'x' || o_orderkey, o_orderdate, o_custkey FROM orders WHERE o_custkey % 3 = 0),
    ci AS (SELECT DOCUMENT_ID, CAST(year(o_orderdate) + i AS VARCHAR) AS YEAR_LBL,
        CAST((o_custkey + i) % 5 AS INTEGER) AS CITATION_CNT FROM ov, (SELECT unnest(range(4)) AS i))
"""
METRIC_SQL = """
    fl AS (SELECT CAST(o_orderkey AS VARCHAR) AS DOCUMENT_ID, c AS CATEGORY_LBL, s AS SUB_CATEGORY_LBL, o_custkey % m AS METRIC_CNT,
        src AS CITATION_SOURCE_LBL, o_custkey % sm AS CITATION_SOURCE_CNT
      FROM orders, (VALUES ('citation', 'Citation Indexes', 50, 'Index A', 11), ('citation', 'Citation Indexes', 50, 'Index B', 7),
        ('citation', 'Policy Citations', 3, NULL, NULL), ('capture', 'Readers', 90, 'Shelf', 13)) v(c, s, m, src, sm))
"""


@query(f"WITH {AFFILIATION_SQL} SELECT * FROM aff")
def affiliation_load(spark, sf):
    return plan.affiliations(affiliation_pages(spark, sf))


@query(f"WITH {AFFILIATION_SQL} SELECT AFFILIATION_ID, AFFILIATION_NM FROM aff WHERE CAST(AFFILIATION_ID AS VARCHAR) LIKE '6000001%'")
def affiliation_prefix(spark, sf):
    kept = plan.with_id_prefix(plan.affiliations(affiliation_pages(spark, sf)), "6000001")
    return kept.select("AFFILIATION_ID", "AFFILIATION_NM").orderBy("AFFILIATION_NM", "AFFILIATION_ID")


@query(
    f"""
    WITH {AFFILIATION_SQL}, a AS (
      SELECT AFFILIATION_ID, 1 AS SECTOR_ID FROM aff WHERE upper(AFFILIATION_NM) LIKE '%FOREST%'
      UNION ALL SELECT AFFILIATION_ID, 2 FROM aff WHERE upper(AFFILIATION_NM) LIKE '%LAND%'),
    b AS (SELECT * FROM a UNION ALL SELECT AFFILIATION_ID, 3 FROM aff WHERE AFFILIATION_ID NOT IN (SELECT AFFILIATION_ID FROM a))
    SELECT SECTOR_ID, SECTOR_LBL, count(*) AS AFFILIATION_CNT FROM b
    JOIN (VALUES (1,'CFS'),(2,'LMS'),(3,'TBD')) s(SECTOR_ID, SECTOR_LBL) USING (SECTOR_ID) GROUP BY 1, 2
    """
)
def affiliation_sector_summary(spark, sf):
    assigned = plan.affiliation_sectors(plan.affiliations(affiliation_pages(spark, sf)))
    return plan.sector_summary(assigned, plan.sector_table(spark))


@query(
    f"""
    WITH {AFFILIATION_SQL} SELECT AFFILIATION_ID, AFFILIATION_NM, CASE WHEN AFFILIATION_ID = 60000003 THEN 'DRF3' END AS INDICATOR_CD FROM aff
    """
)
def affiliation_indicators(spark, sf):
    """Affiliations with their indicator tag; the tag table is written out in code."""
    tags = literal_rows(spark, [(60000003, "DRF3")], schemas.AFFILIATION_INDICATOR)
    loaded = plan.affiliations(affiliation_pages(spark, sf)).select("AFFILIATION_ID", "AFFILIATION_NM")
    return loaded.join(tags, "AFFILIATION_ID", "left")


@query(
    f"""
    WITH {ENTRY_SQL}, fi AS (SELECT *, row_number() OVER (PARTITION BY DOCUMENT_ID ORDER BY strftime(l_shipdate, '%Y-%m-%d'),
        'Title ' || l_linenumber, '2-s2.0-' || l_partkey, l_returnflag, l_linestatus, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
        CASE WHEN l_discount > 0.05 THEN 1 WHEN l_discount < 0.02 THEN 0 END NULLS FIRST, CAST(l_suppkey AS VARCHAR)) AS rn FROM en)
    SELECT DOCUMENT_ID, 'Title ' || l_linenumber AS DOCUMENT_TITLE_LBL, '2-s2.0-' || l_partkey AS ELECTRONIC_ID, l_returnflag AS SUB_TYPE_ID,
      l_linestatus AS SUB_TYPE_LBL, strftime(l_shipdate, '%Y-%m-%d') AS COVER, CAST(NULL AS VARCHAR) AS DISPLAY, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS CITED_BY_CNT,
      CASE WHEN l_discount > 0.05 THEN 1 WHEN l_discount < 0.02 THEN 0 END AS OPEN_ACCESS_IND,
      CASE WHEN l_discount > 0.05 THEN 'Open Access' ELSE 'Not Open Access' END AS OPEN_ACCESS_IND_LBL,
      CAST(l_suppkey AS VARCHAR) AS PRISM_VOLUME_NBR, 'Journal' AS PRIMS_AGGREGATION_TYPE_LBL,
      {", ".join(f"{value} AS {_column_of(field)}" for field, value in PUBLICATION_REST.items())}
    FROM fi WHERE rn = 1
    """
)
def publication_load(spark, sf):
    """All 25 columns, from pages of many entries."""
    loaded = plan.publications(publication_pages(spark, sf))
    dates = {"PRISM_COVER_DT": "COVER", "PRISM_COVER_DISPLAY_DT": "DISPLAY"}
    return loaded.select([F.col(c).cast("string").alias(dates[c]) if c in dates else c for c in loaded.columns])


@query(f"WITH {ENTRY_SQL} SELECT DISTINCT DOCUMENT_ID, AFFILIATION_ID FROM en")
def affiliation_publication_load(spark, sf):
    return plan.affiliation_publications(publication_pages(spark, sf))


@query(
    f"""
    WITH {AUTHOR_SQL} SELECT AUTHOR_ID, FIRST_NM, LAST_NM, FULLNAME FROM (SELECT *, row_number() OVER (
      PARTITION BY AUTHOR_ID ORDER BY FULLNAME NULLS FIRST, FIRST_NM, LAST_NM) AS rn FROM au) WHERE rn = 1
    """
)
def author_load(spark, sf):
    return plan.authors(plan.author_entries(publication_pages(spark, sf)))


@query(f"WITH {AUTHOR_SQL} SELECT DISTINCT AUTHOR_ID, DOCUMENT_ID FROM au")
def author_publication_load(spark, sf):
    return plan.author_publications(plan.author_entries(publication_pages(spark, sf)))


@query(
    f"""
    WITH {AUTHOR_SQL} SELECT AUTHOR_ID, FIRST_NM, LAST_NM, FULLNAME FROM au WHERE AUTHOR_ID IN (
      SELECT AUTHOR_ID FROM (SELECT AUTHOR_ID, FULLNAME FROM au GROUP BY 1, 2) GROUP BY 1 HAVING count(*) > 1)
    """
)
def author_name_discrepancies(spark, sf):
    return plan.name_discrepancies(plan.author_entries(publication_pages(spark, sf)))


@query(f"WITH {CITATION_SQL} SELECT * FROM ci")
def citations_by_year(spark, sf):
    return plan.citations_by_year(overviews(spark, sf))


@query(f"WITH {CITATION_SQL} SELECT YEAR_LBL, CAST(sum(CITATION_CNT) AS BIGINT) AS CITATION_CNT FROM ci GROUP BY 1")
def citation_report_years(spark, sf):
    return plan.citations_per_year(plan.citations_by_year(overviews(spark, sf)))


@query(f"WITH {CITATION_SQL} SELECT DOCUMENT_ID, CAST(sum(CITATION_CNT) AS BIGINT) AS CITATION_CNT FROM ci GROUP BY 1")
def citation_report_documents(spark, sf):
    return plan.citations_per_document(plan.citations_by_year(overviews(spark, sf)))


@query(f"WITH {CITATION_SQL} SELECT DOCUMENT_ID, count(*) AS YEARS FROM ci WHERE CITATION_CNT > 0 GROUP BY 1")
def citation_report_cited_years(spark, sf):
    return plan.cited_years_per_document(plan.citations_by_year(overviews(spark, sf)))


@query(f"WITH {CITATION_SQL} SELECT DOCUMENT_ID, YEAR_LBL, CITATION_CNT FROM ci WHERE CITATION_CNT > 0")
def citation_report_cited_rows(spark, sf):
    return plan.cited_rows(plan.citations_by_year(overviews(spark, sf)))


@query(
    f"""
    WITH {CITATION_SQL} SELECT count(DISTINCT DOCUMENT_ID) AS DOCUMENTS,
      count(DISTINCT CASE WHEN CITATION_CNT <> 0 THEN DOCUMENT_ID END) AS CITED_DOCUMENTS FROM ci
    """
)
def citation_report_counts(spark, sf):
    return plan.document_counts(plan.citations_by_year(overviews(spark, sf)))


@query(f"WITH {METRIC_SQL} SELECT * FROM fl")
def impact_flat(spark, sf):
    return plan.impact_flat(metric_documents(spark, sf))


@query(f"WITH {METRIC_SQL} SELECT DOCUMENT_ID, CATEGORY_LBL, SUB_CATEGORY_LBL, max(METRIC_CNT) AS METRIC_CNT FROM fl GROUP BY 1, 2, 3")
def impact_metrics(spark, sf):
    return plan.impact_metrics(metric_documents(spark, sf))


@query(
    f"""
    WITH {METRIC_SQL} SELECT DISTINCT DOCUMENT_ID, CATEGORY_LBL, SUB_CATEGORY_LBL, CITATION_SOURCE_LBL, CITATION_SOURCE_CNT AS METRIC_CNT
    FROM fl WHERE CATEGORY_LBL = 'citation' AND CITATION_SOURCE_LBL IS NOT NULL
    """
)
def impact_sources(spark, sf):
    return plan.impact_sources(plan.impact_flat(metric_documents(spark, sf)))


@query(
    f"""
    WITH {METRIC_SQL} SELECT 'missing DOCUMENT_ID' AS measure, count(*) FILTER (WHERE DOCUMENT_ID IS NULL) AS value FROM fl
    UNION ALL SELECT 'missing CATEGORY_LBL', count(*) FILTER (WHERE CATEGORY_LBL IS NULL) FROM fl
    UNION ALL SELECT 'missing CITATION_SOURCE_LBL', count(*) FILTER (WHERE CITATION_SOURCE_LBL IS NULL) FROM fl
    UNION ALL SELECT 'distinct CATEGORY_LBL', count(DISTINCT CATEGORY_LBL) FROM fl
    UNION ALL SELECT 'distinct CITATION_SOURCE_LBL', count(DISTINCT CITATION_SOURCE_LBL) FROM fl
    UNION ALL SELECT 'documents with rows', count(*) FILTER (WHERE CAST(o_orderkey AS VARCHAR) IN (SELECT DOCUMENT_ID FROM fl)) FROM orders
    UNION ALL SELECT 'documents without rows', count(*) FILTER (WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT DOCUMENT_ID FROM fl)) FROM orders
    """
)
def impact_profile(spark, sf):
    documents = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("DOCUMENT_ID"))
    flat = plan.impact_flat(metric_documents(spark, sf))
    return profile_nested(flat, documents, "DOCUMENT_ID", ["CATEGORY_LBL", "CITATION_SOURCE_LBL"])
