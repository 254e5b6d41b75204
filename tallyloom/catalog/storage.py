"""Queries that write derived tables to the shared folder and read them back."""

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.catalog import audit, bibliometrics, jobs
from tallyloom.catalog.registry import query, table
from tallyloom.operators.quality import has_size, is_complete, is_unique, run_checks
from tallyloom.plans import bibliometrics as plan
from tallyloom.functions.cells import column_number
from tallyloom.plans import labour, samples, spend_audit, tracker
from tallyloom.session import materialize, scratch_path
from tallyloom.sinks import landing, snapshots, tables
from tallyloom.sources import files, schemas
from tallyloom.sources.schemas import LONG, TEXT, record

_ENTRY_COUNTS = f"WITH {bibliometrics.ENTRY_SQL} SELECT l_returnflag AS subtype, count(*) AS n FROM en GROUP BY 1"


def _entry_counts(pages):
    entries = pages.select(F.explode("`search-results`.entry").alias("item"))
    return entries.groupBy(F.col("item.subtype").alias("subtype")).agg(F.count(F.lit(1)).alias("n"))


@query(_ENTRY_COUNTS)
def json_directory(spark, sf):
    path = scratch_path(spark, "pages")
    landing.write_lines(bibliometrics.publication_lines(spark, sf), path)
    return _entry_counts(files.read_json(spark, path, schemas.PUBLICATION_PAGE))


@query(
    f"""
    WITH {bibliometrics.ENTRY_SQL} SELECT count(*) AS lines, count(*) FILTER (WHERE l_linenumber = 7) AS malformed,
      (SELECT count(*) FROM en WHERE l_linenumber <> 7) AS entries, true AS named FROM lineitem
    """
)
def text_lines(spark, sf):
    """Pages as text lines with their file; the pages of line 7 are cut off in the middle."""
    path = scratch_path(spark, "lines")
    lines = bibliometrics.publication_lines(spark, sf)
    cut = F.when(F.col("line") == 7, F.substring("value", 1, 30)).otherwise(F.col("value"))
    landing.write_lines(lines.select(cut.alias("value")), path)
    parsed = files.parse_json_lines(files.read_text_lines(spark, path), schemas.PUBLICATION_PAGE)
    entries = F.coalesce(F.size("page.`search-results`.entry"), F.lit(0))
    return parsed.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("page").isNull()).alias("malformed"),
        F.sum(F.when(entries > 0, entries).otherwise(0)).alias("entries"),
        F.every(F.col("filename").contains("/lines-")).alias("named"),
    )


@query(
    """
    WITH s AS (SELECT *, row_number() OVER (PARTITION BY s_suppkey // 100 ORDER BY s_suppkey) - 1 AS place FROM supplier)
    SELECT s_suppkey, CAST(5 + 3 * place AS INTEGER) AS "row", s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation FROM s
    UNION ALL SELECT s_suppkey, 7 + 3 * place, 'again, "' || s_name || '"', NULL FROM s
    """
)
def positional_read(spark, sf):
    """Sheet files of a hundred suppliers: four heading lines, then three rows each, of which one is empty."""
    base = scratch_path(spark, "sheets")
    first = F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string"))
    again = F.concat(F.col("s_suppkey").cast("string"), F.lit(',"again, ""'), "s_name", F.lit('""",'))
    rows = table(spark, sf, "supplier").select("s_suppkey", F.concat_ws("\n", first, F.lit(",,"), again).alias("value"))
    grouped = rows.groupBy(F.floor(F.col("s_suppkey") / 100).alias("sheet"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("s_suppkey", "value"))), lambda row: row["value"])
    sheets = grouped.agg(F.concat(F.lit("a\n\nb\nc\n"), F.array_join(ordered, "\n")).alias("value"))
    sheets.write.partitionBy("sheet").text(base)
    block = files.read_block(spark, f"{base}/*", ["s_suppkey", "name", "nation"], first_row=5)
    return block.select(F.col("s_suppkey").cast("bigint").alias("s_suppkey"), "row", "name", "nation")


@query(
    """
    SELECT doc_id, CAST(3 + row_number() OVER (ORDER BY doc_id) AS BIGINT) AS place, nullif(text, '') AS body, nullif(source, '') AS source
    FROM documents
    """
)
def sheet_in_parts(spark, sf):
    """Documents as cells of sheets, with their line breaks and quotes, each sheet read by several tasks.

    A sheet holds a range of documents; the place counts rows over all sheets.
    """
    base = scratch_path(spark, "large-sheets")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), quoted(F.col("text")), quoted(F.col("source")))
    rows = table(spark, sf, "documents").select("doc_id", line.alias("value"))
    rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(base)
    block = files.read_block(spark, base, ["doc_id", "body", "source"], in_parts=True)
    sheets = block.groupBy("file").agg(F.min(F.col("doc_id").cast("long")).alias("low"), F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sheets.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = block.join(offsets, "file")
    return placed.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("offset") + F.col("row") + 3).alias("place"), "body", "source")


@query(jobs.EMPLOYMENT_SQL)
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "labour")
    jobs.labour_rows(spark, sf).write.option("header", True).csv(path)
    return jobs.employment(files.read_csv(spark, path, schemas.LABOUR_FORCE))


@query(f"WITH {jobs.SAMPLE_SQL} SELECT * FROM res")
def sheet_directories(spark, sf):
    """Sample workbooks written as directories, two per sheet name, and read as one table."""
    base, headers = scratch_path(spark, "workbooks"), {}
    for name in jobs.SHEETS:
        sheet = jobs.sample_sheet(spark, sf, name)
        headers[name] = schemas.texts(sheet.columns)
        zone_low = F.col("Zone") < "2"
        sheet.where(zone_low).write.option("header", True).csv(f"{base}/book1/{name}")
        sheet.where(~zone_low).write.option("header", True).csv(f"{base}/book2/{name}")
    return jobs._typed(samples.sample_results(files.read_sheets(spark, base, headers)))


ACCOUNTS = record(key=LONG, name=TEXT)


def _accounts(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    supplier = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    return {"CUSTOMER": customer, "SUPPLIER": supplier}


@query(
    """
    SELECT 'CUSTOMERS' AS kind, c_custkey AS key, c_name AS name FROM customer
    UNION ALL SELECT 'SUPPLIER', s_suppkey, s_name FROM supplier
    """
)
def publish_roundtrip(spark, sf):
    """Silver tables under a declared schema, checked, then published behind the gate."""
    base = scratch_path(spark, "lake")
    silver = {name: tables.refresh(df, f"{base}/silver/{name}", ACCOUNTS) for name, df in _accounts(spark, sf).items()}
    checks = [has_size(), is_complete("key"), is_unique("key")]
    results = run_checks("CUSTOMER", silver["CUSTOMER"], checks).unionByName(
        run_checks("SUPPLIER", silver["SUPPLIER"], checks)
    )
    gold = tables.publish(spark, silver, f"{base}/gold", results, renames={"CUSTOMER": "CUSTOMERS"})
    parts = [spark.read.schema(ACCOUNTS).parquet(path).withColumn("kind", F.lit(name)) for name, path in gold.items()]
    return parts[0].unionByName(parts[1]).select("kind", "key", "name")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def compaction(spark, sf):
    path = scratch_path(spark, "small")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    tables.refresh(customer.repartition(16), path)
    tables.compact(spark, path, customer.schema)
    return tables.read_current(spark, path, customer.schema)


def _orders_by_year(spark, sf):
    year = F.year("o_orderdate").cast("string").alias("run_date")
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), year)


def _years(orders):
    return [r.run_date for r in orders.select("run_date").distinct().orderBy("run_date").collect()]


@query(
    """
    SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN o_orderstatus ELSE 'old' END AS status,
           CAST(year(o_orderdate) AS VARCHAR) AS run_date FROM orders
    """
)
def dated_rerun(spark, sf):
    """All years land once; one year lands again and replaces only itself."""
    path, orders = scratch_path(spark, "runs"), _orders_by_year(spark, sf)
    tables.refresh_run(orders.withColumn("status", F.lit("old")), path, _years(orders))
    return tables.refresh_run(files.run_rows(orders, "1997"), path, ["1997"])


@query(
    """
    SELECT o_orderkey, o_orderstatus AS status, CAST(year(o_orderdate) AS VARCHAR) AS run_date FROM orders
    WHERE year(o_orderdate) <> 1996 AND (year(o_orderdate) <> 1995 OR o_orderstatus = 'F')
    """
)
def dated_empty_rerun(spark, sf):
    """All years land once; one lands again without any row, another with fewer rows."""
    path, orders = scratch_path(spark, "runs"), _orders_by_year(spark, sf)
    tables.refresh_run(orders, path, _years(orders))
    again = files.run_rows(orders, "1995").where("status = 'F'")
    return tables.refresh_run(again, path, ["1995", "1996"])


@query(
    """
    SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1994 THEN 'new' ELSE o_orderstatus END AS status,
           CAST(year(o_orderdate) AS VARCHAR) AS run_date FROM orders
    """
)
def dated_compaction(spark, sf):
    """A dated table of many small files is compacted, then one run lands again; no row is lost."""
    path, orders = scratch_path(spark, "runs"), _orders_by_year(spark, sf)
    tables.refresh_run(orders.repartition(12), path, _years(orders))
    tables.compact(spark, path, orders.schema)
    return tables.refresh_run(files.run_rows(orders, "1994").withColumn("status", F.lit("new")), path, ["1994"])


@query(
    """
    SELECT 'before' AS moment, o_orderkey, o_orderstatus FROM orders
    UNION ALL SELECT 'after', o_orderkey, 'Full Time' FROM orders
    """
)
def snapshot_as_of(spark, sf):
    path = scratch_path(spark, "snapshots")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    first, second = dt.datetime(2021, 2, 22, 22, 0), dt.datetime(2021, 2, 23, 22, 0)
    snapshots.commit(orders, path, "CREATE", first)
    snapshots.update(spark, path, {"o_orderstatus": F.lit("Full Time")}, second)
    before = snapshots.read_as_of(spark, path, dt.datetime(2021, 2, 22, 22, 32, 33))
    after = snapshots.read_version(spark, path)
    return before.select(F.lit("before").alias("moment"), "*").unionByName(after.select(F.lit("after").alias("moment"), "*"))


@query(
    """
    SELECT CAST(0 AS BIGINT) AS version, 'CREATE' AS operation, count(*) AS n_rows FROM orders
    UNION ALL SELECT 1, 'UPDATE', count(*) FROM orders
    """
)
def snapshot_history(spark, sf):
    path = scratch_path(spark, "snapshots")
    snapshots.commit(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path, "CREATE")
    snapshots.update(spark, path, {"o_orderstatus": F.lit("Full Time")})
    return snapshots.history(spark, path).select("version", "operation", "n_rows")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT s_suppkey, 'new' FROM supplier")
def table_as_select(spark, sf):
    """Create a table from a query, append to it, scan it by name."""
    name = f"tallyloom_{uuid.uuid4().hex}"
    customer = table(spark, sf, "customer").select("c_custkey", "c_mktsegment").where("c_mktsegment = 'BUILDING'")
    path = scratch_path(spark, "ctas")
    tables.create_table_as(customer, name, path)
    tables.create_table_as(customer, name, path)
    more = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.lit("new").alias("c_mktsegment"))
    tables.append(more, path)
    spark.catalog.refreshTable(name)
    stored = materialize(files.read_table(spark, name), "table-scan")
    spark.sql(f"DROP TABLE {name}")
    return stored


def _checks_sql():
    """Expected rows of the bibliometric checks."""

    def row(name, constraint, source, bad):
        return (
            f"SELECT '{name}' AS \"table\", '{constraint}' AS \"constraint\", count(*) AS n_rows, {bad} AS n_bad FROM {source}"
        )

    def missing(column, parent):
        return f"count(*) FILTER (WHERE {column} NOT IN (SELECT {column} FROM {parent}))"

    size, none = "CAST(count(*) = 0 AS BIGINT)", "CAST(0 AS BIGINT)"
    author_bridge = "(SELECT DISTINCT AUTHOR_ID, DOCUMENT_ID FROM au)"
    affiliation_bridge = "(SELECT DISTINCT DOCUMENT_ID, AFFILIATION_ID FROM en)"
    publication, author = "(SELECT DISTINCT DOCUMENT_ID FROM en)", "(SELECT DISTINCT AUTHOR_ID FROM au)"
    metric = "(SELECT DISTINCT DOCUMENT_ID, CATEGORY_LBL, SUB_CATEGORY_LBL FROM fl)"
    source = "(SELECT DISTINCT DOCUMENT_ID, CITATION_SOURCE_LBL FROM fl WHERE CATEGORY_LBL = 'citation' AND CITATION_SOURCE_LBL IS NOT NULL)"
    document = "Reference(DOCUMENT_ID -> PUBLICATION)"
    rows = []
    for name, table_sql, checks in [
        ("AFFILIATION", "aff", [("Completeness(AFFILIATION_ID)", none), ("Completeness(ELECTRONIC_ID)", none), ("Uniqueness(AFFILIATION_ID)", none)]),
        ("PUBLICATION", publication, [("Completeness(DOCUMENT_ID)", none), ("Uniqueness(DOCUMENT_ID)", none)]),
        (
            "AFFILIATION_PUBLICATION",
            affiliation_bridge,
            [
                ("Completeness(DOCUMENT_ID)", none),
                (document, none),
                ("Completeness(AFFILIATION_ID)", none),
                (
                    "Reference(AFFILIATION_ID -> AFFILIATION)",
                    "count(*) FILTER (WHERE CAST(AFFILIATION_ID AS BIGINT) NOT IN (SELECT AFFILIATION_ID FROM aff))",
                ),
            ],
        ),
        ("AUTHOR", author, [("Completeness(AUTHOR_ID)", none), ("Uniqueness(AUTHOR_ID)", none)]),
        (
            "AUTHOR_PUBLICATION",
            author_bridge,
            [
                ("Completeness(DOCUMENT_ID)", none),
                (document, none),
                ("Completeness(AUTHOR_ID)", none),
                ("Reference(AUTHOR_ID -> AUTHOR)", none),
            ],
        ),
        (
            "CITATION_COUNT_BY_YEAR",
            "ci",
            [("Completeness(DOCUMENT_ID)", none), (document, missing("DOCUMENT_ID", "en")), ("Uniqueness(DOCUMENT_ID,YEAR_LBL)", none)],
        ),
        (
            "IMPACT_METRIC",
            metric,
            [("Completeness(DOCUMENT_ID)", none), (document, missing("DOCUMENT_ID", "en")), ("Uniqueness(DOCUMENT_ID,SUB_CATEGORY_LBL)", none)],
        ),
        (
            "IMPACT_CITATION_SOURCE",
            source,
            [("Completeness(DOCUMENT_ID)", none), (document, missing("DOCUMENT_ID", "en")), ("Uniqueness(DOCUMENT_ID,CITATION_SOURCE_LBL)", none)],
        ),
        ("affiliations", "(SELECT DISTINCT (AFFILIATION_ID - 60000000) // 100 FROM aff)", [("Completeness(page)", none)]),
        ("publications", "(SELECT unnest(range(CAST(ceil(count(*) / 25.0) AS BIGINT))) FROM en GROUP BY l_suppkey)", [("Completeness(page)", none)]),
        ("citations", "orders", [("Completeness(page)", none)]),
        ("metrics", "orders", [("Completeness(page)", none)]),
    ]:
        rows.append(row(name, "Size", table_sql, size))
        rows += [row(name, constraint, table_sql, bad) for constraint, bad in checks]
    return " UNION ALL ".join(rows)


def _landed_run(spark, sf, gate):
    base, run_date = scratch_path(spark, "run"), "2021-07-08"
    for kind, lines in {
        "affiliations": bibliometrics.affiliation_lines,
        "publications": bibliometrics.paged_publication_lines,
        "citations": bibliometrics.citation_lines,
        "metrics": bibliometrics.metric_lines,
    }.items():
        landing.write_lines(lines(spark, sf), f"{base}/landing/{kind}/run_date={run_date}")
    return base, plan.load_run(spark, f"{base}/landing", f"{base}/lake", run_date, gate)


@query(
    f"WITH {bibliometrics.AFFILIATION_SQL}, {bibliometrics.AUTHOR_SQL}, {bibliometrics.CITATION_SQL}, {bibliometrics.METRIC_SQL} {_checks_sql()}"
)
def bibliometric_run(spark, sf):
    """A whole dated run: landed text, bronze, silver, checks, published tables; the check results."""
    return _landed_run(spark, sf, gate=False)[1].select("table", "constraint", "n_rows", "n_bad")


@query(
    f"""
    WITH {bibliometrics.AUTHOR_SQL}, {bibliometrics.CITATION_SQL}
    SELECT DOCUMENT_ID, count(DISTINCT AUTHOR_ID) AS authors, any_value(cited) AS cited FROM au LEFT JOIN
      (SELECT DOCUMENT_ID AS d, CAST(sum(CITATION_CNT) AS BIGINT) AS cited FROM ci GROUP BY 1) ON d = DOCUMENT_ID GROUP BY 1
    """
)
def published_tables(spark, sf):
    """Authors and citations per document, from the tables a run published."""
    gold = f"{_landed_run(spark, sf, gate=False)[0]}/lake/gold"
    bridge = tables.read_published(spark, gold, "AUTHOR_PUBLICATION", schemas.AUTHOR_PUBLICATION)
    citations = tables.read_published(spark, gold, "CITATIONS_BY_YEAR", schemas.CITATION_COUNT_BY_YEAR)
    authors = bridge.groupBy("DOCUMENT_ID").agg(F.count(F.lit(1)).alias("authors"))
    cited = citations.groupBy("DOCUMENT_ID").agg(F.sum("CITATION_CNT").alias("cited"))
    return authors.join(cited, "DOCUMENT_ID", "left")


@query(
    f"""
    WITH {bibliometrics.AFFILIATION_SQL}, a AS (
      SELECT AFFILIATION_ID, 1 AS SECTOR_ID FROM aff WHERE upper(AFFILIATION_NM) LIKE '%FOREST%'
      UNION ALL SELECT AFFILIATION_ID, 2 FROM aff WHERE upper(AFFILIATION_NM) LIKE '%LAND%')
    SELECT 'AFFILIATION_SECTOR' AS "table", CAST(AFFILIATION_ID AS VARCHAR) AS id, CAST(SECTOR_ID AS VARCHAR) AS value FROM a
    UNION ALL SELECT 'AFFILIATION_SECTOR', CAST(AFFILIATION_ID AS VARCHAR), '3' FROM aff WHERE AFFILIATION_ID NOT IN (SELECT AFFILIATION_ID FROM a)
    UNION ALL SELECT * FROM (VALUES ('SECTOR', '1', 'CFS'), ('SECTOR', '2', 'LMS'), ('SECTOR', '3', 'TBD'), ('AFFILIATION_INDICATOR', '60031860', 'DRF3'))
    UNION ALL SELECT 'ACKNOWLEDGEMENTS_BY_YEAR', CAST(year(o_orderdate) AS VARCHAR), CAST(count(*) AS VARCHAR) FROM orders GROUP BY 2
    """
)
def indicator_load(spark, sf):
    """Sector, indicator and acknowledgement tables, refreshed twice from a run and read back."""
    base = scratch_path(spark, "reference")
    years = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("Year"))
    years.agg(F.count(F.lit(1)).alias("Count")).write.option("header", True).csv(f"{base}/csv")
    affiliation = tables.refresh(plan.affiliations(bibliometrics.affiliation_pages(spark, sf)), f"{base}/AFFILIATION")
    for _ in range(2):
        stored = plan.load_reference(spark, affiliation, f"{base}/csv", f"{base}/gold")
    keys = {"AFFILIATION_SECTOR": ("AFFILIATION_ID", "SECTOR_ID"), "SECTOR": ("SECTOR_ID", "SECTOR_LBL"), "AFFILIATION_INDICATOR": ("AFFILIATION_ID", "INDICATOR_CD"), "ACKNOWLEDGEMENTS_BY_YEAR": ("YEAR_LBL", "ACKNOWLEDGEMENTS")}
    parts = [stored[n].select(F.lit(n).alias("table"), F.col(a).cast("string").alias("id"), F.col(b).cast("string").alias("value")) for n, (a, b) in keys.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("SELECT CAST(year(o_orderdate) AS VARCHAR) AS YEAR_LBL, CAST(count(*) AS VARCHAR) AS ACKNOWLEDGEMENTS FROM orders GROUP BY 1")
def acknowledgements_load(spark, sf):
    """Two CSV columns under other header names, taken by position."""
    path = scratch_path(spark, "acknowledgements")
    years = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("Year"))
    years.agg(F.count(F.lit(1)).alias("Count")).write.option("header", True).csv(path)
    return plan.acknowledgements(spark, path)


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, upper(c_name) FROM customer WHERE c_custkey % 2 = 1")
def appended_pages(spark, sf):
    """Two landings appended to one table."""
    path = scratch_path(spark, "appended")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    tables.append(customer.where("c_custkey % 2 = 0"), path)
    tables.append(customer.where("c_custkey % 2 = 1").withColumn("c_name", F.upper("c_name")), path)
    return spark.read.schema(customer.schema).parquet(path)


# ---- whole jobs: files in, stored tables out ----


def _tracker_files(spark, sf, base):
    """The tracker's sheets as files of some thousand order keys each, projects in order."""
    lines = jobs.tracker_sheets(spark, sf).select("file", F.regexp_replace("value", r"(?s)^.*Name,Value\n", "").alias("line"))
    sheet = F.floor(F.substring("file", 7, 12).cast("bigint") / 4000)
    grouped = lines.groupBy(F.lpad(sheet.cast("string"), 9, "0").alias("sheet"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("file", "line"))), lambda row: row["line"])
    content = F.concat(F.lit('Tracker\n\n"Projects, all\nregions",,\nName,Value\n'), F.array_join(ordered, "\n"))
    grouped.agg(content.alias("value")).write.partitionBy("sheet").text(base)


@query(
    f"""
    WITH {jobs.PROJECT_SQL}, lk AS (SELECT unnest(['GEOLOGY_IND', 'PERMAFROST_IND', 'UNUSED_IND']) AS SPECIALIZATION_CD)
    SELECT PROJECT_ID, SPECIALIZATION_CD, pj.PROJECT_NM, pj.o_orderstatus AS DOCUMENTATION, lk.SPECIALIZATION_CD IS NOT NULL AS known
    FROM sp FULL JOIN lk USING (SPECIALIZATION_CD) LEFT JOIN pj USING (PROJECT_ID)
    """
)
def tracker_run(spark, sf):
    """Sheet files to the three stored tables, read back and joined."""
    base = scratch_path(spark, "tracker")
    _tracker_files(spark, sf, f"{base}/sheets")
    lookup = spark.sql("SELECT explode(array('GEOLOGY_IND', 'PERMAFROST_IND', 'UNUSED_IND')) AS Specialization_CD")
    stored = tracker.load_tracker(spark, f"{base}/sheets/*", lookup, f"{base}/tables", jobs.FISCAL_YEAR)
    project = stored["EA_PROJECT_TRACKER"].select("PROJECT_ID", "PROJECT_NM", F.col("EA_IA_DOCUMENTATION_ISSUED_LBL").alias("DOCUMENTATION"))
    codes = stored["EA_SPECIALIZATION"].select(F.col("Specialization_CD").alias("SPECIALIZATION_CD"), F.lit(True).alias("listed"))
    rows = stored["EA_PROJECT_SPECIALIZATION"].join(project, "PROJECT_ID", "left").join(codes, "SPECIALIZATION_CD", "left")
    return rows.select("PROJECT_ID", "SPECIALIZATION_CD", "PROJECT_NM", "DOCUMENTATION", F.col("listed").isNotNull().alias("known"))


@query(f"WITH {jobs.SAMPLE_SQL} SELECT Project_NM, Sample_Type_LBL, count(*) AS n, count(v) AS n_values, round(sum(v), 2) AS total FROM res GROUP BY 1, 2")
def samples_run(spark, sf):
    """Workbook directories to the declared result table, and a report read from it by name."""
    base, headers, name = scratch_path(spark, "samples"), {}, f"tallyloom_{uuid.uuid4().hex}"
    for sheet in jobs.SHEETS:
        wide = jobs.sample_sheet(spark, sf, sheet)
        headers[sheet] = schemas.texts(wide.columns)
        wide.write.option("header", True).csv(f"{base}/books/book/{sheet}")
    results = samples.load_samples(spark, f"{base}/books", headers, name, f"{base}/table").groupBy("Project_NM", "Sample_Type_LBL")
    value = F.col("Value_SRT").cast("double")
    report = results.agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("n_values"), F.round(F.sum(value), 2).alias("total"))
    stored = materialize(report, "report")
    spark.sql(f"DROP TABLE {name}")
    return stored


@query(
    f"""
    WITH {jobs.LABOUR_SQL}, ft AS (SELECT * FROM lf WHERE v IS NOT NULL AND ch = '{labour.FULL_TIME}')
    SELECT 'history 0' AS what, 'CREATE TABLE AS SELECT' AS detail, count(*) AS n FROM ft
    UNION ALL SELECT 'history 1', 'UPDATE', count(*) FROM ft
    UNION ALL SELECT 'before', ch, count(*) FROM ft GROUP BY ch
    UNION ALL SELECT 'after', 'Full Time', count(*) FROM ft
    UNION ALL SELECT 'view', NAICS, count(*) FROM ft GROUP BY NAICS
    """
)
def labour_run(spark, sf):
    """CSV to a stored table, an update, its history, both states, and a named view for SQL."""
    base, view = scratch_path(spark, "labour"), f"tallyloom_{uuid.uuid4().hex}"
    jobs.labour_rows(spark, sf).write.option("header", True).csv(f"{base}/csv")
    first, second = dt.datetime(2021, 2, 22, 22, 0), dt.datetime(2021, 2, 23, 22, 0)
    labour.load_labour(spark, f"{base}/csv", f"{base}/table", first, second)
    history = snapshots.history(spark, f"{base}/table")
    parts = [history.select(F.concat(F.lit("history "), "version").alias("what"), F.col("operation").alias("detail"), F.col("n_rows").alias("n"))]
    for what, moment in (("before", dt.datetime(2021, 2, 23)), ("after", dt.datetime(2021, 2, 24))):
        rows = snapshots.read_as_of(spark, f"{base}/table", moment)
        parts.append(rows.groupBy(F.lit(what).alias("what"), F.col("Labour_force_characteristics").alias("detail")).agg(F.count(F.lit(1)).alias("n")))
    tables.register_view(snapshots.read_version(spark, f"{base}/table"), view)
    parts.append(materialize(spark.sql(f"SELECT 'view' AS what, NAICS AS detail, count(*) AS n FROM {view} GROUP BY NAICS"), "view"))
    spark.catalog.dropTempView(view)
    return reduce(lambda a, b: a.unionByName(b), parts)


def _audit_sheet(rows, positions):
    """A sheet of text cells with the given columns at their letters, the others empty."""
    named = {at: name for name, at in positions.items()}
    empty = F.lit(None).cast("string")
    cells = [F.col(named[i]).cast("string") if i in named else empty for i in range(1, max(named) + 1)]
    return rows.select([c.alias(f"c{i}") for i, c in enumerate(cells, 1)])


@query(
    f"""
    WITH RECURSIVE {audit.EVENTS_SQL}, b AS (SELECT f.* REPLACE (CASE WHEN row_index % 11 <> 0 THEN cardholder END AS cardholder) FROM f),
    c AS (SELECT * FROM b WHERE cardholder IS NOT NULL AND NOT in_fps AND coalesce(gl_code, '') <> '52008'),
    {audit.splits_sql('c', audit.LIMIT)}
    SELECT row_index, cardholder, CASE WHEN cardholder IS NOT NULL THEN criteria END AS criteria,
      CASE WHEN cardholder IS NOT NULL THEN highlight END AS highlight
    FROM (SELECT row_index, cardholder,
      {audit._sql_marks([*audit.sql_rules(audit.LIMIT), ("Potential Splits", "in_split", "OrangeRed")])}
    FROM (SELECT b.* EXCLUDE (criteria), row_index IN (SELECT row_index FROM members) AS in_split FROM b))
    """
)
def audit_run(spark, sf):
    """Four sheets from files to saved results beside them; every eleventh row has no cardholder."""
    base = scratch_path(spark, "audit")
    master = audit.events_master(spark, sf).withColumn("cardholder", F.when(F.col("row_index") % 11 != 0, F.col("cardholder")))
    letters = {name: column_number(letter) for letter, name in schemas.AUDIT_CELLS.items()}
    rows = master.withColumn("description", F.col("row_index"))
    _audit_sheet(rows, letters).write.option("header", True).csv(f"{base}/Master.csv")
    for name, entries in zip(spend_audit.LIST_CELLS, audit.events_lists(audit.events_master(spark, sf))):
        _audit_sheet(entries, {"entry": column_number(spend_audit.LIST_CELLS[name])}).write.option("header", True).csv(f"{base}/{name}.csv")
    width = max(letters.values())

    def sheet(name, columns):
        return files.read_csv(spark, f"{base}/{name}.csv", schemas.texts([f"c{i}" for i in range(1, columns + 1)]))

    sheets = {name: sheet(name, column_number(letter)) for name, letter in spend_audit.LIST_CELLS.items()}
    cells = sheet("Master", width)
    sheets["Master"] = spend_audit.master_rows(cells.withColumn("row", F.col("c3").cast("bigint")))
    saved = tables.save_results(spend_audit.audit_sheets(sheets, spend_limit=audit.LIMIT), f"{base}/Master.parquet")
    return spark.read.schema(record(row_index=LONG, cardholder=TEXT, criteria=TEXT, highlight=TEXT)).parquet(saved)
