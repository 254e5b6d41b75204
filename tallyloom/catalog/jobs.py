"""Queries for the tracker, sample and labour-force jobs, on inputs that Spark derives from the test tables."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.plans import labour, samples, tracker
from tallyloom.session import spread
from tallyloom.sources.files import parse_block, stack_sheets
from tallyloom.sources.schemas import TRACKER_INDICATORS

PROVINCE_CODES = [*tracker.PROVINCES, "XX"]
_QUOTED_CODES = ", ".join(f"'{c}'" for c in PROVINCE_CODES)
FISCAL_YEAR = "2020-21"


def tracker_sheets(spark, sf):
    """One sheet per order: four heading lines, two projects and an empty row between them."""
    order = F.col("o_orderkey")
    marks = [F.when((order + i) % 4 == 0, F.lit("x")).otherwise("") for i in range(len(TRACKER_INDICATORS))]

    def line(name, province, deadline):
        cells = [
            F.date_format("o_orderdate", "yyyy-MM-dd"),
            order.cast("string"),
            name,
            *[F.lit("")] * 2,
            province,
            *[F.lit("")] * 4,
            deadline,
            *[F.lit("")] * 2,
            F.col("o_orderstatus"),
            *[F.lit("")] * 3,
            *marks,
        ]
        return F.concat_ws(",", *cells)

    province = F.get(F.array(*[F.lit(c) for c in PROVINCE_CODES]), (F.col("o_custkey") % 12).cast("int"))
    deadline = F.substring("o_orderpriority", 1, 1)
    plain = line(F.concat(F.lit("P"), order), province, deadline)
    quoted = line(F.concat(F.lit('"Site ""A"", row\n'), order, F.lit('"')), F.lit("MB"), F.lit("6"))
    heading = F.lit("Tracker\n\n\"Projects, all\nregions\",,\nName,Value")
    content = F.concat_ws("\n", heading, plain, F.lit("," * 32), quoted)
    name = F.concat(F.lit("sheet-"), F.lpad(order.cast("string"), 12, "0"))
    return spread(table(spark, sf, "orders")).select(name.alias("file"), content.alias("value"))


def tracker_block(spark, sf):
    return parse_block(tracker_sheets(spark, sf), tracker.COLUMNS, tracker.FIRST_ROW)


_PROVINCE_SQL = "CASE code " + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in tracker.PROVINCES.items()) + " END"
_DEADLINE_SQL = "CASE band " + " ".join(f"WHEN '{c}' THEN '{n}'" for c, n in tracker.DEADLINES.items()) + " END"
PROJECT_SQL = f"""
    src AS (SELECT *, ([{_QUOTED_CODES}])[(o_custkey % 12) + 1] AS code1, substr(o_orderpriority, 1, 1) AS band1 FROM orders),
    pr AS (SELECT o_orderkey, 1 AS line, 'P' || o_orderkey AS PROJECT_NM, code1 AS code, band1 AS band, o_orderstatus FROM src
        UNION ALL SELECT o_orderkey, 2, 'Site "A", row' || chr(10) || o_orderkey, 'MB', '6', o_orderstatus FROM src),
    pj AS (SELECT *, row_number() OVER (ORDER BY o_orderkey, line) - 1 AS PROJECT_ID FROM pr),
    sp AS (SELECT PROJECT_ID, PROJECT_NM, ind AS SPECIALIZATION_CD, 'x' AS SPECIALIZATION_CNT
      FROM pj, (SELECT unnest([{', '.join(f"'{c}'" for c in TRACKER_INDICATORS)}]) AS ind, unnest(range(16)) AS i)
      WHERE (o_orderkey + i) % 4 = 0)
"""


@query(
    f"""
    WITH {PROJECT_SQL} SELECT PROJECT_ID, PROJECT_NM, CAST(o_orderkey AS VARCHAR) AS EAD_FILE_NBR, code AS PROVINCE_LBL,
      {_PROVINCE_SQL} AS PROVINCE_DESC, {_DEADLINE_SQL} AS NEXT_DEADLINE_DESC, '{FISCAL_YEAR}' AS FISCAL_YEAR FROM pj
    """
)
def tracker_projects(spark, sf):
    return tracker.projects(tracker_block(spark, sf), FISCAL_YEAR).select(
        "PROJECT_ID", "PROJECT_NM", "EAD_FILE_NBR", "PROVINCE_LBL", "PROVINCE_DESC", "NEXT_DEADLINE_DESC", "FISCAL_YEAR"
    )


@query("SELECT o_orderstatus AS EA_IA_DOCUMENTATION_ISSUED_LBL, 2 * count(*) AS count FROM orders GROUP BY 1")
def tracker_counts(spark, sf):
    return tracker.documentation_counts(tracker_block(spark, sf))


@query(f"WITH {PROJECT_SQL} SELECT * FROM sp")
def tracker_specializations(spark, sf):
    return tracker.specializations(tracker.projects(tracker_block(spark, sf), FISCAL_YEAR))


@query(
    f"""
    WITH {PROJECT_SQL}, lk AS (SELECT unnest(['GEOLOGY_IND', 'PERMAFROST_IND']) AS SPECIALIZATION_CD
        UNION ALL SELECT DISTINCT 'BRAND_' || p_brand FROM part)
    SELECT PROJECT_ID, SPECIALIZATION_CD FROM sp FULL JOIN lk USING (SPECIALIZATION_CD)
    """
)
def tracker_bridge(spark, sf):
    """Lookup: two of the codes in use, and one code per part brand that no project uses."""
    long = tracker.specializations(tracker.projects(tracker_block(spark, sf), FISCAL_YEAR))
    used = spark.sql("SELECT explode(array('GEOLOGY_IND', 'PERMAFROST_IND')) AS Specialization_CD")
    brands = table(spark, sf, "part").select(F.concat(F.lit("BRAND_"), "p_brand").alias("Specialization_CD")).distinct()
    return tracker.project_specializations(long, used.unionByName(brands))


# Sheet name -> the order status it holds and its test columns as SQL expressions.
SHEETS = {
    "TRM_aquaregia": ("O", {"AR-Fe_mg/kg": "o_totalprice / 100", "pH": "o_orderkey % 14"}),
    "XRF": ("F", {"Si.pct": "if(o_custkey % 3 <> 0, o_custkey % 100, NULL)"}),
    "Leach": ("P", {"pH": "o_orderkey % 14"}),
}


def sample_sheet(spark, sf, name):
    """One wide all-text sheet. Every tenth row has no sample id; some projects are missing."""
    status, tests = SHEETS[name]
    columns = {
        "Sample ID": F.when(F.col("o_orderkey") % 10 != 0, F.concat(F.lit("S"), "o_orderkey")),
        "Project Name": F.when(F.col("o_custkey") % 5 != 0, F.concat(F.lit("Project "), F.col("o_custkey") % 40)),
        "Material Type": F.col("o_orderpriority"),
        "Lithology": F.lit("shale"),
        "Zone": (F.col("o_custkey") % 4).cast("string"),
        "Borehole": F.lit(None).cast("string"),
        **{test: F.expr(value).cast("string") for test, value in tests.items()},
    }
    rows = table(spark, sf, "orders").where(F.col("o_orderstatus") == status)
    return rows.select([column.alias(c) for c, column in columns.items()])


def sample_sheets(spark, sf):
    return stack_sheets([sample_sheet(spark, sf, name).withColumn("Sample Type", F.lit(name)) for name in SHEETS])


SAMPLE_SQL = """
    wide AS (SELECT 'S' || o_orderkey AS SAMPLE_ID, CASE WHEN o_custkey % 5 <> 0 THEN 'Project ' || (o_custkey % 40) END AS Project_NM,
        CASE o_orderstatus WHEN 'O' THEN 'TRM_aquaregia' WHEN 'F' THEN 'XRF' WHEN 'P' THEN 'Leach' END AS Sample_Type_LBL,
        o_orderpriority AS Material_Type_LBL, CAST(o_custkey % 4 AS VARCHAR) AS Zone_LBL,
        CASE WHEN o_orderstatus = 'O' THEN o_totalprice / 100 END AS fe,
        CASE WHEN o_orderstatus IN ('O', 'P') THEN o_orderkey % 14 END AS ph,
        CASE WHEN o_orderstatus = 'F' AND o_custkey % 3 <> 0 THEN o_custkey % 100 END AS si
      FROM orders WHERE o_orderkey % 10 <> 0),
    res AS (SELECT SAMPLE_ID, Project_NM, Sample_Type_LBL, Material_Type_LBL, Zone_LBL, 'AR-Fe_mg/kg' AS Test_NM, CAST(fe AS DOUBLE) AS v FROM wide
        UNION ALL SELECT SAMPLE_ID, Project_NM, Sample_Type_LBL, Material_Type_LBL, Zone_LBL, 'pH', ph FROM wide
        UNION ALL SELECT SAMPLE_ID, Project_NM, Sample_Type_LBL, Material_Type_LBL, Zone_LBL, 'Si.pct', si FROM wide)
"""


def _typed(results):
    return results.select(
        "SAMPLE_ID",
        "Project_NM",
        "Sample_Type_LBL",
        "Material_Type_LBL",
        "Zone_LBL",
        "Test_NM",
        F.col("Value_SRT").cast("double").alias("v"),
    )


@query(f"WITH {SAMPLE_SQL} SELECT * FROM res")
def samples_long(spark, sf):
    return _typed(samples.sample_results(sample_sheets(spark, sf)))


@query(f"WITH {SAMPLE_SQL} SELECT * FROM res")
def samples_rejoined(spark, sf):
    return _typed(samples.rejoined_results(sample_sheets(spark, sf)))


@query(f"WITH {SAMPLE_SQL} SELECT DISTINCT Project_NM, Sample_Type_LBL FROM res")
def sample_projects(spark, sf):
    return samples.projects_and_types(samples.sample_results(sample_sheets(spark, sf)))


@query(f"WITH {SAMPLE_SQL} SELECT Project_NM, count(*) AS count FROM res WHERE Project_NM IS NOT NULL GROUP BY 1")
def sample_project_counts(spark, sf):
    return samples.rows_per_project(samples.sample_results(sample_sheets(spark, sf)))


@query(f"WITH {SAMPLE_SQL} SELECT * FROM res WHERE Sample_Type_LBL = 'TRM_aquaregia' AND Test_NM = 'AR-Fe_mg/kg' AND v > 1700")
def sample_results_above(spark, sf):
    results = samples.sample_results(sample_sheets(spark, sf))
    return _typed(samples.results_above(results, "TRM_aquaregia", "AR-Fe_mg/kg", 1700))


@query(
    f"""
    WITH {SAMPLE_SQL}, listed AS (SELECT SAMPLE_ID, Sample_Type_LBL FROM wide
        UNION ALL SELECT SAMPLE_ID, Sample_Type_LBL FROM wide WHERE Sample_Type_LBL = 'XRF' AND Zone_LBL = '1'),
      n AS (SELECT count(*) AS n FROM listed GROUP BY SAMPLE_ID, Sample_Type_LBL)
    SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT) AS n_bad, 'Failure' AS status FROM n
    """
)
def sample_duplicates(spark, sf):
    """The samples of one sheet and zone are listed twice."""
    sheets = sample_sheets(spark, sf)
    twice = sheets.where("`Sample Type` = 'XRF' AND Zone = '1'")
    return samples.sample_checks(sheets.unionByName(twice)).select("n_rows", "n_bad", "status")


def labour_rows(spark, sf):
    """An all-text labour-force table: one row per order, every ninth value missing."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(
        F.col("c_nationkey").cast("string").alias("GEO"),
        F.date_format("o_orderdate", "yyyy-MM").alias("Date"),
        F.when(F.col("o_orderkey") % 9 != 0, F.col("o_totalprice").cast("string")).alias("VALUE"),
        F.when(F.col("o_orderstatus") == "O", labour.FULL_TIME).otherwise(F.col("o_orderpriority")).alias("Labour_force_characteristics"),
        F.when(F.col("o_orderpriority") == "5-LOW", labour.ALL_INDUSTRIES).otherwise(F.col("c_mktsegment")).alias("NAICS"),
    )


LABOUR_SQL = f"""
    lf AS (SELECT CAST(c_nationkey AS VARCHAR) AS GEO, strftime(o_orderdate, '%Y-%m') AS "Date",
        CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice END AS v,
        CASE WHEN o_orderstatus = 'O' THEN '{labour.FULL_TIME}' ELSE o_orderpriority END AS ch,
        CASE WHEN o_orderpriority = '5-LOW' THEN '{labour.ALL_INDUSTRIES}' ELSE c_mktsegment END AS NAICS
      FROM orders JOIN customer ON o_custkey = c_custkey)
"""


@query(f"""WITH {LABOUR_SQL} SELECT GEO, v AS value_number, "Date" FROM lf WHERE v > 6000""")
def labour_above(spark, sf):
    rows = labour.above(labour_rows(spark, sf))
    return rows.select("GEO", F.col("VALUE").cast("double").alias("value_number"), "Date")


@query(f"WITH {LABOUR_SQL} SELECT ch AS Labour_force_characteristics, count(*) AS count FROM lf WHERE v IS NOT NULL GROUP BY 1")
def labour_counts(spark, sf):
    return labour.rows_per_characteristic(labour_rows(spark, sf))


EMPLOYMENT_SQL = f"""
    WITH {LABOUR_SQL} SELECT NAICS, round(sum(v), 2) AS Employment FROM lf
    WHERE v IS NOT NULL AND ch = '{labour.FULL_TIME}' AND NAICS <> '{labour.ALL_INDUSTRIES}' GROUP BY 1
"""


def employment(rows):
    return labour.employment_by_industry(labour.full_time(rows)).withColumn("Employment", F.round("Employment", 2))


@query(EMPLOYMENT_SQL)
def labour_employment(spark, sf):
    return employment(labour_rows(spark, sf))


@query(f"WITH {LABOUR_SQL} SELECT NAICS, CAST(CAST(v * 1.5 AS FLOAT) AS DOUBLE) AS new_value FROM lf")
def labour_scaled(spark, sf):
    scaled = labour.scaled_values(labour_rows(spark, sf))
    return scaled.withColumn("new_value", F.col("new_value").cast("double"))
