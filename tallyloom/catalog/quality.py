"""Queries for declared checks."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.operators import quality
from tallyloom.operators.quality import has_size, is_complete, is_unique, refers_to


def _row(name, constraint, source, rows, bad):
    return f"SELECT '{name}' AS \"table\", '{constraint}' AS \"constraint\", {rows} AS n_rows, {bad} AS n_bad FROM {source}"


def _unique(name, keys, source):
    counted = f"(SELECT count(*) AS n FROM {source} GROUP BY {keys})"
    return _row(
        name,
        f"Uniqueness({keys})",
        counted,
        "CAST(sum(n) AS BIGINT)",
        "CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT)",
    )


_RESULTS = " UNION ALL ".join(
    [
        _row("documents", "Size", "documents", "count(*)", "CAST(count(*) = 0 AS BIGINT)"),
        _row("documents", "Completeness(doc_id)", "documents", "count(*)", "count(*) FILTER (WHERE doc_id IS NULL)"),
        _row("documents", "Completeness(lang)", "documents", "count(*)", "count(*) FILTER (WHERE lang = 'en')"),
        _unique("documents", "doc_id", "documents"),
        _row(
            "documents",
            "Reference(doc_id -> labels)",
            "documents",
            "count(*)",
            "count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels))",
        ),
        _row("lineitem", "Size", "lineitem", "count(*)", "CAST(count(*) = 0 AS BIGINT)"),
        _unique("lineitem", "l_orderkey,l_linenumber", "lineitem"),
        _row(
            "lineitem",
            "Reference(l_orderkey -> orders)",
            "lineitem",
            "count(*)",
            "count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))",
        ),
        _row("nothing", "Size", "(SELECT * FROM orders WHERE o_totalprice < 0)", "count(*)", "CAST(count(*) = 0 AS BIGINT)"),
    ]
)


def _results(spark, sf):
    documents = table(spark, sf, "documents").withColumn("lang", F.nullif(F.col("lang"), F.lit("en")))
    lineitem, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    labels = table(spark, sf, "labels")
    parts = [
        quality.run_checks(
            "documents",
            documents,
            [
                has_size(),
                is_complete("doc_id"),
                is_complete("lang"),
                is_unique("doc_id"),
                refers_to({"doc_id": "doc_id"}, labels, "labels"),
            ],
        ),
        quality.run_checks(
            "lineitem",
            lineitem,
            [has_size(), is_unique("l_orderkey", "l_linenumber"), refers_to({"l_orderkey": "o_orderkey"}, orders, "orders")],
        ),
        quality.run_checks("nothing", orders.where("o_totalprice < 0"), [has_size()]),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    f"""
    SELECT *, CASE WHEN n_bad > 0 THEN 'Failure' ELSE 'Success' END AS status,
           CASE WHEN n_bad > 0 THEN n_bad || ' of ' || n_rows || ' rows break the constraint' END AS message
    FROM ({_RESULTS})
    """
)
def quality_report(spark, sf):
    return _results(spark, sf)


@query(
    f"""
    SELECT "table", CASE WHEN max(n_bad) > 0 THEN 'Failure' ELSE 'Success' END AS status,
           count(*) FILTER (WHERE n_bad > 0) AS failed_checks
    FROM ({_RESULTS}) GROUP BY "table"
    """
)
def quality_status(spark, sf):
    return quality.overall_status(_results(spark, sf))


@query(
    """
    SELECT 'documents' AS "table", 'Reference(doc_id -> labels)' AS "constraint", count(*) AS n_rows,
           count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS n_bad FROM documents
    """
)
def fk_check(spark, sf):
    check = refers_to({"doc_id": "doc_id"}, table(spark, sf, "labels"), "labels")
    result = quality.run_checks("documents", table(spark, sf, "documents"), [check])
    return result.select("table", "constraint", "n_rows", "n_bad")


@query(
    """
    SELECT 'missing l_orderkey' AS measure, count(*) FILTER (WHERE l_orderkey IS NULL) AS value FROM lineitem
    UNION ALL SELECT 'missing flag', count(*) FILTER (WHERE l_returnflag = 'N') FROM lineitem
    UNION ALL SELECT 'distinct flag', count(DISTINCT nullif(l_returnflag, 'N')) FROM lineitem
    UNION ALL SELECT 'documents with rows', count(*) FILTER (WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)) FROM orders
    UNION ALL SELECT 'documents without rows', count(*) FILTER (WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) FROM orders
    """
)
def nested_profile(spark, sf):
    flat = table(spark, sf, "lineitem").withColumn("flag", F.nullif(F.col("l_returnflag"), F.lit("N")))
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    return quality.profile_nested(flat, orders, "l_orderkey", ["flag"])
