"""Queries for scalar functions, labels and reshaping."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.functions import cells, text
from tallyloom.operators import reshape

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    """
    SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type, count(*) AS n FROM events GROUP BY 1, 2
    """
)
def json_field(spark, sf):
    parsed = table(spark, sf, "events").select(F.from_json("props", "k int")["k"].alias("k"), "event_type")
    return parsed.groupBy("k", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    r"""
    SELECT page_id, regexp_extract(url, ':(.*)', 1) AS rest, regexp_extract('AF-ID(' || page_id || ')', '\(([^)]+)', 1) AS inner_id,
           substr(url, 8) AS host_path, regexp_extract(url, '\(([^)]+)', 1) AS no_match
    FROM pages
    """
)
def regex_suffix(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id",
        text.after_colon(url).alias("rest"),
        text.in_parentheses(F.concat(F.lit("AF-ID("), "page_id", F.lit(")"))).alias("inner_id"),
        text.suffix_from(url, 8).alias("host_path"),
        text.in_parentheses(url).alias("no_match"),
    )


@query(
    """
    SELECT o_orderkey,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Within 15 days' WHEN '2-HIGH' THEN '15 - 60 days'
           WHEN '3-MEDIUM' THEN '60 - 180 days' END AS deadline,
      CASE WHEN o_orderstatus = 'O' THEN 'Open Access' ELSE 'Not Open Access' END AS access_label
    FROM orders
    """
)
def label_codes(spark, sf):
    deadlines = {"1-URGENT": "Within 15 days", "2-HIGH": "15 - 60 days", "3-MEDIUM": "60 - 180 days"}
    flag = F.when(F.col("o_orderstatus") == "O", True).when(F.col("o_orderstatus") == "F", False)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        cells.label(F.col("o_orderpriority"), deadlines).alias("deadline"),
        cells.open_access_label(flag).alias("access_label"),
    )


@query(
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS n FROM orders
    WHERE year(o_orderdate) BETWEEN 1999 + 1 - 3 AND 1999 + 1 GROUP BY 1
    """
)
def year_window(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("order_year"))
    kept = years.where(cells.year_window(F.col("order_year"), 1999, 3))
    return kept.groupBy("order_year").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, value * 1.5 AS new_value FROM events")
def scaled_value(spark, sf):
    return table(spark, sf, "events").select("event_id", cells.scaled(F.col("value")).alias("new_value"))


@query("SELECT event_id, CAST(CAST(value * 1.5 AS FLOAT) AS DOUBLE) AS new_value FROM events")
def scaled_in_sql(spark, sf):
    """The registered SQL function, called from SQL."""
    cells.register_scaled(spark)
    table(spark, sf, "events").createOrReplaceTempView("tallyloom_events")
    return spark.sql("SELECT event_id, CAST(converted_value(value) AS DOUBLE) AS new_value FROM tallyloom_events")


@query(
    """
    SELECT p_partkey, CAST(levenshtein(p_name, lower(p_type || ' ' || p_brand)) AS INTEGER) AS distance,
      round(100.0 * (greatest(1, length(p_name), length(p_type || ' ' || p_brand))
        - levenshtein(p_name, lower(p_type || ' ' || p_brand)))
        / greatest(1, length(p_name), length(p_type || ' ' || p_brand)), 6) AS similarity,
      5 * levenshtein(p_name, lower(p_type)) <= 2 * greatest(1, length(p_name), length(p_type)) AS alike
    FROM part
    """
)
def text_similarity(spark, sf):
    name, other = F.col("p_name"), F.lower(F.concat("p_type", F.lit(" "), "p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey",
        text.edit_distance(name, other).alias("distance"),
        F.round(text.similarity_percent(name, other), 6).alias("similarity"),
        text.similar_at_least(name, F.lower("p_type"), 60).alias("alike"),
    )


@query(
    """
    SELECT event_id, CAST(floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-15 12:00:00')) / 86400000000) AS BIGINT) AS days
    FROM events
    """
)
def day_gap(spark, sf):
    start = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    return table(spark, sf, "events").select("event_id", cells.whole_days(start, F.col("ts")).alias("days"))


@query(
    """
    SELECT event_id, event_id % 3 <> 0 AS numeric_cell, CASE WHEN event_id % 3 <> 0 THEN value END AS number_value FROM events
    """
)
def cell_numbers(spark, sf):
    content = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    rows = table(spark, sf, "events").withColumn("content", content)
    return rows.select(
        "event_id", cells.is_number(F.col("content")).alias("numeric_cell"), cells.number(F.col("content")).alias("number_value")
    )


@query(
    """
    SELECT r_name, upper(n_name) AS name_upper, CAST(n_nationkey AS VARCHAR) AS key_text, 'FY' AS fiscal_year,
           n_regionkey || '-' || n_nationkey AS pair_key
    FROM nation JOIN region ON n_regionkey = r_regionkey
    """
)
def projected_columns(spark, sf):
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    named = cells.rename_positions(nation, ["key", "name", "region"])
    joined = cells.text_columns(named, ["key"]).join(region, F.col("region") == F.col("r_regionkey"))
    return joined.select(
        "r_name",
        F.upper(text.strip_all(F.concat(F.lit("\t"), "name", F.lit("  ")))).alias("name_upper"),
        F.col("key").alias("key_text"),
        F.lit("FY").alias("fiscal_year"),
        F.concat_ws("-", "region", "key").alias("pair_key"),
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, measure, amount FROM (
      SELECT l_orderkey, l_linenumber, nullif(l_quantity, 1) AS l_quantity, l_extendedprice, nullif(l_discount, 0) AS l_discount,
             nullif(l_tax, 0) AS l_tax FROM lineitem)
    UNPIVOT (amount FOR measure IN (l_quantity, l_extendedprice, l_discount, l_tax))
    """
)
def unpivot_fixed(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns(
        {
            "l_quantity": F.nullif(F.col("l_quantity"), F.lit(1.0)),
            "l_discount": F.nullif(F.col("l_discount"), F.lit(0.0)),
            "l_tax": F.nullif(F.col("l_tax"), F.lit(0.0)),
        }
    )
    return reshape.unpivot_present(lines, ["l_orderkey", "l_linenumber"], MEASURES, "measure", "amount")


@query(
    """
    SELECT c_custkey, Test, value FROM (
      SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment,
             c_name FROM customer)
    UNPIVOT INCLUDE NULLS (value FOR Test IN (c_name, c_nationkey, c_mktsegment))
    """
)
def unpivot_wide(spark, sf):
    customer = table(spark, sf, "customer").drop("c_acctbal")
    blanked = customer.withColumn("c_mktsegment", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")))
    return reshape.unpivot_rest(blanked, ["c_custkey"])


@query(
    """
    SELECT o_orderkey, o_custkey, Test, value FROM (
      SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders)
    UNPIVOT (value FOR Test IN (o_orderstatus, o_orderpriority))
    """
)
def wide_split_rejoin(spark, sf):
    wide = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    dimension, facts = reshape.split_wide(wide, "o_orderkey", ["o_orderkey", "o_custkey"])
    return dimension.join(facts, "o_orderkey", "left")


def _nested_lines(spark, sf):
    """Every line as a two-level nested document: zero, one or two groups of one or two items."""
    item = F.struct(F.col("l_partkey").alias("id"), F.lit("part").alias("kind"))
    other = F.struct(F.col("l_suppkey").alias("id"), F.lit("supplier").alias("kind"))
    one = F.struct(F.lit("a").alias("name"), F.array(item, other).alias("items"))
    two = F.struct(F.lit("b").alias("name"), F.when(F.col("l_linenumber") > 3, F.array(item)).alias("items"))
    groups = F.when(F.col("l_returnflag") == "R", F.array(one, two)).when(F.col("l_returnflag") == "A", F.array(two))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", groups.alias("groups"))


_GROUPS = """
    g AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'a' AS name FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'b' FROM lineitem WHERE l_returnflag IN ('R', 'A')),
    i AS (SELECT l_orderkey, l_linenumber, name, l_partkey AS id, 'part' AS kind FROM g WHERE name = 'a' OR l_linenumber > 3
          UNION ALL SELECT l_orderkey, l_linenumber, name, l_suppkey, 'supplier' FROM g WHERE name = 'a')
"""


@query(f"WITH {_GROUPS} SELECT * FROM i")
def nested_explode(spark, sf):
    groups = reshape.explode_items(_nested_lines(spark, sf), F.col("groups"), "g").select("l_orderkey", "l_linenumber", "g.*")
    rows = reshape.explode_items(groups, F.col("items"), "i")
    return rows.select("l_orderkey", "l_linenumber", "name", "i.id", "i.kind")


@query(
    f"""
    WITH {_GROUPS} SELECT * FROM i UNION ALL
    SELECT l_orderkey, l_linenumber, name, NULL, NULL FROM g WHERE name = 'b' AND l_linenumber <= 3
    """
)
def nested_explode_outer(spark, sf):
    groups = reshape.explode_items(_nested_lines(spark, sf), F.col("groups"), "g").select("l_orderkey", "l_linenumber", "g.*")
    rows = reshape.explode_items(groups, F.col("items"), "i", keep_empty=True)
    return rows.select("l_orderkey", "l_linenumber", "name", "i.id", "i.kind")


@query(
    """
    SELECT o_orderkey, CAST(year(o_orderdate) + i AS VARCHAR) AS year_lbl, (o_custkey + i) % 5 AS cnt
    FROM orders, (SELECT unnest(range(4)) AS i)
    """
)
def parallel_arrays(spark, sf):
    steps = F.sequence(F.lit(0), F.lit(3))
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.transform(steps, lambda i: (F.year("o_orderdate") + i).cast("string")).alias("years"),
        F.transform(steps, lambda i: (F.col("o_custkey") + i) % 5).alias("counts"),
    )
    return reshape.explode_parallel(orders, [F.col("o_orderkey")], {"year_lbl": F.col("years"), "cnt": F.col("counts")})
