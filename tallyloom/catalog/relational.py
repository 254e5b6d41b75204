"""Queries for filters, joins, aggregates, dedup and classification."""

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query, table
from tallyloom.functions.text import suffix_from
from tallyloom.operators import relational as ops
from tallyloom.operators.bitmaps import distinct_where
from tallyloom.sources.files import literal_rows
from tallyloom.sources.schemas import INT, TEXT, record

LINE = "l_orderkey, l_linenumber"
LINE_ALL = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
NAME_SECTORS = [(1, "RING"), (2, "RED")]


@query(
    """
    WITH a AS (
      SELECT p_partkey, 1 AS sector_id FROM part WHERE upper(p_name) LIKE '%RING%'
      UNION ALL SELECT p_partkey, 2 FROM part WHERE upper(p_name) LIKE '%RED%'),
    b AS (SELECT * FROM a UNION ALL
      SELECT p_partkey, 3 FROM part WHERE p_partkey NOT IN (SELECT p_partkey FROM a))
    SELECT b.sector_id, s.sector_lbl, count(*) AS part_cnt
    FROM b JOIN (VALUES (1,'CFS'),(2,'LMS'),(3,'TBD')) s(sector_id, sector_lbl) ON b.sector_id = s.sector_id
    GROUP BY b.sector_id, s.sector_lbl
    """
)
def sector_summary(spark, sf):
    sectors = literal_rows(spark, [(1, "CFS"), (2, "LMS"), (3, "TBD")], record(sector_id=INT, sector_lbl=TEXT))
    assigned = ops.classify(table(spark, sf, "part"), "p_name", NAME_SECTORS, 3, "sector_id")
    counts = assigned.groupBy("sector_id").agg(F.count(F.lit(1)).alias("part_cnt"))
    return counts.join(sectors, "sector_id").select("sector_id", "sector_lbl", "part_cnt")


@query(
    """
    SELECT p_partkey, unnest(CASE WHEN len(hits) > 0 THEN hits ELSE [3] END) AS sector_id
    FROM (SELECT p_partkey, list_filter([CASE WHEN upper(p_name) LIKE '%RING%' THEN 1 END,
                 CASE WHEN upper(p_name) LIKE '%RED%' THEN 2 END], lambda x: x IS NOT NULL) AS hits FROM part)
    """
)
def sector_assignments(spark, sf):
    return ops.classify(table(spark, sf, "part"), "p_name", NAME_SECTORS, 3, "sector_id").select("p_partkey", "sector_id")


@query(
    f"""
    SELECT {LINE_ALL}, strftime(l_shipdate, '%Y-%m-%d') AS shipped FROM (
      SELECT *, row_number() OVER (PARTITION BY {LINE} ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity,
        l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem) WHERE rn = 1
    """
)
def dedup_keep_first(spark, sf):
    first = ops.keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return first.select(*LINE_ALL.split(", "), F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))


@query(
    f"""
    SELECT {LINE}, l_partkey, l_suppkey, l_returnflag FROM (
      SELECT *, dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag) AS rk FROM lineitem) WHERE rk = 1
    """
)
def dedup_all_ties(spark, sf):
    ties = ops.keep_ties(table(spark, sf, "lineitem"), ["l_orderkey"], ["l_returnflag"])
    return ties.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")


@query(f"SELECT {LINE}, count(*) AS copies FROM lineitem GROUP BY {LINE} HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return ops.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT sha256(text) AS digest, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1
    """
)
def duplicate_text(spark, sf):
    """Copies of whole texts; the digest of a text travels through the shuffle instead of the text."""
    digests = table(spark, sf, "documents").select(F.sha2("text", 256).alias("digest"))
    return ops.duplicates(digests, ["digest"])


@query(
    f"""
    SELECT {LINE}, l_returnflag FROM lineitem WHERE l_orderkey IN (
      SELECT l_orderkey FROM (SELECT l_orderkey, nullif(l_returnflag, 'N') AS v FROM lineitem GROUP BY 1, 2)
      GROUP BY l_orderkey HAVING count(*) > 1)
    """
)
def key_variants(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("variant", F.nullif(F.col("l_returnflag"), F.lit("N")))
    return ops.variants(lines, "l_orderkey", "variant").select("l_orderkey", "l_linenumber", "l_returnflag")


@query("SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans(spark, sf):
    lost = ops.orphans(table(spark, sf, "documents"), table(spark, sf, "labels"), {"doc_id": "doc_id"})
    return lost.select("doc_id", "source", "n_chars")


@query(
    """
    SELECT o_orderkey IS NOT NULL AS has_order, p_partkey IS NOT NULL AS has_part, count(*) AS n_lines
    FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'F') o ON l_orderkey = o_orderkey
    LEFT JOIN (SELECT * FROM part WHERE p_size > 25) p ON l_partkey = p_partkey
    GROUP BY 1, 2
    """
)
def left_join_two_parents(spark, sf):
    open_orders = table(spark, sf, "orders").where("o_orderstatus <> 'F'")
    large = table(spark, sf, "part").where("p_size > 25")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    joined = ops.with_parents(lines, [(open_orders, {"l_orderkey": "o_orderkey"}), (large, {"l_partkey": "p_partkey"})])
    return joined.groupBy(
        F.col("o_orderkey").isNotNull().alias("has_order"), F.col("p_partkey").isNotNull().alias("has_part")
    ).agg(F.count(F.lit(1)).alias("n_lines"))


@query(
    """
    SELECT code, n_name AS label, count(l_orderkey) AS n_facts
    FROM (SELECT l_orderkey, l_linenumber AS code FROM lineitem WHERE l_linenumber <> 4) f
    FULL JOIN (SELECT n_nationkey AS code, n_name FROM nation WHERE n_nationkey <> 2) n USING (code)
    GROUP BY 1, 2
    """
)
def full_outer_lookup(spark, sf):
    facts = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("code")).where("code <> 4")
    lookup = table(spark, sf, "nation").select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("label"))
    joined = ops.full_outer_lookup(facts, lookup.where("code <> 2"), "code")
    return joined.groupBy("code", "label").agg(F.count("l_orderkey").alias("n_facts"))


@query(
    """
    WITH listed AS (SELECT DISTINCT upper(trim(c_mktsegment)) AS entry FROM customer WHERE c_nationkey = 3 AND c_acctbal > 5000),
         names AS (SELECT DISTINCT upper(trim(c_name)) AS entry FROM customer WHERE c_acctbal < 0)
    SELECT c_custkey, upper(c_mktsegment) IN (SELECT entry FROM listed) AS in_segments,
           c_name IN (SELECT entry FROM names) AS in_names
    FROM customer
    """
)
def set_membership_flags(spark, sf):
    customer = table(spark, sf, "customer")
    padded = customer.withColumn("c_mktsegment", F.concat(F.lit("\t "), "c_mktsegment", F.lit(" \n")))
    segments = ops.lookup_set(padded.where("c_nationkey = 3 AND c_acctbal > 5000"), "c_mktsegment")
    names = ops.lookup_set(customer.where("c_acctbal < 0"), "c_name")
    flagged = ops.flag_membership(customer, F.upper("c_mktsegment"), segments, "in_segments")
    flagged = ops.flag_membership(flagged, F.col("c_name"), names, "in_names")
    return flagged.select("c_custkey", "in_segments", "in_names")


@query(
    """
    SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS seq FROM orders
    """
)
def sequence_ids(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return ops.number_rows(rows, ["o_orderdate", "o_orderkey"], "seq", unique=True).select("o_orderkey", "o_custkey", "seq")


@query("SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem")
def distinct_pairs(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey").distinct()


@query(
    """
    SELECT n_name, r_name, count(*) AS customers, CAST(sum(n_orders) AS BIGINT) AS orders
    FROM (SELECT c_nationkey, o_custkey, count(*) AS n_orders FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2)
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2
    """
)
def inner_join_counts(spark, sf):
    """Orders are counted per customer before the join, so a hot customer joins as one row."""
    per_customer = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    per_nation = (
        per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("customers"), F.sum("n_orders").alias("orders"))
    )
    nation = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_name", "r_name", "customers", "orders"
    )


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_by_group(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    """
    SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem
    WHERE l_returnflag <> 'N' GROUP BY l_suppkey
    """
)
def sum_by_group(spark, sf):
    lines = table(spark, sf, "lineitem").where("l_returnflag <> 'N'")
    totals = lines.groupBy("l_suppkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))
    return totals.orderBy(F.desc("total"), "l_suppkey")


@query(
    f"SELECT l_orderkey, l_returnflag, l_linestatus, max(l_quantity) AS top FROM lineitem GROUP BY 1, 2, 3"
)
def max_metric(spark, sf):
    lines = table(spark, sf, "lineitem")
    return lines.groupBy("l_orderkey", "l_returnflag", "l_linestatus").agg(F.max("l_quantity").alias("top"))


@query(
    """
    SELECT count(DISTINCT l_orderkey) AS orders,
           count(DISTINCT CASE WHEN l_discount <> 0 THEN l_orderkey END) AS discounted FROM lineitem
    """
)
def distinct_filtered(spark, sf):
    conditions = {"orders": F.lit(True), "discounted": F.col("l_discount") != 0}
    return distinct_where(table(spark, sf, "lineitem"), "l_orderkey", conditions)


@query(
    """
    SELECT 'lineitem' AS name, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'documents', count(*) FROM documents
    """
)
def table_counts(spark, sf):
    parts = [
        table(spark, sf, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name in ("lineitem", "orders", "documents")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    """
    SELECT l_orderkey, l_partkey, l_quantity FROM lineitem
    WHERE l_returnflag = 'R' AND l_quantity > 30 AND l_linestatus <> 'F' AND l_discount IS NOT NULL
      AND l_shipmode_text LIKE '1%'
    """.replace("l_shipmode_text", "CAST(l_partkey AS VARCHAR)")
)
def filter_conjunction(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 30) & (F.col("l_linestatus") != "F"))
        .where(F.col("l_discount").isNotNull() & F.col("l_partkey").cast("string").startswith("1"))
        .select("l_orderkey", "l_partkey", "l_quantity")
    )


@query("SELECT p_partkey, p_type FROM part WHERE p_brand IN ('Brand#1', 'Brand#7') AND p_size NOT IN (1, 2, 3)")
def filter_membership(spark, sf):
    keep = F.col("p_brand").isin("Brand#1", "Brand#7") & ~F.col("p_size").isin(1, 2, 3)
    return table(spark, sf, "part").where(keep).select("p_partkey", "p_type")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = 'Customer#000000077'")
def point_lookup(spark, sf):
    return table(spark, sf, "customer").where(F.col("c_name") == "Customer#000000077").select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@query(
    """
    SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey
    ORDER BY n_orders DESC, o_custkey LIMIT 20
    """
)
def ordered_head(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    return counts.orderBy(F.desc("n_orders"), "o_custkey").limit(20)


@query(
    """
    SELECT 'supplier' AS kind, s_suppkey AS key, s_acctbal AS balance, NULL AS segment FROM supplier
    UNION ALL SELECT 'customer', c_custkey, c_acctbal, c_mktsegment FROM customer
    """
)
def union_by_name(spark, sf):
    supplier = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("balance")
    )
    customer = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_custkey").alias("key"),
    )
    return supplier.unionByName(customer, allowMissingColumns=True)


@query("SELECT substr(c_name, 10) AS number_text, c_custkey FROM customer WHERE substr(c_name, 10) LIKE '0000001%'")
def prefix_filter(spark, sf):
    numbered = table(spark, sf, "customer").select(suffix_from(F.col("c_name"), 10).alias("number_text"), "c_custkey")
    return numbered.where(F.col("number_text").startswith("0000001"))
