"""Plans that matter at scale."""

import contextlib
import io

from pyspark.sql import functions as F

from tallyloom.operators import quality, relational, rules, splits
from tallyloom.plans import bibliometrics
from tallyloom.sources import schemas
from tallyloom.sources.files import parse_json_lines


def plan(df, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def test_ranks_are_limited_before_the_shuffle(spark, tmp_path):
    spark.range(10).selectExpr("id % 3 AS holder", "id AS session", "id AS pos", "'s' AS shop", "id AS at").write.parquet(
        f"{tmp_path}/t"
    )
    df = spark.read.parquet(f"{tmp_path}/t")
    for limited in (relational.keep_first(df, ["holder"], ["pos"]), splits._first_leaders(df, 4, 60, splits.LARGEST_BATCH)):
        text = plan(limited, "simple")
        assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_stored_pages_are_read_by_field(spark, tmp_path):
    spark.createDataFrame([], schemas.PUBLICATION_PAGE).write.parquet(f"{tmp_path}/p")
    pages = spark.read.schema(schemas.PUBLICATION_PAGE).parquet(f"{tmp_path}/p")

    def scan(df):
        return next(line for line in plan(df).splitlines() if line.startswith("ReadSchema"))

    assert "dc:title" not in scan(bibliometrics.author_publications(bibliometrics.author_entries(pages)))
    assert "author" not in scan(bibliometrics.publications(pages))
    assert "dc:title" not in scan(bibliometrics.affiliation_publications(pages))


def test_lines_are_parsed_once(spark):
    lines = spark.createDataFrame([("{}",)], "value string")
    parsed = parse_json_lines(lines, schemas.PUBLICATION_PAGE).where(F.col("page").isNotNull()).select("page.*")
    text = parsed.transform(bibliometrics.publications)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(") == 1


def test_lookup_join_keeps_hot_facts_splittable(spark):
    facts, lookup = spark.range(9).selectExpr("id % 2 AS k", "id"), spark.range(3).selectExpr("id AS k", "id AS label")
    text = plan(relational.full_outer_lookup(facts, lookup, "k"), "simple")
    assert "FullOuter" not in text and "LeftOuter" in text


def test_variants_and_ties_use_hash_aggregates(spark, tmp_path):
    spark.range(20).selectExpr("id % 3 AS k", "cast(id % 2 AS string) AS v", "id AS o").write.parquet(f"{tmp_path}/v")
    df = spark.read.parquet(f"{tmp_path}/v")
    for result in (relational.variants(df, "k", "v"), relational.keep_ties(df, ["k"], ["v", "o"])):
        text = plan(result, "simple")
        assert "SortAggregate" not in text and "HashAggregate" in text


def test_a_reference_check_is_one_aggregate(spark):
    child, parent = spark.range(5).selectExpr("id % 2 AS c"), spark.range(3).selectExpr("id AS p")
    checked = quality.run_checks("t", child, [quality.refers_to({"c": "p"}, parent, "parent")])
    text = plan(checked, "simple")
    assert "Join" not in text and text.count("Exchange hashpartitioning") == 1


def test_lists_of_one_key_are_joined_once(spark):
    rows = spark.range(3).selectExpr("cast(id AS string) AS cardholder", "'m' AS merchant")
    lists = [spark.createDataFrame([("0",)], "entry string") for _ in range(3)]
    text = rules.with_list_flags(rows, *lists)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftOuter") == 2
