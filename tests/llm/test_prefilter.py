"""The bitmap before exact joins."""

from pyspark.sql import functions as F

from tallyloom.llm import prefilter


def test_all_keys_and_few_others_pass(spark):
    keys = spark.range(0, 3000, 3).select((F.col("id") - 100).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("t"))
    rows = spark.range(3000).select((F.col("id") - 100).alias("k"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("t"))
    passed = {r["k"] for r in rows.where(prefilter.may_match(keys, ["k", "t"], "k", "t")).collect()}
    wanted = {r["k"] for r in keys.collect()}
    assert wanted <= passed and len(passed) < len(wanted) + 20
    assert rows.where(prefilter.may_match(keys.limit(0), ["k", "t"], "k", "t")).count() == 0
