"""Incremental landing, bucketed and sorted tables, check states, drift and bitmaps."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tallyloom.catalog import layouts
from tallyloom.operators import bitmaps, quality, states
from tallyloom.sinks import landing, tables, versions
from tallyloom.sources import drift
from tallyloom.sources.schemas import LONG, TEXT, record

SMALL = "/root/testdata/sf0.001"


def write(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(path)


def values(df):
    return sorted(r["value"] for r in df.collect())


def test_every_file_lands_once(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/table"
    write(spark, source, ["a", "b"])
    for _ in range(2):
        assert values(landing.land(spark, source, target)) == ["a", "b"]
    for k in range(5):
        write(spark, source, [f"c{k}"])
    stored = landing.land(spark, source, target, files_per_batch=2)
    assert values(stored) == ["a", "b", *(f"c{k}" for k in range(5))]
    assert values(landing.land(spark, source, target)) == values(stored)
    assert stored.where("filename IS NULL").count() == 0


def test_a_failed_batch_is_repeated(spark, tmp_path):
    source, target = f"{tmp_path}/in", f"{tmp_path}/table"
    write(spark, source, ["1", "2"])
    landing.land(spark, source, target, lambda rows: rows.select(F.col("value").cast("int").alias("value")))
    write(spark, source, ["3", "x"])
    with pytest.raises(Exception, match="x"):
        landing.land(spark, source, target, lambda rows: rows.select(F.col("value").cast("int").alias("value")))
    fixed = landing.land(spark, source, target, lambda rows: rows.select(F.col("value").try_cast("int").alias("value")))
    assert sorted((r["value"] for r in fixed.collect()), key=str) == [1, 2, 3, None]


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_need_no_exchange(spark):
    names = layouts.bucketed_silver(spark, SMALL, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (layouts.document_report(spark, names), layouts.bucketed_orphan_rows(spark, names)):
            plan = executed(df)
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        files = spark.table(names["PUBLICATION"]).select("_metadata.file_name").distinct().count()
        assert files <= 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        layouts.drop_tables(spark, names)


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("condition", ["name = 'n0042000'", "startswith(name, 'n00420')", "code = 70001", "name = 'absent'"])
def test_lookups_skip_row_groups(spark, tmp_path, condition):
    rows = spark.range(200_000).select(
        F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("name"), (F.pmod(F.col("id") * 7919, F.lit(200_003)) * 3 + 1).alias("code"), F.sha2(F.col("id").cast("string"), 256).alias("filler")
    )
    path = f"{tmp_path}/sorted"
    tables.store_sorted(rows.repartition(3), path, ["name"], {"code": 200_000}, 1 << 20)
    stored = spark.read.schema(rows.schema).parquet(path)
    found = stored.where(condition)
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in rows.where(condition).collect()}
    assert scanned_rows(found) < 200_000 / 8


ITEM = record(k=LONG, name=TEXT, parent=LONG, run=TEXT)


def item_checks(spark):
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id long")
    return [quality.has_size(), quality.is_complete("name"), quality.is_unique("k"), quality.is_unique("k", "name"), quality.refers_to({"parent": "id"}, parent, "P")]


def test_checks_from_states_equal_a_full_check(spark, tmp_path):
    pick, checks, path = random.Random(1), item_checks(spark), f"{tmp_path}/states"
    runs = {run: [(pick.choice([None, *range(40)]), pick.choice([None, "a", "b"]), pick.choice([None, 1, 2, 3]), run) for _ in range(30)] for run in ("d1", "d2", "d/3")}
    as_rows = lambda df: sorted(tuple(r) for r in df.drop("message").collect())
    for run, rows in runs.items():
        states.store_state(spark.createDataFrame(rows, ITEM), path, run, checks)
    whole = spark.createDataFrame([r for rows in runs.values() for r in rows], ITEM)
    assert as_rows(states.checks_from_states(spark, "T", path, ITEM, checks)) == as_rows(quality.run_checks("T", whole, checks))
    runs["d2"] = [(1, "again", 1, "d2")]
    states.store_state(spark.createDataFrame(runs["d2"], ITEM), path, "d2", checks)
    whole = spark.createDataFrame([r for rows in runs.values() for r in rows], ITEM)
    assert as_rows(states.checks_from_states(spark, "T", path, ITEM, checks)) == as_rows(quality.run_checks("T", whole, checks))


def test_states_of_no_rows(spark, tmp_path):
    checks, path = item_checks(spark), f"{tmp_path}/states"
    empty = spark.createDataFrame([], ITEM)
    states.store_state(empty, path, "d1", checks)
    got = {r["constraint"]: (r["status"], r["n_rows"], r["n_bad"]) for r in states.checks_from_states(spark, "T", path, ITEM, checks).collect()}
    want = {r["constraint"]: (r["status"], r["n_rows"], r["n_bad"]) for r in quality.run_checks("T", empty, checks).collect()}
    assert got == want and got["Size"] == ("Failure", 0, 1)


def test_schema_of_a_sample_and_drift(spark):
    lines = spark.createDataFrame([('{"a": {"b": [{"c": 1, "odd name": "x"}]}, "n": null}',), ('{"a": {"b": []}, "d": 1.5}',), ("broken {",), ("",)], "value string")
    schema = drift.sample_schema(lines)
    assert drift.field_types(schema) == {"a": "object", "a.b": "object", "a.b.c": "bigint", "a.b.odd name": "string", "d": "decimal(2,1)", "n": "string"}
    declared = drift.sample_schema(spark.createDataFrame([('{"a": {"b": [{"c": "t", "gone": {"x": 1}}]}, "n": 1, "d": 2}',)], "value string"))
    rows = [tuple(r) for r in drift.field_drift(lines, declared).collect()]
    assert rows == [("a.b.odd name", "extra", "string"), ("a.b.gone", "missing", "object"), ("a.b.gone.x", "missing", "bigint")]
    assert drift.field_drift(lines, schema).count() == 0
    with pytest.raises(ValueError):
        drift.sample_schema(lines.where("value = ''"))


def test_bitmaps_count_distinct_ids(spark):
    pick = random.Random(3)
    rows = [(pick.randrange(4), pick.choice([None, pick.randrange(-70_000, 70_000), pick.randrange(100), 2**40 + pick.randrange(5)]), pick.random() < 0.5) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g int, k long, flag boolean")
    by_group = {r["g"]: r["n"] for r in bitmaps.count_ids(bitmaps.id_bitmaps(df, "k", ["g"]), ["g"]).collect()}
    assert by_group == {g: len({k for h, k, _ in rows if h == g and k is not None}) for g in range(4)}
    united = bitmaps.count_ids(bitmaps.unite(bitmaps.id_bitmaps(df, "k", ["g"]))).first()["n"]
    assert united == len({k for _, k, _ in rows if k is not None})
    both = bitmaps.distinct_where(df, "k", {"all": F.lit(True), "flagged": F.col("flag"), "none": F.lit(False)})
    assert tuple(both.first()) == (united, len({k for _, k, f in rows if f and k is not None}), 0)
    assert "Expand" not in executed(both)
    assert tuple(bitmaps.distinct_where(df.limit(0), "k", {"all": F.lit(True)}).first()) == (0,)


def current_run(spark, path, run):
    return versions.current(spark, tables._run_path(path, run), tables._run_place(path, run))


def test_compaction_leaves_compact_runs_alone(spark, tmp_path):
    path = f"{tmp_path}/runs"
    rows = spark.range(200).select("id", F.concat(F.lit("d"), F.col("id") % 3).alias("run_date"))
    tables.refresh_run(rows.repartition(1), path, ["d0", "d1", "d2"])
    tables.refresh_run(rows.where("run_date <> 'd0'").repartition(9), path, ["d1", "d2"])
    before = {run: current_run(spark, path, run) for run in ("d0", "d1", "d2")}
    assert tables.compact(spark, path, rows.schema) == ["d1", "d2"]
    after = {run: current_run(spark, path, run) for run in before}
    assert after["d0"] == before["d0"] and after["d1"] != before["d1"]
    assert re.sub("_run=.*", "", after["d1"]) == re.sub("_run=.*", "", after["d2"])
    assert tables.compact(spark, path, rows.schema) == []
    stored = tables.read_runs(spark, path, rows.schema)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, rows.collect()))
    assert stored.groupBy("run_date").agg(F.count_distinct("_metadata.file_path").alias("n")).where("n > 1").count() == 0


def test_rows_stay_where_they_are_written(spark, tmp_path):
    path = f"{tmp_path}/runs"
    rows = spark.createDataFrame([(1, "a=b/c %"), (2, "ü")], "v int, run_date string")
    tables.refresh_run(rows, path, ["a=b/c %", "ü", "none"])
    assert tables.stored_runs(spark, path) == sorted(["a=b/c %", "ü", "none"])
    assert [r["v"] for r in tables.read_runs(spark, path, rows.schema, ["ü"]).collect()] == [2]
    assert tables.read_runs(spark, path, rows.schema, ["none"]).count() == 0
    folders = {current_run(spark, path, run).split("/_run=")[0] for run in ("a=b/c %", "ü", "none")}
    assert len(folders) == 1 and folders.pop().startswith(f"{path}/batch-")
