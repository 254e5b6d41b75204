import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import quality
from tallyloom.operators.relational import keep_first, number_rows, variants
from tallyloom.operators.reshape import explode_parallel
from tallyloom.plans import bibliometrics, samples
from tallyloom.sinks import snapshots, tables, versions
from tallyloom.sources import files, schemas


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_required_columns_are_enforced_while_writing(spark, tmp_path):
    schema = schemas.AFFILIATION_PUBLICATION
    good = spark.createDataFrame([("a", 1), ("b", 2)], "AFFILIATION_ID string, DOCUMENT_ID int")
    stored = tables.refresh(good, f"{tmp_path}/t", schema)
    assert rows(stored) == [("1", "a"), ("2", "b")]
    bad = spark.createDataFrame([("a", None)], "AFFILIATION_ID string, DOCUMENT_ID int")
    with pytest.raises(Exception, match="DOCUMENT_ID must not be NULL"):
        tables.refresh(bad, f"{tmp_path}/t", schema)
    assert rows(tables.read_current(spark, f"{tmp_path}/t", stored.schema)) == [("1", "a"), ("2", "b")]
    with pytest.raises(ValueError, match="columns missing"):
        tables.conform(good.drop("AFFILIATION_ID"), schema)


def test_refresh_may_read_its_own_table(spark, tmp_path):
    path = f"{tmp_path}/self"
    schema = spark.range(5).schema
    tables.refresh(spark.range(5), path)
    for low in (1, 2, 3):
        tables.refresh(tables.read_current(spark, path, schema).where(f"id >= {low}"), path)
    assert rows(tables.read_current(spark, path, schema)) == [(3,), (4,)]
    assert len(versions.children(spark, path)) == versions.KEPT
    with pytest.raises(LookupError):
        tables.read_current(spark, f"{tmp_path}/other", schema)


def test_rerun_of_a_dated_run_does_not_duplicate(spark, tmp_path):
    path = f"{tmp_path}/runs"
    both = spark.createDataFrame([(1, "d1"), (2, "d/2 x")], "v int, run_date string")
    tables.refresh_run(both, path, ["d1", "d/2 x"])
    again = spark.createDataFrame([(3, "d/2 x")], both.schema)
    tables.refresh_run(again, path, ["d/2 x"])
    assert rows(tables.refresh_run(again, path, ["d/2 x"])) == [(1, "d1"), (3, "d/2 x")]
    assert rows(tables.refresh_run(both.limit(0), path, ["d1"])) == [(3, "d/2 x")]
    assert tables.stored_runs(spark, path) == ["d/2 x", "d1"]
    with pytest.raises(Exception, match="row of another run: d1"):
        tables.refresh_run(both, path, ["d/2 x"])
    assert rows(tables.read_runs(spark, path, both.schema)) == [(3, "d/2 x")]


def test_compaction_keeps_rows_and_layout(spark, tmp_path):
    path, runs = f"{tmp_path}/small", f"{tmp_path}/runs"
    small = spark.range(100).repartition(20)
    tables.refresh(small, path)
    tables.compact(spark, path, small.schema)
    table = tables.read_current(spark, path, small.schema)
    assert table.count() == 100 and table.select("_metadata.file_name").distinct().count() == 1
    dated = small.withColumn("run_date", F.concat(F.lit("d"), F.col("id") % 2))
    tables.refresh_run(dated, runs, ["d0", "d1"])
    tables.compact(spark, runs, dated.schema)
    kept = tables.refresh_run(dated.where("run_date = 'd1' AND id < 10"), runs, ["d1"])
    assert kept.where("run_date = 'd0'").count() == 50 and kept.where("run_date = 'd1'").count() == 5
    assert kept.where("run_date = 'd0'").select("_metadata.file_name").distinct().count() == 1
    spark.range(3).write.parquet(f"{tmp_path}/plain")
    with pytest.raises(LookupError, match="no refreshed or dated table"):
        tables.compact(spark, f"{tmp_path}/plain", small.schema)


def test_crash_between_write_and_commit_leaves_the_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    tables.refresh(spark.range(3), path)
    tables.publish(spark, {"a": spark.range(1), "b": spark.range(2)}, f"{tmp_path}/gold")

    def crash(*_):
        raise OSError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "commit", crash)
        with pytest.raises(OSError):
            tables.refresh(spark.range(9), path)
        with pytest.raises(OSError):
            tables.publish(spark, {"a": spark.range(8), "b": spark.range(8)}, f"{tmp_path}/gold")
    schema = spark.range(1).schema
    assert tables.read_current(spark, path, schema).count() == 3
    assert [tables.read_published(spark, f"{tmp_path}/gold", n, schema).count() for n in "ab"] == [1, 2]
    assert tables.refresh(spark.range(4), path).count() == 4


def test_declared_table_and_results_path(spark, tmp_path):
    tables.create_table(spark, "sector_decl", schemas.SECTOR, f"{tmp_path}/sector")
    tables.create_table(spark, "sector_decl", schemas.SECTOR)
    assert spark.table("sector_decl").schema.names == schemas.SECTOR.names
    assert tables.results_path("a.b/c.csv") == "a.b/c_results.csv"
    saved = tables.save_results(spark.range(2), f"{tmp_path}/in.parquet")
    assert saved.endswith("in_results.parquet") and spark.read.parquet(saved).count() == 2
    spark.sql("DROP TABLE sector_decl")


def test_gate(spark, tmp_path):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    results = quality.run_checks("t", df, [quality.has_size(), quality.is_complete("k"), quality.is_unique("k")])
    got = {r.constraint: (r.status, r.n_rows, r.n_bad) for r in results.collect()}
    assert got == {"Size": ("Success", 3, 0), "Completeness(k)": ("Failure", 3, 1), "Uniqueness(k)": ("Failure", 2, 2)}
    with pytest.raises(quality.ChecksFailed, match="1 of 3 rows"):
        tables.publish(spark, {"t": df}, f"{tmp_path}/gold", results)
    assert not (tmp_path / "gold").exists()
    paths = tables.publish(spark, {"t": df}, f"{tmp_path}/gold", results, gate=False, renames={"t": "u"})
    assert spark.read.parquet(paths["u"]).count() == 3


def test_checks_on_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    checks = [quality.has_size(), quality.is_unique("k"), quality.refers_to({"k": "k"}, parent, "p")]
    got = {r.constraint: (r.status, r.n_rows) for r in quality.run_checks("e", empty, checks).collect()}
    assert got == {"Size": ("Failure", 0), "Uniqueness(k)": ("Success", 0), "Reference(k -> p)": ("Success", 0)}


def test_snapshots(spark, tmp_path):
    path = f"{tmp_path}/versions"
    with pytest.raises(LookupError):
        snapshots.read_as_of(spark, path, dt.datetime(2020, 1, 1))
    snapshots.commit(spark.range(3), path, "CREATE", dt.datetime(2021, 1, 1))
    snapshots.update(spark, path, {"id": F.lit(9).cast("bigint")}, dt.datetime(2021, 1, 2))
    assert rows(snapshots.read_as_of(spark, path, dt.datetime(2021, 1, 1, 12))) == [(0,), (1,), (2,)]
    assert rows(snapshots.read_version(spark, path)) == [(9,)] * 3
    assert rows(snapshots.history(spark, path).select("version", "operation", "n_rows")) == [(0, "CREATE", 3), (1, "UPDATE", 3)]
    spark.range(1).write.parquet(f"{path}/version=2")
    assert snapshots.read_version(spark, path).count() == 3
    with pytest.raises(LookupError):
        snapshots.read_version(spark, path, 2)


def test_csv_header_must_match(spark, tmp_path):
    path = f"{tmp_path}/c"
    spark.createDataFrame([("1999", "3")], "YEAR_LBL string, ACKNOWLEDGEMENTS string").write.option("header", True).csv(path)
    assert rows(files.read_csv(spark, path, schemas.ACKNOWLEDGEMENTS_BY_YEAR)) == [("1999", "3")]
    with pytest.raises(Exception):
        files.read_csv(spark, path, schemas.texts(["OTHER", "ACKNOWLEDGEMENTS"])).collect()


def test_malformed_json_is_reported_not_guessed(spark):
    schema = schemas.record(id=schemas.TEXT)
    lines = spark.createDataFrame([('{"id": "1"}',), ('{"id": "2"',), ("",), ("[]",), ('{"other": 1}',)], "value string")
    parsed = files.parse_json_lines(lines, schema)
    assert [r.id for r in parsed.where("page IS NOT NULL").select("page.id").collect()] == ["1", None]
    assert rows(files.malformed_lines(parsed).select("value")) in ([("[]",), ('{"id": "2"',)], [('{"id": "2"',)])


def test_sheet_block(spark, tmp_path):
    (tmp_path / "s.csv").write_text('t\n\n"multi\nline",x\nhead\nskip,a,"1\n2","q ""z"""\r\n,,,\n\nskip,b,,5" pipe\n')
    block = files.read_block(spark, f"{tmp_path}/s.csv", ["k", "m", "n"], first_row=5, first_column=2)
    assert [tuple(r)[1:] for r in block.orderBy("row").collect()] == [
        (5, "a", "1\n2", 'q "z"'),
        (8, "b", None, '5" pipe'),
    ]


def test_jdbc_options():
    assert files.jdbc_options("u", "t", ("id", 0, 10, 4), user="me") == {
        "url": "u", "dbtable": "t", "user": "me", "partitionColumn": "id", "lowerBound": "0", "upperBound": "10", "numPartitions": "4",
    }


def test_run_selection(spark):
    df = spark.createDataFrame([("1", "d1"), ("2", "d1"), ("1", "d2")], "id string, run_date string")
    assert files.run_rows(df, "d1").count() == 2
    assert rows(files.run_rows(df, "d1", "test", "id", "1")) == [("1", "d1")]
    with pytest.raises(ValueError):
        files.run_rows(df, "d1", "other")


def test_pandas_bridge(spark):
    frame = files.head_as_pandas(spark.range(10), 3)
    assert len(frame) == 3
    assert files.from_pandas(spark, frame, "id bigint").count() == 3


def test_dedup_and_numbers_ignore_partitioning(spark):
    df = spark.range(200).select((F.col("id") % 7).alias("k"), (F.col("id") % 13).alias("a"), "id")
    first = [rows(keep_first(df.repartition(n), ["k"], ["a"])) for n in (1, 4, 64)]
    assert first[0] == first[1] == first[2]
    numbered = [rows(number_rows(df.repartition(n), ["a", "k"], "n", start=1)) for n in (1, 64)]
    assert numbered[0] == numbered[1]
    assert sorted(r[-1] for r in numbered[0]) == list(range(1, 201))


def test_missing_value_is_a_variant(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (2, "b"), (3, None), (4, "x"), (4, "y")], "k int, v string")
    assert {r.k for r in variants(df, "k", "v").collect()} == {1, 4}


def test_parallel_arrays_of_unequal_length(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [1])], "k int, x array<string>, y array<int>")
    arrays = {"x": F.col("x"), "y": F.col("y")}
    with pytest.raises(Exception, match="differ in length"):
        explode_parallel(df, [F.col("k")], arrays).collect()
    assert rows(explode_parallel(df, [F.col("k")], arrays, strict=False)) == [(1, "a", 1), (1, "b", None)]


def test_names_with_several_sectors(spark):
    df = spark.createDataFrame([(1, "Forest and Land"), (2, "Iceland"), (3, "x"), (4, None)], "AFFILIATION_ID int, AFFILIATION_NM string")
    assert rows(bibliometrics.affiliation_sectors(df)) == [(1, 1), (1, 2), (2, 2), (3, 3), (4, 3)]


def test_empty_pages_and_missing_sources(spark):
    pages = spark.createDataFrame([((("0", []),))], schemas.AFFILIATION_PAGE)
    assert bibliometrics.affiliations(pages).count() == 0
    doc = spark.createDataFrame(
        [("1", [("citation", [("a", 5, None), ("b", 7, [("s", 1), ("t", 2)])])])], schemas.METRIC_DOCUMENT
    )
    flat = bibliometrics.impact_flat(doc)
    assert flat.count() == 3
    assert rows(bibliometrics.impact_metrics(doc)) == [("1", "citation", "a", 5), ("1", "citation", "b", 7)]
    assert rows(bibliometrics.impact_sources(flat)) == [("1", "citation", "b", "s", 1), ("1", "citation", "b", "t", 2)]


def test_samples_on_two_sheets(spark):
    names = ["Sample ID", "Project Name", "Material Type", "Lithology", "Zone", "Borehole"]
    quoted = ", ".join(f"`{n}` string" for n in names)
    one = spark.createDataFrame([("S1", "P", "m", "l", "z", "b", "1700.9")], f"{quoted}, `AR-Fe_mg/kg` string")
    two = spark.createDataFrame([("S1", "P", "m", "l", "z", "b", None), (None, *"Pmlzb", "9")], f"{quoted}, pH string")
    sheets = files.stack_sheets(
        [one.withColumn("Sample Type", F.lit("A")), two.withColumn("Sample Type", F.lit("B"))]
    )
    long = samples.sample_results(sheets)
    assert long.columns == schemas.SAMPLE_RESULT.names
    assert long.count() == 4
    assert rows(long) == rows(samples.rejoined_results(sheets))
    assert samples.rejoined_results(sheets, by_sheet=False).count() == 8
    assert samples.results_above(long, "A", "AR-Fe_mg/kg", 1700).count() == 1
    assert samples.sample_checks(sheets).first().status == "Success"
