"""What jobs that land pages and store tables leave on disk while they run."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from tallyloom.catalog import layouts, storage
from tallyloom.session import SHUFFLE_SETTING, shuffles_removed

LINE = (
    "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, "
    "l_shipdate date, l_quantity double, l_discount double"
)


@pytest.fixture
def folder(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    lines = [(k, 7 if k % 10 == 3 else 1, k % 5, 1 + k % 2, "R" if k % 2 else "N", "O", day, 3.0, 0.01) for k in range(60)]
    tables = {
        "lineitem": spark.createDataFrame(lines, LINE),
        "orders": spark.createDataFrame([(k, k % 3, day) for k in range(60)], "o_orderkey bigint, o_custkey bigint, o_orderdate date"),
        "supplier": spark.createDataFrame([(1, "one", 5), (2, "two", 6)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "part": spark.createDataFrame([(k, f"steel {k}") for k in range(5)], "p_partkey bigint, p_name string"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    """Where the catalog's queries write."""
    for module in (storage, layouts):
        monkeypatch.setattr(module, "scratch_path", lambda spark, label: f"{tmp_path}/scratch/{label}-1")
    return f"{tmp_path}/scratch"


def part_files(base):
    found = [f"{d}/{name}" for d, _, names in os.walk(base) for name in names if name.startswith("part-")]
    assert found
    return found


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("run", [storage.published_tables, storage.bibliometric_run])
def test_a_run_keeps_landed_text_and_tables_compressed(spark, folder, scratch, run):
    found = rows(run(spark, folder))
    if run is storage.published_tables:
        assert found == sorted((str(k), 2, sum((k % 3 + i) % 5 for i in range(4))) for k in range(60) if k % 5)
    else:
        assert len(found) == 40 and ("AUTHOR_PUBLICATION", "Size", 96, 0) in found and ("metrics", "Completeness(page)", 60, 0) in found
    landed, stored = part_files(f"{scratch}/run-1/landing"), part_files(f"{scratch}/run-1/lake")
    assert all(f.endswith(".gz") for f in landed) and all(f.endswith(".zstd.parquet") for f in stored)


ENTRIES = [("N", 24), ("R", 24)]


@pytest.mark.parametrize(
    ("run", "pages", "expected"),
    [
        (layouts.json_from_sample, "sampled-1/pages", ENTRIES),
        (storage.json_directory, "pages-1", ENTRIES),
        (storage.text_lines, "lines-1", [(60, 6, 42, True)]),
        (layouts.landed_pages, "landing-1/pages", sorted((f"SCOPUS_ID:{k}", f"2-s2.0-{k % 5}", "second" if k % 2 else "first") for k in range(60) if k % 5)),
    ],
)
def test_pages_lie_compressed(spark, folder, scratch, run, pages, expected):
    assert rows(run(spark, folder)) == expected
    assert all(f.endswith(".gz") for f in part_files(f"{scratch}/{pages}"))


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def test_shuffles_go_with_their_write(spark, tmp_path):
    before, setting = shuffle_files(spark), spark.conf.get(SHUFFLE_SETTING)
    counts = spark.range(1000).repartition(3).groupBy(F.col("id") % 7).agg(F.count(F.lit(1)).alias("n"))
    with pytest.raises(ValueError, match="stop"), shuffles_removed(spark):
        counts.write.parquet(f"{tmp_path}/counts")
        until = time.time() + 20
        while shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.2)
        assert not shuffle_files(spark) - before
        raise ValueError("stop")
    assert spark.conf.get(SHUFFLE_SETTING) == setting
    assert spark.read.parquet(f"{tmp_path}/counts").agg(F.sum("n")).first()[0] == 1000


def test_buckets_are_as_many_as_shuffle_partitions_and_pages_made_once(spark, folder, monkeypatch):
    made, make = [], layouts.bibliometrics.publication_pages
    monkeypatch.setattr(layouts.bibliometrics, "publication_pages", lambda *a: made.append(a) or make(*a))
    names = layouts.bucketed_silver(spark, folder)
    try:
        details = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {names['PUBLICATION']}").collect()}
        assert details["Num Buckets"] == spark.conf.get("spark.sql.shuffle.partitions")
        assert len(made) == 1
        assert rows(layouts.document_report(spark, names)) == sorted((str(k), 2, sum((k % 3 + i) % 5 for i in range(4))) for k in range(60) if k % 5)
    finally:
        layouts.drop_tables(spark, names)
