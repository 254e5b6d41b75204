"""What a plan carries through its shuffles and sorts, where it would grow faster than its input otherwise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.catalog import audit, bibliometrics, layouts

LINE = (
    "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, "
    "l_shipdate date, l_quantity double, l_discount double, l_extendedprice double"
)


@pytest.fixture
def folder(spark, tmp_path):
    day = dt.date(2024, 1, 2)
    lines = [(k, 1, k % 5, 1 + k % 2, "R", "O", day, 3.0, 0.01, 10.0) for k in range(60)]
    tables = {
        "lineitem": spark.createDataFrame(lines, LINE),
        "orders": spark.createDataFrame([(k, k % 3) for k in range(60)], "o_orderkey bigint, o_custkey bigint"),
        "customer": spark.createDataFrame([(0, "A", -5.0), (1, "B", 100.0), (2, None, 900.0)], "c_custkey bigint, c_name string, c_acctbal double"),
        "part": spark.createDataFrame([(k, "steel bolt" if k == 1 else None if k == 2 else "CHEQUE", k) for k in range(5)], "p_partkey bigint, p_name string, p_size int"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_pages_collect_lines_and_not_entries(spark, folder):
    pages = bibliometrics.paged_publication_lines(spark, folder)
    assert "collect_list(struct(l_orderkey," in "".join(optimized(pages))
    sizes = bibliometrics.publication_pages(spark, folder).select(F.size("`search-results`.entry").alias("n")).collect()
    assert sorted(r.n for r in sizes) == [24, 24]


def test_order_lines_are_joined_by_order_and_part_alone(spark, folder):
    rows = audit.order_lines_flagged(spark, folder)
    plan = optimized(rows)
    at = next(i for i, line in enumerate(plan) if "Relation" in line and "l_orderkey" in line)
    indent = lambda line: len(line) - len(line.lstrip(" :+-"))
    above, depth = 0, indent(plan[at])
    for line in reversed(plan[:at]):
        if indent(line) < depth:
            depth = indent(line)
            above += line.lstrip(" :+-").startswith("Join")
    assert above == 2
    found = {(r.cardholder, r.in_fps, r.in_rcm) for r in rows.collect()}
    assert found == {("A", True, True), ("B", False, True), (None, False, False)}
    assert {(r.merchant, r.in_dsc) for r in rows.collect()} == {("steel bolt", True), (None, False), ("CHEQUE", False)}


def test_drift_builds_its_lines_once(spark, folder, monkeypatch):
    counted, kind = [], type(spark.range(1))
    count = kind.count
    monkeypatch.setattr(kind, "count", lambda self: counted.append(self.columns) or count(self))
    assert {r.pages for r in layouts.page_drift(spark, folder).collect()} == {60}
    assert ["value"] not in counted
