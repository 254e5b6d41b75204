from types import SimpleNamespace

import pyarrow as pa
import pytest

from tallyloom.session import BATCH_BYTES, BATCH_ROWS, BATCH_SETTING, BYTES_SETTING, by_batches, shared_folder


def session(master, named=None):
    """What ``shared_folder`` asks of a session; no test starts a cluster."""
    context = SimpleNamespace(master=master, applicationId="app", getCheckpointDir=lambda: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: named if key == "spark.checkpoint.dir" else default))


@pytest.mark.parametrize("folder", ["file:///shared/kept", "/shared/kept", "hdfs://store/kept/"])
def test_a_named_folder_is_taken_on_a_cluster(folder):
    assert shared_folder(session("spark://head:7077", folder)) == folder.rstrip("/")


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_folder(session("spark://head:7077"))


def _sizes(batches):
    for batch in batches:
        yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64())})


@pytest.mark.parametrize("given,most", [("10000", BATCH_ROWS), ("0", BATCH_ROWS), ("-1", BATCH_ROWS), ("300", 300)])
def test_texts_go_to_python_in_small_batches(spark, given, most):
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, given)
    try:
        sizes = [r.n for r in by_batches(spark.range(0, 2500, 1, 1), _sizes, "n long").collect()]
    finally:
        spark.conf.set(BATCH_SETTING, before)
    assert max(sizes) == most and sum(sizes) == 2500


def _bytes(batches):
    for batch in batches:
        yield pa.record_batch({"n": pa.array([batch.num_rows], pa.int64()), "size": pa.array([batch.nbytes], pa.int64())})


@pytest.mark.parametrize("given,most", [("67108864b", BATCH_BYTES), ("64MB", BATCH_BYTES), ("300k", 300 << 10)])
def test_long_texts_go_to_python_in_batches_of_few_bytes(spark, given, most):
    before = spark.conf.get(BYTES_SETTING)
    spark.conf.set(BYTES_SETTING, given)
    try:
        texts = spark.range(0, 500, 1, 1).selectExpr("repeat(chr(97 + id % 26), 20000) text")
        rows = by_batches(texts, _bytes, "n long, size long").collect()
    finally:
        spark.conf.set(BYTES_SETTING, before)
    assert sum(r.n for r in rows) == 500 and max(r.size for r in rows) < most + 40000
