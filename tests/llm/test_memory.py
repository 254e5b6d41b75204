"""Memory that steps over whole texts take in a task."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.llm import minhash, quality_model, secret_scan, texts, winnowing

FIELD = secret_scan.Field(np.zeros((secret_scan.SIZE + 1, 3)), np.zeros((3, 3)), np.zeros(3))
MARKS = np.zeros(1 << winnowing.BITS, bool)


def batch():
    """Four megabytes of text in a thousand rows."""
    r = random.Random(7)
    words = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(r.choices(words, k=620)) for _ in range(1000)]
    return pa.record_batch({"doc_id": pa.array(range(1000), pa.int64()), "key": pa.array([str(i) for i in range(1000)]), "text": pa.array(texts)})


@pytest.mark.parametrize(
    "run",
    [
        lambda b: secret_scan._mask_batches(b, FIELD, "x"),
        lambda b: secret_scan._scan_batches(b, FIELD),
        lambda b: quality_model._statistics_batches(b),
        lambda b: winnowing._document_batches(b, winnowing.WINDOW, MARKS, ()),
        lambda b: minhash._signature_batches(b, 5, 20, 8),
        lambda b: minhash._set_batches(b, 5),
    ],
    ids=["mask", "scan", "statistics", "prints", "signatures", "sets"],
)
def test_a_batch_of_whole_texts_takes_little_memory(run):
    rows = batch()
    list(run([rows.slice(0, 1)]))  # tables made once
    tracemalloc.start()
    try:
        n = sum(part.num_rows for part in run([rows]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == 1000 and peak < 48 << 20, peak


def test_a_large_cluster_takes_a_few_times_its_sets():
    """Near copies of one set, two blocks of sets in all, as one task gets them."""
    r = np.random.default_rng(3)
    base, sets = r.integers(0, 2**63, 600).astype(np.uint64), []
    for _ in range(3400):
        own = base.copy()
        own[r.integers(0, 600, 6)] = r.integers(0, 2**63, 6).astype(np.uint64)
        sets.append(np.unique(own))
    bits = np.zeros((len(sets), minhash.HASHES * minhash.BITS // 8), np.uint8)
    tracemalloc.start()
    try:
        found = minhash.link_forest(sets, bits, 80, -1.0)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(found) == len(sets) - 1 and peak < 80 << 20, peak


def test_hash_tables_stay_small_and_go_back():
    data = np.full(3 << 20, 97, np.uint8)
    starts = np.arange(0, len(data) - 8, 8)
    list(texts.hash_spans(data, starts, starts + 7))
    assert sum(x.nbytes for x in texts._powers) <= 4 << 20
    texts.give_back()
    assert not texts._powers
