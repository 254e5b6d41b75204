"""Decontamination where fingerprints repeat inside texts and are common to many."""

import random
from collections import Counter

import numpy as np
import pytest

from tallyloom.llm import winnowing
from tests.llm.test_llm import brute_contamination, prose

ROW, ITEM = "doc_id long, text string", "item_id string, text string"


def found(spark, docs, items):
    done = winnowing.contamination(spark.createDataFrame(docs, ROW), spark.createDataFrame(items, ITEM)).collect()
    return {r["doc_id"]: tuple(r)[1:] for r in done}


def test_equal_words_in_a_row(spark):
    docs = [(1, "same " * 20_000), (2, "same " * 12), (3, "x " + "same " * 40 + "y"), (4, prose(50, 3)), (5, ("a b " * 3000))]
    items = [("p", "same " * 20_000), ("q", "same " * 20), ("r", "b a " * 500), ("s", "same")]
    assert found(spark, docs, items) == brute_contamination(docs, items)
    steps = winnowing.Hits(spark.createDataFrame(docs, ROW), spark.createDataFrame(items, ITEM))
    assert steps.hits.count() <= 3 * sum(len(t.split()) for _, t in docs)


def test_a_passage_common_to_many_items_and_texts(spark):
    """1,000 items and 2,000 texts share a preamble: rows grow with both, not with their product."""
    preamble = prose(40, 77)
    items = [(f"i{k}", f"{preamble} {prose(20, 1000 + k)}") for k in range(1000)]
    docs = [(k, f"{prose(30, 5000 + k)} {preamble} {prose(10, 9000 + k)}") for k in range(2000)]
    docs += [(2000 + k, items[k][1] + " and more") for k in range(20)]
    assert found(spark, docs, items) == brute_contamination(docs, items)
    steps = winnowing.Hits(spark.createDataFrame(docs, ROW), spark.createDataFrame(items, ITEM))
    assert steps.hits.count() < 60 * len(docs)
    assert steps.item_windows.count() < 60 * len(items)


def test_items_of_one_text_and_without_ids(spark):
    text, other = prose(30, 8), prose(30, 9)
    items = [("a", text), ("b", text), ("b", text), (None, text), (None, other), ("é", "only this"), ("z", "only this")]
    docs = [(1, text), (2, other), (3, "well only this, then"), (4, text + " " + other), (5, None), (None, text)]
    want = brute_contamination(docs, items)
    assert found(spark, docs, items) == want and want[2][1] == 30 and want[2][2] == 0 and want[1][2] == 2


@pytest.mark.parametrize("n", [0, 12, 13, 40])
def test_windows_around_places(n):
    r = random.Random(n)
    places = np.array(sorted(r.sample(range(max(1, n - 6)), min(3, max(0, n - 6)))), np.int64)
    want = [s for s in range(n - 12) if any(s <= p and p + 7 <= s + 13 for p in places.tolist())]
    assert winnowing.around(places, n).tolist() == want


def test_every_shared_window_has_a_common_fingerprint():
    r = np.random.default_rng(4)
    words = r.integers(0, 6, 4000).astype(np.uint64)
    kept = dict(zip(*(x.tolist() for x in winnowing.kept_grams(words, np.array([0, len(words)]))[::-1])))
    seen = Counter()
    for s in range(len(words) - 12):
        prints = frozenset((p - s, h) for p, h in kept.items() if s <= p <= s + 6)
        window = tuple(words[s : s + 13].tolist())
        seen[window] += 1
        assert prints
