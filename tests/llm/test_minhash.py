"""Forests of likely pairs and links inside a task, and the recall of links on all rows of a larger table."""

import random

import numpy as np
import pytest

from tallyloom.llm import minhash
from tallyloom.session import clear_scratch

DOCUMENTS = "/root/testdata/sf0.1/documents.parquet"


def parts(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(x) for x in range(n)]


def same_parts(a, b):
    return len(set(a)) == len(set(b)) == len(set(zip(a, b)))


def edited(seed, groups=8, copies=25):
    """Sets of near copies around the threshold, of subsets, of equal shares and of unrelated ones."""
    r = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        base = r.integers(0, 2**63, r.integers(5, 200)).astype(np.uint64)
        for _ in range(copies):
            kept = base[r.random(len(base)) > r.choice([0.0, 0.03, 0.1, 0.2])]
            fresh = r.integers(0, 2**63, r.integers(0, max(2, len(base) // 6))).astype(np.uint64)
            out.append(np.unique(np.concatenate([kept, fresh])) if len(kept) else np.unique(base))
    return out


@pytest.mark.parametrize("threshold", [50, 80, 85, 100])
def test_forests_join_what_all_pairs_join(threshold):
    sets = edited(threshold)
    bits = np.array([np.frombuffer(minhash.packed(minhash.minima(s)), np.uint8) for s in sets])
    sizes = np.array([len(s) for s in sets])
    links, likely = [], []
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * both >= threshold * (sizes[i] + sizes[j] - both):
                links.append((i, j))
            if 100 * min(sizes[i], sizes[j]) >= threshold * max(sizes[i], sizes[j]) and minhash.estimate(bits[i], bits[j]) >= 0.6:
                likely.append((i, j))
    found = minhash.link_forest(sets, bits, threshold, -1.0)
    assert set(found) <= {(b, a) for a, b in links} and same_parts(parts(len(sets), found), parts(len(sets), links))
    assert len(found) == len(sets) - len(set(parts(len(sets), links)))
    forest = minhash.likely_forest(bits, sizes, threshold, 0.6)
    assert same_parts(parts(len(sets), forest), parts(len(sets), likely)) and len(forest) < len(sets)


def test_links_are_the_same_however_many_sets_are_compared_at_once(monkeypatch):
    sets = edited(5)
    bits = np.array([np.frombuffer(minhash.packed(minhash.minima(s)), np.uint8) for s in sets])
    found = minhash.link_forest(sets, bits, 80, -1.0)
    monkeypatch.setattr(minhash, "COMPARED", 300)
    assert minhash.link_forest(sets, bits, 80, -1.0) == found and len(found) > 20


@pytest.mark.parametrize("size,threshold", [(3, 85), (5, 80)])
def test_no_link_of_a_twentieth_of_all_rows_is_lost(spark, size, threshold):
    """All links of the ids divisible by 20 with all rows, by comparing every pair of sets."""
    docs = spark.read.parquet(DOCUMENTS)
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, size, threshold).collect()}
    clear_scratch(spark)
    table = docs.select("doc_id", "text").toArrow()
    sets = [s for b in table.to_batches(max_chunksize=1000) for s in minhash.shingle_sets(b.column("text"), size)]
    ids, sizes = table.column("doc_id").to_numpy(), np.array([len(s) for s in sets])
    holders, token = np.repeat(np.arange(len(sets)), sizes), np.concatenate(sets)
    order = np.argsort(token, kind="stable")
    holders, token = holders[order], token[order]
    links = 0
    for x in np.flatnonzero((ids % 20 == 0) & (sizes > 0)).tolist():
        low, high = np.searchsorted(token, sets[x]), np.searchsorted(token, sets[x], side="right")
        both = np.bincount(np.concatenate([holders[a:b] for a, b in zip(low, high)]), minlength=len(sets))
        near = np.flatnonzero((both > 0) & (100 * both >= threshold * (sizes[x] + sizes - both)))
        links += len(near) - 1
        assert all(found[ids[y]] == found[ids[x]] for y in near.tolist())
    assert links > 200


def test_more_members_give_rows_in_proportion(spark):
    """A group of near copies that are mostly no links: rows given out stay below the number of members."""
    r = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(w if r.random() > 0.06 else f"e{r.randrange(10**9)}" for w in base)) for i in range(400)]
    steps = minhash.NearDuplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert steps.links().count() < len(rows)
    assert steps.clusters().count() <= len(rows)
