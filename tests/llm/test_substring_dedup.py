"""Removal of repeated word runs against brute force and SQL."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import queries, substring_dedup
from tallyloom.session import BATCH_ROWS, by_batches
from tests.check_catalog import compare, database

ROW = "doc_id long, text string"


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[k : k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words):
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone[k : k + window] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def fresh(r, n):
    return [f"w{r.randrange(10**9)}" for _ in range(n)]


def planted(seed, docs=60, window=35):
    """Texts with passages around the threshold, shared, edited, cut off, overlapping and repeated inside one text."""
    r = random.Random(seed)
    passages = [fresh(r, n) for n in (window - 1, window, window + 1, 50, 120)]
    rows = []
    for i in range(docs):
        words = fresh(r, r.randint(0, 60))
        for _ in range(r.randint(0, 4)):
            p = list(r.choice(passages))
            low = r.randrange(len(p))
            p = p[low:] if r.random() < 0.4 else p[: low + 1] if r.random() < 0.4 else p
            if p and r.random() < 0.4:
                p[r.randrange(len(p))] = f"e{r.randrange(10**9)}"
            at = r.randint(0, len(words))
            words[at:at] = p
        rows.append((i, r.choice([" ", "\n", " \t "]).join(words)))
    return rows


def edge_rows():
    r = random.Random(4)
    base, long = " ".join(fresh(r, 90)), " ".join(fresh(r, 30_000))
    rows = [(100, None), (101, ""), (102, " \n\t"), (103, base), (104, base), (104, base), (None, base), (None, None), (105, base.replace(" ", "\x0b\f ")), (106, base + " tail")]
    rows += [(107, long), (108, long[: len(long) // 2]), (109, "same " * 500), (110, "same " * 34), (111, "same " * 36 + "é 中 😀"), (112, "a\xa0b \x1c c " * 40)]
    return rows


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, ROW).withColumns({c: F.lit("clash") for c in ("key", "spans", "gram", "kept", "anchors")})
    done = substring_dedup.remove_repeats(df, **options)
    return sorted((tuple(x) for x in done.drop("kept").collect()), key=repr)


@pytest.mark.parametrize("window,gram,block", [(35, 11, 5), (35, 35, 5), (12, 4, 3), (7, 1, 4)])
def test_equals_brute_force(spark, window, gram, block):
    rows = planted(window, 60, window) + edge_rows()
    assert found(spark, rows, window=window, gram=gram, block=block) == brute(rows, window)


def test_a_hot_line_in_different_surroundings(spark):
    """One line of 20 words in every text: no window repeats, and each context is extended on its own."""
    r = random.Random(8)
    line = fresh(r, 20)
    rows = [(i, " ".join([*fresh(r, 30), *line, *fresh(r, 30)])) for i in range(400)]
    rows += [(1000 + i, " ".join([*rows[i][1].split()[20:55], "end"])) for i in range(30)]
    assert found(spark, rows) == brute(rows, 35)


def test_kept_words_and_empty_table(spark):
    r = random.Random(9)
    shared = fresh(r, 40)
    df = spark.createDataFrame([(1, " ".join(["head", *shared, "tail"])), (2, " ".join(shared)), (3, "alone")], ROW)
    assert {x["doc_id"]: x["kept"] for x in substring_dedup.remove_repeats(df).collect()} == {1: "head tail", 2: "", 3: None}
    assert substring_dedup.remove_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        substring_dedup.remove_repeats(df, window=10, gram=11)


def test_smallest_is_the_last_of_equals():
    values = np.random.default_rng(1).integers(0, 5, 300).astype(np.uint64)
    for width in (1, 2, 3, 25, 300):
        want = [k + width - 1 - int(np.argmin(values[k : k + width][::-1])) for k in range(300 - width + 1)]
        assert substring_dedup.smallest_at(values, width).tolist() == want


def test_query_matches_sql_on_more_rows(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, database(folder), folder, queries.QUERIES["op11_substring_dedup"], queries.ORACLES["op11_substring_dedup"]) is None


def test_texts_reach_python_in_batches_of_bounded_rows(spark, monkeypatch):
    """Every step that sends whole texts to Python goes by bounded batches."""
    steps = []

    def seen(df, run, schema):
        steps.append(run)
        return by_batches(df, run, schema)

    anchored = substring_dedup._anchor_batches

    def counted(batches, **options):
        for batch in batches:
            assert batch.num_rows <= BATCH_ROWS
            yield from anchored([batch], **options)

    monkeypatch.setattr(substring_dedup, "by_batches", seen)
    monkeypatch.setattr(substring_dedup, "_anchor_batches", counted)
    shared = " ".join(f"s{k}" for k in range(40))
    docs = spark.range(0, 2500, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.lit(f" {shared}")).alias("text"))
    rows = substring_dedup.remove_repeats(docs).agg(F.count("*"), F.sum("n_removed")).first()
    assert tuple(rows) == (2500, 2500 * 40) and len(steps) == 3
