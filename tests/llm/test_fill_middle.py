"""Fill-in-middle against plain string operations, and its boundary sets against sorted lists."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import fill_middle as fim
from tallyloom.llm import queries
from tests.check_catalog import compare, database

ROW = "doc_id long, text string"


def direct(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:low], text[low:high], text[high:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}"


def texts():
    r = random.Random(3)
    odd = ["a", "é", "中", "😀", "\n", "\x00", "<", "P>"]
    out = [None, "", "a", "😀", "has <P> in it", "<M>", "x" * 70_000, "é" * 70_000, "ab中" * 60_000, "plain ascii " * 100_000]
    out += ["".join(r.choice(odd) for _ in range(r.randint(1, 200))) for _ in range(150)]
    return out


def test_equals_string_operations(spark):
    rows = [*enumerate(texts()), (None, "text without id"), (7, "é" * 70_000), (7, "é" * 70_000)]
    df = spark.createDataFrame(rows, ROW).withColumns({c: F.lit("clash") for c in ("n", "form", "h1", "output")})
    got = fim.fill_in_middle(df)
    found = sorted(([r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]] for r in got.collect()), key=repr)
    assert found == sorted(([i, *direct(i, t)] for i, t in rows), key=repr)
    assert {r["form"] for r in got.collect()} == {"plain", "psm", "spm"}
    by_text = {(r["output_sha256"], r["restored_sha256"]) for r in got.collect()}
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert by_text == {(sha(direct(i, t)[4]), sha(t)) for i, t in rows}
    assert fim.fill_in_middle(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["run", "array", "bitmap", "mixed"])
def test_select_in_every_container(kind):
    r = random.Random(5)
    text = {"run": "a" * 150_000, "array": "😀" * 4000 + "a" * 3, "bitmap": "".join(r.choice("aé") for _ in range(100_000)), "mixed": "a" * 70_000 + "中" * 30_000 + "".join(r.choice("aé😀") for _ in range(60_000))}[kind]
    raw = np.frombuffer(text.encode(), np.uint8)
    points = fim.Boundaries(raw)
    want = np.concatenate([[0], np.cumsum([len(c.encode()) for c in text])])
    assert points.size == len(want)
    for k in [0, 1, len(text) - 1, len(text), *(r.randint(0, len(text)) for _ in range(2000))]:
        assert points.select(k) == want[k]
    names = {type(c).__name__ for c in points.containers}
    assert names >= {"run": {"RunContainer"}, "array": {"ArrayContainer"}, "bitmap": {"BitmapContainer"}, "mixed": {"RunContainer", "BitmapContainer"}}[kind]
    with pytest.raises(IndexError):
        points.select(len(text) + 1)


def test_query_matches_sql_on_more_rows(spark):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, database(folder), folder, queries.QUERIES["op12_fill_in_middle"], queries.ORACLES["op12_fill_in_middle"]) is None
