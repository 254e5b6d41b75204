"""Benchmark decontamination by winnowed fingerprints.

A span shared by a document and a benchmark item counts from 13 consecutive words. Texts are fingerprinted by
hashes of 7 words of which the smallest in every 7 consecutive ones is kept, so any 13
shared words share a kept fingerprint at the same place. Items of fewer words are fingerprinted whole.

1. Items are fingerprinted and stored; a bitmap of fixed size (``BITS``) marks their fingerprints.
2. One pass over the documents keeps only fingerprints that the bitmap marks. The bitmap only spares
   work: with a large benchmark it fills up and more fingerprints reach the join, with the same result.
3. Kept fingerprints of distinct texts are joined with those of the items as a semi join: a place of a text stays or goes, once,
   however often its fingerprint occurs among the items.
4. Each place that stays is extended to the windows of 13 words around it (or the short item's words), which are looked up among the
   items' windows, again one row for each. Windows found are hits; overlapping ones unite.
5. Windows that the same items have share one item set, and texts that meet the same sets share one list of items. So a
   passage that many items and texts have in common is listed once, and not once for each pair of them.

Texts are identified by checksum, so copies are extended once and every row gets its text's result. Windows are equal if their
64-bit hashes are. Only windows around an equal fingerprint are looked up: of 10**9 such windows among 10**9 windows of items
0.05 are expected to be taken for another one. Item sets and lists have 128 bits.

Defined results: a missing or empty text has no words, no hits and is not contaminated; a missing or empty item
is in nothing; an item without an id marks words but is not listed; rows of the same item id count as one
item; other columns are ignored; empty tables give no rows or no hits.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import NARROW_BYTES, byte_table, grams, hash_spans, mix, runs, signed, sliced, utf8
from tallyloom.session import by_batches, materialize

WINDOW = 13
GRAM = 7
BITS = 22

_values, _inside = byte_table(True, bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words after lower-casing A-Z, and each row's bounds among them."""
    data, bounds = utf8(column)
    data = _values[data]
    starts, ends, own = runs(_inside[data], bounds)
    return hash_spans(data, starts, ends), own


def kept_grams(words: np.ndarray, bounds: np.ndarray, window: int = WINDOW, size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Winnowed gram hashes of all rows of at least ``window`` words, and their word positions in the batch."""
    hashes, span = grams(words, size), window - size + 1
    count = len(hashes) - span + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    best, at = hashes[:count].copy(), np.zeros(count, np.int8)
    for k in range(1, span):
        later = hashes[k : k + count]
        better = later <= best
        best = np.where(better, later, best)
        at[better] = k
    inside = np.ones(count, bool)
    for bound in range(1, window):  # windows that reach into the next row
        cut = bounds[1:-1] - bound
        inside[cut[(cut >= 0) & (cut < count)]] = False
    chosen = np.unique((np.arange(count) + at)[inside])
    return hashes[chosen], chosen


def whole_grams(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``size`` words inside a row, apart from those of other sizes."""
    hashes = grams(words, size)
    inside = np.ones(len(hashes), bool)
    for bound in range(1, size):
        cut = bounds[1:-1] - bound
        inside[cut[(cut >= 0) & (cut < len(hashes))]] = False
    return mix(hashes[inside] + np.uint64(size)), np.flatnonzero(inside)


PRINTS = "array<struct<print: bigint, place: int, size: smallint>>"


def _prints(hashes: np.ndarray, places: np.ndarray, sizes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Fingerprints as a list of (print, place in the row, words of the short item or 0) for each row; places ascend."""
    own = np.searchsorted(places, bounds)
    row = np.repeat(bounds[:-1], np.diff(own))
    items = pa.StructArray.from_arrays([pa.array(signed(hashes)), pa.array((places - row).astype(np.int32)), pa.array(sizes.astype(np.int16))], ["print", "place", "size"])
    return pa.ListArray.from_arrays(pa.array(own.astype(np.int32)), items)


def _lists(hashes: list[np.ndarray]) -> pa.Array:
    sizes = [len(h) for h in hashes]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(signed(np.concatenate([np.zeros(0, np.uint64), *hashes]))))


def _item_batches(batches, window: int):
    """Fingerprints and windows of every item; a short item is one window and its own fingerprint."""
    for batch in sliced(batches):
        words, bounds = word_hashes(batch.column("text"))
        prints, windows = [], []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own, ends = words[low:high], np.array([0, high - low])
            size = min(window, len(own))
            windows.append(np.unique(whole_grams(own, ends, size)[0]) if size else words[:0])
            prints.append(np.unique(kept_grams(own, ends, window)[0]) if size == window else windows[-1])
        yield pa.record_batch({
            "item_id": batch.column("item_id"), "n": pa.array(np.diff(bounds).astype(np.int32)), "prints": _lists(prints), "windows": _lists(windows),
        })


def _document_batches(batches, window: int, marks: np.ndarray, short: tuple[int, ...]):
    for batch in sliced(batches, limit=NARROW_BYTES):
        words, bounds = word_hashes(batch.column("text"))
        found = [(*kept_grams(words, bounds, window), 0), *((*whole_grams(words, bounds, size), size) for size in short)]
        hashes, places = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        sizes = np.repeat([size for *_, size in found], [len(h) for h, *_ in found])
        marked = marks[(hashes >> np.uint64(64 - BITS)).astype(np.int64)]
        hashes, places, sizes = hashes[marked], places[marked], sizes[marked]
        order = np.argsort(places, kind="stable")
        hit = np.diff(np.searchsorted(places[order], bounds)) > 0
        raw = words.tobytes()
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "key": batch.column("key"), "n_words": pa.array(np.diff(bounds), pa.int64()),
            "words": pa.array([raw[8 * a : 8 * b] if h else None for a, b, h in zip(bounds[:-1], bounds[1:], hit)], pa.binary()),
            "prints": _prints(hashes[order], places[order], sizes[order], bounds),
        })


def around(places: np.ndarray, n: int, window: int = WINDOW, gram: int = GRAM) -> np.ndarray:
    """Starts of all windows in ``n`` words that hold a gram at one of ``places``."""
    edges = np.zeros(n + 2, np.int64)
    np.add.at(edges, np.maximum(places - (window - gram), 0), 1)
    np.add.at(edges, places + 1, -1)
    starts = np.flatnonzero(np.cumsum(edges) > 0)
    return starts[starts + window <= n]


def _window_batches(batches, window: int):
    """The windows around each text's matched places: place, words, hash."""
    for batch in sliced(batches, "words"):
        keys, out = [], {"place": [], "size": [], "window": []}
        for i in range(batch.num_rows):
            words, matches = np.frombuffer(batch.column("words")[i].as_py(), np.uint64), batch.column("matches")[i].values
            places, sizes = (matches.field(x).to_numpy().astype(np.int64) for x in ("place", "size"))
            for size in np.unique(sizes).tolist():
                at = places[sizes == size]
                at = around(at, len(words), window) if size == 0 else at
                hashes, starts = whole_grams(words, np.array([0, len(words)]), size or window)
                out["place"].append(at)
                out["size"].append(np.full(len(at), size or window))
                out["window"].append(hashes[np.searchsorted(starts, at)])
                keys += [i] * len(at)
        joined = {k: np.concatenate([np.zeros(0, np.int64), *(x.view(np.int64) for x in v)]) for k, v in out.items()}
        yield pa.record_batch({
            "key": batch.column("key").take(pa.array(keys, pa.int64())), "place": pa.array(joined["place"].astype(np.int32)),
            "size": pa.array(joined["size"].astype(np.int32)), "window": pa.array(joined["window"]),
        })


LISTS = ["c", "x", "y"]


def _listed_batches(batches):
    """Number and checksum of each list's items, which arrive sorted; nothing of a list is kept but its checksum."""
    name, digest, n, done = None, None, 0, []

    def rows():
        values = [[d[i] for d in done] for i in range(5)]
        return pa.record_batch({k: pa.array(v, pa.string() if k == "items_sha256" else pa.int64()) for k, v in zip([*LISTS, "n_items", "items_sha256"], values)})

    for batch in batches:
        for *own, item in zip(*(batch.column(c).to_pylist() for c in (*LISTS, "item_id"))):
            if own != name:
                if name:
                    done.append((*name, n, digest.hexdigest()))
                name, digest, n = own, hashlib.sha256(), 0
            digest.update(("," if n else "").encode() + item.encode())
            n += 1
        yield rows()
        done = []
    if name:
        done.append((*name, n, digest.hexdigest()))
    yield rows()


def text_key(name: str):
    """Checksum that identifies a text; a missing one is as an empty one."""
    return F.md5(F.coalesce(F.col(name).cast("string"), F.lit("")))


class Hits:
    """Hits of all documents with the items, step by step."""

    def __init__(self, df: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW):
        as_text = lambda name: F.col(name).cast("string").alias("text")
        items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), as_text("text"))
        run = functools.partial(_item_batches, window=window)
        items = materialize(items.mapInArrow(run, "item_id string, n int, prints array<bigint>, windows array<bigint>").where("n > 0"), "benchmark-items")
        prints = materialize(items.select(F.explode("prints").alias("print")).distinct(), "benchmark-prints")
        slots = prints.select(F.shiftrightunsigned("print", 64 - BITS).alias("slot")).distinct().toArrow().column("slot").to_numpy()
        marks = np.zeros(1 << BITS, bool)  # at most 2**BITS slots are collected, whatever the benchmark's size
        marks[slots] = True
        lengths = items.where(F.col("n") < window).select("n").distinct().collect()
        rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("key"), as_text(text))
        run = functools.partial(_document_batches, window=window, marks=marks, short=tuple(sorted(r["n"] for r in lengths)))
        self.found = materialize(by_batches(rows, run, f"doc_id long, key string, n_words long, words binary, prints {PRINTS}"), "document-prints")
        texts = self.found.where("words is not null").dropDuplicates(["key"])
        matched = texts.select("key", F.inline("prints")).join(prints, "print", "left_semi")
        matches = matched.groupBy("key").agg(F.collect_list(F.struct("place", "size")).alias("matches"))
        run = functools.partial(_window_batches, window=window)
        windows = texts.select("key", "words").join(matches, "key").mapInArrow(run, "key string, place int, size int, window long")
        self.item_windows = materialize(items.select("item_id", F.explode("windows").alias("window")).distinct(), "item-windows")
        part = lambda k: F.bit_xor(F.when(F.col("item_id").isNotNull(), F.xxhash64(F.lit(k), "item_id")))
        zero = F.lit(0).cast("long")
        sets = self.item_windows.groupBy("window").agg(F.count("item_id").alias("n"), F.coalesce(part(1), zero).alias("a"), F.coalesce(part(2), zero).alias("b"))
        self.sets = materialize(sets, "item-sets")
        self.hits = materialize(windows.join(self.sets, "window"), "hits")

    def rows(self) -> DataFrame:
        return self.found.select("doc_id", "key", "n_words")

    def counts(self) -> DataFrame:
        """key, n_hit: words inside hits, overlaps counted once."""
        spans = self.hits.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("place", "size"))).alias("spans"))

        def united(done, span):
            end = span["place"] + span["size"]
            more = F.greatest(F.lit(0), end - F.greatest(done["end"], span["place"]))
            return F.struct(F.greatest(done["end"], end).alias("end"), (done["n"] + more).alias("n"))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return spans.select("key", F.aggregate("spans", start, united, lambda done: done["n"]).cast("long").alias("n_hit"))

    def items(self) -> DataFrame:
        """key, n_items, items_sha256 of the texts that hit an item with an id."""
        met = materialize(self.hits.where("n > 0").select("key", "n", "a", "b").distinct(), "met-sets")
        part = lambda k: F.bit_xor(F.xxhash64(F.lit(k), "n", "a", "b"))
        lists = materialize(met.groupBy("key").agg(F.count(F.lit(1)).alias("c"), part(1).alias("x"), part(2).alias("y")), "text-lists")
        one = lists.groupBy(*LISTS).agg(F.min("key").alias("key"))
        used = one.join(met, "key").select(*LISTS, "n", "a", "b")
        shown = self.sets.groupBy("n", "a", "b").agg(F.min("window").alias("window")).join(self.item_windows.where("item_id is not null"), "window")
        listed = used.join(shown.select("n", "a", "b", "item_id"), ["n", "a", "b"]).select(*LISTS, "item_id").distinct()
        dealt = listed.repartition(*LISTS).sortWithinPartitions(*LISTS, "item_id")
        summed = dealt.mapInArrow(_listed_batches, "c long, x long, y long, n_items long, items_sha256 string")
        return lists.join(summed, LISTS).select("key", "n_items", "items_sha256")


def _contaminated(share: int):
    return (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))


def contamination(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (a ``share``-th of the words or more are hits)."""
    hits = Hits(df, benchmark, window=window)
    nothing = hashlib.sha256(b"").hexdigest()
    joined = hits.rows().join(hits.counts().join(hits.items(), "key", "left"), "key", "left")
    joined = joined.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", F.lit(nothing)).alias("items_sha256"),
    )
    return joined.withColumn("contaminated", _contaminated(share))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20) -> DataFrame:
    """Rows of ``df`` (with ``doc_id`` and ``text``) that are not contaminated, all columns unchanged."""
    hits = Hits(df, benchmark, window=window)
    bad = hits.rows().join(hits.counts(), "key").where(_contaminated(share)).select("key").distinct()
    bad = materialize(bad.withColumnRenamed("key", "_text_key"), "contaminated-texts")
    return df.join(bad, text_key("text") == bad["_text_key"], "left_anti")
