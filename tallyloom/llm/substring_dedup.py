"""Removal of every word that lies in a run of 35 words occurring elsewhere, by seed and extend.

1. Seeds: of the ``GRAM``-word grams inside a window the one with the smallest hash is its anchor (winnowing), so equal
   windows have equal anchors at the same offset. Neighbouring windows mostly share theirs: about one word in thirteen is an
   anchor, and the windows of one anchor are a run of starts (its *context* runs from the first window to the end of the last).
2. Join: anchors that occur at one place only end here. Of the others, contexts with equal words are one class; all
   windows of a class with two places are repeats.
3. Extend: where an anchor has several classes, one member of each is extended both ways over its text's words. A window with
   ``o`` words left of the anchor is the extension by ``o`` to the left and by the rest to the right. Extensions are compared
   through their names, first in blocks of ``BLOCK`` neighbouring ``o``: a block ends where the words that all its extensions share
   occur once, and is taken whole where all its words occur twice. Only blocks at the ends of repeats are left,
   and of these each extension is compared. Occurrences of an anchor are counted and never paired, so a hot anchor is linear.
4. Overlapping repeats of a text unite to maximal ones, and each text is cut once.

Anchors, contexts and extensions are named by 64-bit hashes of 64-bit word hashes, a name being compared within an equal anchor only
(so two independent hashes must agree). For 10**12 contexts (100 TB) wrong anchor and name together are expected
10**-15 times; among 10**9 different contexts of one single anchor two equal names have a chance of 3 %. Texts are identified by MD5.

Defined results: a missing or empty text has no words; texts of fewer words than the window are unchanged; a text that
occurs in several rows is removed whole in each if it has a window; rows without or with a repeated id are rows as others; other columns
are ignored; an empty table gives no rows. ``kept`` is null where nothing was removed.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import byte_table, grams, hash_spans, mix, powers, ragged, runs, signed, sliced, utf8
from tallyloom.session import by_batches, materialize

WINDOW = 35
GRAM = 11
BLOCK = 5
SLICE = 1 << 20

_values, _inside = byte_table(False, b" \t\n\x0b\x0c\r")
ANCHORS = "array<struct<gram: bigint, context: bigint, low: int, count: tinyint, reach: tinyint>>"


class Names:
    """Names of any span of words of a batch, from prefix sums."""

    def __init__(self, words: np.ndarray):
        self.up, self.down = powers(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix(words + np.uint64(0x5851F42D4C957F2D)) * self.up[: len(words)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def batch_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all rows, and each row's bounds among them."""
    data, bounds = utf8(column)
    starts, ends, own = runs(_inside[data], bounds)
    return hash_spans(data, starts, ends), own


def smallest_at(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the last smallest of every ``width`` consecutive values, by doubling."""
    at, best, done = np.arange(len(values)), values, 1
    while done < width:
        step = min(done, width - done)
        left, right = slice(None, len(best) - step), slice(step, None)
        later = best[right] <= best[left]
        at, best = np.where(later, at[right], at[left]), np.where(later, best[right], best[left])
        done += step
    return at


def anchors(words: np.ndarray, own: np.ndarray, window: int, gram: int):
    """For each anchor of a batch: row, first start and last start, anchor position, its name, its context's name."""
    if len(words) < window:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    hashes = grams(words, gram)
    chosen = smallest_at(hashes, window - gram + 1)
    starts = np.arange(len(chosen))
    row = np.repeat(np.arange(len(own) - 1), np.diff(own))[: len(chosen)]
    valid = starts + window <= own[1:][row]
    starts, chosen, row = starts[valid], chosen[valid], row[valid]
    if not len(starts):
        return anchors(words[:0], own, window, gram)
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    low, high = starts[first], starts[np.append(first[1:], len(starts)) - 1]
    place = chosen[first]
    shape = (place - low).astype(np.uint64) * np.uint64(1 << 20) + (high - low).astype(np.uint64)
    return row[first], low, high, place, hashes[place], mix(Names(words).of(low, high + window) + shape)


def normal(raw: bytes) -> bytes:
    """The words joined by one blank; bytes split at the same six characters as the word pattern."""
    return b" ".join(raw.split())


def _anchor_batches(batches, window: int, gram: int):
    for batch in sliced(batches, limit=SLICE):
        data, bounds = utf8(batch.column("text"))
        words, own = batch_words(batch.column("text"))
        row, low, high, place, name, context = anchors(words, own, window, gram)
        items = pa.StructArray.from_arrays(
            [pa.array(signed(name)), pa.array(signed(context)), pa.array((low - own[row]).astype(np.int32)), pa.array((high - low + 1).astype(np.int8)), pa.array((place - low).astype(np.int8))],
            ["gram", "context", "low", "count", "reach"],
        )
        sums = [hashlib.sha256(normal(data[a:b].tobytes())).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "key": batch.column("key"), "n_words": pa.array(np.diff(own), pa.int64()), "whole_sha256": pa.array(sums, pa.string()),
            "anchors": pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(own))).astype(np.int32)), items),
        })


def _block_batches(batches, window: int, size: int):
    """The blocks of extensions of every context asked for: what all share, all words, and each extension by itself."""
    for batch in sliced(batches, limit=SLICE):
        words, own = batch_words(batch.column("text"))
        names, asked = Names(words), batch.column("asked")
        row = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
        item = asked.flatten()
        low, count, reach = (item.field(x).to_numpy().astype(np.int64) for x in ("low", "count", "reach"))
        at, near, far = own[row] + low + reach, reach - count + 1, reach
        first = near // size
        many = far // size - first + 1
        pick = np.repeat(np.arange(len(row)), many)
        block = first[pick] + ragged(many)
        near, far, at = np.maximum(block * size, near[pick]), np.minimum(block * size + size - 1, far[pick]), at[pick]
        core = names.of(at - block * size, at - block * size - size + 1 + window)
        whole = mix(names.of(at - far, at - near + window) + (near * 1024 + far).astype(np.uint64))
        length = far - near + 1
        left = np.repeat(near, length) + ragged(length)
        single = names.of(np.repeat(at, length) - left, np.repeat(at, length) - left + window)
        yield pa.record_batch({
            "gram": item.field("gram").take(pa.array(pick)), "block": pa.array(block.astype(np.int32)), "core": pa.array(signed(core)), "whole": pa.array(signed(whole)),
            "key": batch.column("key").take(pa.array(row[pick])), "at": pa.array(at - own[row[pick]], pa.int64()), "near": pa.array(near.astype(np.int32)),
            "far": pa.array(far.astype(np.int32)), "alone": item.field("alone").take(pa.array(pick)),
            "singles": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(signed(single))),
        })


def _cut_batches(batches):
    """Each text without the words of its spans."""
    for batch in sliced(batches, limit=SLICE):
        spans, out = batch.column("spans"), []
        offsets, flat = spans.offsets.to_numpy(), spans.flatten()
        start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
        shift = int(offsets[0])
        for i, text in enumerate(batch.column("text").to_pylist()):
            words = text.encode().split()
            own = slice(int(offsets[i]) - shift, int(offsets[i + 1]) - shift)
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, start[own], 1)
            np.add.at(edge, end[own], -1)
            stays = np.cumsum(edge[:-1]) == 0
            out.append((len(words) - int(stays.sum()), b" ".join(words[k] for k in np.flatnonzero(stays).tolist()).decode()))
        yield pa.record_batch({"key": batch.column("key"), "n_removed": pa.array([n for n, _ in out], pa.int64()), "kept": pa.array([t for _, t in out], pa.string())})


def _twice(rows: DataFrame, *names: str) -> DataFrame:
    return materialize(rows.groupBy(*names).count().where("count > 1").select(*names), "twice")


def extended_spans(contexts: DataFrame, window: int, size: int) -> DataFrame:
    """Spans (key, start, end) of single contexts whose extensions another class of the anchor has too."""
    run = functools.partial(_block_batches, window=window, size=size)
    schema = "gram long, block int, core long, whole long, key binary, at long, near int, far int, alone boolean, singles array<bigint>"
    blocks = materialize(by_batches(contexts.where("asked is not null").select("key", "text", "asked"), run, schema), "blocks")
    alive = materialize(blocks.join(_twice(blocks, "gram", "block", "core"), ["gram", "block", "core"]), "alive-blocks")
    marked = _twice(alive, "gram", "whole").withColumn("repeated", F.lit(True))
    left = materialize(alive.join(marked, ["gram", "whole"], "left"), "left-blocks")
    whole = left.where("repeated and alone").select("key", (F.col("at") - F.col("far")).alias("start"), (F.col("at") - F.col("near") + window).alias("end"))
    # One member of each repeated block stays, as the partner of blocks that end inside it.
    standing = left.where("repeated").dropDuplicates(["gram", "whole"]).withColumn("alone", F.lit(False))
    rest = left.where("repeated is null").unionByName(standing)
    each = rest.select("gram", "key", "at", "near", "alone", F.posexplode("singles").alias("k", "name"))
    each = each.select("gram", "key", "alone", (F.col("at") - F.col("near") - F.col("k")).alias("start"), (F.col("near") + F.col("k")).alias("o"), "name")
    each = materialize(each, "extensions")
    found = each.join(_twice(each, "gram", "o", "name"), ["gram", "o", "name"]).where("alone")
    return whole.union(found.select("key", "start", (F.col("start") + window).alias("end")))


class Repeats:
    """The steps over one table of texts."""

    def __init__(self, df: DataFrame, doc_id: str, text: str, window: int, gram: int, block: int):
        if not 1 <= gram <= window or window > 127:
            raise ValueError("grams fit into windows, and windows have 127 words at most")
        rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        keyed = rows.withColumn("key", F.unhex(F.md5("text")))
        run = functools.partial(_anchor_batches, window=window, gram=gram)
        self.window = window
        self.rows = materialize(by_batches(keyed, run, f"doc_id long, key binary, n_words long, whole_sha256 string, anchors {ANCHORS}"), "anchors")
        self.copies = materialize(self.rows.where(F.col("n_words") >= window).groupBy("key").count().where("count > 1").select("key"), "copies")
        # A place is a position of a distinct text: rows of one text are one place, two positions of a text are two.
        placed = self.rows.select("key", F.inline("anchors")).withColumn("place", F.xxhash64("key", "low"))
        grouped = placed.groupBy("gram").agg(F.min("place").alias("first"), F.max("place").alias("last"))
        repeated = materialize(grouped.where("first <> last").select("gram"), "repeated-anchors")
        candidates = materialize(placed.join(repeated, "gram"), "joined-anchors")
        classes = candidates.groupBy("gram", "context").agg(F.min("place").alias("p"), F.max("place").alias("q"), F.min(F.struct("key", "low", "count", "reach")).alias("one"))
        classes = materialize(classes.select("gram", "context", (F.col("p") == F.col("q")).alias("alone"), "one.*"), "classes")
        several = classes.groupBy("gram").agg(F.min("context").alias("c"), F.max("context").alias("d")).where("c <> d").select("gram")
        asked = classes.join(materialize(several, "several"), "gram")
        sure = candidates.join(classes.where("not alone").select("gram", "context"), ["gram", "context"])
        sure = sure.select("key", F.col("low").cast("long").alias("start"), (F.col("low") + F.col("count") + (window - 1)).cast("long").alias("end"))
        sure = materialize(sure.join(self.copies, "key", "left_anti").distinct(), "sure")
        lists = asked.groupBy("key").agg(F.collect_list(F.struct("gram", "low", "count", "reach", "alone")).alias("asked"))
        lists = lists.join(sure.select("key").distinct(), "key", "full_outer")
        long_enough = keyed.where(F.octet_length("text") >= 2 * window - 1).select("key", "text")
        self.contexts = materialize(long_enough.dropDuplicates(["key"]).join(lists, "key"), "contexts")
        self.spans = materialize(sure.union(extended_spans(self.contexts, window, block)), "spans")


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words left, joined by blanks), kept."""
    found = Repeats(df, doc_id, text, window, gram, block)
    spans = found.spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    changed = by_batches(found.contexts.select("key", "text").join(spans, "key"), _cut_batches, "key binary, n_removed long, kept string")
    changed = changed.join(found.copies, "key", "left_anti")
    whole = found.copies.select("key", F.lit(None).cast("long").alias("n_removed"), F.lit("").alias("kept"))
    changed = materialize(changed.unionByName(whole).withColumn("cut_sha256", F.sha2("kept", 256)), "cut-texts")
    joined = found.rows.select("doc_id", "key", "n_words", "whole_sha256").join(changed, "key", "left")
    removed = F.when(F.col("kept").isNull(), 0).otherwise(F.coalesce("n_removed", "n_words"))
    return joined.select("doc_id", "n_words", removed.cast("long").alias("n_removed"), F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"), "kept")


ORACLE = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
windows AS (SELECT r, p, md5(array_to_string(list_slice(w, p + 1, p + {WINDOW}), ' ')) AS s
  FROM (SELECT r, w, unnest(range(len(w) - {WINDOW} + 1)) AS p FROM docs WHERE len(w) >= {WINDOW})),
again AS (SELECT s FROM windows GROUP BY s HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(p, p + {WINDOW})) AS k FROM windows JOIN again USING (s)),
words AS (SELECT r, unnest(range(len(w))) AS k, unnest(w) AS word FROM docs),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS t FROM words ANTI JOIN gone USING (r, k) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM docs LEFT JOIN kept USING (r)
"""
