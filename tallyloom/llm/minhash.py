"""Near-duplicate documents: banded b-bit MinHash, confirmed on full shingle sets.

1. One pass turns each whole text into its set of shingles (64-bit hashes), the set's 128-bit name,
   band keys of its minima, and its packed signature: the low ``b`` bits of every minimum.
2. Texts with equal sets are one class; everything below moves classes, so copies cost one row each.
3. Classes that share a band key are candidates; only rows of band keys that two classes have are kept. Inside a task the packed
   signatures of such a bucket are compared by bit counts: the share of equal values, corrected for chance equality of low
   bits, estimates the similarity. Pairs so far below the threshold that a link at it is there less often than it shares no
   band key (``least_estimate``) are unlikely. A bucket gives out a spanning forest of its likely pairs, so fewer rows than it has
   members, and not the pairs. Both classes of a link are then in one *cluster* of likely pairs.
4. The full sets of a cluster meet once in one task, which confirms links exactly. A pair over the threshold shares one of the
   rarest shingles of both (prefix filter), so few pairs are compared. Links that join two parts are given out, the others add nothing.
5. Components of these links give each document the smallest id it reaches.

Buckets of more than ``BLOCK`` classes and clusters of more than ``BLOCK_BYTES`` of sets are cut into blocks, and every two blocks
meet in a task: a class of such a group is sent as often as the group has blocks, each time in full. The results are the same.

Two ways to miss a link are left, each with a probability of at most ``MISS`` (1e-8) for two sets at the threshold: they share no
band key, or their signatures look too different. Bands follow from the threshold; one that 160 hashes cannot serve is refused.

Defined results: a missing or empty text has an empty set and is linked with nothing; rows of the same
text are one class even with the same id; a row without an id takes part, but names no component unless
no member has an id; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import connected
from tallyloom.llm.prefilter import may_match
from tallyloom.llm.texts import NARROW_BYTES, byte_table, fold, give_back, grams, hash_spans, mix, ragged, runs, signed, sliced, utf8
from tallyloom.llm.winnowing import text_key
from tallyloom.session import by_batches, materialize

HASHES = 160
BITS = 2
MISS = 1e-8
BLOCK = 8192
BLOCK_BYTES = 8 << 20
COMPARED = 1 << 17  # tokens of other sets looked up at once

_values, _inside = byte_table(True, b" \t\n\x0b\x0c\r")
_factors = mix(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every row; fewer words than ``size`` are one shingle."""
    data, bounds = utf8(column)
    data = _values[data]
    starts, ends, own = runs(_inside[data], bounds)
    words = hash_spans(data, starts, ends)
    whole = grams(words, size)
    out = []
    for low, high in zip(own[:-1].tolist(), own[1:].tolist()):
        if high - low >= size:
            out.append(np.unique(whole[low : high - size + 1]))
        elif high > low:
            out.append(grams(words[low:high], high - low) + np.uint64(high - low))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_name(hashes: np.ndarray) -> bytes:
    return fold(hashes, 1).to_bytes(8, "big") + fold(hashes, 2).to_bytes(8, "big")


def minima(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of the set under each hash function."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(hashes), 4096):
        np.minimum(best, (hashes[low : low + 4096, None] * _factors).min(0), out=best)
    return best


def band_keys(best: np.ndarray, bands: int, rows: int) -> list[int]:
    keys = best[: bands * rows].reshape(bands, rows)
    mixed = np.arange(1, bands + 1, dtype=np.uint64)
    for k in range(rows):
        mixed = mix(mixed * np.uint64(0x9FB21C651E98DF25) + keys[:, k])
    return signed(mixed).tolist()


def packed(best: np.ndarray) -> bytes:
    """Low bits of the mixed minima as ``BITS`` planes of one bit for each hash function."""
    low = mix(best)
    return b"".join(np.packbits(((low >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)).tobytes() for k in range(BITS))


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity of rows of packed signatures from bit counts, corrected for chance equality."""
    differ = (a ^ b).reshape(*np.broadcast_shapes(a.shape, b.shape)[:-1], BITS, HASHES // 8)
    equal = HASHES - np.bitwise_count(np.bitwise_or.reduce(differ, axis=-2)).sum(-1, dtype=np.int64)
    chance = 0.5**BITS
    return (equal / HASHES - chance) / (1 - chance)


def band_miss(threshold: int, bands: int, rows: int) -> float:
    """Probability that two sets at the threshold (in hundredths) share no band key."""
    return (1 - min(1.0, threshold / 100) ** rows) ** bands


def bands_for(threshold: int) -> tuple[int, int]:
    """Bands and rows of a band: the most rows with a miss of at most ``MISS``."""
    for rows in range(HASHES, 0, -1):
        if threshold > 0 and band_miss(threshold, HASHES // rows, rows) <= MISS:
            return HASHES // rows, rows
    raise ValueError(f"threshold {threshold} is too low for {HASHES} hashes")


def least_estimate(threshold: int, miss: float) -> float:
    """The largest bound that two sets at the threshold stay under with a probability of at most ``miss``, by the binomial tail."""
    similar = min(1.0, threshold / 100)
    equal, below, count = similar + (1 - similar) * 0.5**BITS, 0.0, 0
    while count < HASHES:
        below += math.comb(HASHES, count) * equal**count * (1 - equal) ** (HASHES - count)
        if below > miss:
            break
        count += 1
    return ((count - 0.5) / HASHES - 0.5**BITS) / (1 - 0.5**BITS)


def _signature_batches(batches, size: int, bands: int, rows: int):
    for batch in sliced(batches, limit=NARROW_BYTES):
        sets = shingle_sets(batch.column("text"), size)
        best = [minima(s) if len(s) else None for s in sets]
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"), "key": batch.column("key"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "name": pa.array([set_name(s) if len(s) else None for s in sets], pa.binary()),
            "bands": pa.array([None if m is None else band_keys(m, bands, rows) for m in best], pa.list_(pa.int64())),
            "bits": pa.array([None if m is None else packed(m) for m in best], pa.binary()),
        })


def _set_batches(batches, size: int):
    for batch in sliced(batches, limit=NARROW_BYTES):
        sets = shingle_sets(batch.column("text"), size)
        kept = batch.select([c for c in batch.schema.names if c not in ("key", "text")])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([s.tobytes() for s in sets], pa.binary())], [*kept.schema.names, "hashes"])


def likely_forest(bits: np.ndarray, sizes: np.ndarray, threshold: int, least: float) -> list[tuple[int, int]]:
    """Pairs that join all rows joined by likely pairs; a row is compared only with rows not reached yet."""
    rest, found = np.arange(len(sizes)), []
    while len(rest):
        reached, rest = [int(rest[0])], rest[1:]
        while reached and len(rest):
            x = reached.pop()
            near = 100 * np.minimum(sizes[rest], sizes[x]) >= threshold * np.maximum(sizes[rest], sizes[x])
            near[near] = estimate(bits[x], bits[rest[near]]) >= least
            hits, rest = rest[near].tolist(), rest[~near]
            found += [(x, y) for y in hits]
            reached += hits
    return found


def link_forest(sets: list[np.ndarray], bits: np.ndarray, threshold: int, least: float) -> list[tuple[int, int]]:
    """Pairs of sets at or over the threshold that join all sets joined by such pairs."""
    sizes = np.array([len(s) for s in sets], np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    # Numbers of tokens, the rarest first, in four bytes each; a task holds two blocks of sets at most.
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    token = np.empty(len(order), np.int32)
    token[order] = np.cumsum(np.concatenate([[False], flat[1:] != flat[:-1]]), dtype=np.int32)
    del flat, order
    often = np.bincount(token)
    by_count = np.argsort(often, kind="stable")
    rank = np.empty(len(often), np.int32)
    rank[by_count] = np.arange(len(often), dtype=np.int32)
    token, often = rank[token], often[by_count]
    del by_count, rank
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    for low, high in zip(bounds[:-1], bounds[1:]):
        token[low:high].sort()
    # Of two sets over the threshold, each has a common token among its size - ceil(threshold * size) + 1 rarest.
    first = bounds[:-1] + sizes - -(-threshold * sizes // 100) + 1
    early = np.flatnonzero((np.arange(len(token), dtype=np.int32) < first.astype(np.int32)[owner]) & (often[token] > 1))
    by_token = early[np.argsort(token[early], kind="stable")]
    holders, keys, asked = owner[by_token], token[by_token], token[early]
    del owner, by_token
    low, high = np.searchsorted(keys, asked), np.searchsorted(keys, asked, side="right")
    own = np.searchsorted(early, bounds)
    root, mark, found = np.arange(len(sets)), np.zeros(len(often), bool), []
    for x in range(len(sets)):
        posts = [holders[a:b] for a, b in zip(low[own[x] : own[x + 1]], high[own[x] : own[x + 1]])]
        if not posts:
            continue
        y = np.unique(np.concatenate(posts))
        y = y[(y > x) & (root[y] != root[x])]
        y = y[100 * np.minimum(sizes[y], sizes[x]) >= threshold * np.maximum(sizes[y], sizes[x])]
        if len(y):
            y = y[estimate(bits[x], bits[y]) >= least]
        if not len(y):
            continue
        mark[token[bounds[x] : bounds[x + 1]]] = True
        ends = np.cumsum(sizes[y])
        for some in np.split(y, np.flatnonzero(np.diff(ends // COMPARED)) + 1):
            places = np.repeat(bounds[some], sizes[some]) + ragged(sizes[some])
            both = np.add.reduceat(mark[token[places]], np.concatenate([[0], np.cumsum(sizes[some])[:-1]]), dtype=np.int64)
            for z in some[100 * both >= threshold * (sizes[x] + sizes[some] - both)].tolist():
                if root[z] != root[x]:
                    root[root == root[z]] = root[x]
                    found.append((x, z))
        mark[token[bounds[x] : bounds[x + 1]]] = False
    return found


def _taken(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The batches as one; the list is emptied, so that they are not kept beside it."""
    joined = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    held.clear()
    return joined


def _groups(batches, keys: list[str]):
    """Rows of each key as a record batch; rows of a key arrive one after the other."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*(batch.column(k).to_pylist() for k in keys)))
        start = 0
        for stop in range(1, batch.num_rows + 1):
            if stop < batch.num_rows and values[stop] == values[start]:
                continue
            if held and values[start] != current:
                yield _taken(held)
            current = values[start]
            held.append(batch.slice(start, stop - start))
            start = stop
    if held:
        yield _taken(held)


def _bits_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(batch.num_rows, -1)


def _pair_batch(batch: pa.RecordBatch, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = (batch.column("name").take(pa.array([p[k] for p in pairs], pa.int64())) for k in (0, 1))
    return pa.record_batch({"a": a, "b": b})


def _likely_batches(batches, threshold: int, least: float):
    for group in _groups(batches, ["band", "low", "high"]):
        yield _pair_batch(group, likely_forest(_bits_of(group), group.column("n_shingles").to_numpy(), threshold, least))
        group = None
    give_back()


def _link_batches(batches, threshold: int, least: float):
    for group in _groups(batches, ["cluster", "low", "high"]):
        sets = [np.frombuffer(h.as_buffer(), np.uint64) for h in group.column("hashes")]
        yield _pair_batch(group, link_forest(sets, _bits_of(group), threshold, least))
        group = sets = None
    give_back()


def block_pairs(rows: DataFrame, *group: str) -> DataFrame:
    """Rows of groups with ``blocks`` blocks, dealt so that every two blocks of a group meet as (group, low, high)."""
    rows = rows.withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("block"))
    rows = rows.withColumn("other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(others)))
    rows = rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("block", "other", "blocks")
    # Sorted by name too, so that a repeated task gives out the same forest.
    return rows.repartition(*group, "low", "high").sortWithinPartitions(*group, "low", "high", "name")


class NearDuplicates:
    """The steps over one table; ``size`` words to a shingle, ``threshold`` in hundredths."""

    def __init__(self, df: DataFrame, size: int = 5, threshold: int = 80, doc_id: str = "doc_id", text: str = "text"):
        self.size, self.threshold = size, threshold
        self.bands, self.rows = bands_for(threshold)
        self.least = least_estimate(threshold, band_miss(threshold, self.bands, self.rows))
        self.texts = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_key(text).alias("key"), F.col(text).cast("string").alias("text"))
        run = functools.partial(_signature_batches, size=size, bands=self.bands, rows=self.rows)
        schema = "doc_id long, key string, n_shingles long, name binary, bands array<bigint>, bits binary"
        self.documents = materialize(by_batches(self.texts, run, schema), "signatures")
        grouped = self.documents.where("name is not null").groupBy("name")
        first = [F.first(c).alias(c) for c in ("n_shingles", "bands", "bits")]  # equal for all rows of a name
        self.classes = materialize(grouped.agg(F.min("doc_id").alias("doc_id"), F.min("key").alias("key"), *first), "classes")

    def clusters(self) -> DataFrame:
        """(node, component) of the classes that likely pairs join."""
        buckets = self.classes.select("name", F.explode("bands").alias("band"))
        shared = buckets.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = materialize(shared.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "shared-bands")
        rows = materialize(buckets.join(shared, "band"), "bucket-rows")
        dealt = block_pairs(rows.join(self.classes.select("name", "n_shingles", "bits"), "name"), "band")
        likely = dealt.mapInArrow(functools.partial(_likely_batches, threshold=self.threshold, least=self.least), "a binary, b binary")
        return connected(materialize(likely, "likely-pairs"))  # read twice: a second run might find another forest

    def links(self) -> DataFrame:
        """Confirmed pairs (a, b) of classes that join all classes linked with each other."""
        found = self.clusters().withColumnsRenamed({"node": "name", "component": "cluster"})
        wanted = materialize(found.join(self.classes.select("name", "key", "n_shingles", "bits"), "name"), "cluster-classes")
        sizes = wanted.groupBy("cluster").agg(F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES).cast("int").alias("blocks"))
        asked = wanted.select("name", "key", "bits", "cluster").join(sizes, "cluster")
        sources = self.texts.where(F.octet_length("text") > 0).where(may_match(wanted, ["key"], "key")).select("key", "text")
        sources = sources.dropDuplicates(["key"]).join(asked, "key")
        schema = "cluster binary, name binary, bits binary, blocks int, hashes binary"
        ordered = sources.select("key", "text", "cluster", "name", "bits", "blocks")
        sets = materialize(by_batches(ordered, functools.partial(_set_batches, size=self.size), schema), "sets")
        run = functools.partial(_link_batches, threshold=self.threshold, least=self.least)
        return materialize(block_pairs(sets, "cluster").mapInArrow(run, "a binary, b binary"), "links")

    def components(self) -> DataFrame:
        """(name, component_id, first_key): each class with the smallest document id and text key it is linked with."""
        labels = connected(self.links())
        labelled = self.classes.select("name", "doc_id", "key").join(labels.withColumnRenamed("node", "name"), "name", "left")
        labelled = labelled.withColumn("component", F.coalesce("component", "name"))
        smallest = labelled.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.min("key").alias("first_key"))
        return labelled.join(smallest, "component").select("name", "component_id", "first_key")


def near_duplicates(df: DataFrame, size: int = 5, threshold: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and whether the document is its component's first."""
    found = NearDuplicates(df, size, threshold, doc_id, text)
    joined = found.documents.select("doc_id", "n_shingles", "name").join(found.components(), "name", "left")
    component = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep_first(df: DataFrame, size: int = 5, threshold: int = 80) -> DataFrame:
    """Rows of ``df`` (with ``doc_id`` and ``text``) without the near-duplicates of a document of smaller id.

    All columns are unchanged. Rows are judged by id and text: of rows of one id with different texts, each stays or goes
    by its own text; of repeated rows of the same id that stay, all stay, since nothing tells them apart. Rows without an
    id go where a linked row has one; among themselves one row stays, of the smallest text key. Texts without words stay.
    """
    found = NearDuplicates(df, size, threshold)
    rows = found.documents.join(found.components(), "name")
    first = F.when(F.col("component_id").isNull(), F.col("key") == F.col("first_key")).otherwise(F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
    dropped = materialize(rows.where(~first).select(F.col("doc_id").alias("_dropped"), F.col("key").alias("_text_key")).distinct(), "dropped")
    same = df["doc_id"].eqNullSafe(dropped["_dropped"]) & (text_key("text") == dropped["_text_key"])
    nameless = F.col("doc_id").isNull() & F.coalesce(F.col("text").rlike(r"[^ \t\n\x0B\f\r]"), F.lit(False))
    # Most rows cannot be among the dropped ones and stay without a shuffle.
    perhaps = may_match(dropped, ["_dropped", "_text_key"], F.col("doc_id").cast("long"), text_key("text"))
    named = df.where(~nameless)
    kept = named.where(~perhaps).unionByName(named.where(perhaps).join(dropped, same, "left_anti"))
    return kept.unionByName(df.where(nameless).join(dropped, same, "left_anti").dropDuplicates(["text"]))
