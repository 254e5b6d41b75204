"""Removal of every byte that lies in a 200-byte string occurring elsewhere.

The method is a difference cover adapted to a bounded prefix. Residues modulo three make a record of
two thirds of all bytes; as only prefixes of 200 bytes have to be told apart, sampled positions are chosen by
content instead (a string synchronizing set): of the 24-byte grams inside a 200-byte string the one with the
smallest hash. Equal strings have their sample at the same offset, which is what a difference cover is for, and
about one position in ninety is sampled.

1. Sample: every start of a 200-byte string belongs to one sample; a sample's starts are a run. Its record
   has its gram's name and the name of its whole context, the bytes from its first start to the end of its last string.
2. Names of grams that occur once end here. Equal contexts are one class: the strings of a class of two or
   more members all occur twice.
3. Merge the rest: where a gram has several classes, one member of each brings its context bytes, and the
   names of all 200-byte strings of the gram's contexts are compared in one task. Grams with very many classes
   are compared by counts over all tasks instead, in blocks of 16, 4 and 1 neighbouring starts: a block whose
   common part occurs once ends, one whose whole bytes occur twice is repeated, and only the rest is divided. So no
   task holds a hot gram, and a class gives a few rows and not one for each of its strings.
4. Equal names become byte runs; each text is cut once.

Grams, contexts and strings are named by 64-bit hashes, always within an equal gram name.

Defined results: a missing or empty text has no bytes; a text of 200 bytes or more that occurs twice is removed
whole in every row; shorter texts are never touched; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import mix, powers, signed, sliced, utf8
from tallyloom.session import materialize

LENGTH = 200
GRAM = 24
PIECE = 1 << 20
HOT_CLASSES = 2000
_PLACE = np.uint64((1 << 21) - 1)


class Names:
    """Names of any byte span of an array, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=self.sums[1:])

    def of(self, starts, ends) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, from prefix and suffix minima of blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def samples(data: np.ndarray, bounds: np.ndarray, length: int, gram: int):
    """For each sample: row, first start and last start in the batch, sample position, gram name, context name."""
    names = Names(data)
    if len(data) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    at = np.arange(len(data) - gram + 1)
    grams = names.of(at, at + gram)
    ranked = (grams & ~_PLACE) | (_PLACE - at.astype(np.uint64))
    chosen = (_PLACE - (smallest(ranked, length - gram + 1) & _PLACE)).astype(np.int64)
    starts = np.arange(len(chosen))
    row = np.searchsorted(bounds, starts, side="right") - 1
    valid = starts + length <= bounds[row + 1]
    starts, chosen, row = starts[valid], chosen[valid], row[valid]
    if not len(starts):
        return samples(data[:0], bounds[:1], length, gram)
    new = np.ones(len(starts), bool)
    new[1:] = (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    low, high = starts[first], starts[np.append(first[1:], len(starts)) - 1]
    place = chosen[first]
    context = mix(names.of(low, high + length) + (place - low).astype(np.uint64) * np.uint64(1024) + (high - low).astype(np.uint64))
    return row[first], low, high, place, grams[place], context


def pieces(column: pa.Array, length: int):
    """(bytes, bounds, first row, offset of the first row) so that every string lies in one piece."""
    data, bounds = utf8(column)
    if len(data) <= PIECE:
        yield data, bounds, 0, 0
        return
    for row in range(len(bounds) - 1):
        for low in range(int(bounds[row]), max(int(bounds[row + 1]) - length + 1, int(bounds[row]) + 1), PIECE):
            high = min(low + PIECE + length - 1, int(bounds[row + 1]))
            yield data[low:high], np.array([0, high - low]), row, low - int(bounds[row])


def _sample_batches(batches, length: int, gram: int):
    for batch in sliced(batches, limit=PIECE):
        for data, bounds, first, offset in pieces(batch.column("text"), length):
            row, low, high, place, name, context = samples(data, bounds, length, gram)
            yield pa.record_batch({
                "key": batch.column("key").take(pa.array(row + first)), "gram": pa.array(signed(name)), "context": pa.array(signed(context)),
                "low": pa.array(low - bounds[row] + offset, pa.int64()), "count": pa.array((high - low + 1).astype(np.int32)),
                "reach": pa.array((place - low).astype(np.int32)),
            })


def _context_batches(batches, length: int):
    """Each text, once, and the context bytes of the classes it stands for."""
    for batch in batches:
        out = {k: [] for k in ("key", "text", "gram", "low", "count", "reach", "members", "bytes")}
        size = 0

        def flush():
            return pa.record_batch({
                "key": pa.array(out["key"], pa.binary()), "text": pa.array(out["text"], pa.binary()), "gram": pa.array(out["gram"], pa.int64()),
                "low": pa.array(out["low"], pa.int64()), "count": pa.array(out["count"], pa.int32()), "reach": pa.array(out["reach"], pa.int32()), "members": pa.array(out["members"], pa.int64()), "bytes": pa.array(out["bytes"], pa.binary()),
            })

        def add(*row):
            for k, value in zip(out, row):
                out[k].append(value)

        for i in range(batch.num_rows):
            key, text, classes = (batch.column(x)[i].as_py() for x in ("key", "text", "classes"))
            raw = text.encode("utf-8", "surrogatepass")
            if batch.column("wanted")[i].as_py():
                add(key, raw, *[None] * 6)
            for c in classes or ():
                add(key, None, c["gram"], c["low"], c["count"], c["reach"], c["n"], raw[c["low"] : c["low"] + c["count"] + length - 1])
            size += len(raw) + (length + 100) * len(classes or ())
            if size > 4 << 20:
                yield flush()
                out, size = {k: [] for k in out}, 0
        yield flush()


def string_names(contexts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of all strings of all contexts, and how many each context has."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(c) for c in contexts], np.int64)
    counts = sizes - length + 1
    starts = np.repeat(np.cumsum(sizes) - sizes, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return Names(data).of(starts, starts + length), counts


def true_runs(flags: np.ndarray, counts: np.ndarray):
    """(context, first, last) of every run of True that stays in one context."""
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    head = (np.cumsum(counts) - counts)[owner[at[first]]]
    return owner[at[first]], at[first] - head, at[last] - head


def _merged_batches(batches, length: int):
    """Byte runs of single members whose strings other classes of the gram have; grams arrive one after the other."""
    gram, rows = None, []

    def resolved():
        names, counts = string_names([r["bytes"] for r in rows], length)
        _, inverse, seen = np.unique(names, return_inverse=True, return_counts=True)
        owner, first, last = true_runs(seen[inverse] > 1, counts)
        alone = np.array([r["members"] == 1 for r in rows])[owner] if len(owner) else np.zeros(0, bool)
        chosen = [(rows[o], int(a), int(b)) for o, a, b in zip(owner[alone], first[alone], last[alone])]
        return pa.record_batch({
            "key": pa.array([r["key"] for r, _, _ in chosen], pa.binary()), "start": pa.array([r["low"] + a for r, a, _ in chosen], pa.int64()),
            "end": pa.array([r["low"] + b + length for r, _, b in chosen], pa.int64()),
        })

    for batch in batches:
        for row in batch.to_pylist():
            if row["gram"] != gram and rows:
                yield resolved()
                rows = []
            gram = row["gram"]
            rows.append(row)
    if rows:
        yield resolved()


BLOCK_COLUMNS = "gram long, key binary, low long, reach int, members long, bytes binary, near int, far int"


def _block_batches(batches, length: int, size: int):
    """Blocks of ``size`` starts: their offsets from the sample, the name of their common part and of all their bytes.

    Offsets count back from the sample, so equal strings fall into equal blocks.
    """
    for batch in batches:
        rows = batch.to_pylist()
        data = np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8)
        ends = np.cumsum([len(r["bytes"]) for r in rows])
        pick, near, far, base = [], [], [], []
        for i, r in enumerate(rows):
            for low in range(r["near"] // size * size, r["far"] + 1, size):
                pick.append(i)
                base.append(low)
                near.append(max(low, r["near"]))
                far.append(min(low + size - 1, r["far"]))
        near, far, base, pick = (np.array(x, np.int64) for x in (near, far, base, pick))
        at = (np.concatenate([[0], ends[:-1]]) + np.array([r["reach"] for r in rows]))[pick] if len(rows) else pick
        names = Names(data)
        core = mix(names.of(at - base, at - base - size + 1 + length) + base.astype(np.uint64))
        whole = mix(names.of(at - far, at - near + length) + (near * 1024 + far).astype(np.uint64))
        kept = batch.select(["gram", "key", "low", "reach", "members", "bytes"]).take(pa.array(pick))
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(near.astype(np.int32)), pa.array(far.astype(np.int32)), pa.array(signed(core)), pa.array(signed(whole))],
            [*kept.schema.names, "near", "far", "core", "whole"],
        )


def hot_spans(contexts: DataFrame, length: int) -> DataFrame:
    """Byte runs (key, start, end) of single members of hot grams whose strings other classes have."""
    rest = contexts.select("gram", "key", "low", "reach", "members", "bytes", (F.col("reach") - F.col("count") + 1).alias("near"), F.col("reach").alias("far"))
    found = rest.select("key", F.col("low").alias("start"), F.col("low").alias("end")).limit(0)
    for size in (16, 4, 1):
        run = functools.partial(_block_batches, length=length, size=size)
        blocks = materialize(rest.mapInArrow(run, f"{BLOCK_COLUMNS}, core long, whole long"), "blocks")
        twice = lambda name: materialize(blocks.groupBy("gram", name).count().where("count > 1").select("gram", name), name)  # noqa: E731, B023
        marked = twice("whole").withColumn("repeated", F.lit(True))
        left = materialize(blocks.join(twice("core"), ["gram", "core"]).join(marked, ["gram", "whole"], "left"), "left")
        start, end = F.col("low") + F.col("reach") - F.col("far"), F.col("low") + F.col("reach") - F.col("near") + length
        found = found.union(left.where("repeated AND members = 1").select("key", start.alias("start"), end.alias("end")))
        # One member of each repeated block stays as a partner of blocks that are cut off elsewhere.
        standing = left.where("repeated").dropDuplicates(["gram", "whole"]).withColumn("members", F.lit(2).cast("long"))
        rest = left.where("repeated IS NULL").unionByName(standing).drop("core", "whole", "repeated")
        rest = rest.select("gram", "key", "low", "reach", "members", "bytes", "near", "far")
    return found


def cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """Bytes removed, maximal removed runs, and what is left."""
    merged: list[list[int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    edges = [0, *(x for span in merged for x in span), len(raw)]
    return sum(b - a for a, b in merged), len(merged), b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _cut_batches(batches):
    for batch in batches:
        keys, raws, spans = (batch.column(x).to_pylist() for x in ("key", "text", "spans"))
        done = [cut(raw, [(s["start"], s["end"]) for s in own]) for raw, own in zip(raws, spans)]
        yield pa.record_batch({
            "key": pa.array(keys, pa.binary()), "n_removed": pa.array([d[0] for d in done], pa.int64()), "n_spans": pa.array([d[1] for d in done], pa.int64()),
            "kept": pa.array([d[2] for d in done], pa.binary()),
        })


def repeated_spans(texts: DataFrame, copies: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Byte runs (key, start, end) of the texts that occur once, and those texts (key, text as bytes).

    ``texts`` has key and text, ``copies`` the keys of texts that occur more than once.
    """
    run = functools.partial(_sample_batches, length=length, gram=gram)
    sampled = texts.where(F.octet_length("text") >= length).mapInArrow(run, "key binary, gram long, context long, low long, count int, reach int")
    repeated = materialize(sampled.groupBy("gram").count().where("count > 1").select("gram"), "repeated-grams")
    candidates = materialize(sampled.join(repeated, "gram"), "repeated-samples")
    classes = candidates.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "low", "count", "reach")).alias("first"))
    classes = materialize(classes.select("gram", "context", "n", "first.*"), "sample-classes")
    several = materialize(classes.groupBy("gram").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), "several-classes")
    standing = classes.join(several, "gram")
    sure = candidates.join(classes.where("n > 1").select("gram", "context"), ["gram", "context"])
    sure = sure.select("key", F.col("low").alias("start"), (F.col("low") + F.col("count") + (length - 1)).alias("end"))
    sure = materialize(sure.join(copies, "key", "left_anti").distinct(), "sure-spans")
    asked = standing.groupBy("key").agg(F.collect_list(F.struct("gram", "low", "count", "reach", "n")).alias("classes"))
    single = standing.where("n = 1").select("key").union(sure.select("key")).distinct().withColumn("wanted", F.lit(True))
    asked = asked.join(single, "key", "full_outer").withColumn("wanted", F.coalesce("wanted", F.lit(False)))
    once = texts.dropDuplicates(["key"]).join(asked, "key")
    schema = "key binary, text binary, gram long, low long, count int, reach int, members long, bytes binary"
    stored = materialize(once.mapInArrow(functools.partial(_context_batches, length=length), schema), "contexts")
    contexts = stored.where("gram is not null").drop("text").join(several, "gram")
    dealt = contexts.where(F.col("classes") <= HOT_CLASSES).drop("classes").repartition("gram").sortWithinPartitions("gram")
    merged = dealt.mapInArrow(functools.partial(_merged_batches, length=length), "key binary, start long, end long")
    hot = contexts.where(F.col("classes") > HOT_CLASSES)
    split = hot_spans(hot, length) if not several.where(F.col("classes") > HOT_CLASSES).isEmpty() else sure.limit(0)
    spans = materialize(sure.union(merged).union(split), "spans")
    return spans, stored.where("text is not null").select("key", "text")


def remove_repeats(df: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes; null if nothing was removed)."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    keyed = rows.withColumn("key", F.unhex(F.md5("text")))
    copies = materialize(keyed.where(F.octet_length("text") >= length).groupBy("key").count().where("count > 1").select("key"), "copies")
    spans, texts = repeated_spans(keyed.select("key", "text"), copies, length, gram)
    grouped = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    changed = texts.join(grouped, "key").mapInArrow(_cut_batches, "key binary, n_removed long, n_spans long, kept binary")
    changed = changed.unionByName(copies.select("key", F.lit(None).cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept")))
    changed = materialize(changed.withColumn("cut_sha256", F.sha2("kept", 256)), "cut-texts")
    narrow = keyed.select("doc_id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole_sha256"))
    joined = narrow.join(changed, "key", "left")
    return joined.select(
        "doc_id", "n_bytes", F.when(F.col("n_spans").isNull(), 0).otherwise(F.coalesce("n_removed", "n_bytes")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"), "kept",
    )

