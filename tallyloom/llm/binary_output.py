"""Token ids as Arrow files of fixed-size lists, readable at random without a copy.

Documents are ordered by id with a range partitioning, so each task holds a run of ids. It encodes its
documents, writes one Arrow file of equal-length sequences (``ids``: fixed-size list of uint16 or
uint32, ``mask``: fixed-size list of booleans, false only on the padding of the shard's last
sequence) and one of the shard's documents with their places. A file's batches all have the same number of
sequences, so token ``i`` of a shard is at a computable place of a memory-mapped file. The manifest has
one row per shard; it is the only thing the driver sees and gives each shard its global start. Every
attempt of a task writes files of its own name and only the manifest's names are read, so a lost
executor or a second attempt leaves no trace in the result.

White space never lies inside a token of the word tokenizer and is dropped by it, so a text is
encoded chunk by chunk between ASCII white space: the library encodes a chunk when it is first met, known
chunks are kept up to a bound.

Defined results: a missing or empty text has just the end id; rows of the same id keep ascending order by
text; rows without an id come first; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.texts import Memo, refuse_others, sliced, strings
from tallyloom.llm.token_counts import load
from tallyloom.session import materialize, scratch_path

SEQUENCE = 1024
BATCH_SEQUENCES = 512
KEPT_CHUNKS = 700_000
KEPT_WORDS = 500_000
KEPT_LENGTH = 256  # longer chunks are not kept

# Latin letters that neither the normalizer's composition nor its lower-casing joins with anything, then punctuation.
_plain = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?*#$%&|]*)").fullmatch


class Encoder:
    """Encodes texts to bytes of little-endian ids; one per Python worker."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.model = self.tokenizer.model.tokenize
        self.words = Memo(self.ask, KEPT_WORDS, KEPT_LENGTH)
        self.known = Memo(self.encode_chunk, KEPT_CHUNKS, KEPT_LENGTH)

    def ask(self, part: str) -> bytes:
        """Ids of a part from the library; plain lower-case words go straight to its model."""
        if part.isascii() and part.isalpha() and part.islower():
            ids = [t.id for t in self.model(part)]
        else:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a chunk. A word with punctuation behind it is two tokens' worth of input to the library."""
        match = _plain(chunk)
        return self.words[match[1].lower()] + self.words[match[2]] if match else self.ask(chunk)

    def encode(self, texts: list[str], end: int) -> list[bytes]:
        for blank in "\t\n\x0b\x0c\r":
            texts = [text.replace(blank, " ") for text in texts]
        tail, ids = np.array([end], self.kind).tobytes(), self.known.__getitem__
        return [b"".join(map(ids, text.split(" "))) + tail for text in texts]


def check_kind(path: str) -> None:
    """Raise for files whose tokens reach over white space or whose texts are normalized in another way."""
    encoder = Encoder(path)
    encode = encoder.tokenizer.encode
    refuse_others(path, lambda texts: [np.frombuffer(e, encoder.kind)[:-1].tolist() for e in encoder.encode(texts, 0)], lambda text: encode(text, add_special_tokens=False).ids)


_encoders: dict[str, Encoder] = {}


def store(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


class ShardWriter:
    """Writes the ids of one shard as equal-length sequences with a mask."""

    def __init__(self, sink, kind: np.dtype, length: int):
        self.length, self.kind = length, kind
        item = pa.from_numpy_dtype(kind)
        self.schema = pa.schema({"ids": pa.list_(item, length), "mask": pa.list_(pa.bool_(), length)})
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.parts: list[np.ndarray] = []
        self.waiting = self.written = 0

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.waiting += len(ids)
        block = self.length * BATCH_SEQUENCES
        if self.waiting >= block:
            joined = np.concatenate(self.parts)
            whole = len(joined) // block * block
            for low in range(0, whole, block):
                self._batch(joined[low : low + block], block)
            self.parts = [joined[whole:].copy()]
            self.waiting = len(joined) - whole

    def _batch(self, ids: np.ndarray, size: int) -> None:
        mask = np.arange(size) < len(ids)
        padded = np.zeros(size, self.kind)
        padded[: len(ids)] = ids
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.writer.write_batch(pa.record_batch(arrays, schema=self.schema))
        self.written += len(ids)

    def close(self) -> int:
        if self.waiting:
            rest = np.concatenate(self.parts)
            self._batch(rest, -(-len(rest) // self.length) * self.length)
        self.writer.close()
        return self.written


def write_shard(batches, path: str, folder: str, end: int, length: int):
    """Encode the sorted documents of a partition and write its two files; yields the manifest row."""
    from pyspark import TaskContext

    encoder = _encoders.setdefault(path, None) or Encoder(path)
    _encoders[path] = encoder
    fs, root = store(folder)
    fs.create_dir(root, recursive=True)
    name = f"{root}/{uuid.uuid4().hex}"
    places = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()})
    total, rows = 0, 0
    with fs.open_output_stream(f"{name}.arrow") as out, fs.open_output_stream(f"{name}.docs.arrow") as index:
        writer = ShardWriter(out, encoder.kind, length)
        with pa.ipc.new_file(index, places) as docs:
            for batch in sliced(batches):
                encoded = encoder.encode(strings(batch.column("text")), end)
                sizes = np.array([len(e) // encoder.kind.itemsize for e in encoded], np.int64)
                starts = total + np.cumsum(sizes) - sizes
                docs.write_batch(pa.record_batch([batch.column("doc_id"), pa.array(starts), pa.array(sizes)], schema=places))
                writer.add(np.frombuffer(b"".join(encoded), encoder.kind))
                total, rows = total + int(sizes.sum()), rows + len(sizes)
        writer.close()
    if rows:
        shard = TaskContext.get().partitionId()
        yield pa.record_batch({"shard": pa.array([shard], pa.int64()), "name": [name], "n_docs": pa.array([rows], pa.int64()), "n_tokens": pa.array([total], pa.int64())})


class ShardReader:
    """Random access to one shard: tokens by position, without reading the rest of the file."""

    def __init__(self, fs: pafs.FileSystem, name: str):
        local = isinstance(fs, pafs.LocalFileSystem)
        self.file = pa.memory_map(f"{name}.arrow") if local else fs.open_input_file(f"{name}.arrow")
        self.reader = pa.ipc.open_file(self.file)
        self.length = self.reader.schema.field("ids").type.list_size
        self.block = self.length * BATCH_SEQUENCES
        self.at, self.ids = -1, np.zeros(0)

    def batch(self, k: int) -> np.ndarray:
        if k != self.at:
            batch = self.reader.get_batch(k)
            self.ids, self.at = batch.column("ids").flatten().to_numpy(zero_copy_only=True), k
        return self.ids

    def tokens(self, start: int, count: int) -> np.ndarray:
        first, last = start // self.block, (start + count - 1) // self.block
        parts = []
        for k in range(first, last + 1):
            low, high = max(start - k * self.block, 0), min(start + count - k * self.block, self.block)
            parts.append(self.batch(k)[low:high])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)


def read_shards(batches, folder: str):
    """Documents of the listed shards, from the files."""
    fs, _ = store(folder)
    for batch in batches:
        for row in batch.to_pylist():
            shard = ShardReader(fs, row["name"])
            with fs.open_input_file(f"{row['name']}.docs.arrow") as source:
                docs = pa.ipc.open_file(source)
                for k in range(docs.num_record_batches):
                    part = docs.get_batch(k)
                    starts, sizes = part.column("start").to_numpy(), part.column("n_tokens").to_numpy()
                    sums = [zlib.crc32(shard.tokens(int(s), int(n)).astype("<u4").tobytes()) for s, n in zip(starts, sizes)]
                    yield pa.record_batch({"doc_id": part.column("doc_id"), "start": pa.array(starts + row["base"]), "n_tokens": part.column("n_tokens"), "ids_crc32": pa.array(sums, pa.int64())})


def write_tokens(df: DataFrame, path: str, folder: str, doc_id: str = "doc_id", text: str = "text", end: int = 2, length: int = SEQUENCE) -> DataFrame:
    """Write the ids of all texts in ascending id order and return the manifest: shard, name, n_docs, n_tokens."""
    spark = df.sparkSession
    check_kind(path)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    run = functools.partial(write_shard, path=path, folder=folder, end=end, length=length)
    return materialize(ordered.mapInArrow(run, "shard long, name string, n_docs long, n_tokens long"), "token-manifest")


def read_tokens(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """Every document of a written set with its global start and the checksum of its ids.

    The manifest has a row for each shard (partition) and so stays small at any input size.
    """
    base, listed = 0, []
    for row in manifest.orderBy("shard").collect():
        listed.append((row["name"], base))
        base += row["n_tokens"]
    shards = spark.createDataFrame(listed, "name string, base long").repartition(max(1, len(listed)))
    run = functools.partial(read_shards, folder=folder)
    return shards.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", end: int = 2, length: int = SEQUENCE) -> DataFrame:
    """Write to the shared folder and read back: doc_id, start, n_tokens, ids_crc32."""
    folder = scratch_path(df.sparkSession, "tokens")
    folder = folder if ":" in folder.split("/")[0] else os.path.abspath(folder)
    manifest = write_tokens(df, path, folder, doc_id, text, end, length)
    return read_tokens(df.sparkSession, manifest, folder)
