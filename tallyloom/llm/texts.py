"""Whole texts as arrays inside a task: batches by size, byte spans of words, 64-bit hashes.

All functions work on one Arrow batch at a time; nothing here knows about Spark plans.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
NARROW_BYTES = 1 << 19  # for steps that make tens of bytes of each byte of a text
PIECE_BYTES = 1 << 16

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def give_back() -> None:
    """Return freed memory to the system. Spark keeps a worker for later tasks, which would keep all it once held."""
    _powers.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def sliced(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of at most ``limit`` text bytes, or a single row if that is longer. Freed memory goes back at the end."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    batch = sizes = ends = None
    give_back()


class Memo(dict):
    """Keeps what ``make`` gives for a string, up to a number of them; others, and longer ones, are made whenever they are met."""

    def __init__(self, make: Callable[[str], object], bound: int, longest: int):
        super().__init__()
        self.make, self.bound, self.longest = make, bound, longest

    def __missing__(self, key: str):
        made = self.make(key)
        if len(self) < self.bound and len(key) <= self.longest:
            self[key] = made
        return made


def strings(column: pa.Array) -> list[str]:
    """The texts, a missing one as an empty text."""
    return pc.fill_null(column, "").to_pylist()


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the row bounds in them; a missing text has none."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def byte_table(lower: bool, separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Tables over byte values: the byte after lower-casing A-Z, and whether it belongs to a word."""
    values = np.arange(256, dtype=np.uint8)
    if lower:
        values[65:91] += 32
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return values, inside


def runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross rows: starts, ends, and each row's bounds among the runs."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    joined = mask[1:] & mask[:-1]
    cuts = bounds[(bounds > 0) & (bounds < len(mask))]
    joined[cuts - 1] = False
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~joined
    last[:-1] &= ~joined
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    values = values ^ (values >> np.uint64(30))
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers, ``n`` or more, of the hash base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        _powers.clear()
        for base in (_BASE, _INVERSE):
            values = np.full(1 << max(17, int(n).bit_length()), base, np.uint64)
            values[0] = 1
            _powers.append(np.cumprod(values, out=values))
    return _powers[0], _powers[1]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; starts ascend. Spans are hashed piece by piece to bound memory."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + PIECE_BYTES)))
        low, high = int(starts[i]), int(ends[i:j].max())
        up, down = powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes; the last ``size - 1`` positions have none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
        out += words[k : k + n]
    return mix(out)


def fold(values: np.ndarray, seed: int = 0) -> int:
    """One 64-bit hash of a sequence of 64-bit values, in order."""
    n = len(values)
    up, _ = powers(n + 1)
    total = int(np.sum(mix(values + np.uint64(seed)) * up[:n], dtype=np.uint64)) if n else 0
    return int(mix(np.array([total ^ (n * 0xA24BAED4963EE407) % (1 << 64)], np.uint64))[0])


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as the long values that Spark stores."""
    return values.view(np.int64)


def ragged(lengths: np.ndarray) -> np.ndarray:
    """0, 1, .. length - 1 for each length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


PROBES = (
    "Hello, world! It's 2024: don't, we'll.", " a", "a  b", "  two\n\n three\t4 ", "ABC Def ghi", "é É ß ﬁ ² Å e\u0301", "中文字 日本", "x\u00a0y\u3000z",
    "naïve 12,345.67 #tag @me", "a_b-c/d\\e", "😀👍🏽", "\x00\x7f\u200b", "unbelievably internationalization", "'S 'RE", "...!!??", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
)


def refuse_others(path: str, own: Callable[[list[str]], list], library: Callable[[str], object]) -> None:
    """Raise unless ``own`` agrees with the library on texts that differ between kinds of tokenizer files."""
    wrong = [text for text, found in zip(PROBES, own(list(PROBES))) if found != library(text)]
    if wrong:
        raise ValueError(f"{path} is of a kind that is not served: it treats {wrong[0]!r} in another way")
