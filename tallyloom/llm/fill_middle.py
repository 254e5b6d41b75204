"""Fill-in-middle transformation: texts cut at two code points and rearranged around sentinels.

The cuts are numbers of code points, the texts are UTF-8 bytes. The byte offsets at which code points start, and
the end of the text, form a set of integers; the byte offset of cut ``k`` is the set's ``k``-th member (select).
:class:`Boundaries` stores that set as compressed bitmaps do: one container for each 2**16 offsets, which is the smallest of

* run: starts and lengths of runs (texts of one-byte characters are one run),
* array: the members themselves,
* bitmap: one bit for each of the 2**16 offsets,

each with the running count of its members. A cut is found by a binary search among the containers' running counts,
then inside one container: by index (array), among running run lengths (run) or among running bit counts (bitmap).

The choice of cuts and form comes from ``sha256(seed:doc_id)``, so it does not depend on partitions, order or retries.
A task sees one slice of an Arrow batch at a time; nothing is shuffled.

Defined results: a missing or empty text is plain, of 0 code points; a text that has a sentinel in it is plain, so every
output can be taken apart again; a missing id counts as an empty one, so its rows are cut alike; repeated rows give equal
rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import sliced, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SPAN = 1 << 16


class RunContainer:
    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts, self.before = starts, np.cumsum(lengths) - lengths

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


class ArrayContainer:
    def __init__(self, members: np.ndarray):
        self.members = members.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.members[k])


class BitmapContainer:
    def __init__(self, flags: np.ndarray):
        self.bits = np.packbits(flags, bitorder="little")
        counts = np.bitwise_count(self.bits).astype(np.int32)
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        bits = np.flatnonzero(np.unpackbits(self.bits[at : at + 1], bitorder="little"))
        return 8 * at + int(bits[k - int(self.before[at])])


def container(flags: np.ndarray):
    """The smallest container for the offsets at which ``flags`` is true."""
    edges = np.flatnonzero(flags[1:] != flags[:-1]) + 1
    edges = np.concatenate([[0] if flags[0] else [], edges, [len(flags)] if flags[-1] else []]).astype(np.int64)
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    members = int(lengths.sum())
    smallest = min(4 * len(starts), 2 * members, SPAN // 8)
    if smallest == 4 * len(starts):
        return RunContainer(starts, lengths), members
    if smallest == 2 * members:
        return ArrayContainer(np.flatnonzero(flags)), members
    return BitmapContainer(flags), members


class Boundaries:
    """The byte offsets at which the code points of a text start, and its end."""

    def __init__(self, raw: np.ndarray):
        flags = np.ones(len(raw) + 1, bool)
        flags[:-1] = (raw & 0xC0) != 0x80
        found = [container(flags[low : low + SPAN]) for low in range(0, len(flags), SPAN)]
        self.containers = [c for c, _ in found]
        self.ends = np.cumsum([n for _, n in found])
        self.size = int(self.ends[-1])

    def select(self, k: int) -> int:
        """Byte offset of the ``k``-th code point; the end for ``k`` equal to their number."""
        if not 0 <= k < self.size:
            raise IndexError(k)
        at = int(np.searchsorted(self.ends, k, side="right"))
        return at * SPAN + self.containers[at].select(k - (int(self.ends[at - 1]) if at else 0))


def arranged(raw: bytes, low: int, high: int, form: str) -> bytes:
    """The output for byte cuts ``low`` and ``high``."""
    prefix, middle, suffix = raw[:low], raw[low:high], raw[high:]
    if form == "psm":
        return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    if form == "spm":
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return raw


def restored(output: bytes, form: str) -> bytes:
    """The text an output was made of. Sentinels occur once each, because texts that have one stay plain."""
    if form == "plain":
        return output
    head, _, middle = output.partition(MIDDLE)
    if form == "psm":
        prefix, _, suffix = head[len(PREFIX) :].partition(SUFFIX)
    else:
        suffix, _, prefix = head[len(SUFFIX) :].partition(PREFIX)
    return prefix + middle + suffix


def _batches(batches, plain_from: int, spm_below: int, texts: bool):
    for batch in sliced(batches):
        data, bounds = utf8(batch.column("text"))
        draws = np.column_stack([batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)])
        out: dict[str, list] = {k: [] for k in ("n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256")}
        for row in range(batch.num_rows):
            view = data[bounds[row] : bounds[row + 1]]
            raw, points = view.tobytes(), Boundaries(view)
            n, (h1, h2, h3, h4) = points.size - 1, draws[row].tolist()
            first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
            plain = n == 0 or any(mark in raw for mark in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= plain_from
            form = "plain" if plain else "spm" if h4 % 100 < spm_below else "psm"
            output = raw if plain else arranged(raw, points.select(first), points.select(second), form)
            values = (n, form, None if plain else first, None if plain else second - first, output.decode() if texts else None,
                      hashlib.sha256(output).hexdigest(), hashlib.sha256(restored(output, form)).hexdigest())
            for k, value in zip(out, values):
                out[k].append(value)
        kinds = {"n": pa.int64(), "prefix_chars": pa.int64(), "middle_chars": pa.int64()}
        yield pa.record_batch({"doc_id": batch.column("doc_id")} | {k: pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()})


def fill_in_middle(df: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, plain_from: int = 90, spm_below: int = 20, texts: bool = True) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output, output_sha256, restored_sha256.

    ``plain_from`` of 100 texts are rearranged, ``spm_below`` of 100 of those with the suffix first. Without ``texts`` the
    output column is left out; its checksum stays.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *draws)
    run = functools.partial(_batches, plain_from=plain_from, spm_below=spm_below, texts=texts)
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string, restored_sha256 string"
    done = rows.mapInArrow(run, schema)
    return done if texts else done.drop("output")


ORACLE = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
numbers AS (
  SELECT *, CAST('0x' || d[1:8] AS BIGINT) AS h1, CAST('0x' || d[9:16] AS BIGINT) AS h2, CAST('0x' || d[17:24] AS BIGINT) AS h3,
    CAST('0x' || d[25:32] AS BIGINT) AS h4 FROM drawn),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, substr(t, 1, low) AS p, substr(t, low + 1, high - low) AS m, substr(t, high + 1) AS s FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""
