"""SentencePiece encoding and decoding by one pass of an Aho-Corasick automaton.

The automaton holds all pieces. Reading a segment once, every match found over the output links ends at the
current position and relaxes it: for a unigram model the best total score of all ways to get there
(Viterbi); for a merge (BPE) model the one last piece that merging would leave there. The latter is the
longest-first match that fits the last piece at its start, where two pieces fit if no merge across their common bound would
have come before the merges that formed them. Both give the library's ids, unlike a plain best score
over a merge model's ranks.

No piece holds a blank mark behind another character, so a text falls into segments that start with blank marks
and are encoded independently; known segments are kept up to a bound. Characters outside the pieces are
their UTF-8 bytes.

A model file whose library splits or normalizes texts in another way is refused when it is loaded.

Defined results: a missing or empty text has no ids; decoding gives the text back, but for the blank
mark U+2581 itself, which comes back as a blank; other columns are ignored, or passed through if kept, whatever their names.
"""

from __future__ import annotations

import functools
import re
from heapq import heappop, heappush

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import Memo, give_back, refuse_others, sliced, strings
from tallyloom.session import by_batches

BLANK = "▁"
KEPT_SEGMENTS = 600_000
KEPT_PARTS = 200_000
KEPT_PAIRS = 400_000
KEPT_LENGTH = 256  # longer segments and parts are not kept
_segments = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+").findall


class Pieces:
    """A piece table with its automaton; ``kind`` is ``bpe`` or ``unigram``."""

    def __init__(self, pieces: list[str], scores: list[float], usable: list[bool], byte_ids: list[int], unknown: int = 0, kind: str = "bpe"):
        self.pieces, self.scores, self.byte_ids, self.unknown, self.kind = pieces, scores, byte_ids, unknown, kind
        self.ids = {p: i for i, p in enumerate(pieces) if usable[i]}
        self.known = Memo(lambda segment: np.array(self.encode_parts(segment), "<u2").tobytes(), KEPT_SEGMENTS, KEPT_LENGTH)
        self.parts = Memo(self.encode_segment, KEPT_PARTS, KEPT_LENGTH)
        self.inner = {pair for p in self.ids for pair in zip(p, p[1:])}
        self.spines: dict[tuple[int, int], list[tuple[int, float, float]]] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.fitting = Memo(lambda pair: self._fits(*pair), KEPT_PAIRS, 2)
        self.worst = min((scores[i] for i in self.ids.values()), default=0.0) - 10.0
        if kind == "unigram":
            self.worst = min(scores[i] for i in self.ids.values()) - 10.0
        self.raw = [p.replace(BLANK, " ").encode() for p in pieces]
        for value, i in enumerate(byte_ids):
            self.raw[i] = bytes([value])
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            if kind == "unigram" or self.formed(i):  # merging never leaves a piece that no merge forms
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()

    def bytes_of(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]

    # Merge models.

    def merge(self, text: str, least: float = float("-inf")) -> list[str]:
        """Merge neighbours by score, the leftmost of equals first, down to scores above ``least``.

        Possible merges wait in a heap over a linked list of parts, so a text of n characters takes about n log n steps.
        """
        ids, scores, size = self.ids, self.scores, len(text)
        parts, after, before, heap = list(text), list(range(1, size + 1)), list(range(-1, size - 1)), []

        def offer(a: int, b: int) -> None:
            i = ids.get(parts[a] + parts[b])
            if i is not None and scores[i] > least:
                heappush(heap, (-scores[i], a, len(parts[a]), len(parts[b])))

        for a in range(size - 1):
            offer(a, a + 1)
        while heap:
            _, a, left, right = heappop(heap)
            b = after[a]
            if len(parts[a]) != left or b >= size or len(parts[b]) != right:
                continue  # one of both has grown or gone since
            parts[a], parts[b], after[a] = parts[a] + parts[b], "", after[b]
            if after[a] < size:
                before[after[a]] = a
                offer(a, after[a])
            if before[a] >= 0:
                offer(before[a], a)
        return [p for p in parts if p]

    def split(self, i: int) -> tuple[int, int] | None:
        """The two pieces whose merge forms piece ``i``; None for a single character or a piece no merge forms."""
        if i not in self.halves:
            parts = self.merge(self.pieces[i], self.scores[i]) if len(self.pieces[i]) > 1 else []
            both = [self.ids.get(p) for p in parts]
            self.halves[i] = (both[0], both[1]) if len(both) == 2 and None not in both else None
        return self.halves[i]

    def formed(self, i: int) -> bool:
        return len(self.pieces[i]) == 1 or self.split(i) is not None

    def spine(self, i: int, side: int) -> list[tuple[int, float, float]]:
        """Pieces at one edge of piece ``i`` over time: (piece, score that forms it, score that takes it up)."""
        if (i, side) not in self.spines:
            out, now, taken = [], i, float("-inf")
            while True:
                halves = self.split(now)
                born = self.scores[now] if halves else float("inf")
                out.append((now, born, taken))
                if not halves:
                    break
                now, taken = halves[side], born
            self.spines[i, side] = out
        return self.spines[i, side]

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging leaves a bound between both pieces."""
        for a, born_a, taken_a in self.spine(left, 1):
            for b, born_b, taken_b in self.spine(right, 0):
                if min(born_a, born_b) > max(taken_a, taken_b):  # both there at some time; scores fall with time
                    joined = self.ids.get(self.pieces[a] + self.pieces[b])
                    if joined is not None and self.scores[joined] > taken_a and self.scores[joined] >= taken_b:
                        return False
        return True

    def _merge_pass(self, text: str) -> list[int]:
        last: list[tuple[int, int] | None] = [None] * (len(text) + 1)  # piece (or -1) and its start
        done, fitting = 0, self.fitting
        for end, (i, size) in self.automaton.iter(text):
            while done < end:  # positions without a match
                done += 1
                if last[done] is None:
                    last[done] = (-1, done - 1)
            if last[end + 1] is None:
                start = end + 1 - size
                before = last[start]
                if start == 0 or before and (before[0] < 0 or fitting[before[0], i]):
                    last[end + 1] = (i, start)
        for at in range(done + 1, len(text) + 1):
            if last[at] is None:
                last[at] = (-1, at - 1)
        return self._back(text, last)

    # Unigram models.

    def _best_pass(self, text: str) -> list[int]:
        best, last = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
        done = 0

        def alone(upto: int) -> None:
            nonlocal done
            while done < upto:  # a character without a piece of its own
                done += 1
                if text[done - 1] not in self.ids and best[done - 1] + self.worst > best[done]:
                    best[done], last[done] = best[done - 1] + self.worst, (-1, done - 1)

        for end, (i, size) in self.automaton.iter(text):
            alone(end)
            total = best[end + 1 - size] + self.scores[i]
            if total > best[end + 1]:
                best[end + 1], last[end + 1] = total, (i, end + 1 - size)
        alone(len(text))
        return self._back(text, last)

    def _back(self, text: str, last: list) -> list[int]:
        out, at = [], len(text)
        while at:
            piece, start = last[at]
            out += [piece] if piece >= 0 else self.bytes_of(text[start])[::-1]
            at = start
        return out[::-1]

    def encode_segment(self, text: str) -> list[int]:
        if self.kind == "unigram":
            return self._best_pass(text)
        if text.startswith(BLANK * 2):  # the runs of blanks all have one score, so their merges depend on their places
            return [i for p in self.merge(text) for i in ([self.ids[p]] if p in self.ids else self.bytes_of(p))]
        return self._merge_pass(text)

    def encode_parts(self, text: str) -> list[int]:
        """Encode between neighbours that no piece has side by side; known parts are kept up to a bound."""
        inner, cuts = self.inner, [0]
        cuts += [k for k, pair in enumerate(zip(text, text[1:]), 1) if pair not in inner]
        return [i for low, high in zip(cuts, [*cuts[1:], len(text)]) for i in self.parts[text[low:high]]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of every text."""
        ids = self.known.__getitem__
        return [b"".join(map(ids, _segments(BLANK + t.replace(" ", BLANK)))) if t else b"" for t in texts]

    def forget(self) -> None:
        """Drop what texts taught; the next task learns from its own. One small thing kept in between would hold a block of memory."""
        for memo in (self.known, self.parts, self.fitting, self.spines):
            memo.clear()

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no text become the replacement character."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        return raw.decode("utf-8", "replace").removeprefix(" ")


@functools.cache
def load(path: str, kind: str = "bpe") -> Pieces:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.GetPieceSize()
    if size > 1 << 16:
        raise ValueError("more pieces than 16-bit ids")
    special = [model.IsControl(i) or model.IsUnknown(i) or model.IsUnused(i) or model.IsByte(i) for i in range(size)]
    byte_ids = [i for i in range(size) if model.IsByte(i)]
    own = Pieces([model.IdToPiece(i) for i in range(size)], [model.GetScore(i) for i in range(size)], [not s for s in special], byte_ids, model.unk_id(), kind)
    refuse_others(path, lambda texts: [np.frombuffer(c, "<u2").tolist() for c in own.encode(texts)], model.EncodeAsIds)
    return own


OUTPUTS = ("n_tokens", "ids", "restored")


def _encode_batches(batches, path: str, kind: str, names: tuple[str, ...]):
    pieces = load(path, kind)
    for batch in sliced(batches, "_text"):
        texts = strings(batch.column("_text"))
        coded = pieces.encode(texts)
        ids = [np.frombuffer(c, "<u2") for c in coded]
        sizes = np.array([len(i) for i in ids], np.int64)
        flat = np.concatenate([*ids, np.zeros(0, "<u2")]).astype(np.int32)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        restored = [pieces.decode(i.tolist()) == t.replace(BLANK, " ") for i, t in zip(ids, texts)]
        made = [pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat)), pa.array(restored, pa.bool_())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*names, *OUTPUTS])
    pieces.forget()
    give_back()


def _kept(df: DataFrame, keep: tuple[str, ...], outputs: tuple[str, ...], read: Column, into: str) -> tuple[DataFrame, tuple[str, ...], str]:
    """The kept columns and the one to read under a name of its own, the names they come back as, and their types."""
    names = tuple(f"{name}_in" if name in outputs else name for name in keep)
    rows = df.select(*[F.col(f"`{name}`").alias(f"_k{i}") for i, name in enumerate(keep)], read.alias(into))
    fields = "".join(f"`{name}` {f.dataType.simpleString()}, " for name, f in zip(names, rows.schema.fields))
    return rows, names, fields


def encode(df: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), kind: str = "bpe") -> DataFrame:
    """The kept columns, n_tokens, ids, and whether decoding the ids gives the text back. One narrow pass.

    A kept column that has the name of a result comes back with ``_in`` behind it.
    """
    load(path, kind)
    rows, names, fields = _kept(df, tuple(keep), OUTPUTS, F.col(f"`{text}`").cast("string"), "_text")
    run = functools.partial(_encode_batches, path=path, kind=kind, names=names)
    return by_batches(rows, run, f"{fields}n_tokens long, ids array<int>, restored boolean")


def _decode_batches(batches, path: str, kind: str, names: tuple[str, ...]):
    pieces = load(path, kind)
    for batch in batches:
        texts = [pieces.decode(ids or []) for ids in batch.column("_ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*names, "text"])


def decode(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",), kind: str = "bpe") -> DataFrame:
    """The kept columns and the text of the ids; missing ids give an empty text. A kept ``text`` comes back as ``text_in``."""
    rows, names, fields = _kept(df, tuple(keep), ("text",), F.col(f"`{ids}`"), "_ids")
    return rows.mapInArrow(functools.partial(_decode_batches, path=path, kind=kind, names=names), f"{fields}text string")
