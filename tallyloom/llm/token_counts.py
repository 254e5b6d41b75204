"""Token counts by compiled finite-state transducers.

The pattern that a byte-level BPE tokenizer splits texts with is compiled to a deterministic
transducer over ten character classes. Each transition says whether a new piece begins before the
character read or before the one ahead of it. All state maps that any chunk of text can have form a
small monoid; its elements are numbered once, so a chunk's map is found with one table look-up per
character whatever state the chunk starts in. Maps of successive chunks compose through a parallel
prefix scan (doubling steps with the composition table); a document's first chunk begins with the
constant map "start of text", which resets everything before it. The scan gives every chunk its start
state, and the states give the piece bounds.

The second machine reads pieces. Its transitions are annotated with the number of tokens emitted for
the whole piece, which the library states when a piece is first met; transitions are kept up to a
bound, beyond it they are worked out again. Counts are therefore the library's own.

Defined results: a missing or empty text has 0 bytes and 0 tokens; strings of added tokens count as
one token each and split the text, which is the library's default; repeated rows and missing ids are
counted row by row; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import refuse_others, sliced, strings

CHUNK = 64
KEPT_PIECES = 800_000

# Character classes: letters with a part in contractions apart.
LETTER, STMD, LETTER_R, LETTER_V, LETTER_L, LETTER_E, NUMBER, SPACE, WHITE, QUOTE, OTHER = range(11)
LETTERS = (LETTER, STMD, LETTER_R, LETTER_V, LETTER_L, LETTER_E)
# States: what the piece being read is so far.
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, APOSTROPHE, ONE_SPACE, ONE_WHITE, MANY_SPACE, MANY_WHITE, CONTRACTED, SEEN_R, SEEN_V, SEEN_L = range(13)
PENDING = {SEEN_R: LETTER_E, SEEN_V: LETTER_E, SEEN_L: LETTER_L}
BEFORE_THIS, BEFORE_LAST = 1, 2


def fresh(kind: int) -> int:
    """State after the first character of a piece."""
    if kind in LETTERS:
        return IN_LETTERS
    return {NUMBER: IN_NUMBERS, SPACE: ONE_SPACE, WHITE: ONE_WHITE, QUOTE: APOSTROPHE, OTHER: IN_OTHER}[kind]


def step(state: int, kind: int) -> tuple[int, int]:
    """Next state and the piece bounds that this character decides."""
    white = kind in (SPACE, WHITE)
    joined = IN_OTHER if kind in (QUOTE, OTHER) else fresh(kind)
    if state in (ONE_SPACE, ONE_WHITE, MANY_SPACE, MANY_WHITE):
        if white:
            return (MANY_SPACE if kind == SPACE else MANY_WHITE), 0
        split = BEFORE_LAST if state in (MANY_SPACE, MANY_WHITE) else 0
        if state in (ONE_SPACE, MANY_SPACE):
            return joined, split
        return fresh(kind), split | BEFORE_THIS
    if state in PENDING:
        if kind == PENDING[state]:
            return CONTRACTED, 0
        return (IN_LETTERS, BEFORE_LAST) if kind in LETTERS else (fresh(kind), BEFORE_LAST | BEFORE_THIS)
    if state == APOSTROPHE:
        if kind in (QUOTE, OTHER):
            return IN_OTHER, 0
        if kind == STMD:
            return CONTRACTED, 0
        if kind in (LETTER_R, LETTER_V, LETTER_L):
            return {LETTER_R: SEEN_R, LETTER_V: SEEN_V, LETTER_L: SEEN_L}[kind], 0
    same = {IN_LETTERS: LETTERS, IN_NUMBERS: (NUMBER,), IN_OTHER: (QUOTE, OTHER)}.get(state, ())
    return (state, 0) if kind in same else (fresh(kind), BEFORE_THIS)


@functools.cache
def compiled() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """State maps by number, map after one more character, composition, outputs, the reset map's number.

    Symbol 11 is padding (the identity), so chunks of any length have a map.
    """
    table = np.array([[step(s, k)[0] for k in range(11)] for s in range(13)], np.int64)
    outputs = np.array([[step(s, k)[1] for k in range(11)] for s in range(13)], np.uint8)
    identity, reset = tuple(range(13)), (START,) * 13
    numbers, queue, after = {identity: 0, reset: 1}, [identity, reset], []
    for mapping in queue:
        row = []
        for kind in range(11):
            image = tuple(int(table[s, kind]) for s in mapping)
            if image not in numbers:
                numbers[image] = len(queue)
                queue.append(image)
            row.append(numbers[image])
        after.append([*row, numbers[mapping]])
    maps = np.array(queue, np.int64)
    compose = np.array([[numbers[tuple(second[list(first)])] for second in maps] for first in queue], np.int32)
    return maps, np.array(after, np.int32), compose, outputs, 1


def character_classes(tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """First code points and classes of all ranges, as the tokenizer's own pre-tokenizer tells them.

    A character is a letter if no bound falls between ``a`` and it, and so on; what joins nothing is
    white space. Asking the library avoids any difference between Unicode versions.
    """
    split = tokenizer.pre_tokenizer.pre_tokenize_str
    kinds = np.full(0x110000, WHITE, np.uint8)
    leads = (("a", LETTER), ("!", OTHER), ("1", NUMBER))

    def probe(points: list[int]) -> None:
        for lead, kind in leads if len(points) > 64 else ():
            if len(split(lead + "".join(map(chr, points)))) == 1:
                kinds[points] = kind
                return
        if len(points) > 64:
            for low in range(0, len(points), len(points) // 8):
                probe(points[low : low + len(points) // 8])
            return
        for lead, kind in leads:
            bounds = {start for _, (start, _) in split("".join(f"{lead}{chr(p)}\n" for p in points))}
            kinds[[p for i, p in enumerate(points) if 3 * i + 1 not in bounds]] = kind

    for low in range(0, 0x110000, 4096):
        if points := [p for p in range(low, low + 4096) if not 0xD800 <= p < 0xE000]:
            probe(points)
    for characters, kind in (("stmd", STMD), ("r", LETTER_R), ("v", LETTER_V), ("l", LETTER_L), ("e", LETTER_E), (" ", SPACE), ("'", QUOTE)):
        kinds[[ord(c) for c in characters]] = kind
    firsts = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1]]))
    return firsts.astype(np.int32), kinds[firsts]


@functools.cache
def classes_of(path: str) -> tuple[np.ndarray, np.ndarray]:
    return character_classes(load(path))


@functools.cache
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def piece_bounds(kinds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """True where a piece begins, for documents of the given lengths one after the other."""
    maps, after, compose, outputs, reset = compiled()
    filled = lengths[lengths > 0]
    chunks = -(-filled // CHUNK)
    first_chunk = np.cumsum(chunks) - chunks
    grid = np.full((int(chunks.sum()), CHUNK), 11, np.uint8)
    within = np.arange(len(kinds)) - np.repeat(np.cumsum(filled) - filled, filled)
    place = np.repeat(first_chunk * CHUNK, filled) + within
    grid.reshape(-1)[place] = kinds
    seen = np.zeros(grid.shape, np.int32)  # number of the map of the chunk's characters before this one
    now = np.zeros(len(grid), np.int32)
    for column in range(CHUNK):
        seen[:, column] = now
        now = after[now, grid[:, column]]
    now[first_chunk] = compose[reset, now[first_chunk]]
    shift = 1
    while shift < len(now):  # inclusive scan of the chunk maps
        now[shift:] = compose[now[:-shift], now[shift:]]
        shift *= 2
    begin = np.concatenate([[START], maps[now[:-1], START]]) if len(now) else np.zeros(0, np.int64)
    begin[first_chunk] = START
    states = maps[seen.reshape(-1)[place], np.repeat(begin, CHUNK)[place]]
    out = outputs[states, kinds]
    bounds = (out & BEFORE_THIS) > 0
    bounds[np.cumsum(filled) - filled] = True
    late = np.flatnonzero(out & BEFORE_LAST) - 1
    bounds[late] = True
    ends = np.cumsum(filled) - 1
    final = np.array([step(int(s), int(k))[0] for s, k in zip(states[ends], kinds[ends])], np.int64)
    bounds[ends[np.isin(final, list(PENDING))]] = True
    return bounds


class Counter:
    """Counts tokens of texts with both machines; one per Python worker."""

    def __init__(self, path: str, firsts: np.ndarray, kinds: np.ndarray):
        self.tokenizer = load(path)
        self.added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        table = np.repeat(kinds, np.diff(np.append(firsts, 0x110000)))
        self.table, self.annotated = table, {}

    def segments(self, text: str) -> tuple[list[str], int]:
        """Text between added tokens and the number of added tokens."""
        parts, found = [text], 0
        for content in self.added:
            if content in text:
                pieces = [p.split(content) for p in parts]
                found += sum(len(p) - 1 for p in pieces)
                parts = [x for p in pieces for x in p]
        return parts, found

    def annotate(self, pieces: list[str]) -> None:
        """Ask the library for the tokens of new pieces; plain words go straight to its model."""
        model, rest = self.tokenizer.model, []
        for piece in pieces:
            word = piece[1:] if piece[0] == " " else piece
            if word.isascii() and word.isalpha():
                self.annotated[piece] = len(model.tokenize(piece if word is piece else f"\u0120{word}"))
            else:
                rest.append(piece)
        encoded = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        self.annotated.update({p: len(e) for p, e in zip(rest, encoded)})

    def count(self, texts: list[str]) -> np.ndarray:
        totals, parts, owners = np.zeros(len(texts), np.int64), [], []
        for i, text in enumerate(texts):
            own, totals[i] = self.segments(text)
            parts += own
            owners += [i] * len(own)
        lengths = np.array([len(p) for p in parts], np.int64)
        joined = "".join(parts)
        if not joined:
            return totals
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.flatnonzero(piece_bounds(self.table[points], lengths))
        cuts = [*starts.tolist(), len(joined)]
        pieces = [joined[a:b] for a, b in zip(cuts, cuts[1:])]
        known = self.annotated
        unseen = list(set(pieces) - known.keys())
        self.annotate(unseen)
        emitted = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        if len(known) > KEPT_PIECES:
            for p in unseen:
                del known[p]
        rows = np.repeat(np.array(owners, np.int64), lengths)[starts]
        return totals + np.bincount(rows, emitted, len(texts)).astype(np.int64)


_counters: dict[str, Counter] = {}


def count_batches(batches, path: str, firsts: np.ndarray, kinds: np.ndarray):
    counter = _counters.setdefault(path, None) or Counter(path, firsts, kinds)
    _counters[path] = counter
    for batch in sliced(batches):
        text = batch.column("text")
        size = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(counter.count(strings(text)))], ["doc_id", "n_bytes", "n_tokens"])


def check_kind(path: str, firsts: np.ndarray, kinds: np.ndarray) -> None:
    """Raise for files whose pattern or added tokens the machines do not serve."""
    counter = Counter(path, firsts, kinds)
    for token in counter.tokenizer.get_added_tokens_decoder().values():
        if token.lstrip or token.rstrip or token.single_word:
            raise ValueError(f"{path}: the added token {token.content!r} takes up its surroundings, which is not served")
    encode = counter.tokenizer.encode
    refuse_others(path, lambda texts: counter.count(texts).tolist(), lambda text: len(encode(text, add_special_tokens=False).ids))


def count_tokens(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit. One narrow pass, no shuffle."""
    firsts, kinds = classes_of(path)
    check_kind(path, firsts, kinds)
    run: Callable = functools.partial(count_batches, path=path, firsts=firsts, kinds=kinds)
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
