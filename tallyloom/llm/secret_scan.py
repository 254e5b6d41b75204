"""Secret scanning: fixed patterns, and a linear-chain conditional random field over tokens.

Tokens are runs of ASCII letters, digits and ``_+/-`` or of other non-ASCII characters. Each has features of its
own shape, of its neighbouring words (hashed), of the characters that separate them, and of the whole file. The field
tags tokens as outside, begin or inside of a secret; a sequence is a line, so no secret spans lines.
Decoding is Viterbi over all tokens of every whole text. A line in which no token's best non-outside
score, transitions included, reaches zero has the all-outside path as its best; such lines
are recognised with array arithmetic, the others are decoded in step with each other. That bound is exact.

The field is trained on the pattern matches of a bounded sample of rows, without the patterns among its features. Rows with
a match and rows without one are bounded separately, each to about ``SAMPLE_ROWS`` chosen by a hash of id and text, so all
matching rows are used while there are no more, whatever the table's size. Of a row with many matches, up to ``CENTRES``
of each kind are used, spread over all of them.

The field's spans are added under the kind ``crf``, without the tokens that a pattern match touches: what is left of a
span on either side, or between matches, stays as spans of its own. Pattern matches always stay.

Defined results: a missing or empty text has no span; without a match in the table the field adds
nothing; repeated rows are scanned row by row; other columns are ignored or passed through.
"""

from __future__ import annotations

import functools
import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import NARROW_BYTES, hash_spans, runs, sliced, utf8
from tallyloom.session import by_batches

SAMPLE_ROWS = 2_000
WINDOW = 10
CENTRES = 8
HASHED = 512
KINDS = ("assign", "access", "hex", "crf")

# The patterns of known secrets.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
SHORTEST = {"assign": 8, "access": 16, "hex": 32}
#: For Spark: every text that has a pattern match matches this too, some others as well.
CANDIDATE = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]{%d}|AKIA[A-Z0-9]{%d}|[0-9a-f]{%d}"
    % (SHORTEST["assign"], SHORTEST["access"] - len("AKIA"), SHORTEST["hex"])
)
_cues = ("pass", "secret", "token", "api")

OUTSIDE, BEGIN, INSIDE = range(3)


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern matches as (kind, start, end) by kind, in code points."""
    found = []
    lowered = text.lower()
    if any(cue in lowered for cue in _cues):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= SHORTEST["access"]]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def _table(*characters: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for k, group in enumerate(characters):
        table[list(group)] |= 1 << k
    return table


_LOWER, _UPPER, _DIGIT = bytes(range(97, 123)), bytes(range(65, 91)), bytes(range(48, 58))
_inside = np.zeros(256, bool)
_inside[list(_LOWER + _UPPER + _DIGIT + b"_+/-")] = True
_inside[128:] = True
_classes = [_table(x) for x in (_LOWER, _UPPER, _DIGIT, b"abcdef0123456789")]
_kind = np.zeros(256, np.uint8)
for _k, _group in enumerate((_LOWER, _UPPER, _DIGIT)):
    _kind[list(_group)] = _k + 1
_lowered = np.arange(256, dtype=np.uint8)
_lowered[65:91] += 32
SEPARATORS = b" =:\"'\n.,"
_separator = np.full(256, len(SEPARATORS), np.uint8)
for _k, _c in enumerate(SEPARATORS):
    _separator[_c] = _k

LENGTHS = np.array([4, 8, 12, 16, 20, 24, 32, 64])
OWN = len(LENGTHS) + 1 + 16 + 4 + 6 + 2 * (len(SEPARATORS) + 1) + 8
SIZE = OWN + 2 * HASHED


@dataclass
class Tokens:
    """Tokens of a batch with the numbers of their active features (one column for each kind of feature)."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    lines: np.ndarray
    features: np.ndarray


def tokens_of(data: np.ndarray, bounds: np.ndarray) -> Tokens:
    starts, ends, own = runs(_inside[data], bounds)
    n, rows = len(starts), len(bounds) - 1
    if not n:
        return Tokens(starts, ends, own, starts, np.zeros((0, 8), np.int64))
    length = ends - starts

    def within(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return sums[ends] - sums[starts]

    lower, upper, digits, hexes = (within(table[data]) for table in _classes)
    change = np.zeros(len(data), np.uint8)
    kinds = _kind[data]
    change[1:] = kinds[1:] != kinds[:-1]
    turns = within(change) - change[starts]
    newline = np.cumsum(data == 10)
    row = np.repeat(np.arange(rows), np.diff(own))
    line = newline[starts] + row  # a new row is a new line
    before = np.where(starts > bounds[row], _separator[data[np.maximum(starts - 1, 0)]], 5)
    after = np.where(ends < bounds[row + 1], _separator[data[np.minimum(ends, len(data) - 1)]], 5)
    shape = (lower > 0) * 1 + (upper > 0) * 2 + (digits > 0) * 4 + (hexes == length) * 8
    words = (hash_spans(_lowered[data], starts, ends) % np.uint64(HASHED - 1)).astype(np.int64) + 1
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    same = line[1:] == line[:-1]
    left[1:], right[:-1] = np.where(same, words[:-1], 0), np.where(same, words[1:], 0)
    sizes = np.diff(bounds)
    equals = np.concatenate([[0], np.cumsum(data == 61)])
    has_equals = (equals[bounds[1:]] - equals[bounds[:-1]]) > 0
    file = (has_equals * 4 + np.minimum(3, sizes // 1000)).astype(np.int64)
    parts = [
        (np.searchsorted(LENGTHS, length, side="right"), len(LENGTHS) + 1), (shape, 16), (np.minimum(3, 4 * digits // length), 4),
        (np.minimum(5, turns), 6), (before, len(SEPARATORS) + 1), (after, len(SEPARATORS) + 1), (file[row], 8), (left, HASHED), (right, HASHED),
    ]
    columns, base = [], 0
    for values, size in parts:
        columns.append(values.astype(np.int64) + base)
        base += size
    return Tokens(starts, ends, own, line, np.column_stack(columns))


@dataclass(frozen=True)
class Field:
    """Weights of every feature for each tag, of tag pairs, and of a line's first tag."""

    weights: np.ndarray
    pairs: np.ndarray
    first: np.ndarray

    def emissions(self, features: np.ndarray) -> np.ndarray:
        out = np.zeros((len(features), 3))
        for column in range(features.shape[1]):
            out += self.weights[features[:, column]]
        return out

    def decode(self, tokens: Tokens) -> np.ndarray:
        """The best tag of every token, line by line."""
        tags = np.zeros(len(tokens.starts), np.int8)
        if not len(tags):
            return tags
        scores = self.emissions(tokens.features)
        gain = scores[:, 1:].max(1) - scores[:, 0]
        bonus = max(0.0, float(self.pairs.max() - self.pairs[0, 0]), float(self.first.max() - self.first[0]))
        heads = np.flatnonzero(np.concatenate([[True], tokens.lines[1:] != tokens.lines[:-1]]))
        counts = np.diff(np.append(heads, len(tags)))
        open_lines = np.flatnonzero(np.maximum.reduceat(gain, heads) + 2 * bonus >= 0)
        if not len(open_lines):
            return tags
        order = open_lines[np.argsort(-counts[open_lines], kind="stable")]
        at, size = heads[order], counts[order]
        best = self.first + scores[at]
        back, active = [], len(at)
        ended = np.zeros((len(at), 3))
        for step in range(1, int(size[0])):
            still = int(np.searchsorted(-size, -step, side="left"))  # lines longer than step
            ended[still:active] = best[still:active]
            active = still
            paths = best[:active, :, None] + self.pairs
            back.append(paths.argmax(1).astype(np.int8))
            best = paths.max(1) + scores[at[:active] + step]
        ended[:active] = best[:active]
        now = ended.argmax(1)
        for step in range(int(size[0]) - 1, -1, -1):
            alive = int(np.searchsorted(-size, -step, side="left"))
            tags[at[:alive] + step] = now[:alive]
            if step:
                now[:alive] = back[step - 1][np.arange(alive), now[:alive]]
        return tags


def tagged_spans(tokens: Tokens, tags: np.ndarray, row: int, taken: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Byte spans of the secrets of a row, from the start of the batch, without the tokens that touch a ``taken`` span."""
    low, high = int(tokens.bounds[row]), int(tokens.bounds[row + 1])
    found: list[list[int]] = []
    last = -2
    marked = np.flatnonzero(tags[low:high]) + low
    if taken is not None and len(taken):
        taken = taken[np.argsort(taken[:, 0])]
        reach = np.concatenate([[0], np.maximum.accumulate(taken[:, 1])])
        marked = marked[reach[np.searchsorted(taken[:, 0], tokens.ends[marked])] <= tokens.starts[marked]]
    for i in marked:
        if tags[i] == INSIDE and last == i - 1 and tokens.lines[i] == tokens.lines[i - 1]:
            found[-1][1] = int(tokens.ends[i])
        else:
            found.append([int(tokens.starts[i]), int(tokens.ends[i])])
        last = i
    return [(a, b) for a, b in found]


class Scanner:
    """Pattern matches and the field's spans of a batch of texts."""

    def __init__(self, field: Field | None):
        self.field = field

    def scan(self, column: pa.Array) -> list[tuple[str, list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
        """For each row the text, the pattern spans and all spans, both by start and then kind."""
        texts = column.to_pylist()
        base = [pattern_spans(t) if t else [] for t in texts]
        added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
        if self.field is not None:
            data, bounds = utf8(column)
            tokens = tokens_of(data, bounds)
            tags = self.field.decode(tokens)
            rows = np.unique(np.searchsorted(tokens.bounds, np.flatnonzero(tags), side="right") - 1)
            for row in rows.tolist():
                raw = data[bounds[row] : bounds[row + 1]]
                places = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # of code points
                taken = places[np.array([s[1:] for s in base[row]], np.int64).reshape(-1, 2)] + bounds[row]
                spans = np.array(tagged_spans(tokens, tags, row, taken), np.int64).reshape(-1, 2) - bounds[row]
                added[row] = [("crf", a, b) for a, b in np.searchsorted(places, spans).tolist()]
        by_place = lambda s: (s[1], KINDS.index(s[0]))
        return [(t, sorted(b, key=by_place), sorted(b + a, key=by_place)) for t, b, a in zip(texts, base, added)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def spread_over(values: list[int], most: int) -> list[int]:
    """All values, or ``most`` of them from the first to the last at even distances."""
    return values if len(values) <= most else [values[k * (len(values) - 1) // (most - 1)] for k in range(most)]


def training_windows(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Feature rows and tags around every pattern match, and around one token of each text without any."""
    data, bounds = utf8(column)
    tokens = tokens_of(data, bounds)
    out = []
    for row, text in enumerate(column.to_pylist()):
        low, high = int(tokens.bounds[row]), int(tokens.bounds[row + 1])
        if low == high:
            continue
        tags = np.zeros(high - low, np.int8)
        centres: dict[str, list[int]] = {}
        for kind, start, end in pattern_spans(text):
            if kind == "assign":  # the value is the secret, the name before it is its context
                start = end - len(ASSIGN.match(text, start)[2])
            a = int(bounds[row]) + len(text[:start].encode("utf-8", "surrogatepass"))
            b = a + len(text[start:end].encode("utf-8", "surrogatepass"))
            hit = np.flatnonzero((tokens.starts[low:high] < b) & (tokens.ends[low:high] > a))
            if len(hit):
                tags[hit] = INSIDE
                tags[hit[0]] = BEGIN
                centres.setdefault(kind, []).append(int(hit[0]))
        for centre in [c for own in centres.values() for c in spread_over(own, CENTRES)] or [(high - low) // 2]:
            near = np.arange(max(0, centre - WINDOW), min(high - low, centre + WINDOW + 1))
            near = near[tokens.lines[low + near] == tokens.lines[low + centre]]
            out.append((tokens.features[low + near], tags[near]))
    return out


def train(windows: list[tuple[np.ndarray, np.ndarray]], rounds: int = 60, rate: float = 0.15, decay: float = 1e-4) -> Field | None:
    """Maximise the conditional likelihood of the windows' tags by full-batch steps with momentum scaling."""
    if not any((tags == BEGIN).any() for _, tags in windows):
        return None
    n, longest, kinds = len(windows), max(len(t) for _, t in windows), windows[0][0].shape[1]
    features, tags, alive = np.full((n, longest, kinds), SIZE, np.int64), np.zeros((n, longest), np.int64), np.zeros((n, longest))
    for i, (f, t) in enumerate(windows):
        features[i, : len(t)], tags[i, : len(t)], alive[i, : len(t)] = f, t, 1
    flat = features.reshape(-1)
    weights, pairs, first = np.zeros((SIZE + 1, 3)), np.zeros((3, 3)), np.zeros(3)
    pairs[OUTSIDE, INSIDE] = first[INSIDE] = -4.0
    want = np.eye(3)[tags] * alive[..., None]

    def spread(x: np.ndarray) -> np.ndarray:
        each = np.repeat(x.reshape(-1, 3), kinds, axis=0)
        return np.stack([np.bincount(flat, each[:, k], SIZE + 1) for k in range(3)], axis=1)

    both = alive[:, 1:] * alive[:, :-1]
    seen_pairs = np.einsum("nti,ntj,nt->ij", want[:, :-1], want[:, 1:], both)
    squares = [np.zeros_like(x) for x in (weights, pairs, first)]
    lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
    for _ in range(rounds):
        scores = weights[features].sum(2)
        forward, backward = np.zeros((n, longest, 3)), np.zeros((n, longest, 3))
        forward[:, 0] = first + scores[:, 0]
        for t in range(1, longest):
            step = lse(forward[:, t - 1, :, None] + pairs, 1) + scores[:, t]
            forward[:, t] = np.where(alive[:, t, None] > 0, step, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step = lse(pairs + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(alive[:, t + 1, None] > 0, step, 0)
        total = lse(forward[:, -1], 1)
        marginal = np.exp(forward + backward - total[:, None, None]) * alive[..., None]
        joint = forward[:, :-1, :, None] + pairs + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(np.minimum(joint, 0)) * both[..., None, None]).sum((0, 1))
        slopes = [spread(want - marginal) - decay * n * weights, seen_pairs - expected, (want[:, 0] - marginal[:, 0]).sum(0)]
        for value, slope, square in zip((weights, pairs, first), slopes, squares):
            square += (slope / n) ** 2
            value += rate * (slope / n) / (np.sqrt(square) + 1e-6)
    return Field(weights, pairs, first)


def _matching(batch: pa.RecordBatch) -> pa.Array:
    return pa.array([bool(pattern_spans(text)) for text in batch.column("text").to_pylist()], pa.bool_())


def _count_batches(batches):
    for batch in sliced(batches, limit=NARROW_BYTES):
        yield pa.record_batch({"n": pa.array([_matching(batch).true_count], pa.int64())})


def _window_batches(batches, matching: bool):
    for batch in sliced(batches, limit=NARROW_BYTES):
        has = _matching(batch)
        for features, tags in training_windows(batch.column("text").filter(has if matching else pc.invert(has))):
            yield pa.record_batch({"f": pa.array([features.astype("<i2").tobytes()]), "t": pa.array([tags.tobytes()])})


def learn(df: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE_ROWS) -> Field | None:
    """Train on about ``sample`` rows with a pattern match and as many without; None if no row has a match."""
    scale = 1 << 40
    place = F.pmod(F.xxhash64(F.col(doc_id), F.col(text).cast("string")), F.lit(scale))
    rows = df.select(place.alias("place"), F.col(text).cast("string").alias("text")).where("text is not null")
    candidate = F.col("text").rlike(CANDIDATE)
    matching = by_batches(rows.where(candidate).select("text"), _count_batches, "n long").agg(F.sum("n")).first()[0]
    if not matching:
        return None
    others = rows.count() - matching

    def windows(size: int, own: bool) -> DataFrame:
        chosen = rows.where(F.col("place") < min(scale, scale * sample // max(1, size)))
        if own:
            chosen = chosen.where(candidate)  # after the cheap bound, which leaves few rows of a large table
        return by_batches(chosen.select("text"), functools.partial(_window_batches, matching=own), "f binary, t binary")

    parsed = []
    # Sorted here: a sort in Spark would run both scans once more to find its ranges.
    for row in sorted(windows(matching, True).union(windows(others, False)).collect()):
        tags = np.frombuffer(row["t"], np.int8)
        parsed.append((np.frombuffer(row["f"], "<i2").reshape(len(tags), -1).astype(np.int64), tags))
    return train(parsed) if parsed else None


def _scan_batches(batches, field: Field | None):
    scanner = Scanner(field)
    for batch in sliced(batches, limit=NARROW_BYTES):
        rows = scanner.scan(batch.column("text"))
        kinds = [[sum(s[0] == kind for s in base) for _, base, _ in rows] for kind in KINDS[:3]]
        yield pa.record_batch({
            "doc_id": batch.column("doc_id"),
            **{f"n_{kind}": pa.array(n, pa.int64()) for kind, n in zip(KINDS, kinds)},
            "base_sha256": pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for _, base, _ in rows], pa.string()),
            "spans": pa.array([joined(spans) for _, _, spans in rows], pa.string()),
        })


def scan(df: DataFrame, field: Field | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans of every whole text: doc_id, n_assign, n_access, n_hex, base_sha256, spans. One narrow pass."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return by_batches(rows, functools.partial(_scan_batches, field=field), schema)


def masked(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with every span, or run of overlapping spans, replaced."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _mask_batches(batches, field: Field | None, mark: str):
    scanner = Scanner(field)
    for batch in sliced(batches, limit=NARROW_BYTES):
        at = batch.schema.get_field_index("text")
        texts = [masked(t, spans, mark) if spans else t for t, _, spans in scanner.scan(batch.column(at))]
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))


def mask_secrets(df: DataFrame, field: Field | None, mark: str = "[SECRET]") -> DataFrame:
    """``df`` with the secrets of its column ``text`` replaced, all other columns unchanged."""
    return by_batches(df, functools.partial(_mask_batches, field=field, mark=mark), df.schema)
