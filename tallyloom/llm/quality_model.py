"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Statistics of each whole text are computed once, in one narrow pass, and stored beside the ids in the
shared folder. The class moments (count, sums, sums of products) are ordinary aggregates over all
labelled rows, so learning needs no sample and moves two rows to the driver. Each class
covariance is shrunk towards the pooled one and towards a diagonal; its Cholesky factor is computed
once and kept in the model. A score is the logistic of the difference of the class log densities, each
a squared Mahalanobis distance from a triangular solve plus the factor's log determinant.

Defined results: a missing or empty text has the statistics of an empty text and gets a score like any
other; labels without an id or value are not learned from, repeated labels count each time; without
two labelled rows of both classes every score is the share of label 1 (0.5 without any label); other
columns are ignored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import NARROW_BYTES, byte_table, hash_spans, runs, sliced, utf8
from tallyloom.session import by_batches, materialize

NAMES = (
    "words", "word_length", "symbols", "bars", "exclamations", "capitals", "digits", "points", "lines",
    "next_same", "second_same", "distinct", "longest_run",
)
SMOOTH = 8
SYMBOLS = b"#*$%&<>@^~{}[]\\"
_, _WORD = byte_table(False, b" \t\n\x0b\x0c\r")


def _marks(characters: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(characters)] = 1
    return table


_COUNTED = [
    _marks(SYMBOLS), _marks(b"|"), _marks(b"!"), _marks(bytes(range(65, 91))), _marks(b"0123456789"), _marks(b".,;:?"), _marks(b"\n"),
]


def statistics(column: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each text."""
    data, bounds = utf8(column)
    rows = len(bounds) - 1
    starts, ends, word_bounds = runs(_WORD[data], bounds)
    hashes = hash_spans(data, starts, ends)
    words = np.diff(word_bounds)
    row = np.repeat(np.arange(rows), words)
    counts = []
    for table in _COUNTED:
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        counts.append(sums[bounds[1:]] - sums[bounds[:-1]])
    per = words + SMOOTH  # shares of a text of a few words are no evidence
    size = np.diff(bounds)

    def repeats(distance: int) -> np.ndarray:
        same = (hashes[distance:] == hashes[:-distance]) & (row[distance:] == row[:-distance])
        return np.bincount(row[distance:][same], minlength=rows)

    keyed = np.sort((row.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    new = np.ones(len(keyed), bool)
    new[1:] = keyed[1:] != keyed[:-1]
    distinct = np.bincount((keyed[new] >> np.uint64(44)).astype(np.int64), minlength=rows)
    longest = np.zeros(rows)
    np.maximum.at(longest, row, ends - starts)
    symbols, bars, exclamations, capitals, digits, points, lines = counts
    share = lambda x: np.log1p(50 * x / per)
    return np.column_stack([
        np.log1p(words), np.log1p(size / np.maximum(words, 1)), share(symbols), share(bars), share(exclamations),
        share(capitals), share(digits), share(points), share(lines), share(repeats(1)) if rows else [], share(repeats(2)) if rows else [],
        np.log((distinct + SMOOTH) / np.sqrt(per)), np.log1p(longest),
    ]).reshape(rows, len(NAMES))


def _statistics_batches(batches):
    for batch in sliced(batches, limit=NARROW_BYTES):
        found = statistics(batch.column("text"))
        x = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(NAMES)), pa.array(found.reshape(-1)))
        yield pa.record_batch([batch.column("doc_id"), x], names=["doc_id", "x"])


def document_statistics(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the array ``x`` of transformed statistics."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return by_batches(rows, _statistics_batches, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Class priors, means and inverse Cholesky factors; ``share`` answers when there is nothing to compare."""

    share: float
    offsets: tuple[float, float] | None = None
    means: tuple[np.ndarray, np.ndarray] | None = None
    whiten: tuple[np.ndarray, np.ndarray] | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        density = []
        for offset, mean, factor in zip(self.offsets, self.means, self.whiten):
            z = (x - mean) @ factor.T
            density.append(offset - 0.5 * np.einsum("ij,ij->i", z, z))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def fit(labelled: DataFrame, pooled: float = 0.1, diagonal: float = 0.05) -> Discriminant:
    """Learn from rows of ``x`` and ``label`` (0 or 1).

    ``pooled`` is the weight of the pooled covariance in each class, ``diagonal`` that of the diagonal.
    """
    d = len(NAMES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    moments = [F.count(F.lit(1)).alias("n")]
    moments += [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    moments += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"p{i}_{j}") for i, j in pairs]
    found = {r["label"]: r for r in labelled.where("label in (0, 1)").groupBy("label").agg(*moments).collect()}
    counts = [found[k]["n"] if k in found else 0 for k in (0, 1)]
    total = sum(counts)
    if min(counts) < 2:
        return Discriminant(counts[1] / total if total else 0.5)
    means, scatters = [], []
    for k in (0, 1):
        mean, scatter = np.array([found[k][f"s{i}"] for i in range(d)]) / counts[k], np.empty((d, d))
        for i, j in pairs:
            scatter[i, j] = scatter[j, i] = found[k][f"p{i}_{j}"] - counts[k] * mean[i] * mean[j]
        means.append(mean)
        scatters.append(scatter)
    common = (scatters[0] + scatters[1]) / total
    offsets, whiten = [], []
    for k in (0, 1):
        covariance = (1 - pooled) * scatters[k] / counts[k] + pooled * common
        covariance = (1 - diagonal) * covariance + diagonal * np.diag(np.diag(covariance)) + 1e-6 * np.eye(d)
        factor = np.linalg.cholesky(covariance)
        offsets.append(float(np.log(counts[k] / total) - np.log(np.diag(factor)).sum()))
        whiten.append(np.linalg.inv(factor))
    return Discriminant(counts[1] / total, tuple(offsets), tuple(means), tuple(whiten))


def _score_batches(batches, model: Discriminant):
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(NAMES))
        yield pa.record_batch([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])


def score_statistics(statistics: DataFrame, model: Discriminant) -> DataFrame:
    return statistics.mapInArrow(functools.partial(_score_batches, model=model), "doc_id long, score double")


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether the id's checksum puts the row in the fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def learn(statistics: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id") -> Discriminant:
    """Learn from the labels outside the held-out fold."""
    chosen = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    chosen = chosen.where(~held_out(F.col("doc_id"))).where(F.col("label").isNotNull())
    return fit(statistics.join(chosen, "doc_id").select("x", "label"))


def classify(df: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Score every document: doc_id, held_out, score, predicted."""
    stored = materialize(document_statistics(df), "quality-statistics")
    scored = score_statistics(stored, learn(stored, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _keep_batches(batches, model: Discriminant, threshold: float):
    for batch in sliced(batches, limit=NARROW_BYTES):
        yield batch.filter(pa.array(model.score(statistics(batch.column("text"))) >= threshold))


def keep_good(df: DataFrame, model: Discriminant, threshold: float = 0.3) -> DataFrame:
    """Rows of ``df`` (with a column ``text``) that the model accepts, all columns unchanged."""
    return by_batches(df, functools.partial(_keep_batches, model=model, threshold=threshold), df.schema)
