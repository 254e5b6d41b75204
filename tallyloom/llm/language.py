"""Language identification with one bit-sliced Bloom filter for all languages.

Each slot of the filter is a bit mask of languages, with as many 64-bit words as the languages need, so a look-up combines the masks of a gram's slots and
returns every language that has it. A text's grams are looked up whole; the count of set bits for each
language is corrected for the filter's rate of false positives in that language, and the largest
corrected count decides. Grams are four bytes of lower-case letters and blanks.

Learning takes a bounded sample of each language's labelled rows (about ``SAMPLE_ROWS``, chosen by a hash of the
id; all rows of a language that has no more) outside the held-out fold. Every labelled language takes part, and with at least
one row. For each language the most frequent grams that are not far more frequent elsewhere are
put in; ``GRAMS`` bounds their number. What is sent to tasks grows with the languages only: eight bytes a slot for each 64.

Defined results: ``und`` with score 0 for a text that is missing or has no letter, and for all texts when
nothing was learned; when no gram is known, the language with most rows wins with score 0; ties go to the language first in the
alphabet; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Collection
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.texts import mix, sliced, strings

SAMPLE_ROWS = 20_000
GRAMS = 40_000
SLOTS = 1 << 20
HASHES = 2
WORD = 64

_kept = np.full(256, 32, np.uint8)
_kept[97:123] = np.arange(97, 123)
_kept[128:] = np.arange(128, 256)


def text_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Four-byte grams of all texts and the bounds of each text's own."""
    coded = [f" {t.lower()} ".encode("utf-8", "surrogatepass") for t in texts]
    joined = np.frombuffer(b"".join(coded) + b"   ", np.uint8)
    data = _kept[joined].astype(np.uint32)
    lengths = np.array([len(c) for c in coded], np.int64)
    ends = np.cumsum(lengths)
    n = int(ends[-1]) if len(ends) else 0
    grams = data[:n] | data[1 : n + 1] << np.uint32(8) | data[2 : n + 2] << np.uint32(16) | data[3 : n + 3] << np.uint32(24)
    blank = data == 32
    valid = ~((blank[:n] & blank[1 : n + 1]) | (blank[1 : n + 1] & blank[2 : n + 2]) | (blank[2 : n + 2] & blank[3 : n + 3]))
    for back in (1, 2, 3):  # a gram may not reach into the next text
        at = ends - back
        valid[at[at >= 0]] = False
    kept = np.concatenate([[0], np.cumsum(valid)])
    return grams[valid], kept[np.concatenate([[0], ends])]


def slots_of(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    hashed = mix(grams.astype(np.uint64))
    return [((hashed >> np.uint64(32 * k)) & np.uint64(slots - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass(frozen=True)
class LanguageFilter:
    """Languages in alphabetical order, the slots' masks (one column for each 64), false positive rates, the most common language."""

    languages: tuple[str, ...]
    masks: np.ndarray
    rates: np.ndarray
    common: int

    def decide(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        grams, bounds = text_grams(texts)
        first, second = slots_of(grams, len(self.masks))
        totals = np.diff(bounds)
        counts = np.zeros((len(texts), len(self.languages)))
        for k in range(len(self.languages)):
            if k % WORD == 0:
                found = self.masks[first, k // WORD] & self.masks[second, k // WORD]
            sums = np.concatenate([[0], np.cumsum((found >> np.uint64(k % WORD)) & np.uint64(1), dtype=np.int64)])
            counts[:, k] = sums[bounds[1:]] - sums[bounds[:-1]]
        corrected = np.maximum((counts - totals[:, None] * self.rates) / (1 - self.rates), 0)
        best = corrected.argmax(1)
        most = corrected.sum(1)
        score = np.divide(corrected.max(1), most, out=np.zeros(len(texts)), where=most > 0)
        best[most == 0] = self.common
        names = [self.languages[b] for b in best]
        for i, text in enumerate(texts):
            if not any(map(str.isalpha, text)):
                names[i], score[i] = "und", 0.0
        return names, score


def build_filter(counts: dict[str, Collection[int]], rows: dict[str, int], slots: int = SLOTS) -> LanguageFilter:
    """The filter from each language's grams and number of rows."""
    languages = tuple(sorted(counts))
    masks = np.zeros((slots, -(-len(languages) // WORD)), np.uint64)
    for k, language in enumerate(languages):
        grams = np.fromiter(counts[language], np.int64, len(counts[language]))
        for at in slots_of(grams.astype(np.uint32), slots):
            masks[at, k // WORD] |= np.uint64(1 << k % WORD)
    fill = np.array([((masks[:, k // WORD] >> np.uint64(k % WORD)) & np.uint64(1)).mean() for k in range(len(languages))])
    common = max(range(len(languages)), key=lambda k: (rows[languages[k]], -k))
    return LanguageFilter(languages, masks, np.minimum(fill**HASHES, 0.999), common)


def _gram_batches(batches):
    for batch in sliced(batches):
        texts, languages = strings(batch.column("text")), batch.column("lang").to_pylist()
        grams, bounds = text_grams(texts)
        order = {language: k for k, language in enumerate(sorted(set(languages)))}
        owner = np.repeat([order[language] for language in languages], np.diff(bounds)).astype(np.uint64)
        keys, counts = np.unique((owner << np.uint64(32)) | grams, return_counts=True)
        names = np.array(sorted(order), object)[(keys >> np.uint64(32)).astype(np.int64)]
        yield pa.record_batch({"lang": pa.array(names, pa.string()), "gram": pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), "n": pa.array(counts, pa.int64())})


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE_ROWS) -> LanguageFilter | None:
    """The filter learned from labelled rows outside the held-out fold, or None without any."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    scale = 1 << 40
    rows = rows.withColumn("place", F.pmod(F.xxhash64("doc_id"), F.lit(scale)))
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least")).collect()
    if not found:
        return None
    per_language = {r["lang"]: r["n"] for r in found}
    bounds = {r["lang"]: max(scale * sample // r["n"], r["least"] + 1) for r in found if r["n"] > sample}
    chosen = rows
    if bounds:
        bound = F.create_map(*[F.lit(x) for pair in sorted(bounds.items()) for x in pair])[F.col("lang")]
        chosen = rows.where(F.col("place") < F.coalesce(bound, F.lit(scale)))
    counted = chosen.select("text", "lang").mapInArrow(_gram_batches, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    most = F.max("share").over(Window.partitionBy("gram"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("share"), "gram"))
    common = counted.withColumn("share", share).withColumn("most", most).where(F.col("share") >= 0.3 * F.col("most"))
    common = common.withColumn("place", place).where(F.col("place") <= GRAMS)
    table = common.select("lang", "gram").toArrow()
    names = table.column("lang").combine_chunks().dictionary_encode()
    order = np.argsort(names.indices.to_numpy(), kind="stable")
    cuts = np.bincount(names.indices.to_numpy(), minlength=len(names.dictionary)).cumsum()[:-1]
    own = dict(zip(names.dictionary.to_pylist(), np.split(table.column("gram").to_numpy()[order], cuts)))
    grams = {language: own.get(language, ()) for language in per_language}
    return build_filter(grams, per_language)


def _decide_batches(batches, model: LanguageFilter | None):
    for batch in sliced(batches):
        texts = strings(batch.column("text"))
        names, scores = model.decide(texts) if model else (["und"] * len(texts), np.zeros(len(texts)))
        yield pa.record_batch([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])


def identify(df: DataFrame, model: LanguageFilter | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The language of every whole text: doc_id, held_out, lang_pred, score."""
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    decided = rows.mapInArrow(functools.partial(_decide_batches, model=model), "doc_id long, lang_pred string, score double")
    return decided.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
