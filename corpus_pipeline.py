"""A corpus pipeline of five stages over the documents table, each on what its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import minhash, pieces, quality_model, secret_scan, winnowing
from tallyloom.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the quality classifier accepts; it learns from the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stored = materialize(quality_model.document_statistics(docs), "labelled-statistics")  # narrow: texts are not shuffled
    return quality_model.keep_good(docs.select(*COLUMNS), quality_model.learn(stored, labels))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each group of near-duplicates (five words, similarity 0.8)."""
    return minhash.keep_first(docs.select(*COLUMNS))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more is in benchmark items, by runs of 13 words."""
    return winnowing.drop_contaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts and count characters anew; no document is dropped."""
    masked = secret_scan.mask_secrets(docs.select(*COLUMNS), secret_scan.learn(docs))
    return masked.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast("long"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", no_near_duplicates),
    ("benchmark decontamination", no_benchmark),
    ("secret scans", no_secrets),
    ("SentencePiece encoding", encoded),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is stored and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
