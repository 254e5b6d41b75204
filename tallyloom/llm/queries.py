"""Queries of this subpackage, each an operator applied to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import conversation_trie, fill_middle, language, minhash, oracles, pieces, quality_model, quality_rules, secret_scan, substring_dedup, suffix_dedup, winnowing
from tallyloom.llm.binary_output import token_output
from tallyloom.llm.token_counts import count_tokens

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(documents(spark, folder))


ORACLES["op1_quality_rules"] = quality_rules.ORACLE


@query
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(documents(spark, folder), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return secret_scan.scan(docs, secret_scan.learn(docs))


@query
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_model.classify(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


@query
def op5_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return token_output(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, folder)).drop("kept")


@query
def op8_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(documents(spark, folder), size=3, threshold=85)


ORACLES["op8_minhash_dedup"] = oracles.near_duplicates(3, 85)


@query
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.contamination(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


ORACLES["op9_decontamination"] = oracles.contamination()


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return language.identify(docs, language.learn(docs))


@query
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.remove_repeats(documents(spark, folder)).drop("kept")


ORACLES["op11_substring_dedup"] = substring_dedup.ORACLE


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.fill_in_middle(documents(spark, folder), texts=False)


ORACLES["op12_fill_in_middle"] = fill_middle.ORACLE


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.conversation_trie(spark.read.parquet(f"{folder}/conversations.parquet"))


ORACLES["op13_conversation_trie"] = conversation_trie.ORACLE
