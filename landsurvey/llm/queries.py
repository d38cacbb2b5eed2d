"""The corpus queries: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import chat, decontamination, exact_dedup, language_id, mixing, oracles, secrets, simhash, substring_dedup, token_counts, toxicity
from .common import read_table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(spark, read_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(spark, read_table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(spark, read_table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(spark, read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = "word_bpe_49k.json") -> DataFrame:
    return token_counts.token_counts(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path(vocabulary))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(spark, read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = "</s>[INST] ok [/INST]"
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], "conv_id bigint, turn bigint, role string, text string")
    return chat.report(spark, rows.unionByName(extra))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(spark, read_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


QUERIES = {f.__name__: f for f in (op1_decontamination, op2_simhash, op3_language_id, op4_secrets, op5_mixing, op6_token_counts, op7_substring_dedup, op8_toxicity, op9_chat, op10_exact_dedup)}
ORACLES = oracles.ORACLES
