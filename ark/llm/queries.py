"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontamination, oracles, pieces, quality_classifier, quality_rules, sharding, simhash, suffix_dedup, token_counts, toxicity
from .common import table


def tokenizer(name: str) -> str:
    """Place of a public tokenizer's file; ARK_TOKENIZERS names another folder."""
    if folder := os.environ.get("ARK_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("mark")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of each text, their number and digest, and whether they read back as the text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_rows(docs, tokenizer("piece_bpe_32k.model")).drop("text")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), trusted)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed_bytes(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    hard = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digests(chat.format_conversations(rows.union(hard), tokenizer("byte_bpe_50k.json")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_quality_classifier, op2_decontamination, op3_sentencepiece, op4_toxicity, op5_token_counts, op6_sharding,
        op7_quality_rules, op8_suffix_dedup, op9_simhash, op10_chat_formatting)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
