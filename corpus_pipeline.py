"""Five stages that clean and encode ``documents``, each one of the operators in ``ark.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ark.llm import decontamination, pieces, quality_rules, similar, suffix_dedup
from ark.llm.common import stored, table
from ark.llm.queries import tokenizer


#: Bytes from which a repeat is a passage: 50 words of four bytes, their spaces counted.
PASSAGE = 200


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels").where("quality = 1"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8 or more."""
    return similar.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of ``PASSAGE`` bytes go; so do documents of which nothing stays. n_chars follows the text."""
    kept = suffix_dedup.drop_repeats(docs, PASSAGE)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they read back as its text."""
    return pieces.encode_rows(docs, tokenizer("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeats),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: Hashes, fingerprints and token ids have no SQL twin; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
