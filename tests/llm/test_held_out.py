"""The pipeline's quality stage on clean documents whose labels are withheld."""

from __future__ import annotations

import os

import pytest

from ark.llm import quality_rules

DATA = os.path.dirname(os.environ.get("ARK_TEST_SF", "/root/testdata/sf0.001"))


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_clean_documents_without_labels_stay(spark, size):
    docs, labels = spark.read.parquet(f"{DATA}/{size}/documents.parquet"), spark.read.parquet(f"{DATA}/{size}/labels.parquet")
    langs = {r.doc_id: r.lang for r in docs.collect()}
    usable = {r.doc_id for r in quality_rules.quality_rules(docs, labels.limit(0)).where("not base_failed").collect()}
    trusted, bad = labels.where("quality = 1"), {r.doc_id for r in labels.where("quality = 0").collect()} & usable
    withheld = {r.doc_id for r in trusted.where("doc_id % 5 = 1").collect()} & usable
    kept = {r.doc_id for r in quality_rules.keep_good(docs, trusted.where("doc_id % 5 <> 1")).collect()}
    for lang in set(langs.values()):
        mine = {i for i in withheld if langs[i] == lang}
        assert len(mine - kept) <= 1 + len(mine) // 5
    assert len(bad & kept) < len(bad) / 2


def test_columns_and_missing_language(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    trusted = spark.read.parquet(f"{DATA}/sf0.001/labels.parquet").where("quality = 1")
    odd = docs.selectExpr("doc_id", "text", "n_chars as __trusted", "source as __lang")
    assert quality_rules.keep_good(odd, trusted).dtypes == odd.dtypes
    assert quality_rules.keep_good(odd, trusted).count() > 100
    assert quality_rules.keep_good(odd, trusted.limit(0)).count() == quality_rules.quality_rules(docs, trusted.limit(0)).where("kept").count()
