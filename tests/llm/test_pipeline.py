"""The pipeline against plain versions of its stages, one after the other."""

from __future__ import annotations

import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

import corpus_pipeline  # noqa: E402
from ark.llm import quality_rules  # noqa: E402
from ark.llm.queries import tokenizer  # noqa: E402

FOLDER = os.environ.get("ARK_TEST_SF", "/root/testdata/sf0.001")


def plain(spark):
    import sentencepiece

    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    docs = {r.doc_id: r.text for r in read("documents").collect()}
    trusted = {r.doc_id for r in read("labels").where("quality = 1").collect()}
    hashes, buckets = quality_rules.Buckets(), {}
    raw, target = np.zeros(quality_rules.BUCKETS), np.zeros(quality_rules.BUCKETS)
    for i, t in docs.items():
        buckets[i] = quality_rules.ngram_buckets(t.encode().split(), hashes).astype(int)
        np.add.at(raw, buckets[i], 1)
        if i in trusted:
            np.add.at(target, buckets[i], 1)
    ratio = np.log((target + 1) / (target.sum() + len(raw))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    docs = {i: t for i, t in docs.items() if not brute.base_rules(t)[-1] and ratio[buckets[i]].mean() >= quality_rules.THRESHOLD}
    docs = {i: docs[i] for i, _, least in brute.components(list(docs.items())) if i == least}
    seen, gone, span = {}, {}, corpus_pipeline.PASSAGE
    texts = {i: t.encode() for i, t in docs.items()}
    for s in texts.values():
        for k in range(len(s) - span + 1):
            seen[s[k : k + span]] = seen.get(s[k : k + span], 0) + 1
    for i, s in texts.items():
        gone[i] = bytearray(len(s))
        for k in range(len(s) - span + 1):
            if seen[s[k : k + span]] > 1:
                gone[i][k : k + span] = b"\1" * span
    docs = {i: bytes(b for b, g in zip(s, gone[i], strict=True) if not g).decode("utf-8", "ignore") for i, s in texts.items()}
    docs = {i: t for i, t in docs.items() if t}
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    docs = {r[0]: docs[r[0]] for r in brute.decontaminate(list(docs.items()), items) if not r[2]}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    return {i: (t, len(t), library.encode(t)) for i, t in docs.items()}


def test_equals_the_plain_stages(spark):
    out = {r.doc_id: (r.text, r.n_chars, r.ids) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert out == plain(spark)
    assert len(out) > 50


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).dtypes == docs.dtypes


def test_stages_take_awkward_rows(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use inside: each stage's rows exactly."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kind = "doc_id long, text string, lang string, source string, n_chars long, h string, fp long, key int, n int, ids string, __id string, mark double, wanted int"
    extra = ("clash", 2, 3, 4, "clash", "clash", 0.5, 6)
    rows = [(None, None, None, None, None), (1, "", None, "s", 0), (1, None, "en", None, 5), (1, "x" * 3000, "en", "s", 3000), (1, "x" * 3000, "en", "s", 3000), (2, "short text", "en", "s", 10)]
    odd = spark.createDataFrame([(*r, *extra) for r in rows], kind)
    kept = {"quality_rules": [], "simhash_near_dedup": [(1, ""), (1, "x" * 3000), (2, "short text")], "suffix_array_dedup": [(None, ""), (1, ""), (1, ""), (2, "short text")], "benchmark_decontamination": [(r[0], r[1] or "") for r in rows], "sentencepiece": [(r[0], r[1] or "") for r in rows]}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, odd, FOLDER)
        found = out.collect()
        assert sorted(((r.doc_id or 0, r.text or "") for r in found)) == sorted((i or 0, t) for i, t in kept[name]), name
        assert all(r["h"] == "clash" and r["fp"] == 2 and r["key"] == 3 and r["__id"] == "clash" and r["wanted"] == 6 for r in found), name
        assert name == "sentencepiece" or out.dtypes == odd.dtypes
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
