"""Operator 3's query returns the ids, not their digests alone."""

from __future__ import annotations

from test_operators import FOLDER

from ark.llm import queries


def test_query_returns_the_ids(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op3_sentencepiece(spark, FOLDER).collect()
    assert len(rows) == len(texts) and all(list(r.ids) == library.encode(texts[r.doc_id]) for r in rows)
