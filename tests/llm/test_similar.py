"""The pipeline's near-copy stage against all pairs."""

from __future__ import annotations

import random
from itertools import combinations

import pytest
from test_operators import FOLDER, KIND, ROWS

import corpus_pipeline
from ark.llm import similar, simhash


def plain(docs):
    """doc_id to the smallest of its component; docs: (id, text), ids without null."""
    sets = [set(similar.shingles(t).tolist()) for _, t in docs]
    root = list(range(len(docs)))
    for a, b in combinations(range(len(docs)), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = [low if r == high else r for r in root]
    return {i: min(docs[k][0] for k in range(len(docs)) if root[k] == root[n]) for n, (i, _) in enumerate(docs)}


def found(df):
    marks, label = similar.similar_groups(df)
    return {r.doc_id: r.label for r in marks.join(label, "fp").collect()}


def family(rng, words, copies, changed):
    base = [f"w{rng.randrange(5_000)}" for _ in range(words)]
    out = [" ".join(base)]
    for k in range(copies):
        text = list(base)
        for at in rng.sample(range(words), changed):
            text[at] = f"new{k}x{at}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize(("share", "hot", "rounds"), [(4, 4, 2), (1, 1, 0), (1, 3, 3)])
def test_every_similar_pair_is_found(spark, monkeypatch, share, hot, rounds):
    """Copies near the bound on either side, some of them linked through their source alone, below one common line, whatever is hot."""
    for name, value in (("SHARE", share), ("HOT", hot), ("ROUNDS", rounds)):
        monkeypatch.setattr(similar, name, value)
    rng = random.Random(5)
    line = " ".join(f"licence{k}" for k in range(30))
    texts = [f"{line} {t}" for changed in range(1, 9) for t in family(rng, 200, 6, changed)] + ["", None, " \n", "One two", "one TWO", "one two three four five six"]
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == plain(docs)


def test_documents(spark):
    d = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in d.collect()]
    assert found(d) == plain(docs)


def test_stage_drops_near_copies(spark):
    """A twentieth of the words differ at one place: similarity 0.9, fingerprints over two bits apart."""
    base = [f"word{k}" for k in range(100)]
    near = base[:-5] + ["other"] * 5
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near))], "doc_id long, text string")
    assert (simhash.fingerprint(" ".join(base)) ^ simhash.fingerprint(" ".join(near))).bit_count() > 2
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, FOLDER).collect()] == [1]


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(*r, "clash", 0.5, 1, 2, 3, "clash") for r in ROWS], KIND)
    kept = similar.keep_one(docs)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.dtypes == docs.dtypes and sorted(i for i in ids if i) == [1, 4, 5, 8, 9, 11] and ids.count(None) == 1
    assert similar.keep_one(docs.limit(0)).count() == 0


def test_fingerprints_link_texts(spark, monkeypatch):
    """Without the exact way for the rest: fingerprints of five-word shingles at most two bits apart link, if the texts are similar."""
    monkeypatch.setattr(similar, "postings", lambda texts, *_: texts.sparkSession.createDataFrame([], "key long, fp long, n int, pos int"))
    rng = random.Random(3)
    apart = lambda a, b: (simhash.fingerprint(a, similar.SHINGLE) ^ simhash.fingerprint(b, similar.SHINGLE)).bit_count()
    base, *near = family(rng, 600, 80, 1)
    near = sorted(near, key=lambda t: apart(base, t))
    assert apart(base, near[0]) <= 2 < apart(base, "other words of a text")
    often = " ".join(f"line{k}" for k in range(11))
    same = [" ".join([often] * 60 + [f"x{n}y{k}" for k in range(40)]) for n in range(2)]
    assert apart(*same) <= 2
    docs = list(enumerate([base, near[0], "other words of a text", *same]))
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == plain(docs) == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}


def test_a_large_group_is_not_squared(spark, monkeypatch):
    """Near copies of one text, similar to it or not quite: each is held against few others, and no link is lost."""
    rng, compared, verified = random.Random(8), [], similar.verified
    monkeypatch.setattr(similar, "verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    base = [f"w{rng.randrange(5_000)}" for _ in range(150)]
    texts = [" ".join(base)]
    for n in range(240):
        text = list(base)
        for at in rng.sample(range(150), 1 + n % 8):
            text[at] = f"new{n}x{at}"
        texts.append(" ".join(text))
    docs = list(enumerate(texts))
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == plain(docs)
    assert sum(compared) < 4 * len(docs)
