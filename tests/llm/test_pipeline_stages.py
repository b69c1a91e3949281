"""The pipeline against plain versions of the stages it has: held-out quality scores, and all pairs at Jaccard 0.8."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import brute
import numpy as np
from test_pipeline import FOLDER

import corpus_pipeline
from ark.llm import quality_rules
from ark.llm.queries import tokenizer


def good(docs, langs, trusted):
    """Ids of (id: text) that pass; each text is scored against the counts of all others."""
    hashes = quality_rules.Buckets()
    own = {i: Counter(quality_rules.ngram_buckets(t.encode().split(), hashes).tolist()) for i, t in docs.items()}
    raw, target = sum(own.values(), Counter()), sum((own[i] for i in docs if i in trusted), Counter())

    def score(i):
        mine, size = own[i], quality_rules.BUCKETS
        theirs = mine if i in trusted else Counter()
        n, rest, left = mine.total(), raw.total() - mine.total(), target.total() - theirs.total()
        each = [k * (np.log((target[b] - theirs[b] + 1) / (left + size)) - np.log((raw[b] - k + 1) / (rest + size))) for b, k in mine.items()]
        return sum(each) / n

    scores = {i: score(i) for i, t in docs.items() if not brute.base_rules(t)[-1]}
    edge = lambda bins, most: min(most, sorted(bins)[len(bins) // 100] / 1000) if bins else most
    bins = [(langs[i], int(np.floor(1000 * s))) for i, s in scores.items() if i in trusted]
    of_all = edge([b for _, b in bins], quality_rules.THRESHOLD)
    least = {lang: edge([b for x, b in bins if x == lang], of_all) for lang in set(langs.values())}
    return {i for i, s in scores.items() if s >= least[langs[i]]}


def heads(docs):
    """The smallest id of each component of texts at Jaccard 0.8 of five-word shingles."""
    sets = {}
    for i, t in docs.items():
        w = brute.WORD.findall(t.translate(brute.LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in docs}
    for a, b in combinations(docs, 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    return set(root.values())


def without_repeats(docs, span):
    texts = {i: t.encode() for i, t in docs.items()}
    seen = Counter(s[k : k + span] for s in texts.values() for k in range(len(s) - span + 1))
    out = {}
    for i, s in texts.items():
        gone = bytearray(len(s))
        for k in range(len(s) - span + 1):
            if seen[s[k : k + span]] > 1:
                gone[k : k + span] = b"\1" * span
        out[i] = bytes(b for b, g in zip(s, gone, strict=True) if not g).decode("utf-8", "ignore")
    return {i: t for i, t in out.items() if t}


def test_equals_plain_versions_of_its_stages(spark):
    import sentencepiece

    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet").collect()
    rows = read("documents")
    docs, langs = {r.doc_id: r.text for r in rows}, {r.doc_id: r.lang for r in rows}
    docs = {i: docs[i] for i in good(docs, langs, {r.doc_id for r in read("labels") if r.quality == 1})}
    docs = {i: docs[i] for i in heads(docs)}
    docs = without_repeats(docs, corpus_pipeline.PASSAGE)
    items = [(r.item_id, r.text) for r in read("benchmark")]
    docs = {r[0]: docs[r[0]] for r in brute.decontaminate(list(docs.items()), items) if not r[2]}
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    found = {r.doc_id: (r.text, r.n_chars, r.ids) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert found == {i: (t, len(t), library.encode(t)) for i, t in docs.items()}
    assert len(found) > 100
