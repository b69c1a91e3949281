"""The operators against plain versions, and on awkward tables."""

from __future__ import annotations

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))
import brute  # noqa: E402

from ark.llm import chat, decontamination, pieces, quality_classifier, quality_rules, queries, sharding, simhash, suffix_dedup, token_counts, toxicity  # noqa: E402
from ark.llm.queries import tokenizer  # noqa: E402

FOLDER = os.environ.get("ARK_TEST_SF", "/root/testdata/sf0.001")
LONG = " ".join(f"w{k}" for k in range(30_000))
COPY = "the quick brown fox jumps over the lazy dog and runs away " * 12
ROWS = [
    (1, None, "en", "a", 0), (2, "", None, "a", 0), (3, "   \n\t ", "en", None, 0), (4, "One.", "en", "a", 4), (4, "One.", "en", "a", 4), (None, "no id here", "de", "b", 10), (None, None, None, None, None),
    (5, COPY, "en", "a", 1), (6, COPY, "fr", "b", 1), (7, "x " + COPY, "fr", "b", 1), (8, LONG, "es", "c", len(LONG)), (9, "ÄÖ ß İ ı é̂ 😀 漢字   x\x00y", "de", "c", 9), (10, LONG + " tail", "es", "c", 9), (11, "a" * 5_000, "es", "c", 9),
]
KIND = "doc_id long, text string, lang string, source string, n_chars long, h string, score double, pos int, n int, fp long, __id string"


@pytest.fixture(scope="module")
def docs(spark):
    """With columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "clash", 0.5, 1, 2, 3, "clash") for r in ROWS], KIND)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], KIND)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (5, 1, 1), (5, 1, 0), (6, None, None), (None, 1, 1), (8, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(100, "lazy dog"), (101, None), (102, "the QUICK brown fox jumps over the lazy dog and runs"), (103, "w5 w6 w7 w8 w9 w10 w11 w12 w13 w14 w15"), (103, "absent"), (None, "one"), (104, "...")], "item_id long, text string")


def real(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def pairs(df, key="doc_id"):
    return [(r[0], r[1]) for r in df.select(key, "text").collect()]


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def want(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# Decontamination


@pytest.mark.parametrize("size", [10, 3])
def test_decontaminate(spark, docs, items, size):
    named = [(i, t) for i, t in pairs(items, "item_id") if i is not None]
    found = decontamination.decontaminate(docs, items, size)
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    assert got(found, *columns) == want(brute.decontaminate(pairs(docs), named, size))


def test_decontaminate_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK", 50)
    d, b = real(spark, "documents"), real(spark, "benchmark")
    found = decontamination.decontaminate(d, b)
    assert got(found, "doc_id", "n_words", "n_hit", "n_items", "items_sha256") == want(brute.decontaminate(pairs(d), pairs(b, "item_id")))


def test_decontaminate_empty(docs, none, items):
    assert decontamination.decontaminate(none, items).count() == 0
    clean = decontamination.decontaminate(docs, items.limit(0))
    assert clean.count() == len(ROWS)
    assert clean.where("contaminated").count() == 0


def test_drop_contaminated(docs, items):
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, None, 9, 11}


def test_proximity(spark):
    d = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "alpha " + "x " * 40 + "beta gamma"), (3, None)], "doc_id long, text string")
    b = spark.createDataFrame([(7, "gamma beta alpha")], "item_id long, text string")
    assert got(decontamination.proximity_matches(d, b, 3, 10), "doc_id", "item_id") == [(1, 7)]


# Suffix dedup


def test_repeats(spark, docs):
    found = suffix_dedup.removed_bytes(docs)
    assert got(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want(brute.repeats(pairs(docs)))


@pytest.mark.parametrize(("length", "gram", "bucket"), [(400, 64, 5_000), (400, 64, 6), (200, 48, 5_000), (200, 64, 12)])
def test_repeats_of_borders(spark, length, gram, bucket):
    """Copied passages in different surroundings, at any place, in themselves, and with one byte changed; small buckets make every gram hot."""
    rng = random.Random(7)
    make = lambda n: "".join(rng.choices("abcdefgh é\n", k=n))
    shared = [make(n) for n in (399, 400, 401, 470, 800, 1500)]
    texts = []
    for _ in range(60):
        s = rng.choice(shared)
        if rng.random() < 0.3:
            k = rng.randrange(len(s))
            s = s[:k] + "#" + s[k + 1 :]
        a, b = sorted(rng.sample(range(len(s)), 2))
        texts.append(make(rng.randrange(300)) + (s if rng.random() < 0.5 else s[a:b]) + make(rng.randrange(300)))
    texts += [make(50) * 20, "z" * 1000, "z" * 700 + make(30)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(suffix_dedup.removed_bytes(df, length, gram, bucket), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want(brute.repeats(rows, length))


def test_repeats_of_a_hot_passage(spark):
    """One passage in many surroundings, and many copies of one text without ids: buckets stay small, nothing is lost."""
    rng = random.Random(11)
    make = lambda n: "".join(rng.choices("abcdefgh é\n", k=n))
    passage, text = make(700), make(900)
    rows = [(k, make(rng.randrange(200)) + passage + make(rng.randrange(200))) for k in range(80)] + [(None, text)] * 60
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(suffix_dedup.removed_bytes(df, bucket=16), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want(brute.repeats(rows))


def test_repeats_across_passes(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PASS", 1 << 20)
    hasher, text = suffix_dedup.Hasher(), random.Random(3).randbytes((1 << 20) + 5_000)
    h, at, first, last = suffix_dedup.anchors_of(text, hasher)
    covered = np.zeros(len(text) - 399, int)
    for a, b in zip(first, last, strict=True):
        covered[a : b + 1] += 1
    assert (covered == 1).all()
    assert ((at >= last) | (at >= first)).all()


def test_drop_repeats(docs, none):
    kept = suffix_dedup.drop_repeats(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert 5 not in ids and 6 not in ids and ids.count(4) == 2 and 1 in ids
    assert suffix_dedup.removed_bytes(none).count() == 0


def test_loser_tree_merges():
    rng = random.Random(1)
    for runs in (1, 2, 3, 5, 8):
        made = [[(bytes(rng.choices(b"ab", k=rng.randrange(12))), b"L", (k, j)) for j in range(rng.randrange(30))] for k in range(runs)]
        merged = list(suffix_dedup.LoserTree(suffix_dedup.read_run(suffix_dedup.write_run(m)) for m in made))
        flat = sorted(x[0] for m in made for x in m)
        assert [m[1][1] for m in merged] == flat
        shared = [os.path.commonprefix([a, b]) for a, b in zip([b"", *flat], flat)]
        assert [m[0] for m in merged] == [len(s) for s in shared]


# SimHash


def test_simhash(spark, docs):
    d = docs.where("doc_id is not null")
    found = simhash.near_duplicates(d)
    assert got(found, "doc_id", "fingerprint", "component_id") == want(brute.components(pairs(d)))


def test_simhash_real(spark):
    d = real(spark, "documents")
    assert got(simhash.near_duplicates(d), "doc_id", "fingerprint", "component_id") == want(brute.components(pairs(d)))


@pytest.mark.parametrize("crowded", [256, 2])
def test_links(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CUT_AGAIN", crowded)
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for k in (1, 2, 3):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), k)))
    fps |= {sum(1 << b for b in rng.sample(range(12), 3)) for _ in range(60)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    found = {tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()}
    assert found == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}


def test_keep_one(spark, docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and ids.count(5) == 1 and 6 not in ids
    assert simhash.near_duplicates(none).count() == 0
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect() if r.doc_id is not None}
    assert set(ids) - {None} == set(found[i] for i in found)


# Quality rules


def test_base_rules(spark, docs, none, labels):
    found = quality_rules.quality_rules(docs, labels.where("quality = 1"))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got(found, *columns) == want((i, *brute.base_rules(t)) for i, t in pairs(docs))
    assert found.where("kept and base_failed").count() == 0
    assert quality_rules.quality_rules(none, labels).count() == 0
    assert quality_rules.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_log_ratio_equals_plain_counts(spark):
    d, lab = real(spark, "documents"), real(spark, "labels").where("quality = 1")
    trusted = {r.doc_id for r in lab.collect()}
    raw, target = np.zeros(quality_rules.BUCKETS), np.zeros(quality_rules.BUCKETS)
    hashes, buckets = quality_rules.Buckets(), {}
    for i, t in pairs(d):
        buckets[i] = quality_rules.ngram_buckets(t.encode().split(), hashes).astype(int)
        np.add.at(raw, buckets[i], 1)
        if i in trusted:
            np.add.at(target, buckets[i], 1)
    ratio = np.log((target + 1) / (target.sum() + len(raw))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    for r in quality_rules.quality_rules(d, lab).collect():
        assert r.llr == pytest.approx(ratio[buckets[r.doc_id]].mean())
        assert r.kept == (not r.base_failed and r.llr >= quality_rules.THRESHOLD)


# Classifiers


def test_quality_classifier_learns(spark, docs, none, labels):
    d, lab = real(spark, "documents").union(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id >= 200")), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality_classifier.classify_quality(d, lab).join(lab, "doc_id")
    held = found.where("held_out").collect()
    right = sum(r.predicted == r.quality for r in held)
    assert right >= 0.9 * len(held)
    odd = quality_classifier.classify_quality(docs, labels).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in quality_classifier.classify_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.classify_quality(none, labels).count() == 0


def test_flat_trees_walk_as_plain_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 5))
    trees = quality_classifier.grow(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0).astype(float), trees=7, depth=3)

    def walk(row):
        total = trees.start
        for t in range(len(trees.feature)):
            k = 0
            while k < trees.feature.shape[1]:
                k = 2 * k + 1 + (row[trees.feature[t, k]] > trees.limit[t, k])
            total += trees.value[t, k - trees.feature.shape[1]]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(trees.scores(x), [walk(r) for r in x])
    assert ((trees.scores(x) > 0.5) == (x[:, 0] + x[:, 1] * x[:, 2] > 0)).mean() > 0.85


def test_labels_of_held_out_rows_are_never_used(spark):
    d, lab = real(spark, "documents"), real(spark, "labels")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    flipped = lab.withColumn("quality", F.when(fold % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn("toxic", F.when(fold % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for f in (quality_classifier.classify_quality, toxicity.score_toxicity):
        assert got(f(d, lab), "doc_id", "score") == got(f(d, flipped), "doc_id", "score")


def test_toxicity(spark, docs, none, labels):
    rng = random.Random(5)
    base = [" ".join(rng.choices("sun moon tree river stone cloud rain wind leaf bird".split(), k=30)) for _ in range(600)]
    rows = [(k, t + " vile wretch" if k % 8 == 0 else t) for k, t in enumerate(base)]
    lab = [(k, 0, int(k % 8 == 0)) for k in range(0, 600, 2)]
    d, labs = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(lab, "doc_id long, quality int, toxic int")
    held = toxicity.score_toxicity(d, labs).where("held_out").collect()
    assert all(r.predicted == (r.doc_id % 8 == 0) for r in held)
    odd = toxicity.score_toxicity(docs, labels).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score_toxicity(docs, labels.limit(0)).count() == len(ROWS)
    assert toxicity.score_toxicity(none, labels).count() == 0


# Token counts


@pytest.fixture(scope="module")
def counter():
    with open(tokenizer("byte_bpe_50k.json"), encoding="utf-8") as f:
        return token_counts.PrefixCounter(f.read())


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))


def test_prefix_counts_equal_the_library(counter, library):
    rng = random.Random(5)
    alphabet = [*"abc  \n\t'slrevd1²Ⅷé漢!#\x1c\x85　😀", "<|endoftext|>", "'ll", "'re", "  ", "́", "ǆ", "٣"]
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        each = [len(library.encode(text[:k], add_special_tokens=False).ids) for k in range(len(text) + 1)]
        limit = rng.randint(0, 12)
        assert counter.prefixes(text) == each
        assert counter.count(text) == each[-1]
        assert counter.longest_prefix(text, limit) == max(k for k, n in enumerate(each) if n <= limit)


def test_a_giant_word_takes_little_memory(counter, library):
    """A hundred thousand letters without a break: exact, and no list of all its places is held."""
    import tracemalloc

    word = "".join(random.Random(5).choices("etaoinshrdlu", k=8_000))
    assert counter.counts([word]) == [len(library.encode(word, add_special_tokens=False).ids)]
    long = "ab" * 50_000
    tracemalloc.start()
    n, cut = counter.count(long), counter.longest_prefix(long, 1024)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counter.prefixes(long[: cut + 1])[-2:] == [1024, 1025] and n > 1024
    assert peak < 8 << 20 and len(counter._counts) < 100_000


def test_token_counts(spark, docs, none, library):
    path = tokenizer("byte_bpe_50k.json")
    for d in (docs, real(spark, "documents")):
        rows = [(i, t or "") for i, t in pairs(d)]
        n = [len(library.encode(t, add_special_tokens=False).ids) for _, t in rows]
        plain = want((i, len(t.encode()), k, k > 1024) for (i, t), k in zip(rows, n, strict=True))
        assert got(token_counts.token_counts(d, path), "doc_id", "n_bytes", "n_tokens", "over_limit") == plain
    assert token_counts.token_counts(none, path).count() == 0


# SentencePiece


@pytest.fixture(scope="module")
def model():
    with open(tokenizer("piece_bpe_32k.model"), "rb") as f:
        return pieces.Pieces(f.read())


def test_chunks_equal_the_whole(model):
    rng = random.Random(3)
    alphabet = [*"abc   \n\t'the éx漢!#\x00😀▁ﬁ0", "  ", " the", "ing", "    ", "xx"]
    for k in range(400):
        text = "".join(rng.choice(alphabet if k % 3 else "xeaon") for _ in range(rng.randint(1, 90)))
        ids = model.library.encode(text)
        assert model.encode(text).tolist() == ids
        assert model.decode(model.encode(text)) == text.replace("▁", " ")
        cut = list(pieces.chunks_of(model.marked(text), rng.choice([33, 40, 50]), model.reach))
        weights = [model.matrix(b, c, f) for _, b, c, f in cut]
        at = pieces.states_at_cuts(weights, leave=-1)
        middle = len(weights) // 2
        if middle:  # by blocks: products first, then within each
            ends = pieces.states_at_cuts([pieces.product(weights[:middle]), pieces.product(weights[middle:])], leave=-1)
            assert at == pieces.states_at_cuts(weights[:middle], ends[0], ends[1])[:-1] + pieces.states_at_cuts(weights[middle:], ends[1], ends[2])
        parts = [model.trace(b, c, model.states(b)[at[j]], model.exits(b, c, f)[at[j + 1]]) for j, b, c, f in cut]
        assert np.concatenate(parts).tolist() == ids


def test_max_plus_products_are_associative(model):
    text = model.marked("an unbelievably longish word, and another one; " * 5)
    m = [model.matrix(b, c, f) for _, b, c, f in pieces.chunks_of(text, 40, model.reach)][:3]
    assert (pieces.combine(pieces.combine(m[0], m[1]), m[2]) == pieces.combine(m[0], pieces.combine(m[1], m[2]))).all()


@pytest.mark.parametrize("giant", [49_152, 300])
def test_encode_rows(spark, docs, none, model, giant, monkeypatch):
    monkeypatch.setattr(pieces, "FAN", 3)
    path = tokenizer("piece_bpe_32k.model")
    found = pieces.encode_rows(docs, path, giant=giant, size=128)
    plain = want((i, model.library.encode(t or ""), True) for i, t in pairs(docs))
    assert got(found, "doc_id", "ids", "round_trip") == plain
    digest = lambda ids: hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
    assert all(r.ids_sha256 == digest(r.ids) and r.n_pieces == len(r.ids) for r in found.collect())
    assert pieces.encode_rows(none, path).count() == 0


# Sharding


def test_formatted_chars_equal_plain_sums(spark):
    """Every conversation of the table, and long ones, against windows by plain sums."""
    rng = random.Random(8)
    counter = token_counts.counter_of(open(tokenizer("byte_bpe_50k.json"), encoding="utf-8").read())
    rows = [tuple(r) for r in real(spark, "conversations").select("conv_id", "turn", "role", "text").collect()]
    for conv in range(10**6, 10**6 + 12):
        rows += [(conv, k, "system" if k < conv % 2 else ["user", "assistant"][k % 2], " ".join(rng.choices(["a", "bee", "#sea", "<d>", "\\e"], k=rng.randrange(700)))) for k in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r.formatted_chars for r in chat.digests(chat.format_conversations(df, tokenizer("byte_bpe_50k.json"))).collect()}
    each = {}
    for conv, _, role, text in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3] or "")):
        each.setdefault(conv, []).append((role or "", text or ""))
    assert found == {conv: brute.chat(turns, counter.counts([chat.turn_text(*t)[0] for t in turns])) for conv, turns in each.items()}


def test_the_risk_s_gradient(spark):
    """The first step goes against the slope of the plain non-negative risk, or of the term below zero alone."""
    rng = np.random.default_rng(2)
    chosen = np.arange(6)
    texts = lambda n, p: [np.flatnonzero(rng.random(6) < p) for _ in range(n)]
    for prior in (0.2, 0.6):
        positive, unlabelled = texts(40, np.array([0.9, 0.7, 0.5, 0.3, 0.1, 0.2])), texts(80, np.array([0.2, 0.3, 0.5, 0.6, 0.7, 0.1]))
        rows = lambda found: np.array([np.isin(chosen, x) for x in found], float)
        p, u = rows(positive), rows(unlabelled)

        def risk(w, p=p, u=u, prior=prior):
            loss = lambda x, sign: np.log1p(np.exp(-sign * (x @ w[:-1] + w[-1]))).mean()
            corrected = loss(u, -1) - prior * loss(p, -1)
            return prior * loss(p, 1) + corrected if corrected >= 0 else -corrected

        made = toxicity.learn(positive, unlabelled, chosen, prior, steps=1, rate=0.01, ridge=0)
        start = toxicity.learn(positive, unlabelled, chosen, prior, steps=0)
        w0 = np.append(start.weights[:6], start.bias)
        slope = np.array([(risk(w0 + d) - risk(w0 - d)) / 2e-5 for d in np.eye(7) * 1e-5])
        step = np.append(made.weights[:6], made.bias) - w0
        steep = np.abs(slope) > 1e-4
        assert (np.sign(step[steep]) == -np.sign(slope[steep])).all() and np.allclose(np.abs(step[steep]), 0.01, rtol=0.01)


def test_folds_and_cuts_of_the_classifiers(spark, docs, labels):
    for out, parts, held, cut in ((quality_classifier.classify_quality(docs, labels), 5, 0, 0.3), (toxicity.score_toxicity(docs, labels), 3, 1, 0.7)):
        for r in out.collect():
            fold = 0 if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % parts
            assert r.held_out == (fold == held) and r.predicted == int(r.score >= cut) and 0 <= r.score <= 1


def test_shards_follow_the_curve_and_keep_equal_texts_together(spark, monkeypatch):
    """Cells never fall along the shards; a text's rows follow each other, whatever their language and source, a hot one's too."""
    monkeypatch.setattr(sharding, "SALTS", 5)
    rows = [(k, f"text {k % 90} " * (1 + k % 7 * (k % 90 > 5)), "en de fr es".split()[k % 4], f"s{k % 11}") for k in range(1500)] + [(None, None, None, None)] * 700
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    out = sharding.shard_documents(df)
    steps = out.join(df.select("doc_id", "text").distinct(), out["doc_id"].eqNullSafe(df["doc_id"])).drop(df["doc_id"]).collect()
    assert len(steps) == len(rows)
    least = {}
    for r in steps:
        least[r.text] = min(least.get(r.text, (99, 99)), (r.lang_step, r.source_step))
    order = [r.text for r in sorted(steps, key=lambda r: (r.shard, r.slot))]
    size = {r.text: r.size_step for r in steps}
    groups = [t for t, before in zip(order, [object(), *order]) if t != before]
    assert len(groups) == len(set(groups))
    asked = spark.createDataFrame([(k, *least[t], size[t]) for k, t in enumerate(groups)], "k int, a int, b int, c int")
    cells = [r.h for r in asked.select("k", sharding.hilbert_index([F.col("a"), F.col("b"), F.col("c")]).alias("h")).orderBy("k").collect()]
    assert cells == sorted(cells)


def test_sharding(spark, docs, none):
    for d in (docs, real(spark, "documents")):
        out = sharding.shard_documents(d).collect()
        rows = pairs(d)
        assert want((r.doc_id, r.size, r.text_crc32) for r in out) == want((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
        shards = {}
        for r in out:
            assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < 40
            shards.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in shards.values())
        n = [len(shards.get(k, ())) for k in range(40)]
        assert max(n) - min(n) <= 1
    assert sharding.shard_documents(none).count() == 0


def test_hilbert_curve_is_continuous(spark):
    cells = spark.range(4096).selectExpr("cast(id % 16 as int) a", "cast(id div 16 % 16 as int) b", "cast(id div 256 as int) c")
    rows = sorted((r.h, (r.a, r.b, r.c)) for r in cells.select("*", sharding.hilbert_index([F.col("a"), F.col("b"), F.col("c")]).alias("h")).collect())
    assert [h for h, _ in rows] == list(range(4096))
    assert all(sum(abs(x - y) for x, y in zip(p, q)) == 1 for (_, p), (_, q) in zip(rows, rows[1:]))


def test_pruning_keeps_all_that_match(spark, tmp_path):
    d = real(spark, "documents")
    out = sharding.shard_documents(d, carry=True)
    listed = sharding.manifest(out)
    kept = {r.shard for r in sharding.prune(listed, lang="de", source="src3").collect()}
    assert {r.shard for r in out.where("row.lang = 'de' and row.source = 'src3'").select("shard").collect()} <= kept
    assert len(kept) < 20
    sharding.write_shards(d, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == d.count() and set(d.columns) <= set(back.columns)


# Chat


def test_escapes_come_back():
    rng = random.Random(4)
    for _ in range(300):
        turns = [("".join(rng.choices("ab\\#:<\n é", k=rng.randrange(4))), "".join(rng.choices(["\\", "#", "<", "### ", "</turn>", "\n", ":", "x", "é"], k=rng.randrange(9)))) for _ in range(rng.randrange(1, 5))]
        text = "".join(chat.turn_text(*t)[0] for t in turns)
        assert chat.read_back(text) == turns


def test_windows():
    rng = random.Random(8)
    for _ in range(200):
        turns = [("system", "s", rng.randrange(1, 9))] * rng.randrange(3) + [(rng.choice(["user", "assistant", "system"]), f"t{k}", rng.randrange(1, 40)) for k in range(rng.randrange(0, 30))]
        out = list(chat.windows(turns, budget=50, history=20))
        opening = next((k for k, t in enumerate(turns) if t[0] != "system"), len(turns))
        new = []
        for k, w in enumerate(out):
            read = chat.read_back(w.text)
            if k:
                assert read[:opening] == [t[:2] for t in turns[:opening]] or len(new) < opening
            assert w.tokens <= 50 or len(read) - w.shown == 1
            said = [chat.unescape(w.text[a:b]) for a, b in w.spans]
            assert said == [t for r, t in read[w.shown :] if r == "assistant"]
            new += read[w.shown :]
        assert new == [t[:2] for t in turns]


def plain_digests(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((-1 if turn is None else turn, role or "", text or ""))
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        yield c, len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("budget", [1024, 60])
def test_digests(spark, budget):
    odd = [(1, 0, "user", None), (1, 1, "assistant", "\\### Assistant: </turn> ok"), (1, 1, "assistant", "again"), (None, 0, None, "x"), (2, None, "assistant", ""), (3, 0, "assistant", "long " * 4000), (3, 1, "user", "q"), (3, 1, "user", "q")]
    kind = "conv_id long, turn long, role string, text string"
    conversations = real(spark, "conversations").select("conv_id", "turn", "role", "text").where("conv_id > 3").union(spark.createDataFrame(odd, kind))
    rows = [tuple(r) for r in conversations.collect()]
    made = conversations.withColumn("tokens", F.lit("clash"))
    found = chat.digests(chat.format_conversations(made, tokenizer("byte_bpe_50k.json"), budget, budget // 4))
    assert got(found, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256") == want(plain_digests(rows))
    assert chat.digests(chat.format_conversations(made.limit(0), tokenizer("byte_bpe_50k.json"))).count() == 0


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.queries()} == set(range(1, 11))
