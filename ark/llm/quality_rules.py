"""Operator 7, quality rules: base rules plus a hashed n-gram log-likelihood ratio.

The score of a text is the mean, over its words and neighbouring word pairs, of log(target / raw): two
multinomials over hash buckets, one counted over trusted documents, one over the whole corpus. A text is
kept if it passes the base rules and its score is at least a fixed threshold.

That level depends on how well trusted texts cover a text's buckets, so ``keep_good``, the pipeline's stage, scores each
text against counts without itself, and lowers the threshold of a language to what its own trusted texts reach so.

Defined cases: a null or empty text has no words, so it fails the base rules; very long texts are scored
whole; a repeated row counts as often as it stands; a document is trusted if any of its labels is; without
any trusted text every score is 0; other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_KEY, bounded_batches, documents_only, lean, map_batches, sheltered, text_bytes, Memo

BUCKETS = 1 << 16
#: Mean log ratio per n-gram from which a text is kept.
THRESHOLD = -0.13
#: Share of a language's trusted texts that may lie below its held-out threshold, and the steps of a score that are told apart.
REJECTED, BINS = 0.01, 1000
#: Trusted ids up to this number (8 bytes each) are broadcast; more are joined by shuffle.
BROADCAST_IDS = 2_000_000
SYMBOLS = b"#*$%&|<>"
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"


class Buckets(Memo):
    """Hash of each word, kept for the next time; bounded."""

    def __init__(self) -> None:
        super().__init__(24 << 20)

    def __missing__(self, word: bytes) -> int:
        found = zlib.crc32(word)
        if len(word) < LONG_KEY:
            self.room(200 + len(word))
            self[word] = found
        return found


def ngram_buckets(words: list[bytes], hashes: Buckets) -> np.ndarray:
    """Buckets of the words and of the word pairs."""
    ones = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    pairs = ones[:-1] * np.uint64(0x9E3779B97F4A7C15) + ones[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate([ones, pairs >> np.uint64(40)]) % np.uint64(BUCKETS)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    n = len(ids)
    if n < 2_000_000:  # three ids fit one 64-bit number
        keys = (a[:-2] * n + a[1:-1]) * n + a[2:]
    else:
        seen: dict[tuple, int] = {}
        keys = np.fromiter((seen.setdefault(t, len(seen)) for t in zip(a[:-2], a[1:-1], a[2:], strict=True)), np.int64, len(a) - 2)
    _, at, times = np.unique(keys, return_inverse=True, return_counts=True)
    twice = times[at] > 1
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k : k + len(twice)] |= twice
    return int(hit.sum())


def base_rules(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed. ``bytes.split`` parts at exactly space and 09-0D."""
    chars = len(text.translate(None, bytes(range(128, 192)) + b" \t\n\v\f\r"))  # one byte of each code point
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, repeats = len(words), repeated_words(words)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return n, chars, symbols, len(lines) - len(set(lines)), repeats, n < 50 or 100 * repeats > 50 * n


def bucket_counts(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents, and of the trusted ones. Each task sends its sums once."""
    spark = docs.sparkSession
    bounded_batches(spark)
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("trusted", F.lit(True))
    marked = documents_only(docs).join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        raw, target, hashes = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64), Buckets()
        for batch in batches:
            for text, good in zip(batch["text"], batch["trusted"], strict=True):
                found = np.bincount(ngram_buckets(text_bytes(text).split(), hashes).astype(np.int64), minlength=BUCKETS)
                raw += found
                if good is True:
                    target += found
        at = np.flatnonzero(raw)
        yield pd.DataFrame({"bucket": at, "raw": raw[at], "target": target[at]})

    sums = marked.select("text", "trusted").mapInPandas(lean(run), "bucket long, raw long, target long")
    return sums.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def log_ratios(counts: DataFrame) -> np.ndarray:
    """log(target / raw) of each bucket, both with one added; BUCKETS rows at most come to the driver."""
    rows = counts.toPandas()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def quality_rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: the base counts, base_failed, llr (mean log ratio per n-gram) and kept."""
    ratios = log_ratios(bucket_counts(docs, trusted))

    def make():
        hashes = Buckets()

        def step(batch: pd.DataFrame) -> pd.DataFrame:
            rows = []
            for text in map(text_bytes, batch["text"]):
                words = text.split()
                base = base_rules(text, words)
                llr = float(ratios[ngram_buckets(words, hashes)].mean()) if words else 0.0
                rows.append((*base, llr, not base[-1] and llr >= threshold))
            out = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"])
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            return out

        return step

    return map_batches(documents_only(docs), make, f"doc_id long, {BASE}, llr double, kept boolean")


def held_out_score(found: np.ndarray, own: bool, raw: np.ndarray, target: np.ndarray) -> float:
    """Mean log(target / raw) of a text's buckets, both counted without the text itself; ``own``: it is in the target."""
    at, times = np.unique(found.astype(np.int64), return_counts=True)
    n, trusted = len(found), target.sum() - own * len(found)
    if not n or not trusted:
        return 0.0
    ratio = np.log(target[at] - own * times + 1) - np.log(raw[at] - times + 1)
    return float((ratio * times).sum() / n - np.log(trusted + BUCKETS) + np.log(raw.sum() - n + BUCKETS))


def held_out_thresholds(scores: DataFrame, threshold: float) -> tuple[dict[str | None, float], float]:
    """Of (lang, bin, n), the trusted texts' held-out scores: per language, and for languages without any.

    At most ``REJECTED`` of a language's trusted texts lie below, and of all of them; no threshold is above the fixed one.
    """
    rows = scores.groupBy("lang", "bin").agg(F.sum("n").alias("n")).toPandas()

    def edge(of: pd.DataFrame, threshold: float) -> float:
        of = of.groupby("bin")["n"].sum().sort_index()
        if of.empty:
            return threshold
        return min(threshold, float(of.index[np.searchsorted(of.cumsum().to_numpy(), int(REJECTED * of.sum()), side="right")]) / BINS)

    of_all = edge(rows, threshold)
    return {None if pd.isna(lang) else lang: edge(of, of_all) for lang, of in rows.groupby("lang", dropna=False)}, of_all


def keep_good(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, that pass the base rules and whose held-out score is at least the threshold of their ``lang``."""
    spark = docs.sparkSession
    rows = bucket_counts(docs, trusted).toPandas()
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    raw[rows["bucket"]], target[rows["bucket"]] = rows["raw"], rows["target"]
    ids = trusted.select(F.col("doc_id").cast("long").alias("__id")).where("__id is not null").distinct().withColumn("__trusted", F.lit(True))
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    marked = sheltered(docs, ("doc_id", "text", "lang"))
    names = marked.columns
    lang = F.col("lang").cast("string") if "lang" in names else F.lit(None).cast("string")
    marked = marked.withColumn("__lang", lang).withColumn("__id", F.col("doc_id").cast("long"))
    bounded_batches(spark)

    def scores(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, found = Buckets(), Counter()
        for batch in batches:
            for text, lang in zip(map(text_bytes, batch["text"]), batch["__lang"], strict=True):
                words = text.split()
                if not base_rules(text, words)[-1]:
                    found[lang, int(np.floor(BINS * held_out_score(ngram_buckets(words, hashes), True, raw, target)))] += 1
        yield pd.DataFrame([(lang, at, n) for (lang, at), n in found.items()], columns=["lang", "bin", "n"])

    own = marked.join(ids, "__id").select("text", "__lang")
    of_lang, of_all = held_out_thresholds(own.mapInPandas(lean(scores), "lang string, bin long, n long"), threshold)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Buckets()
        for batch in batches:
            good = []
            for text, lang, own in zip(map(text_bytes, batch["text"]), batch["__lang"], batch["__trusted"], strict=True):
                words = text.split()
                good.append(not base_rules(text, words)[-1] and held_out_score(ngram_buckets(words, hashes), own is True, raw, target) >= of_lang.get(lang, of_all))
            if any(good):
                yield batch[names][np.array(good, bool)]

    found = marked.join(ids, "__id", "left").select(*names, "__lang", "__trusted")
    return found.mapInPandas(lean(run), marked.select(*names).schema).toDF(*docs.columns)
