"""Operator 1, quality classifier: histogram gradient-boosted trees over document statistics.

Each text is reduced to a few statistics. Trees are grown on the driver over binned statistics of a bounded
sample of labelled documents, then laid out as flat arrays; a batch of documents walks all trees level by level
in numpy.

Defined cases: null and empty texts have all statistics zero and are scored as such; texts are read whole;
repeated rows are scored each; a document with several labels has the largest; null labels are ignored; without
labels every score is 0.5, with one class only it is that class' share; splits of equal gain go to the first
statistic and lowest limit; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents_only, fold_of, map_batches, text_bytes
from .quality_rules import repeated_words

#: Labelled documents to learn from, at most: those of the smallest hashes.
SAMPLE = 20_000
FOLDS, CUT = 5, 0.3
STATISTICS = (
    "log_words", "log_chars", "word_length", "upper", "lower", "digits", "high_bytes", "spaces", "line_ends", "stops", "commas", "bangs", "bars", "symbols",
    "other_marks", "different_words", "commonest_word", "repeated", "repeated_lines", "line_length", "longest_word", "marked_words",
)


def statistics(text: bytes) -> list[float]:
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    seen = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    each: dict[bytes, int] = {}
    for w in words:
        each[w] = each.get(w, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    share = lambda chars: float(seen[list(chars)].sum()) / size
    chars = size - int(seen[128:192].sum())
    marks = seen[33:48].sum() + seen[58:65].sum() + seen[91:97].sum() + seen[123:127].sum()
    named = sum(int(seen[c]) for c in b".,!|#*$%&<>")
    return [
        np.log1p(n), np.log1p(chars), chars / n, float(seen[65:91].sum()) / size, float(seen[97:123].sum()) / size, float(seen[48:58].sum()) / size,
        float(seen[128:].sum()) / size, share(b" \t"), share(b"\n"), share(b"."), share(b","), share(b"!"), share(b"|"), share(b"#*$%&<>"), float(marks - named) / size,
        len(each) / n, max(each.values()) / n, repeated_words(words) / n, (len(lines) - len(set(lines))) / max(1, len(lines)), np.log1p(size / max(1, len(lines))),
        np.log1p(max(map(len, words))), sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n,
    ]


@dataclass
class Trees:
    """All trees as arrays: node k of a tree has the children 2k + 1 and 2k + 2; leaves hold values."""

    feature: np.ndarray  # trees x inner nodes
    limit: np.ndarray
    value: np.ndarray  # trees x leaves
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        inner, trees = self.feature.shape[1], np.arange(len(self.feature))
        at, rows = np.zeros((len(x), len(trees)), np.int64), np.arange(len(x))[:, None]
        while len(trees) and at[0, 0] < inner:
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.limit[trees, at])
        total = self.start + (self.value[trees, at - inner].sum(1) if len(trees) else 0)
        return 1 / (1 + np.exp(-total * np.ones(len(x))))


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0) -> Trees:
    """Boosting under the logistic loss; each split is the best of all bins by its sums of gradients."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start, inner = float(np.log(share / (1 - share))), 2**depth - 1
    if len(set(y.tolist())) < 2:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), start)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    total = np.full(len(y), start)
    features, limits, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = p - y, p * (1 - p)
        feature, limit, at = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best, cut = np.zeros(width), [None] * width
            for f, e in enumerate(edges):
                key = (at - first) * bins + binned[:, f]
                g = np.bincount(key, gradient, width * bins).reshape(width, bins).cumsum(1)
                h = np.bincount(key, weight, width * bins).reshape(width, bins).cumsum(1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                gain[(h < 1) | (all_h - h < 1)] = 0
                gain = gain[:, : len(e)]
                if len(e):
                    for k in np.flatnonzero(gain.max(1) > best + 1e-9):
                        b = int(gain[k].argmax())
                        best[k], cut[k] = gain[k, b], (f, e[b], b)
            right = np.zeros(len(y), bool)
            for k, c in enumerate(cut):
                if c:
                    feature[first + k], limit[first + k] = c[0], c[1]
                    right |= (at == first + k) & (binned[:, c[0]] > c[2])
            at = 2 * at + 1 + right
        leaf = at - inner
        g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, weight, inner + 1)
        value = -rate * g / (h + ridge)
        total += value[leaf]
        features.append(feature)
        limits.append(limit)
        values.append(value)
    return Trees(np.array(features), np.array(limits), np.array(values), start)


def learning_rows(docs: DataFrame, labels: DataFrame, column: str = "quality", sample: int = SAMPLE) -> pd.DataFrame:
    """Statistics and label of the learning documents; ``sample`` rows at most come to the driver."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("y")).where("doc_id is not null and y is not null and y in (0, 1)")
    known = known.where(fold_of("doc_id", FOLDS) != 0).groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = documents_only(docs).join(F.broadcast(known), "doc_id")  # ids of a bounded sample

    def make():
        def step(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"doc_id": batch["doc_id"], "x": [statistics(text_bytes(t)) for t in batch["text"]], "y": batch["y"]})

        return step

    found = map_batches(rows, make, "doc_id long, x array<double>, y int")
    return found.orderBy(F.xxhash64("doc_id"), "doc_id", "x").limit(sample).toPandas()


def fit(docs: DataFrame, labels: DataFrame) -> Trees:
    rows = learning_rows(docs, labels)
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(STATISTICS))
    return grow(x, rows["y"].to_numpy(float))


def score(docs: DataFrame, trees: Trees, cut: float = CUT) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    def make():
        def step(batch: pd.DataFrame) -> pd.DataFrame:
            x = np.array([statistics(text_bytes(t)) for t in batch["text"]], float)
            scores = trees.scores(x)
            return pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": scores, "predicted": (scores >= cut).astype(np.int32)})

        return step

    out = map_batches(documents_only(docs), make, "doc_id long, score double, predicted int")
    return out.select("doc_id", (fold_of("doc_id", FOLDS) == 0).alias("held_out"), "score", "predicted")


def classify_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
