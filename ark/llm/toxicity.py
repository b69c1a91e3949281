"""Operator 4, toxicity: non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents drawn from the whole corpus, labels unseen, are the
unlabelled. A logistic classifier over hashed words and word beginnings minimises the class-prior-corrected risk

    prior * R(positive as 1) + max(0, R(unlabelled as 0) - prior * R(positive as 0)),

stepping back whenever the corrected term falls below zero (Kiryo et al., 2017). The prior is the toxic share
of the labelled documents to learn from.

Defined cases: null and empty texts have no words and get the bias alone; texts are read whole; repeated rows are
scored each; a document with several labels is toxic if any says so; null labels are ignored; without a toxic
label every score is the prior (0 without labels); buckets that tell equally much count in their order; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LONG_KEY, Memo, documents_only, fold_of, map_batches, stored

#: Documents to learn from, at most: those of the smallest hashes.
POSITIVES, UNLABELLED = 4_000, 8_000
FOLDS, HELD_OUT, CUT = 3, 1, 0.7
BUCKETS, FEATURES = 1 << 18, 1_024
BEGINNINGS = (3, 4, 5)
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: object) -> set[str]:
    return set(_WORD.findall(text.lower())) if isinstance(text, str) else set()


def buckets_of(word: str) -> list[int]:
    """Of the word and of its first 3, 4 and 5 letters: inflected and compound words share a beginning."""
    parts = [f"{word} ", *(word[:k] for k in BEGINNINGS if len(word) >= k)]
    return [zlib.crc32(p.encode("utf-8", "surrogatepass")) % BUCKETS for p in parts]


def features_of(text: object) -> set[int]:
    return {b for w in words_of(text) for b in buckets_of(w)}


@dataclass
class Classifier:
    weights: np.ndarray  # of each bucket
    bias: float

    def scores(self, texts: list[object], known: Memo) -> list[float]:
        """``known`` keeps the weighted buckets of words seen before."""
        out = []
        for text in texts:
            present: set[int] = set()
            for w in words_of(text):
                weighted = known.get(w)
                if weighted is None:
                    weighted = [b for b in buckets_of(w) if self.weights[b]]
                    if len(w) < LONG_KEY:
                        known.room(240 + 2 * len(w))
                        known[w] = weighted
                if weighted:
                    present.update(weighted)
            total = self.bias + sum(float(self.weights[b]) for b in sorted(present))
            out.append(1 / (1 + np.exp(-min(max(total, -30), 30))))
        return out


def telling_buckets(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, most: int = FEATURES) -> np.ndarray:
    """The buckets that tell positives from unlabelled texts best, by document frequencies."""
    a, b = (in_p + 0.5) / (n_p + 1), (in_u + 0.5) / (n_u + 1)
    gain = np.where(in_p >= 2, a * np.log(a / b) + (1 - a) * np.log((1 - a) / (1 - b)), 0) * np.sign(a - b)
    chosen = np.argsort(-gain, kind="stable")[:most]
    return chosen[gain[chosen] > 0]


def learn(positive: list[np.ndarray], unlabelled: list[np.ndarray], chosen: np.ndarray, prior: float, steps: int = 400, rate: float = 0.05, ridge: float = 1e-4) -> Classifier:
    """Full-batch Adam over the chosen buckets."""
    weights = np.zeros(BUCKETS)
    if not positive or not unlabelled:
        p = float(np.clip(prior, 1e-9, 1 - 1e-9))
        return Classifier(weights, float(np.log(p / (1 - p))))
    place = np.full(BUCKETS, -1)
    place[chosen] = np.arange(len(chosen))

    def sparse(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        column = place[np.concatenate([*sets, np.zeros(0, np.int64)]).astype(np.int64)]
        return row[column >= 0], column[column >= 0], len(sets)

    pos, unl = sparse(positive), sparse(unlabelled)
    w = np.zeros(len(chosen) + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)

    def margins(part: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
        return np.bincount(part[0], w[part[1]], part[2]) + w[-1]

    def gradient(part: tuple[np.ndarray, np.ndarray, int], per_row: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(part[1], per_row[part[0]], len(chosen)), per_row.sum()) / part[2]

    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, steps + 1):
        zp, zu = margins(pos), margins(unl)
        corrected = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g_corrected = gradient(unl, sigmoid(zu)) - prior * gradient(pos, sigmoid(zp))
        if corrected >= 0:
            g = prior * gradient(pos, sigmoid(zp) - 1) + g_corrected
        else:
            g = -g_corrected
        g = g + ridge * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights[chosen] = w[:-1]
    return Classifier(weights, float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Classifier:
    """To the driver come the document frequencies of BUCKETS buckets, and positives + unlabelled rows of telling buckets, at most."""
    texts = documents_only(docs).where(fold_of("doc_id", FOLDS) != HELD_OUT)
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(fold_of("doc_id", FOLDS) != HELD_OUT).groupBy("doc_id").agg(F.max("y").alias("y"))
    n, ones = known.agg(F.count("*"), F.sum("y")).first()
    prior = (ones or 0) / n if n else 0.0
    first = lambda ids, k: ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(k)
    chosen = first(known.where("y = 1").select("doc_id"), positives).withColumn("kind", F.lit(1))
    chosen = chosen.union(first(texts.where("doc_id is not null").select("doc_id").distinct(), unlabelled).withColumn("kind", F.lit(0)))

    def make():
        def step(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"doc_id": batch["doc_id"], "kind": batch["kind"], "x": [sorted(features_of(t)) for t in batch["text"]]})

        return step

    found = map_batches(texts.join(F.broadcast(chosen), "doc_id"), make, "doc_id long, kind int, x array<int>")
    rows = stored(found.groupBy("doc_id", "kind").agg(F.min("x").alias("x")), "learning")
    n = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    each = rows.select("kind", F.explode("x").alias("bucket")).groupBy("bucket").agg(F.sum("kind").alias("p"), F.sum(1 - F.col("kind")).alias("u")).toPandas()
    in_p, in_u = np.zeros(BUCKETS), np.zeros(BUCKETS)
    in_p[each["bucket"]], in_u[each["bucket"]] = each["p"], each["u"]
    telling = telling_buckets(in_p, in_u, n.get(1, 0), n.get(0, 0))
    few = F.array_intersect("x", F.array(*map(F.lit, telling.tolist())).cast("array<int>"))
    told = rows.select("doc_id", "kind", few.alias("x")).toPandas().sort_values("doc_id")
    of = lambda kind: [np.asarray(x, np.int64) for x in told.loc[told["kind"] == kind, "x"]]
    return learn(of(1), of(0), telling, prior)


def score(docs: DataFrame, classifier: Classifier, cut: float = CUT) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""

    def make():
        known = Memo()

        def step(batch: pd.DataFrame) -> pd.DataFrame:
            scores = np.array(classifier.scores(list(batch["text"]), known))
            return pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "score": scores, "predicted": (scores >= cut).astype(np.int32)})

        return step

    out = map_batches(documents_only(docs), make, "doc_id long, score double, predicted int")
    return out.select("doc_id", (fold_of("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
