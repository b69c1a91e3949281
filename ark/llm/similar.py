"""Near copies by SimHash, and exactly: every pair of texts whose word shingles have a Jaccard similarity of at least ``percent``.

Texts are first linked by their 64-bit SimHash fingerprints over the same shingles, through the blocks of ``simhash``:
those of one fingerprint with the first of them, and the first ones of fingerprints at most two bits apart. A link
stands if the exact similarity does. No number of bits bounds this similarity, so the pairs whose fingerprints lie
further apart are found in an exact way; what is one component by then is not compared again.

The shingles of a text are ordered by one order that holds for all texts: hot ones last, then by hash. Two sets that
are similar enough share a shingle among the first n - ceil(percent * n) + 1 of each, whatever that order is, so the
pairs that meet under one of these keys are all there are; their exact similarity is counted then.

Hot shingles are those that over ``HOT`` texts of a quarter of all hold, wherever they stand in a text: a passage that
many texts share has such ones, and so have near copies. Which are hot decides how many pairs meet by chance, never which
pairs are found. With the most frequent last, a text leads with what it has alone, so one that differs too much from its
near copies meets none of them under a key that still allows the similarity. The others join in rounds. In each round a
text is held against one text of its keys, the one it shares most of them with; of a key that is the text in which it
stands first, as that one has least of its own. Whatever is one component by then need not be compared again, so a group
of near copies is not squared.

Defined cases: as in ``simhash``; texts without words are copies of each other, and a text of fewer words than a
shingle has is one shingle. Hashes of 64 bits stand for equality of shingles.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents_only, forget, map_batches, stored, text_bytes
from .simhash import NO_ID, components, fingerprints, keep_heads, links, text_mark

SHINGLE, PERCENT = 5, 80
#: One text in ``SHARE`` is looked at for hot shingles; one that more than ``HOT`` of them hold is hot, the ``MOST`` hottest at most.
SHARE, HOT, MOST = 4, 4, 1_000_000
#: Rounds of one comparison for each text.
ROUNDS = 2
#: Candidates (8 bytes each) up to this number are broadcast; more are joined by shuffle.
BROADCAST_IDS = 2_000_000


def shingles(text: object, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the different shingles, in ascending order; never empty."""
    words = text_bytes(text).lower().split()
    one = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([one(b" ".join(words))], np.uint64)
    return np.unique(np.array([one(b" ".join(s)) for s in zip(*(words[k:] for k in range(shingle)), strict=False)], np.uint64))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + percent * n // -100 + 1


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(fp, hashes) of (fp, text)."""

    def make():
        return lambda batch: pd.DataFrame({"fp": batch["fp"], "hashes": [shingles(t, shingle).view(np.int64) for t in batch["text"]]})

    return map_batches(texts.select("fp", "text"), make, "fp long, hashes array<long>")


def _leading(texts: DataFrame, shingle: int, percent: int, hot: np.ndarray, times: np.ndarray) -> DataFrame:
    """(key, fp, n, pos): the leading shingles of each text, ``hot`` ones (ascending) last, the more frequent (``times``) the later."""

    def make():
        def step(batch: pd.DataFrame) -> pd.DataFrame:
            keys, sizes = [], []
            for text in batch["text"]:
                own = shingles(text, shingle)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
                    own = own[np.argsort(np.where(hot[at] == own, times[at], 0), kind="stable")]
                keys.append(own[: prefix_length(len(own), percent)])
                sizes.append(len(own))
            each = [len(k) for k in keys]
            return pd.DataFrame({
                "key": np.concatenate(keys).view(np.int64), "fp": np.repeat(batch["fp"].to_numpy(np.int64), each),
                "n": np.repeat(np.array(sizes, np.int32), each), "pos": np.concatenate([np.arange(k, dtype=np.int32) for k in each])})

        return step

    return map_batches(texts.select("fp", "text"), make, "key long, fp long, n int, pos int")


def _frequent(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The hot shingles in ascending order, and in how many of the texts looked at each is: all shingles of a text count, not its leading ones."""

    def make():
        def step(batch: pd.DataFrame) -> pd.DataFrame:
            key, n = np.unique(np.concatenate([shingles(t, shingle) for t in batch["text"]]), return_counts=True)
            return pd.DataFrame({"key": key.view(np.int64), "n": n})

        return step

    some = map_batches(texts.where(F.pmod("fp", F.lit(SHARE)) == 0).select("text"), make, "key long, n long")
    often = some.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > HOT).orderBy(F.desc("n"), "key").limit(MOST).toPandas()
    hot, times = often["key"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64)
    order = np.argsort(hot)
    return hot[order], times[order]


def postings(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(key, fp, n, pos): the leading shingles that several texts share, once for each text; copies are one."""
    rows = _leading(texts, shingle, percent, *_frequent(texts, shingle))
    rows = rows.repartition("key").dropDuplicates(["key", "fp"])
    return stored(rows.withColumn("__m", F.count("*").over(Window.partitionBy("key"))).where("__m > 1").drop("__m"), "postings")


def _may_be(percent: int):
    """Of two texts with their first common shingle at ``pos`` and ``pos_b``: sizes and what follows allow the similarity."""
    follow = F.least(F.col("n") - F.col("pos"), F.col("n_b") - F.col("pos_b"))  # the shared one is counted
    return (100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")) & ((100 + percent) * follow >= percent * (F.col("n") + F.col("n_b")))


def verified(candidates: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b) of the candidates (a, b) whose exact similarity is ``percent`` or more."""
    named = stored(candidates.select(F.col("a").alias("fp")).union(candidates.select("b")).distinct(), "named")
    named = F.broadcast(named) if named.count() <= BROADCAST_IDS else named
    sets = stored(_sets(texts.join(named, "fp", "left_semi").dropDuplicates(["fp"]), shingle), "sets")
    both = candidates.join(sets.toDF("a", "ha"), "a").join(sets.toDF("b", "hb"), "b")
    common = F.size(F.array_intersect("ha", "hb"))
    out = stored(both.where((100 + percent) * common >= percent * (F.size("ha") + F.size("hb"))).select("a", "b"), "similar")
    forget(sets)
    return out


def fingerprint_links(marks: DataFrame) -> DataFrame:
    """(a, b), a < b, of (fp, simhash): texts to be compared, as their fingerprints are equal or at most two bits apart.

    All texts of one fingerprint meet the first of them alone, and so do fingerprints: as many rows as texts and links.
    """
    texts = stored(marks.select("fp", "simhash").distinct(), "simhashes")
    heads = stored(texts.groupBy("simhash").agg(F.min("fp").alias("head")), "heads")
    same = texts.join(heads, "simhash").where("fp <> head").select(F.col("head").alias("a"), F.col("fp").alias("b"))
    near = stored(links(heads.select(F.col("simhash").alias("fp"))), "links")
    near = near.join(heads.toDF("a", "x"), "a").join(heads.toDF("b", "y"), "b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return stored(same.union(near), "near")


def _open_keys(shared: DataFrame, group: DataFrame) -> DataFrame:
    """The postings with their component's root, of keys that are not one component yet."""
    named = shared.join(group, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    split = named.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key")
    return stored(named.join(split, "key", "left_semi"), "open")


def similar_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) of the rows, fp a hash of the text; (fp, label, root), its component."""
    marks = stored(fingerprints(docs, shingle).toDF("doc_id", "fp", "simhash"), "marks")
    texts = documents_only(docs).withColumn("fp", text_mark()).select("fp", "text")
    nodes = stored(marks.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("label")), "nodes")
    shared = postings(texts, shingle, percent)
    tried = fingerprint_links(marks)
    edges = verified(tried, texts, shingle, percent)
    group = components(nodes, edges).select("fp", "root")
    for _ in range(ROUNDS):
        named = _open_keys(shared, group)
        head = named.groupBy("key").agg(F.min(F.struct("pos", "fp", "n", "root")).alias("h")).select("key", F.col("h.fp").alias("head"), F.col("h.n").alias("n_b"), F.col("h.pos").alias("pos_b"), F.col("h.root").alias("root_b"))
        pairs = named.join(head, "key").where((F.col("root") != F.col("root_b")) & _may_be(percent)).groupBy("fp", "head").agg(F.count("*").alias("k"))
        pairs = pairs.withColumns({"a": F.least("fp", "head"), "b": F.greatest("fp", "head")}).join(tried, ["a", "b"], "left_anti")
        pairs = pairs.groupBy("fp").agg(F.min(F.struct(-F.col("k"), "a", "b")).alias("best")).select("best.a", "best.b").distinct()
        pairs = stored(pairs, "stars")
        edges, tried = edges.union(verified(pairs, texts, shingle, percent)), tried.union(pairs)
        forget(named)
        group = components(nodes, edges).select("fp", "root")
    named = _open_keys(shared, group)
    other = named.select("key", F.col("fp").alias("b"), F.col("n").alias("n_b"), F.col("pos").alias("pos_b"), F.col("root").alias("root_b"))
    rest = named.join(other, "key").where((F.col("fp") < F.col("b")) & (F.col("root") != F.col("root_b")) & _may_be(percent)).select(F.col("fp").alias("a"), "b").distinct()
    rest = stored(rest.join(tried, ["a", "b"], "left_anti"), "pairs")
    edges = edges.union(verified(rest, texts, shingle, percent))
    return marks.select("doc_id", "fp"), components(nodes, edges)


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, as ``simhash.keep_one``."""
    marks, label = similar_groups(docs, shingle, percent)
    return keep_heads(docs, marks.withColumn("mark", F.col("fp")), label)
