"""Operator 9, SimHash near-dedup: pigeonhole blocks over 64-bit fingerprints of word shingles.

A fingerprint bit is 1 if it is set in over half of the shingles' XXH64 values. Two fingerprints link if at
most two bits differ. Cut into four 16-bit blocks, such a pair agrees in two whole blocks, so it meets under
one of six 32-bit keys; only pairs under one key are compared. A key that many different fingerprints share
is cut again: of three parts of the other 32 bits one is equal too.

Copies share one fingerprint and are reduced to one row before any join, so a group of copies of any size
costs one row. Components come from label propagation with pointer jumping, over written tables.

Defined cases: null and empty texts have fingerprint zero, linked like any other; a row without doc_id gets
its component's smallest id; repeated rows are returned each; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents_only, map_batches, sheltered, stored, text_bytes

SHINGLE, SEED, DISTANCE = 3, 42, 2
#: Different fingerprints under one key from which the key is cut again.
CUT_AGAIN = 256
#: Stands for a missing doc_id.
NO_ID = 2**63 - 1


def text_mark() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def fingerprint(text: object, shingle: int = SHINGLE, seed: int = SEED) -> int:
    words = text_bytes(text).lower().split()  # bytes: A-Z alone, and exactly the ASCII white space
    if not words:
        return 0
    one = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [one(b" ".join(words), seed)]
    else:
        hashes = [one(b" ".join(s), seed) for s in zip(*(words[k:] for k in range(shingle)), strict=False)]
    ones, n = np.zeros(64, np.int64), len(hashes)
    values = np.array(hashes, np.uint64)
    for k in range(0, n, 4096):
        part = values[k : k + 4096].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return sum(1 << k for k in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(doc_id, mark, fp): a hash of the text, and the fingerprint as a signed 64-bit number."""

    def make():
        def step(batch: pd.DataFrame) -> pd.DataFrame:
            fps = np.array([fingerprint(t, shingle, seed) for t in batch["text"]], np.uint64).view(np.int64)
            return pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "mark": batch["mark"], "fp": fps})

        return step

    return map_batches(documents_only(docs).withColumn("mark", text_mark()), make, "doc_id long, mark long, fp long")


def _field(fp: Column, bits: list[int]) -> Column:
    """The value of the named bits, in order; consecutive bits are cut out at once."""
    out, k, at = F.lit(0).cast("long"), 0, 0
    while k < len(bits):
        run = 1
        while k + run < len(bits) and bits[k + run] == bits[k] + run:
            run += 1
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, bits[k]).bitwiseAND(F.lit((1 << run) - 1)), at))
        k, at = k + run, at + run
    return out


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints at most two bits apart, once each."""
    if distance != 2:
        raise ValueError("the blocks are cut for a distance of two bits")
    pairs = list(combinations(range(4), 2))
    bits = [[b for k in pair for b in range(16 * k, 16 * k + 16)] for pair in pairs]
    other = [[b for b in range(64) if b not in set(mine)] for mine in bits]
    keys = F.array(*[F.struct(F.lit(k).alias("block"), _field(F.col("fp"), bits[k]).alias("key")) for k in range(6)])
    rows = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.block", "k.key")
    size = rows.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = rows.join(size, ["block", "key"])

    def meet(rows: DataFrame, on: list[str]) -> DataFrame:
        a, b = rows.select(*on, F.col("fp").alias("a")), rows.select(*on, F.col("fp").alias("b"))
        apart = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
        return a.join(b, on).where((F.col("a") < F.col("b")) & (apart <= distance)).select("a", "b")

    parts = [F.array(*[F.struct(F.lit(p).alias("part"), _field(F.col("fp"), other[k][11 * p : 11 * p + 11]).alias("bits")) for p in range(3)]) for k in range(6)]
    part = F.element_at(F.array(*parts), F.col("block") + 1)
    crowded = rows.where(F.col("n") > CUT_AGAIN).select("fp", "block", "key", F.explode(part).alias("p")).select("fp", "block", "key", "p.part", "p.bits")
    found = meet(rows.where(F.col("n") <= CUT_AGAIN), ["block", "key"]).union(meet(crowded, ["block", "key", "part", "bits"]))
    return found.distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, label, root): the smallest label that is reachable. ``nodes``: (fp, label) once each; ``edges``: (a, b).

    Each round takes the smallest label of the neighbours and then the label of that label's own node. Both
    tables are written to the shared folder, so no lineage grows and nothing is gathered on the driver.
    """
    both = stored(edges.union(edges.select("b", "a")).toDF("fp", "near"), "edges")
    linked = both.select("fp").distinct()
    at = stored(nodes.join(linked, "fp").select("fp", "label", F.col("fp").alias("root")), "labels")
    while True:
        best = F.min(F.struct("label", "root"))
        near = at.select(F.col("fp").alias("near"), "label", "root").join(both, "near").groupBy("fp").agg(best.alias("m"))
        step = at.withColumnsRenamed({"label": "own", "root": "own_root"}).join(near, "fp").select(
            "fp", "own", "own_root", F.least(F.struct(F.col("own").alias("label"), F.col("own_root").alias("root")), F.col("m")).alias("m"))
        step = stored(step, "step")
        jump = step.select(F.col("fp").alias("r"), F.col("m").alias("via"))
        at = stored(step.join(jump, F.col("m.root") == F.col("r")).select("fp", "own", "own_root", F.least("m", "via").alias("m")).select("fp", "own", "own_root", "m.label", "m.root"), "labels")
        if at.where((F.col("own") != F.col("label")) | (F.col("own_root") != F.col("root"))).isEmpty():
            break
        at = at.select("fp", "label", "root")
    # root is the fingerprint that holds the label: one name for each component
    rest = nodes.join(linked, "fp", "left_anti").select("fp", "label", F.col("fp").alias("root"))
    return rest.union(at.select("fp", "label", "root"))


def _solve(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, mark, fp) of the rows; (fp, label, root) of the fingerprints; the links."""
    marks = stored(fingerprints(docs), "fingerprints")
    nodes = stored(marks.groupBy("fp").agg(F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("label")), "nodes")
    edges = stored(links(nodes.select("fp")), "links")
    return marks, components(nodes, edges), edges


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id, and n_linked, the other fingerprints that its own links to."""
    marks, label, edges = _solve(docs)
    degree = edges.select(F.col("a").alias("fp")).union(edges.select("b")).groupBy("fp").agg(F.count("*").alias("n_linked"))
    return marks.join(label, "fp").join(degree, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("label") < NO_ID, F.col("label")).alias("component_id"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest doc_id, and of its equals that of the smallest text hash."""
    marks, label, _ = _solve(docs)
    return keep_heads(docs, marks, label)


def keep_heads(docs: DataFrame, marks: DataFrame, label: DataFrame) -> DataFrame:
    """The rows ``keep_one`` keeps, of components that are found. ``marks``: (doc_id, mark, fp); ``label``: (fp, root)."""
    heads = marks.join(label, "fp").groupBy("root").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("mark").alias("__mark"))).alias("h")).select("h.*")
    rows = sheltered(docs)
    names = rows.columns
    rows = rows.withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("__mark", text_mark())
    return rows.join(heads, ["__id", "__mark"], "left_semi").dropDuplicates(["__id", "__mark"]).select(*names).toDF(*docs.columns)
