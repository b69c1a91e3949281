"""Choosing block size and group cap on a reproducible sample of families."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .groups import encode_groups, next_fit
from .storage import blocks_of

#: Catalog bytes for each block and each reference to one.
PER_BLOCK, PER_REFERENCE = 90, 40


def sample_families(files: DataFrame, n: int, seed: int = 2026) -> DataFrame:
    """The files of ``n`` families: those of the smallest seeded hashes."""
    chosen = files.select("family").distinct().orderBy(F.xxhash64("family", F.lit(seed)), "family").limit(n)
    return files.join(chosen, "family", "left_semi")


def grid(files: DataFrame, blocks: list[int], caps: list[int]) -> DataFrame:
    """(block, cap, groups, unique_blocks, refs, stored, total): stored bytes of each setting with its metadata."""
    rows = []
    for block in blocks:
        cut = blocks_of(files.select("family", "object_id", "content"), "object_id", block)
        refs = cut.agg(F.count("*").alias("refs"))
        each = cut.join(files.select("object_id", "family"), "object_id").groupBy("sha256").agg(F.min("family").alias("family"), F.first("data").alias("content"), F.first("size").alias("size"))
        for cap in caps:
            plan = next_fit(each, "family", "sha256", "size", cap).join(each.select("sha256", "content"), "sha256")
            packed = encode_groups(plan, ["family", "group_no"], "offset", "content")
            sums = packed.agg(F.count("*").alias("groups"), F.coalesce(F.sum("stored_size"), F.lit(0)).alias("stored")).join(each.agg(F.count("*").alias("unique_blocks")), F.lit(True)).join(refs, F.lit(True))
            rows.append(sums.select(F.lit(block).alias("block"), F.lit(cap).alias("cap"), "groups", "unique_blocks", "refs", "stored", (F.col("stored") + PER_BLOCK * F.col("unique_blocks") + PER_REFERENCE * F.col("refs")).alias("total")))
    return reduce(DataFrame.union, rows)


def choose(results: DataFrame, slack: float = 0.005) -> DataFrame:
    """Among the settings within the slack of the smallest total: the smallest block, then the smallest cap."""
    best = results.agg(F.min("total").alias("least"))
    near = results.join(F.broadcast(best), F.col("total") <= F.col("least") * (1 + slack)).drop("least")
    return near.withColumn("place", F.row_number().over(Window.orderBy("block", "cap"))).where("place = 1").drop("place")
