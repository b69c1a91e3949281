"""Blocks of content: splitting, deduplication, extents, shares and similarity bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def split_blocks(df: DataFrame, key: list[str], content: str, size: int) -> DataFrame:
    """One row per block of ``size`` characters; empty content has one empty block. A text is cut in one pass."""
    cut = F.regexp_extract_all(F.col(content), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    each = df.select(*key, F.posexplode(F.when(F.length(content) == 0, F.array(F.lit(""))).otherwise(cut)).alias("ordinal", "block"))
    return each.select(*key, F.col("ordinal").cast("long").alias("ordinal"), (F.col("ordinal") * F.lit(size)).cast("long").alias("offset"), "block")


def block_stats(blocks: DataFrame, by: str) -> DataFrame:
    """References, different blocks and their ratio for each group; blocks are reduced by digest before they meet."""
    each = blocks.groupBy(by, F.md5(F.col("block").cast("binary")).alias("digest")).agg(F.count("*").alias("refs"))
    return each.groupBy(by).agg(F.sum("refs").cast("long").alias("refs"), F.count("*").alias("uniq")).withColumn("ratio", F.round(F.col("uniq") / F.col("refs"), 4))


def run_lengths(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Runs of equal neighbours as (key, run, value, repeat, first of the order columns)."""
    w = Window.partitionBy(*key).orderBy(*order)
    starts = df.withColumn("__new", F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1))
    runs = starts.withColumn("run", F.sum("__new").over(w).cast("long"))
    return runs.groupBy(*key, "run").agg(F.first(value).alias(value), F.count("*").alias("repeat"), F.min(order[-1]).alias(f"first_{order[-1]}"))


def running_offsets(df: DataFrame, key: list[str], order: list[str], size: str, start: Column | None = None) -> DataFrame:
    """Offset of each member in its group: the sizes before it."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("offset", F.coalesce(F.sum(size).over(w), F.lit(0)) + (F.lit(0) if start is None else start))


def shared_block_family(blocks: DataFrame, key: str, family: str, block: str, widest: int = 32, share: float = 0.1) -> DataFrame:
    """The family of other members that shares most different blocks; blocks of over ``widest`` members say nothing."""
    rows = blocks.select(key, family, block).distinct()
    refs = rows.groupBy(block).agg(F.count("*").alias("refs")).where(f"refs between 2 and {widest}")
    few = rows.join(refs.select(block), block)
    other = few.select(block, F.col(key).alias("__other"), F.col(family).alias("candidate"))
    met = few.join(other, block).where(F.col(key) != F.col("__other")).select(key, "candidate", block).distinct().groupBy(key, "candidate").agg(F.count("*").alias("shared"))
    total = rows.groupBy(key).agg(F.count("*").alias("total"))
    best = Window.partitionBy(key).orderBy(F.desc("shared"), "candidate")
    ranked = met.join(total, key).where(F.col("shared") >= F.greatest(F.lit(1.0), F.lit(share) * F.col("total"))).withColumn("__rank", F.row_number().over(best))
    return ranked.where("__rank = 1").select(key, "candidate", "shared", "total")


def band_candidates(df: DataFrame, key: str, content: str, bands: int = 8, least: int = 2) -> DataFrame:
    """Pairs of different contents that agree in two or more of eight equal slices; copies stand for one of them."""
    one = df.where(F.length(content) >= bands).groupBy(content).agg(F.min(key).alias(key))
    width = F.floor(F.length(content) / bands).cast("int")
    slices = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.struct(i.alias("band"), F.md5(F.substring(F.col(content), i * width + 1, width).cast("binary")).alias("digest")))
    rows = one.select(F.col(key), F.length(content).alias("size"), F.explode(slices).alias("s")).select(key, "size", "s.band", "s.digest")
    a, b = rows.withColumnRenamed(key, "a"), rows.withColumnRenamed(key, "b")
    return a.join(b, ["size", "band", "digest"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("bands")).where(F.col("bands") >= least)
