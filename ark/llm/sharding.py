"""Operator 6, sharding: Hilbert-curve order over quantised metadata, in DataFrame operations only.

Language, source and size are quantised to 16 steps each. Documents are ordered by their place on the Hilbert
curve through these 4,096 cells and the order is cut into runs of equal length (law ``rows``: counts differ
by one at most), so each shard spans few languages, sources and sizes, and its manifest row prunes it.

Equal texts (by a 64-bit hash and size) form a group: a group stands in one cell, that of its least language and
source steps, and its rows follow each other, so it is cut at the ends of shards only, where the law asks for it.

Ranks come without one global sort: a cell is dealt over hash parts, each (cell, part) is numbered by itself,
and the numbers are shifted by the sums of what stands before. A source or a language with a third of all rows
is spread over all parts of its cells; the number of parts grows with the table. A group with over a thousandth of
all rows is a part of its own, dealt over ``SALTS`` further ones by id.

Defined cases: a null text has size 16 and crc 0; null language and source have steps of their own; very long
texts share the last step of size; repeated rows get a slot each, next to each other; other columns are ignored, or
carried unchanged by ``write_shards``; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

SHARDS, BITS, OVERHEAD = 40, 4, 16
#: Rows that one (cell, part) may hold on average if all documents were of one cell.
PART_ROWS = 1_000_000
#: Parts of a group that holds over a thousandth of all rows.
SALTS = 1_024


def hilbert_table(dimensions: int = 3) -> tuple[list[int], list[int]]:
    """Digit and next state for each state and corner of a cube: the curve's rule, worked out once.

    A state is the entry corner and direction of the curve in the present sub-cube.
    """
    corners = 1 << dimensions
    turn = lambda b, k: ((b << k % dimensions) | (b >> (dimensions - k % dimensions))) & (corners - 1)
    gray = [i ^ i >> 1 for i in range(corners)]
    trailing_ones = lambda i: (i ^ (i + 1)).bit_length() - 1
    digits, states = [], []
    for entry in range(corners):
        for axis in range(dimensions):
            for corner in range(corners):
                w = gray.index(turn(corner ^ entry, dimensions - axis - 1))
                enters = gray[2 * ((w - 1) // 2)] if w else 0
                goes = 0 if not w else trailing_ones(w if w % 2 else w - 1)
                digits.append(w)
                states.append((entry ^ turn(enters, axis + 1)) * dimensions + (axis + goes + 1) % dimensions)
    return digits, states


def hilbert_index(steps: list[Column], bits: int = BITS) -> Column:
    """Place on the curve of a cell given by its steps along each dimension."""
    n = len(steps)
    digits, states = hilbert_table(n)
    corner = lambda level: sum((F.shiftright(s, level).bitwiseAND(F.lit(1)) * (1 << k) for k, s in enumerate(steps)), F.lit(0))
    look = lambda table, at: F.element_at(F.array(*map(F.lit, table)), at)
    start = F.struct(F.lit(0).alias("index"), F.lit(0).alias("state"))

    def go(acc: Column, c: Column) -> Column:
        at = (acc["state"] * (1 << n) + c + 1).cast("int")
        return F.struct((acc["index"] * (1 << n) + look(digits, at)).cast("int").alias("index"), look(states, at).cast("int").alias("state"))

    return F.aggregate(F.array(*[corner(level).cast("int") for level in reversed(range(bits))]), start, go)["index"]


def name_step(value: Column) -> Column:
    """Step of a language or source: a hash, so new names need no new table."""
    return F.pmod(F.xxhash64(value.cast("string")), F.lit(1 << BITS)).cast("int")


def size_step(size: Column) -> Column:
    """Step of a size: its power of two, from the least size on."""
    return F.least(F.greatest(F.floor(F.log2(size.cast("double"))) - int(math.log2(OVERHEAD)), F.lit(0)), F.lit((1 << BITS) - 1)).cast("int")


def shard_documents(docs: DataFrame, shards: int = SHARDS, carry: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and the steps lang_step, source_step, size_step; ``carry`` adds the row as a struct."""
    text = F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.xxhash64(text, F.octet_length(text)).alias("mix"),
        name_step(docs["lang"]).alias("lang_step"), name_step(docs["source"]).alias("source_step"), *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []))
    rows = rows.withColumn("size_step", size_step(F.col("size")))
    rows = stored(rows, "steps")
    total = rows.count()
    steps = F.struct("lang_step", "source_step")
    groups = rows.groupBy("mix").agg(F.count("*").alias("n"), F.min(steps).alias("least"), F.max(steps).alias("most"))
    groups = stored(groups.where("n > 1").select("mix", "n", "least", (F.col("least") != F.col("most")).alias("spread")), "groups")
    large = F.broadcast(groups.where(F.col("n") > total / 1000).select("mix", "least", F.lit(1).alias("large")))  # a thousand at most
    spread = groups.where((F.col("n") <= total / 1000) & F.col("spread")).select("mix", F.col("least").alias("other"))
    marked = rows.join(large, "mix", "left")
    few = marked.where("large is null").drop("least").join(spread.withColumnRenamed("other", "least"), "mix", "left")
    rows = marked.where("large is not null").unionByName(few)
    own = F.coalesce("least", F.struct("lang_step", "source_step"))
    rows = rows.withColumn("cell", hilbert_index([own["lang_step"], own["source_step"], F.col("size_step")])).drop("least")
    parts = max(6, math.ceil(math.log2(max(1, total / PART_ROWS))))
    alone = F.col("large").isNotNull()
    rows = rows.withColumn("part", F.shiftrightunsigned("mix", 64 - parts)).withColumn("of", F.when(alone, F.col("mix"))).withColumn("salt", F.when(alone, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(0)).drop("large")
    rows = stored(rows.withColumn("of", F.coalesce("of", F.lit(0))), "cells")
    counts = stored(rows.groupBy("cell", "part", "of", "salt").agg(F.count("*").alias("n")), "counts")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = counts.groupBy("cell").agg(F.sum("n").alias("n"))  # 4,096 rows at most
    cells = cells.select("cell", before(Window.orderBy("cell")).alias("of_cell"))
    keys = ["cell", "part", "of", "salt"]
    starts = counts.select(*keys, before(Window.partitionBy("cell").orderBy("part", "of", "salt")).alias("of_part")).join(cells, "cell")
    starts = starts.select(*keys, (F.col("of_cell") + F.col("of_part")).alias("start"))
    within = Window.partitionBy(*keys).orderBy("mix", "doc_id", "text_crc32", "size")
    ranked = rows.withColumn("k", F.row_number().over(within) - 1).join(starts, keys).withColumn("rank", F.col("start") + F.col("k"))
    ranked = ranked.withColumn("shard", F.expr(f"rank * {shards} div {max(total, 1)}"))
    return ranked.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.expr(f"rank - (shard * {total} + {shards - 1}) div {shards}").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "lang_step", "source_step", "size_step", *(["row"] if carry else []))


def manifest(sharded: DataFrame) -> DataFrame:
    """One row per shard: its rows, bytes and the steps that occur in it."""
    steps = [F.sort_array(F.collect_set(c)).alias(f"{c}s") for c in ("lang_step", "source_step", "size_step")]
    return sharded.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), *steps)


def prune(manifest: DataFrame, lang: str | None = None, source: str | None = None, sizes: tuple[int, int] | None = None) -> DataFrame:
    """The shards that can hold documents of a language, a source and a range of sizes."""
    for column, value in (("lang_steps", lang), ("source_steps", source)):
        if value is not None:
            manifest = manifest.where(F.array_contains(column, name_step(F.lit(value))))
    if sizes is not None:
        manifest = manifest.where(F.exists("size_steps", lambda s: s.between(size_step(F.lit(sizes[0])), size_step(F.lit(sizes[1])))))
    return manifest


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents as Parquet, a folder for each shard, in the order of their slots."""
    sharded = shard_documents(docs, shards, carry=True).repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot")
    sharded.select(F.col("shard").alias("__shard"), "row.*").write.partitionBy("__shard").parquet(path)
