"""Differences between similar blocks: candidates by shared bands, the best one kept."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import encodings

BANDS, CANDIDATES, LEAST = 8, 8, 2
#: Blocks under one band key that are compared: the newest ones before a block.
RECENT = 6


def bands(blocks: DataFrame) -> DataFrame:
    """(id, size, key): eight slices of each block (id, size, data) by position and CRC; slices of one repeated byte say nothing."""
    width = F.floor(F.col("size") / BANDS).cast("int")
    cut = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(i.alias("band"), F.substr(F.col("data"), i * width + 1, width).alias("s")))
    each = blocks.where(F.col("size") >= BANDS).select("id", "size", F.explode(cut).alias("b")).select("id", "size", "b.band", "b.s")
    plain = F.replace(F.hex("s"), F.hex(F.substr(F.col("s"), F.lit(1), F.lit(1))), F.lit("")) == ""
    return each.where(~plain).select("id", "size", F.concat_ws("/", "size", "band", F.crc32("s")).alias("key"))


def candidates(blocks: DataFrame) -> DataFrame:
    """(id, base, shared): up to eight earlier blocks of equal size with two or more shared bands, most shared first.

    Under one key a block looks at the six before it, so a key that very many blocks share costs six rows each.
    """
    before = Window.partitionBy("key").orderBy("id").rowsBetween(-RECENT, -1)
    pairs = bands(blocks).withColumn("bases", F.collect_list("id").over(before)).select("id", F.explode("bases").alias("base"))
    shared = pairs.groupBy("id", "base").agg(F.count("*").alias("shared")).where(F.col("shared") >= LEAST)
    best = Window.partitionBy("id").orderBy(F.desc("shared"), F.desc("base"))
    return shared.withColumn("place", F.row_number().over(best)).where(F.col("place") <= CANDIDATES).drop("place")


def encode_blocks(blocks: DataFrame) -> DataFrame:
    """(id, size, codec, base, data): each block alone, or as a difference to a candidate where that saves over 16 bytes.

    A base is always stored by itself, so chains have one step.
    """
    rows = blocks.select("id", "size", "data")
    pairs = candidates(blocks)
    bases = pairs.select(F.col("base").alias("id")).distinct()
    free = pairs.join(bases, "id", "left_anti")  # a block that is a base is no difference itself
    options = free.join(rows.select(F.col("id").alias("base"), F.col("data").alias("base_data")), "base").groupBy("id").agg(F.collect_list(F.struct("base", "base_data")).alias("options"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, size, data, options in zip(batch["id"], batch["size"], batch["data"], batch["options"], strict=True):
                data = bytes(data)
                best = (*encodings.plain(data), None)
                limit = len(best[1]) - encodings.SAVES
                for o in options if options is not None else ():
                    codec, packed = encodings.difference(data, bytes(o["base_data"]))
                    if len(packed) < limit:
                        best, limit = (codec, packed, int(o["base"])), len(packed)
                out.append((i, size, best[0], best[2], best[1]))
            yield pd.DataFrame(out, columns=["id", "size", "codec", "base", "data"]).astype({"base": "Int64"})

    return rows.join(options, "id", "left").mapInPandas(run, "id long, size long, codec string, base long, data binary")


def decode_blocks(encoded: DataFrame) -> DataFrame:
    """(id, content) of encoded blocks."""
    bases = encoded.where("base is null").select(F.col("id").alias("base"), F.col("codec").alias("b_codec"), F.col("data").alias("b_data"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples():
                base = encodings.decode(r.b_codec, bytes(r.b_data), r.size) if r.b_data is not None else None
                out.append((r.id, encodings.decode(r.codec, bytes(r.data), r.size, base)))
            yield pd.DataFrame(out, columns=["id", "content"])

    return encoded.join(bases, "base", "left").mapInPandas(run, "id long, content binary")
