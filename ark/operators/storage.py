"""Objects in a catalog: stored once by digest, as extents of deduplicated blocks in solid groups."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..catalog import Catalog
from ..functions.expressions import hashes
from ..schemas import SCHEMAS
from ..shared import stored
from .groups import decode_members, encode_groups, next_fit

BLOCK, CAP = 64 << 10, 32 << 20


def id_of(digest: Column) -> Column:
    """An id from the first 63 bits of a hex digest: the same content has the same id in every run. ``store`` refuses
    two digests of one id."""
    return F.shiftrightunsigned(F.conv(F.substring(digest, 1, 16), 16, -10).cast("long"), 1)


def refuse_clashes(new: DataFrame, known: DataFrame) -> None:
    """``new`` and ``known``: sha256. An id that stands for two digests is an error."""
    named = lambda df, name: df.select(id_of(F.col("sha256")).alias("id"), F.col("sha256").alias(name))
    mine, other = named(new, "a"), named(new.union(known), "b")
    if not mine.join(other, "id").where("a <> b").isEmpty():
        raise ValueError("two contents have the same id")


def blocks_of(contents: DataFrame, key: str, size: int, cuts: str | None = None) -> DataFrame:
    """(key, ordinal, offset, sha256, size, data): fixed blocks that restart at each cut; empty contents have none.

    ``cuts`` names an array column of offsets, such as the end of a copier header.
    """
    n = F.octet_length("content")
    inner = F.filter(F.col(cuts), lambda c: (c > 0) & (c < n)) if cuts else F.array().cast("array<int>")
    edges = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0)), inner, F.array(n))))
    starts = F.flatten(F.transform(F.sequence(F.lit(1), F.greatest(F.size(edges) - 1, F.lit(1))), lambda k: F.when(F.get(edges, k) > F.get(edges, k - 1), F.sequence(F.get(edges, k - 1), F.get(edges, k) - 1, F.lit(size))).otherwise(F.array().cast("array<int>"))))
    rows = contents.where(n > 0).select(key, "content", F.array_append(starts, n).alias("s"))
    each = rows.select(key, "content", "s", F.posexplode(F.slice("s", 1, F.size("s") - 1)).alias("ordinal", "offset"))
    data = F.substr(F.col("content"), F.col("offset") + 1, F.get("s", F.col("ordinal") + 1) - F.col("offset"))
    return each.select(key, F.col("ordinal").cast("long").alias("ordinal"), F.col("offset").cast("long").alias("offset"), data.alias("data")).select("*", F.sha2("data", 256).alias("sha256"), F.octet_length("data").cast("long").alias("size"))


def extents(blocks: DataFrame, key: str) -> DataFrame:
    """(key, ordinal, offset, sha256, repeat): neighbours of one block are one extent."""
    w = Window.partitionBy(key).orderBy("ordinal")
    new = F.when(F.lag("sha256").over(w) == F.col("sha256"), 0).otherwise(1)
    runs = blocks.select(key, "ordinal", "offset", "sha256").withColumn("new", new).withColumn("run", F.sum("new").over(w))
    return runs.groupBy(key, "run").agg(F.min("offset").alias("offset"), F.first("sha256").alias("sha256"), F.count("*").alias("repeat")).select(key, (F.col("run") - 1).alias("ordinal"), "offset", "sha256", "repeat")


def store(catalog: Catalog, files: DataFrame, block: int = BLOCK, cap: int = CAP) -> dict[str, int]:
    """Add contents (family, content, and if wanted cuts) that the catalog lacks. Storing twice adds nothing.

    Blocks are grouped by family in the order of their digests; every group is one task's work.
    """
    named = files.select("family", "content", *(["cuts"] if "cuts" in files.columns else []), *hashes(F.col("content")))
    known = catalog.objects.select("sha256")
    fresh = named.dropDuplicates(["sha256"]).join(known, "sha256", "left_anti").withColumn("object_id", id_of(F.col("sha256")))
    fresh = stored(fresh, "fresh")
    blocks = blocks_of(fresh, "object_id", block, "cuts" if "cuts" in files.columns else None)
    held = catalog.chunks.select(F.lower(F.hex("sha256")).alias("sha256"))
    families = fresh.select("object_id", "family")
    new = blocks.join(families, "object_id").groupBy("sha256").agg(F.min("family").alias("family"), F.first("data").alias("content"), F.first("size").alias("size")).join(held, "sha256", "left_anti")
    new = stored(new, "new")
    plan = next_fit(new, "family", "sha256", "size", cap)
    members = plan.join(new.select("sha256", "content"), "sha256")
    packed = encode_groups(members, ["family", "group_no"], "offset", "content").withColumn("id", id_of(F.col("sha256")))
    packed = stored(packed, "packed")
    chunks = plan.join(packed.select("family", "group_no", F.col("id").alias("group_id")), ["family", "group_no"])
    refuse_clashes(fresh.select("sha256"), known)
    refuse_clashes(new.select("sha256"), held)
    counts = {"objects": fresh.count(), "blocks": new.count(), "groups": packed.count()}
    catalog.append("chunks", chunks.select(id_of(F.col("sha256")).alias("id"), F.unhex("sha256").alias("sha256"), "size", F.lit("group").alias("codec"), F.lit(0).alias("depth"), "group_id", F.col("offset").alias("group_offset")))
    catalog.append("compression_groups", packed.select("id", F.unhex("sha256").alias("sha256"), F.unhex(F.sha2("data", 256)).alias("encoded_sha256"), F.col("raw_size").alias("size"), F.lit("lzma2-solid").alias("codec"), "data"))
    listed = chunks.select("group_id", "family").distinct()
    catalog.append("solid_group_families", listed.select("group_id", F.lit(0).alias("ordinal"), F.col("family").alias("family_key")))
    catalog.append("object_chunks", extents(blocks, "object_id").select("object_id", "ordinal", "offset", id_of(F.col("sha256")).alias("chunk_id"), "repeat"))
    catalog.append("object_families", fresh.select("object_id", F.col("family").alias("family_key"), F.lit("import").alias("basis")))
    catalog.append("objects", fresh.select(F.col("object_id").alias("id"), "sha256", "sha1", "md5", "crc32", "size", F.lit("chunks").alias("storage_kind")))
    return counts


def fetch(catalog: Catalog, object_ids: DataFrame) -> DataFrame:
    """(object_id, content): each group is decoded once, whatever number of objects need it."""
    wanted = object_ids.select("object_id").distinct()
    spans = catalog.object_chunks.join(wanted, "object_id", "left_semi").select("object_id", "offset", "chunk_id", F.explode(F.sequence(F.lit(0), (F.col("repeat") - 1).cast("int"))).alias("k"))
    chunks = catalog.chunks.join(spans.select(F.col("chunk_id").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("chunk_id"), "group_id", F.col("group_offset").alias("offset"), "size")
    groups = catalog.compression_groups.select(F.col("id").alias("group_id"), "data", "size", F.lower(F.hex("sha256")).alias("sha256"))
    bytes_of = decode_members(groups, chunks, ["group_id"], "chunk_id")
    parts = spans.join(bytes_of, "chunk_id").withColumn("at", F.col("offset") + F.col("k") * F.octet_length("content"))
    whole = parts.groupBy("object_id").agg(F.sort_array(F.collect_list(F.struct("at", "content"))).alias("p"))

    def join_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"object_id": batch["object_id"], "content": [b"".join(bytes(x["content"]) for x in p) for p in batch["p"]]})

    found = whole.mapInPandas(join_up, "object_id long, content binary")
    sizes = catalog.objects.select(F.col("id").alias("object_id"), "size").join(wanted, "object_id", "left_semi")
    return sizes.join(found, "object_id", "left").select("object_id", F.when(F.col("size") == 0, F.lit(b"")).otherwise(F.col("content")).alias("content"))


def verify(catalog: Catalog) -> DataFrame:
    """(object_id, problem) of objects whose bytes cannot be given back exactly."""
    ids = catalog.objects.where("storage_kind = 'chunks'").select(F.col("id").alias("object_id"), "sha256")
    read = ids.join(fetch(catalog, ids), "object_id", "left")
    problem = F.when(F.col("content").isNull(), "missing").when(F.sha2("content", 256) != F.col("sha256"), "different")
    return read.select("object_id", problem.alias("problem")).where("problem is not null")


def positions(catalog: Catalog) -> DataFrame:
    """(object_id, group_id, offset): where each object first stands; reading in this order decodes each group once. Recipes stand where their body does."""
    at = catalog.object_chunks.join(catalog.chunks.where("group_id is not null").select(F.col("id").alias("chunk_id"), "group_id", F.col("group_offset").alias("o")), "chunk_id")
    first = at.groupBy("object_id").agg(F.min(F.struct("group_id", F.col("o").alias("offset"))).alias("p")).select("object_id", "p.*")
    bodies = catalog.nes_recipes.select("object_id", F.col("body_object_id")).join(first.withColumnRenamed("object_id", "body_object_id"), "body_object_id")
    return first.unionByName(bodies.drop("body_object_id").join(first, "object_id", "left_anti"))


def regroup(catalog: Catalog, folder: str, cap: int) -> Catalog:
    """A copy of the catalog with its blocks packed anew, family by family, into groups of another cap. Identities stay."""
    of_group = catalog.solid_group_families.groupBy("group_id").agg(F.min("family_key").alias("family"))
    held = catalog.chunks.where("group_id is not null")
    groups = catalog.compression_groups.select(F.col("id").alias("group_id"), "data", "size", F.lower(F.hex("sha256")).alias("sha256"))
    places = held.select(F.col("id").alias("chunk_id"), "group_id", F.col("group_offset").alias("offset"), "size")
    bytes_of = decode_members(groups, places, ["group_id"], "chunk_id")
    named = held.join(of_group, "group_id", "left").select("id", F.lower(F.hex("sha256")).alias("sha256"), "size", F.coalesce("family", F.lit("")).alias("family"))
    plan = next_fit(named, "family", "sha256", "size", cap).join(named.select("id", "sha256"), "sha256")
    plan = stored(plan, "plan")
    packed = encode_groups(plan.join(bytes_of.withColumnRenamed("chunk_id", "id"), "id"), ["family", "group_no"], "offset", "content").withColumn("new_group", id_of(F.col("sha256")))
    packed = stored(packed, "packed")
    copy = Catalog(catalog.spark, folder)
    moved = ("chunks", "compression_groups", "solid_group_families")
    for name in SCHEMAS:
        if name not in moved and catalog.written(name):
            copy.append(name, catalog.table(name))
    placed = plan.join(packed.select("family", "group_no", "new_group"), ["family", "group_no"]).select("id", F.col("new_group").alias("group_id"), F.col("offset").alias("group_offset"))
    copy.append("chunks", held.drop("group_id", "group_offset").join(placed, "id"))
    copy.append("chunks", catalog.chunks.where("group_id is null"))
    copy.append("compression_groups", packed.select(F.col("new_group").alias("id"), F.unhex("sha256").alias("sha256"), F.unhex(F.sha2("data", 256)).alias("encoded_sha256"), F.col("raw_size").alias("size"), F.lit("lzma2-solid").alias("codec"), "data"))
    copy.append("solid_group_families", packed.select(F.col("new_group").alias("group_id"), F.lit(0).alias("ordinal"), F.col("family").alias("family_key")))
    return copy
