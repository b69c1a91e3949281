"""Writing a chosen set of games, and importing an external snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..sources.files import archive_bytes, export_files
from .match import agreeing
from .storage import fetch, positions

#: Fields by which an external file and an object agree.
FIELDS = ["size", "crc32", "md5", "sha1", "sha256"]


def folder_of(name, layout: str):
    """``flat``, or ``letter``: a folder for each first letter, ``#`` for the rest."""
    if layout == "flat":
        return F.lit("")
    first = F.upper(F.substring(F.regexp_replace(name, "^~", ""), 1, 1))
    return F.concat(F.when(first.rlike("[A-Z]"), first).otherwise("#"), F.lit("/"))


def set_members(catalog: Catalog, members: DataFrame) -> DataFrame:
    """The members (game, name, object_id) with their contents; each group is decoded once for all of them."""
    placed = members.join(positions(catalog), "object_id", "left")
    return placed.join(fetch(catalog, members.select("object_id")), "object_id").select("game", "name", "object_id", "content", "group_id", "offset")


def export_set(catalog: Catalog, members: DataFrame, folder: str, archives: bool = False, layout: str = "flat") -> DataFrame:
    """Write a set below a shared folder: plain files, or one canonical ZIP for each game. Returns the manifest (name, size, sha256, status)."""
    rows = set_members(catalog, members)
    if archives:
        ids = rows.select("game").distinct().withColumn("plan_id", F.xxhash64("game"))
        built = archive_bytes(rows.join(ids, "game").select("plan_id", "name", "content")).join(ids, "plan_id")
        files = built.select(F.concat(folder_of(F.col("game"), layout), F.col("game"), F.lit(".zip")).alias("name"), F.col("data").alias("content"), "sha256")
    else:
        files = rows.select(F.concat(folder_of(F.col("name"), layout), F.col("name")).alias("name"), "content", F.sha2("content", 256).alias("sha256")).dropDuplicates(["name"])
    written = export_files(files, folder)
    sizes = files.select("name", F.octet_length("content").cast("long").alias("size"), "sha256")
    return sizes.join(written, "name").select("name", "size", "sha256", "status")


def snapshot_links(catalog: Catalog, files: DataFrame) -> dict[str, DataFrame]:
    """What an external snapshot's files (id, size, digests) are here.

    objects: (file_id, object_id) of equal SHA-1 and size; list entries: (file_id, dat_rom_id) of equal size and MD5. In
    both no other field may be at odds. anomalies: files without a strong digest.
    """
    pick = lambda df: df.select("id", *FIELDS)
    return {
        "objects": agreeing(pick(files), pick(catalog.objects), [["sha1", "size"]], FIELDS).toDF("file_id", "object_id"),
        "entries": agreeing(pick(files), pick(catalog.dat_roms), [["size", "md5"]], FIELDS).toDF("file_id", "dat_rom_id"),
        "anomalies": files.where("sha256 is null").select(F.col("id").alias("file_id"), F.lit("missing_sha256").alias("category")),
    }
