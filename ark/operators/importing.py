"""From files to a catalog: contents stored once, occurrences, headers, components and hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.expressions import base_title, body_hash
from ..headers import read_headers
from ..platforms import PLATFORMS, belongs, cuts, header_size
from ..schemas import SCHEMAS
from ..shared import stored
from .records import record_id
from .storage import id_of, store

#: Which hardware table a reading of this format goes to, where it is not the platform's.
ELSEWHERE = {"snes_cartridge": "snes"}


def import_files(catalog: Catalog, files: DataFrame, platform: str, imported_at: str) -> dict[str, int]:
    """Add members (path, name, content, as ``sources.files.members`` gives them) of one platform to the catalog.

    Contents, ROMs and occurrences that are known add nothing. Families are titles until a list says more. Files of
    other platforms in a shared folder are left out and counted.
    """
    p = PLATFORMS[platform]
    every = files.where("content is not null")
    mine = every.where(belongs(platform, F.col("name")))
    if platform not in [r.code for r in catalog.platforms.select("code").collect()]:  # one row for each platform
        catalog.append("platforms", catalog.spark.createDataFrame([(list(PLATFORMS).index(platform) + 1, platform, p.name)], "id long, code string, name string"))
    rows = mine.withColumn("sha256", F.sha2("content", 256)).withColumn("object_id", id_of(F.col("sha256")))
    family = F.concat(F.lit("~"), F.lower(base_title(F.regexp_replace("name", r"\.[^.]*$", ""))))
    counts = store(catalog, rows.select(family.alias("family"), "content", cuts(platform, F.col("content")).alias("cuts")), p.block, p.cap)
    occurrence = rows.select(record_id(F.col("object_id"), F.col("path"), F.col("name")).alias("id"), "object_id", F.lit("rom").alias("kind"), F.col("name").alias("original_name"), F.col("path").alias("source_path"), F.lit(imported_at).alias("imported_at")).dropDuplicates(["id"])
    catalog.append("files", occurrence.join(catalog.files.select("id"), "id", "left_anti"))
    one = rows.dropDuplicates(["object_id"]).withColumn("id", record_id(F.col("object_id"), F.lit(platform)))
    fresh = one.join(catalog.roms.select("id"), "id", "left_anti").withColumn("platform", F.lit(platform)).select("id", "object_id", "platform", "content")
    fresh = stored(fresh, "fresh")
    read = read_headers(fresh, "id")
    read = stored(read, "read")
    head = header_size(platform, F.col("content"))
    body = F.sha2(F.expr("substr(content, head + 1)"), 256)
    bodies = fresh.withColumn("head", head).select("id", "object_id", F.when(F.col("head") > 0, F.substr("content", F.lit(1), F.col("head"))).alias("header"), F.when(F.col("head") > 0, id_of(body)).alias("body_object_id"), body_hash(F.lit(platform), F.col("content")).alias("ra_md5"))
    catalog.append("roms", read.join(bodies, "id").select("id", "object_id", F.lit(list(PLATFORMS).index(platform) + 1).alias("platform_id"), "format", "parse_status", "header", "body_object_id", F.to_json("warnings").alias("warnings_json")))
    parts = read.select("id", F.posexplode("components").alias("ordinal", "c")).select("id", "ordinal", "c.*").join(fresh.select("id", "content"), "id")
    digest = F.sha2(F.substr("content", (F.col("offset") + 1).cast("int"), F.col("size").cast("int")), 256)
    catalog.append("rom_components", parts.select(F.col("id").alias("rom_id"), "ordinal", "kind", "offset", "size", digest.alias("sha256")))
    catalog.append("rom_ra_hashes", bodies.select(F.col("id").alias("rom_id"), "ra_md5", F.lit("body_md5").alias("method")))
    for table in {p.hardware, *ELSEWHERE.values()} - {None}:
        mine_too = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in ELSEWHERE.items() for x in kv]), F.col("format")), F.lit(p.hardware)) == table
        fields = read.where(F.col("hardware").isNotNull() & mine_too).select(F.col("id").alias("rom_id"), F.from_json("hardware", SCHEMAS[f"{table}_hardware"]).alias("h"), F.col("hardware").alias("raw"))
        if not fields.isEmpty():
            known = [f.name for f in SCHEMAS[f"{table}_hardware"] if f.name not in ("rom_id", "raw_json")]
            catalog.append(f"{table}_hardware", fields.select("rom_id", *[F.col(f"h.{n}").alias(n) for n in known], F.col("raw").alias("raw_json")))
    return counts | {"roms": read.count(), "left_out": every.count() - mine.count()}
