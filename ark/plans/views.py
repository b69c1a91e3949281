"""The catalog's 57 views, each a function of a ``Catalog``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.expressions import hex_or_zero, under_root
from ..operators.select import cascade

VIEWS: dict[str, Callable[[Catalog], DataFrame]] = {}


def view(f: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
    VIEWS[f"v_{f.__name__}"] = f
    return f


def prefixed(df: DataFrame, prefix: str, key: str, *columns: str) -> DataFrame:
    """``key`` keeps its name; the columns get the prefix."""
    return df.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in columns])


def flag(condition: Column) -> Column:
    return condition.cast("int")


def only(df: DataFrame, key: str, name: str = "hit") -> DataFrame:
    """The keys that occur, once, with a flag for an existence join."""
    return df.select(key).distinct().withColumn(name, F.lit(1))


def listed(column: str, separator: str = ",") -> Column:
    return F.array_join(F.sort_array(F.collect_list(F.col(column).cast("string"))), separator)


# Storage and identity --------------------------------------------------------------------------------------


@view
def storage(c: Catalog) -> DataFrame:
    size = lambda df, name, where="true", of="size": df.where(where).agg(F.coalesce(F.sum(of), F.lit(0)).cast("long").alias(name))
    count = lambda df, name: df.agg(F.count("*").alias(name))
    bytes_of = c.chunks.select(F.octet_length("data").alias("n")).union(c.compression_groups.select(F.octet_length("data")))
    parts = [
        size(c.objects, "logical_content_bytes", "storage_kind <> 'archive_manifest'"), size(c.objects, "historical_zip_bytes_not_stored", "storage_kind = 'archive_manifest'"),
        size(c.chunks, "unique_raw_chunk_bytes"), size(bytes_of, "stored_chunk_bytes", of="n"), count(c.nes_recipes, "header_body_recipes"), count(c.archive_plans, "zip_plans"),
        count(c.files, "file_occurrences"), count(c.objects, "catalog_objects")]
    return reduce(lambda a, b: a.join(b, F.lit(True)), parts)  # one row each


@view
def file_checksums(c: Catalog) -> DataFrame:
    sums = ("size", "crc32", "md5", "sha1", "sha256")
    plans = prefixed(c.archive_plans.withColumnRenamed("id", "plan_id"), "p_", "plan_id", *sums, "encoder", "zlib_version")
    rows = c.files.join(prefixed(c.objects.withColumnRenamed("id", "object_id"), "source_", "object_id", *sums, "storage_kind"), "object_id")
    rows = rows.join(c.file_archives.withColumnRenamed("file_id", "id"), "id", "left").join(plans, "plan_id", "left")
    archive = F.col("kind") == "archive"
    return rows.select(
        F.col("id").alias("file_id"), "kind", "original_name", F.col("source_storage_kind").alias("storage_kind"), *[f"source_{s}" for s in sums],
        *[F.when(archive, F.col(f"p_{s}")).otherwise(F.col(f"source_{s}")).alias(f"export_{s}") for s in sums], F.col("plan_id").alias("archive_plan_id"),
        F.col("p_encoder").alias("encoder"), F.col("p_zlib_version").alias("zlib_version"),
        F.when(archive, flag(F.col("p_sha256") == F.col("source_sha256"))).otherwise(1).alias("exported_bytes_equal_source"))


@view
def rom_checksums(c: Catalog) -> DataFrame:
    sums = ("size", "crc32", "md5", "sha1", "sha256")
    body = prefixed(c.objects.withColumnRenamed("id", "body_object_id"), "body_", "body_object_id", *sums)
    rows = c.roms.select(F.col("id").alias("rom_id"), "format", "header", "object_id", "body_object_id").join(c.objects.select(F.col("id").alias("object_id"), *sums), "object_id")
    return rows.join(body, "body_object_id", "left").select("rom_id", "format", "header", *sums, F.when(F.col("body_size").isNotNull(), F.col("body_object_id")).alias("body_object_id"), *[f"body_{s}" for s in sums])


@view
def inventory(c: Catalog) -> DataFrame:
    objects = c.objects.select(F.col("id").alias("object_id"), "size", "sha256", "sha1", "md5", "crc32")
    roms = c.roms.select("object_id", F.col("id").alias("rom_id"), "format", "parse_status")
    return c.files.select("object_id", F.col("id").alias("file_id"), "kind", "original_name", "source_path").join(objects, "object_id").join(roms, "object_id", "left")


@view
def exact_duplicates(c: Catalog) -> DataFrame:
    n = c.files.groupBy("object_id").agg(F.count("*").alias("occurrence_count")).where("occurrence_count > 1")
    return n.join(c.objects.select(F.col("id").alias("object_id"), "sha256", "size"), "object_id")


@view
def nes_body_duplicates(c: Catalog) -> DataFrame:
    nes = c.platforms.where("code = 'nes'").select(F.col("id").alias("platform_id"))
    rows = c.roms.where("body_object_id is not null").join(nes, "platform_id", "left_semi")
    return rows.groupBy("body_object_id").agg(F.count("*").alias("variant_count"), listed("id").alias("rom_ids")).where("variant_count > 1")


@view
def nes_prg_chr_candidates(c: Catalog) -> DataFrame:
    rows = c.roms.where("prg_chr_sha256 is not null")
    return rows.groupBy("prg_chr_sha256", "prg_chr_size").agg(F.count("*").alias("variant_count"), listed("id").alias("rom_ids")).where("variant_count > 1")


def matched_targets(c: Catalog) -> DataFrame:
    return only(c.validations.where("status = 'match'"), "dat_rom_id")


@view
def dat_coverage(c: Catalog) -> DataFrame:
    games = c.dat_games.select(F.col("id").alias("dat_game_id"), "dat_set_id", F.col("name").alias("game_name")).join(c.dat_sets.select(F.col("id").alias("dat_set_id")), "dat_set_id")
    rows = c.dat_roms.select(F.col("id").alias("dat_rom_id"), "dat_game_id", F.col("name").alias("rom_name"), F.col("status").alias("s")).join(games, "dat_game_id").join(matched_targets(c), "dat_rom_id", "left")
    status = cascade([(F.lower(F.coalesce("s", F.lit(""))) == "nodump", "nodump"), (F.col("hit").isNotNull(), "matched")], "unmatched")
    return rows.select("dat_set_id", "dat_rom_id", "game_name", "rom_name", status.alias("status"))


@view
def nes_hardware_candidates(c: Catalog) -> DataFrame:
    variants = c.roms.where("body_object_id is not null").select("body_object_id", F.col("id").alias("rom_id"))
    asked = c.roms.select("body_object_id", F.col("id").alias("queried_rom_id"))
    return asked.join(variants, "body_object_id").drop("body_object_id").join(c.nes_hardware, "rom_id")


@view
def solid_groups(c: Catalog) -> DataFrame:
    groups = c.compression_groups.where("codec = 'lzma2-solid'").select(F.col("id").alias("group_id"), F.col("size").alias("raw_bytes"), F.octet_length("data").cast("long").alias("stored_bytes"))
    blocks = c.chunks.groupBy("group_id").agg(F.count("*").alias("blocks"))
    families = c.solid_group_families.groupBy("group_id").agg(F.sort_array(F.collect_list(F.struct("ordinal", "family_key"))).alias("f"))
    out = groups.join(blocks, "group_id", "left").join(families, "group_id", "left")
    return out.select("group_id", "raw_bytes", "stored_bytes", F.round(F.col("stored_bytes") / F.col("raw_bytes"), 4).alias("ratio"), F.coalesce("blocks", F.lit(0)).alias("blocks"), F.array_join(F.transform("f", lambda x: x["family_key"]), " | ").alias("families"))


# Headers ---------------------------------------------------------------------------------------------------

#: View, hardware table, whether the format is shown, and the columns: ``name`` or ``name%digits`` for hex.
HEADER_VIEWS = (
    ("snes", "snes", False, "layout map_mode_name fast_rom coprocessor battery title region maker_code game_code version rom_size_declared ram_size_declared checksum_declared%4 checksum_computed%4 checksum_valid"),
    ("md", "md", False, "system_type copyright title_domestic title_overseas serial devices regions checksum_declared%4 checksum_computed%4 checksum_valid rom_end%6 sram_type sram_start%6 sram_end%6"),
    ("fds", "fds", True, "image_format fwnes_header sides valid_sides manufacturer_code game_code game_type revision disk_type manufacturing_date country_code trailing_bytes"),
    ("bsx", "bsx", True, "mapping maker_code title broadcast_month broadcast_day limited_starts map_mode version checksum_pair_valid"),
    ("ws", "ws", True, "publisher_id color game_id version rom_size_declared save_type save_size orientation bus_width rtc checksum_declared%4 checksum_computed%4 checksum_valid"),
    ("ngp", "ngp", True, "license licensed start_address%6 software_id%4 sub_code color title"),
    ("pokemini", "pokemini", False, "nintendo game_code region_code title two_player"),
    ("pce", "pce", True, "copier_header rom_size banks partial_bank_bytes reset_vector%4"),
    ("vb", "vb", False, "title maker_code game_code version"),
)


def headed(c: Catalog, table: str) -> DataFrame:
    """ROMs with their object and hardware row."""
    roms = c.roms.select(F.col("id").alias("rom_id"), "object_id", "format", "parse_status")
    return roms.join(c.objects.select(F.col("id").alias("object_id"), "sha1", F.col("size")), "object_id").join(c.table(f"{table}_hardware").drop("raw_json"), "rom_id")


def identity(with_format: bool) -> list[str]:
    return ["rom_id", "sha1", "size", *(["format"] if with_format else []), "parse_status"]


def shown(columns: str) -> list[Column]:
    return [hex_or_zero(F.col(name), int(digits)).alias(name) if digits else F.col(name) for name, _, digits in (x.partition("%") for x in columns.split())]


def _header_view(table: str, with_format: bool, columns: str) -> Callable[[Catalog], DataFrame]:
    return lambda c: headed(c, table).select(*identity(with_format), *shown(columns))


for _name, _table, _format, _columns in HEADER_VIEWS:
    VIEWS[f"v_{_name}_headers"] = _header_view(_table, _format, _columns)


def with_common_logo(c: Catalog, table: str) -> DataFrame:
    """Adds logo_is_common: the most frequent logo's, the smallest of equals."""
    hardware = c.table(f"{table}_hardware")
    common = hardware.groupBy("logo_sha1").agg(F.count("*").alias("n")).agg(F.min_by("logo_sha1", F.struct(-F.col("n"), F.col("logo_sha1"))).alias("common"))
    return headed(c, table).join(F.broadcast(common), F.lit(True)).withColumn("logo_is_common", flag(F.col("logo_sha1") == F.col("common")))  # one row


@view
def gb_headers(c: Catalog) -> DataFrame:
    rows = with_common_logo(c, "gb")
    return rows.select(
        *identity(True), "title", "manufacturer_code", "cgb_mode", flag(F.col("sgb_flag") == 3).alias("sgb_enhanced"),
        *shown("cartridge_type_name battery rtc rumble rom_size_declared ram_size_declared destination version"),
        F.coalesce("licensee_new", hex_or_zero(F.col("licensee_old"), 2)).alias("licensee"), "header_checksum_valid", "global_checksum_valid", "logo_is_common")


@view
def gba_headers(c: Catalog) -> DataFrame:
    rows = with_common_logo(c, "gba")
    return rows.select(*identity(False), *shown("title game_code maker_code version complement_valid save_types padding_byte padding_bytes"), (F.col("size") - F.col("padding_bytes")).alias("content_bytes"), "logo_is_common")


@view
def sms_headers(c: Catalog) -> DataFrame:
    status = F.when(F.col("checksum_valid") == 1, "valid").when(F.col("checksum_valid").isNull(), None).when(F.col("checksum_declared") == 0, "not_declared").otherwise("mismatch")
    rows = headed(c, "sms").withColumn("checksum_status", status)
    return rows.select(*identity(False), *shown("header_offset%4 region size_declared product_code version checksum_declared%4 checksum_computed%4 checksum_valid checksum_status codemasters sdsc sdsc_title"))


@view
def msx_headers(c: Catalog) -> DataFrame:
    evidence = c.rom_annotations.where("kind = 'platform'").select("rom_id", F.col("value").alias("platform_evidence"))
    return headed(c, "msx").join(evidence, "rom_id", "left").select(*identity(True), *shown("media header_offset%4 init%4 statement%4 device%4 text%4 platform_evidence"))


# Frontends -------------------------------------------------------------------------------------------------


def frontend_releases(c: Catalog) -> DataFrame:
    systems = c.frontend_platforms.where("frontend_code = 'batocera'").select(F.col("platform_code"), "system_code", F.col("provider_code").alias("default_provider"), "provider_system_id")
    platforms = c.platforms.select(F.col("id").alias("platform_id"), F.col("code").alias("platform_code")).join(systems, "platform_code")
    games = c.games.select(F.col("id").alias("game_id"), "platform_id").join(platforms, "platform_id").drop("platform_id")
    return c.releases.select(F.col("id").alias("release_id"), "game_id", "title").join(games, "game_id")


@view
def screenscraper_games(c: Catalog) -> DataFrame:
    links = c.scraper_game_links.where("provider_code = 'screenscraper'").select("release_id", "provider_game_id", F.col("status").alias("s"), "raw_file_id", "source_url", "checked_at")
    rows = frontend_releases(c).where("default_provider = 'screenscraper'").join(links, "release_id", "left")
    return rows.select("release_id", "game_id", "title", "platform_code", "system_code", "provider_system_id", "provider_game_id", F.coalesce("s", F.lit("pending")).alias("status"), "raw_file_id", "source_url", "checked_at")


def frontend_cells(c: Catalog, where: str) -> DataFrame:
    """Each release by each field of the frontend; the fields are a short fixed list."""
    fields = c.frontend_fields.where("frontend_code = 'batocera'").where(where).select("field_key", "category", "value_type", "xml_location", "provider_field", F.col("provider_media_type").alias("default_media_type"), "default_extension")
    return frontend_releases(c).join(F.broadcast(fields), F.lit(True))


@view
def batocera_game_fields(c: Catalog) -> DataFrame:
    values = c.frontend_game_values.where("frontend_code = 'batocera'").drop("frontend_code")
    rows = frontend_cells(c, "category <> 'media'").join(values, ["release_id", "field_key"], "left")
    by_title = F.col("field_key") == "name"
    return rows.select(
        "release_id", "game_id", F.col("title").alias("catalog_title"), "system_code", "field_key", "category", "value_type", "xml_location",
        F.coalesce("language", F.lit("")).alias("language"), F.coalesce("region", F.lit("")).alias("region"), F.coalesce("value_text", F.when(by_title, F.col("title"))).alias("value_text"),
        cascade([(F.col("value_text").isNotNull(), "populated"), (by_title, "catalog_fallback")], "pending").alias("status"), "provider_field", "provider_code", "source_file_id", "updated_at")


@view
def batocera_media_slots(c: Catalog) -> DataFrame:
    slots = c.frontend_media_slots.where("frontend_code = 'batocera'").drop("frontend_code", "updated_at", "details_json").withColumnsRenamed({"status": "s", "provider_code": "p", "provider_media_type": "m"})
    media = c.media.select(F.col("id").alias("media_id"), "file_id", "width", "height", "duration_ms", "codec")
    files = c.files.select(F.col("id").alias("file_id"), "object_id")
    objects = c.objects.select(F.col("id").alias("object_id"), "size", "crc32", "md5", "sha1", "sha256").join(only(c.object_chunks, "object_id", "stored"), "object_id", "left")
    rows = frontend_cells(c, "category = 'media'").join(slots, ["release_id", "field_key"], "left").join(media, "media_id", "left").join(files, "file_id", "left").join(objects, "object_id", "left")
    stored = F.col("stored").isNotNull() & F.lit(c.payload_available)
    return rows.select(
        "release_id", "game_id", F.col("title").alias("catalog_title"), "system_code", "field_key", F.coalesce("language", F.lit("")).alias("language"), F.coalesce("region", F.lit("")).alias("region"),
        F.coalesce("s", F.lit("pending")).alias("status"), F.coalesce("p", "default_provider").alias("provider_code"), F.coalesce("m", "default_media_type").alias("provider_media_type"), "default_extension",
        "media_id", "source_url", "export_path", "file_id", "width", "height", "duration_ms", "codec", "size", "crc32", "md5", "sha1", "sha256", flag(stored).alias("payload_available"))


# External snapshots ----------------------------------------------------------------------------------------


def named_archives(c: Catalog) -> DataFrame:
    return c.ni_archives.select("snapshot_id", "archive_id", "title")


@view
def nointro_files(c: Catalog) -> DataFrame:
    declared = c.ni_headers.where("kind = 'declared'").select("snapshot_id", "file_id", F.hex("header").alias("h"))
    stored = F.col("object_id").isNotNull() & F.lit(c.payload_available)
    return c.ni_files.join(declared, ["snapshot_id", "file_id"], "left").select(*c.ni_files.columns, flag(stored).alias("payload_available"), F.coalesce("h", F.lit("")).alias("declared_header_hex"))


@view
def nointro_hardware(c: Catalog) -> DataFrame:
    serials = (("pcb", "pcb_serial"), ("romchip1", "romchip_serial1"), ("romchip2", "romchip_serial2"), ("lockout", "lockout_serial"), ("savechip", "savechip_serial"))
    rows = c.ni_sources.where("serials_json <> '{}'").join(named_archives(c), ["snapshot_id", "archive_id"])
    return rows.select("snapshot_id", "archive_id", "title", "kind", "external_id", "source_id", "hardware_assertion_id", *[F.get_json_object("serials_json", f"$.{key}").alias(name) for name, key in serials], "serials_json", "details_json")


@view
def nointro_status(c: Catalog) -> DataFrame:
    return c.ni_dumplog.join(named_archives(c), ["snapshot_id", "archive_id"]).select("snapshot_id", "archive_id", "title", "status_raw", "status", "trusted_count")


@view
def nointro_headers(c: Catalog) -> DataFrame:
    files = c.ni_files.select("snapshot_id", "file_id", "format", "sha256", "object_id")
    return c.ni_headers.join(files, ["snapshot_id", "file_id"]).select("snapshot_id", "file_id", "kind", F.hex("header").alias("header_hex"), "interpretation_json", "format", "sha256", "object_id")


@view
def nointro_archives(c: Catalog) -> DataFrame:
    keys = ("name", "name_alt", "clone", "region", "languages", "categories", "regparent")
    return c.ni_archives.select("snapshot_id", "archive_id", "title", *[F.get_json_object("attrs_json", f"$.{k}").alias(k) for k in keys], "attrs_json")


@view
def ra_latest(c: Catalog) -> DataFrame:
    return c.ra_snapshots.agg(F.max("id").alias("snapshot_id"))


def latest_hashes(c: Catalog) -> DataFrame:
    """The latest snapshot's hashes with their games."""
    last = F.broadcast(ra_latest(c))  # one row
    games = c.ra_games.join(last, "snapshot_id", "left_semi").select("ra_game_id", F.col("title").alias("ra_title"), F.col("category").alias("ra_category"), "num_achievements", "points")
    return c.ra_hashes.join(last, "snapshot_id", "left_semi").select("md5", "ra_game_id").join(games, "ra_game_id")


def has_achievements() -> Column:
    return flag(F.col("num_achievements") > 0).alias("has_achievements")


@view
def rom_ra_matches(c: Catalog) -> DataFrame:
    rows = c.rom_ra_hashes.select("rom_id", F.col("ra_md5").alias("md5")).join(latest_hashes(c), "md5")
    released = c.rom_releases.select("rom_id", "release_id").join(c.releases.select(F.col("id").alias("release_id"), F.col("title").alias("release_title")), "release_id", "left")
    return rows.join(released, "rom_id", "left").select("rom_id", F.col("md5").alias("ra_md5"), "ra_game_id", "ra_title", "ra_category", "num_achievements", "points", has_achievements(), "release_id", "release_title")


@view
def dat_ra_matches(c: Catalog) -> DataFrame:
    games = c.dat_games.select(F.col("id").alias("dat_game_id"), "dat_set_id", F.col("name").alias("game_name"), "cloneof").join(c.dat_sets.select(F.col("id").alias("dat_set_id"), F.col("version").alias("dat_version")), "dat_set_id")
    rows = c.dat_roms.where("size % 8192 <> 512").select(F.col("id").alias("dat_rom_id"), "dat_game_id", "md5").join(latest_hashes(c), "md5").join(games, "dat_game_id").join(matched_targets(c), "dat_rom_id", "left")
    return rows.select("dat_set_id", "dat_version", "dat_game_id", "game_name", "cloneof", "dat_rom_id", "md5", "ra_game_id", "ra_title", "ra_category", "num_achievements", has_achievements(), flag(F.col("hit").isNotNull()).alias("local_rom_available"))


@view
def ra_unmatched_hashes(c: Catalog) -> DataFrame:
    known = c.rom_ra_hashes.select(F.col("ra_md5").alias("md5")).union(c.dat_roms.select("md5"))
    return latest_hashes(c).join(known, "md5", "left_anti").select("md5", "ra_game_id", F.col("ra_title").alias("title"), F.col("ra_category").alias("category"), "num_achievements")


@view
def nointro_ra_matches(c: Catalog) -> DataFrame:
    archives = c.ni_sources.select("snapshot_id", "kind", "external_id", "archive_id").join(named_archives(c), ["snapshot_id", "archive_id"])
    held = c.ni_source_files.select("snapshot_id", "kind", "external_id", "file_id").join(archives, ["snapshot_id", "kind", "external_id"]).select("snapshot_id", "file_id", "archive_id", F.col("title").alias("nointro_title")).distinct()
    rows = c.ni_files.select("snapshot_id", "file_id", "bad", "object_id", "md5").join(latest_hashes(c), "md5").join(held, ["snapshot_id", "file_id"]).join(only(c.dat_roms, "md5"), "md5", "left")
    return rows.select(F.col("snapshot_id").alias("nointro_snapshot_id"), "file_id", "bad", "object_id", "archive_id", "nointro_title", "ra_game_id", "ra_title", "ra_category", "num_achievements", has_achievements(), flag(F.col("hit").isNotNull()).alias("in_dat")).dropDuplicates(["nointro_snapshot_id", "file_id", "ra_game_id", "archive_id"])


# Names -----------------------------------------------------------------------------------------------------


@view
def release_game_names(c: Catalog) -> DataFrame:
    links = c.release_name_links.where("status = 'matched'").select("entry_id", "release_id", "match_method")
    entries = c.game_name_entries.select(F.col("id").alias("entry_id"), "import_id", "row_number", "name_en_original", "name_en", "name_cn_id")
    imports = c.game_name_imports.select(F.col("id").alias("import_id"), "source_name", "source_sha256")
    releases = c.releases.select(F.col("id").alias("release_id"), "game_id", F.col("title").alias("catalog_title"))
    rows = links.join(entries, "entry_id").join(imports, "import_id").join(releases, "release_id").join(c.game_chinese_names.withColumnRenamed("id", "name_cn_id"), "name_cn_id", "left")
    return rows.select("release_id", "game_id", "catalog_title", "entry_id", "name_en_original", "name_en", "name_cn_id", "name_cn", "match_method", "import_id", "row_number", "source_name", "source_sha256")


@view
def game_names(c: Catalog) -> DataFrame:
    return release_game_names(c).select("game_id", "name_en", "name_cn").distinct()


@view
def release_chinese_names(c: Catalog) -> DataFrame:
    return release_game_names(c).where("name_cn_id is not null").select("release_id", "game_id", "name_cn_id", "name_cn").distinct()


@view
def rom_game_names(c: Catalog) -> DataFrame:
    names = release_game_names(c)
    return c.rom_releases.select("rom_id", "release_id").join(names, "release_id").select("rom_id", *names.columns)


@view
def game_name_alternatives(c: Catalog) -> DataFrame:
    rows = c.game_name_entries.where("name_cn_id is not null").select("import_id", "match_key", "name_cn_id").distinct()
    return rows.groupBy("import_id", "match_key").agg(F.count("*").alias("chinese_name_count")).where("chinese_name_count > 1")


@view
def game_name_import_status(c: Catalog) -> DataFrame:
    links = c.release_name_links.groupBy(F.col("entry_id").alias("id")).agg(F.count("*").alias("n"), F.count_if(F.col("status") == "matched").alias("matched"))
    rows = c.game_name_entries.join(c.game_chinese_names.withColumnRenamed("id", "name_cn_id"), "name_cn_id", "left").join(links, "id", "left")
    return rows.select(*c.game_name_entries.columns, "name_cn", cascade([(F.col("matched") > 0, "matched"), (F.col("n") > 0, "ambiguous")], "unmatched").alias("status"), F.coalesce("matched", F.lit(0)).alias("release_count"))


@view
def game_chinese_name_aliases(c: Catalog) -> DataFrame:
    return release_chinese_names(c).select("game_id", "name_cn_id", "name_cn").distinct()


@view
def game_chinese_name_status(c: Catalog) -> DataFrame:
    n = game_chinese_name_aliases(c).groupBy("game_id").agg(F.count("*").alias("n"), F.min("name_cn_id").alias("i"), F.min("name_cn").alias("t"))
    rows = c.games.select(F.col("id").alias("game_id"), "platform_id").join(n, "game_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    one = F.col("n") == 1
    return rows.select("game_id", "platform_id", F.col("n").alias("chinese_name_count"), cascade([(F.col("n") == 0, "missing"), (one, "unique_translation")], "needs_review").alias("status"), F.when(one, F.col("i")).alias("standard_name_cn_id"), F.when(one, F.col("t")).alias("standard_name_cn"))


@view
def release_effective_chinese_names(c: Catalog) -> DataFrame:
    """A release's own names; without any, its game's only name."""
    own = release_chinese_names(c)
    releases = c.releases.select(F.col("id").alias("release_id"), "game_id", F.col("title").alias("catalog_title"))
    direct = own.join(releases.select("release_id", "catalog_title"), "release_id").withColumn("name_basis", F.lit("direct"))
    only_name = game_chinese_name_status(c).where("status = 'unique_translation'").select("game_id", F.col("standard_name_cn_id").alias("name_cn_id"), F.col("standard_name_cn").alias("name_cn"))
    inherited = releases.join(own, "release_id", "left_anti").join(only_name, "game_id").withColumn("name_basis", F.lit("group_inherited"))
    columns = ("release_id", "game_id", "catalog_title", "name_cn_id", "name_cn", "name_basis")
    return direct.select(*columns).union(inherited.select(*columns))


@view
def rom_effective_chinese_names(c: Catalog) -> DataFrame:
    names = release_effective_chinese_names(c)
    return c.rom_releases.select("rom_id", "release_id").join(names, "release_id").select("rom_id", *names.columns)


@view
def game_chinese_name_evidence(c: Catalog) -> DataFrame:
    rows = release_game_names(c).where("name_cn_id is not null")
    return rows.select("game_id", "name_cn_id", "name_cn", F.col("release_id").alias("source_release_id"), F.col("catalog_title").alias("source_title"), "entry_id", "import_id", "row_number", "source_name", "source_sha256")


@view
def game_chinese_name_review(c: Catalog) -> DataFrame:
    return game_chinese_name_aliases(c).join(game_chinese_name_status(c).where("status = 'needs_review'"), "game_id", "left_semi")


@view
def game_name_match_review(c: Catalog) -> DataFrame:
    entries = c.game_name_entries.select(F.col("id").alias("entry_id"), "import_id", "row_number", "name_en_original", "name_cn_id").join(c.game_chinese_names.withColumnRenamed("id", "name_cn_id"), "name_cn_id", "left")
    open_cases = c.game_name_match_decisions.where("status <> 'matched'").select("entry_id", "status", "reason", "parsed_name_json", "candidate_game_ids_json")
    return open_cases.join(entries, "entry_id").select("entry_id", "import_id", "row_number", "name_en_original", "name_cn", "status", "reason", "parsed_name_json", "candidate_game_ids_json")


# Collections and sources -----------------------------------------------------------------------------------


@view
def collection_files(c: Catalog) -> DataFrame:
    """Files below each collection's root; a file in nested roots stands under each. A path meets roots by its folders, not one by one."""
    roots = c.source_collections.select(F.col("id").alias("collection_id"), F.col("kind").alias("collection_kind"), F.col("name").alias("collection"), "root_path", F.lower("root_path").alias("key"))
    parts = F.split(F.lower("source_path"), "/")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    files = c.files.select(F.col("id").alias("file_id"), F.col("kind").alias("file_kind"), "parent_file_id", "original_name", "source_path", "object_id", F.explode(F.array_distinct(above)).alias("key"))
    rows = files.join(roots, "key").where(under_root(F.col("source_path"), F.col("root_path")))
    return rows.select("collection_id", F.col("collection_kind").alias("kind"), "collection", "file_id", "file_kind", "parent_file_id", "original_name", "source_path", "object_id")


@view
def ra_collection(c: Catalog) -> DataFrame:
    files = collection_files(c).where("kind = 'retroachievements' and file_kind = 'rom'")
    zips = c.files.select(F.col("id").alias("parent_file_id"), F.col("original_name").alias("zip_name"))
    hashed = c.rom_ra_hashes.select("rom_id", "ra_md5")
    game_of = latest_hashes(c).groupBy(F.col("md5").alias("ra_md5")).agg(F.min(F.struct("ra_game_id", "ra_title", "ra_category", "num_achievements")).alias("g")).select("ra_md5", "g.*")
    names = c.dat_roms.select(F.col("id").alias("dat_rom_id"), "dat_game_id").join(c.dat_games.select(F.col("id").alias("dat_game_id"), "name"), "dat_game_id")
    validated = c.validations.where("status = 'match'").select("rom_id", "dat_rom_id").join(names, "dat_rom_id", "left").groupBy("rom_id").agg(F.array_join(F.sort_array(F.collect_set("name")), ",").alias("nointro_dat_games"))
    released = c.rom_releases.groupBy("rom_id").agg(F.min("release_id").alias("release_id"))
    rows = files.join(zips, "parent_file_id", "left").join(c.roms.select("object_id", F.col("id").alias("rom_id")), "object_id").join(hashed, "rom_id", "left").join(game_of, "ra_md5", "left").join(validated, "rom_id", "left").join(released, "rom_id", "left")
    status = cascade([(F.col("ra_game_id").isNull(), "ra_hash_unknown"), (F.col("nointro_dat_games").isNotNull(), "in_nointro_dat")], "ra_only")
    return rows.select("collection", "file_id", "original_name", "zip_name", "rom_id", "ra_md5", "ra_game_id", "ra_title", "ra_category", "num_achievements", "nointro_dat_games", "release_id", status.alias("status"))


@view
def information_sources(c: Catalog) -> DataFrame:
    none = F.lit(None).cast("string")

    def branch(df: DataFrame, layer: str, source: Column | str, version: Column, at: Column, entries: Column, detail: Column | str) -> DataFrame:
        text = lambda x: F.lit(x) if isinstance(x, str) else x
        return df.select(F.lit(layer).alias("layer"), text(source).alias("source"), version.alias("version"), at.alias("imported_at"), F.coalesce(entries, F.lit(0)).cast("long").alias("entries"), text(detail).alias("detail"))

    def whole(df: DataFrame, pick: Callable[[str], Column], at: str, layer: str, source: str, detail: str) -> DataFrame:
        return branch(df.agg(pick(at).alias("at"), F.count("*").alias("n")), layer, source, none, F.col("at"), F.col("n"), detail)

    per = lambda df, key: df.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n"))
    tops = collection_files(c).where("parent_file_id is null")
    provider = F.when(F.col("provider_code") == "launchbox", "LaunchBox Games Database").otherwise("ScreenScraper")
    counted = lambda df, child, key: df.join(per(child, key), "id", "left")
    branches = [
        branch(counted(c.dat_sets, c.dat_games, "dat_set_id"), "existing", "No-Intro DAT", F.col("version"), F.col("imported_at"), F.col("n"), F.col("name")),
        whole(c.files, F.min, "imported_at", "existing", "ROM files", "local files (all kinds)"),
        branch(counted(c.source_collections, tops, "collection_id"), "existing", F.concat(F.lit("Source collection: "), "kind"), none, F.col("registered_at"), F.col("n"), F.col("name")),
        branch(counted(c.ni_snapshots, c.ni_archives, "snapshot_id"), "extended", "No-Intro DB Export + Dump Log", F.col("version"), F.col("imported_at"), F.col("n"), F.concat(F.lit("snapshot "), F.col("id").cast("string"))),
        branch(c.ra_snapshots, "extended", "RetroAchievements", F.col("fetched_at"), F.col("fetched_at"), F.col("games"), F.format_string("console %d, %d hashes", "console_id", "hashes")),
        branch(counted(c.game_name_imports, c.game_name_entries, "import_id"), "extended", "English/Chinese names", F.col("source_sha256"), F.col("imported_at"), F.col("n"), F.col("source_name")),
        whole(c.hardware_assertions, F.min, "created_at", "extended", "Documented hardware assertions", "from No-Intro serial fields"),
        branch(counted(c.provider_snapshots, c.provider_snapshot_records, "snapshot_id"), "scraped", provider, F.col("source_sha256"), F.col("started_at"), F.col("n"), F.concat_ws(" ", "scope", "source")),
        whole(c.frontend_game_values, F.max, "updated_at", "future", "Frontend values (Batocera/ScreenScraper)", "local overrides; scraped values are in provider_record_values"),
        whole(c.frontend_media_slots, F.max, "updated_at", "future", "Frontend media slots", "placeholders until media is stored"),
        whole(c.scrape_records, F.max, "fetched_at", "future", "Scrape records", "provider responses"),
    ]
    return reduce(DataFrame.unionByName, branches)


# Providers -------------------------------------------------------------------------------------------------


@view
def provider_latest_records(c: Catalog) -> DataFrame:
    last = c.provider_records.groupBy("provider_code", "provider_key").agg(F.max("id").alias("id"))
    return c.provider_records.join(last.select("id"), "id", "left_semi")


@view
def provider_record_values(c: Catalog) -> DataFrame:
    records = c.provider_records.select(F.col("id").alias("record_id"), "provider_code", "provider_key")
    rows = c.provider_record_values.join(records, "record_id").join(c.scrape_texts.select(F.col("id").alias("text_id"), F.col("text").alias("value")), "text_id")
    return rows.select("provider_code", "provider_key", "record_id", "field", "language", "region", "ordinal", "value")


@view
def scraped_media(c: Catalog) -> DataFrame:
    records = c.provider_records.select(F.col("id").alias("record_id"), "provider_code", "provider_key")
    site = F.when(F.col("provider_code") == "launchbox", "https://images.launchbox-app.com/").otherwise("https://neoclone.screenscraper.fr/api2/mediaJeu.php?")
    return c.provider_record_media.join(records, "record_id").select("provider_code", "provider_key", "record_id", "ordinal", "media_type", "region", "format", "size", "crc32", "md5", "sha1", F.concat(site, "locator").alias("url_without_credentials"))


@view
def subject_scraped_values(c: Catalog) -> DataFrame:
    key = F.when(F.col("accepted") == "screenscraper", F.col("ss_game_id")).otherwise(F.col("lb_database_id")).cast("string")
    accepted = c.scrape_checks.select("subject_kind", "subject_id", "title", "severity", "verdict", F.col("accepted").alias("provider_code"), key.alias("provider_key"))
    latest = provider_latest_records(c).select("provider_code", "provider_key", F.col("id").alias("record_id"))
    values = provider_record_values(c).drop("provider_code", "provider_key")
    return accepted.join(latest, ["provider_code", "provider_key"]).join(values, "record_id").select("subject_kind", "subject_id", "title", "severity", "verdict", "provider_code", "provider_key", "field", "language", "region", "ordinal", "value")


@view
def scrape_check_summary(c: Catalog) -> DataFrame:
    return c.scrape_checks.groupBy("subject_kind", "severity", "verdict").agg(F.count("*").alias("subjects"))
