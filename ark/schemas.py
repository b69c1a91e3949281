"""The catalog's data model: 91 tables. Columns are long integers unless marked ``:s`` (string) or ``:b`` (binary)."""

from __future__ import annotations

from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

# Fixed names: the tables and columns that queries are written against.
MODEL = """
meta key:s value:s
resources name:s kind:s content:s sha256:s
sources id title:s url:s version:s retrieved_at:s notes:s
platforms id code:s name:s metadata_json:s
objects id sha256:s sha1:s md5:s crc32:s size created_at:s storage_kind:s
files id object_id kind:s original_name:s source_path:s source_id parent_file_id member_index member_path:s mime_type:s imported_at:s metadata_json:s
events id action:s entity:s entity_id details_json:s created_at:s
games id platform_id title:s sort_title:s metadata_json:s
releases id game_id title:s region:s revision:s serial:s release_date:s languages_json:s metadata_json:s
roms id object_id platform_id format:s parse_status:s header:b body_object_id prg_chr_sha256:s prg_chr_size parser_version:s warnings_json:s
rom_releases rom_id release_id source_id notes:s
rom_components rom_id ordinal kind:s offset size sha256:s
hardware_assertions id rom_id release_id source_file_id source_id board:s pcb:s chip:s mapper submapper cic:s mirroring:s metadata_json:s confidence:s created_at:s
release_dat_games release_id dat_game_id
dat_sets id source_file_id platform_id name:s version:s author:s description:s mode:s hash_scope:s header_json:s imported_at:s
dat_games id dat_set_id ordinal name:s description:s cloneof:s romof:s attrs_json:s raw_xml:s
dat_roms id dat_game_id ordinal name:s size crc32:s md5:s sha1:s sha256:s status:s merge_name:s attrs_json:s
validations id rom_id dat_rom_id scope:s checked_object_id status:s strength:s details_json:s checked_at:s
dat_changes id old_dat_rom_id new_dat_rom_id classification:s evidence_json:s
naming_decisions id file_id dat_rom_id canonical_name:s reason:s created_at:s
transformations id source_rom_id result_rom_id kind:s target_dat_rom_id evidence_file_id recipe_json:s verified created_at:s
repair_attempts id target_dat_rom_id source_rom_id status:s details_json:s created_at:s
compression_groups id sha256:b encoded_sha256:b size codec:s data:b
chunks id sha256:b size codec:s base_id depth data:b group_id group_offset
object_chunks object_id ordinal offset chunk_id repeat
nes_recipes object_id body_object_id header:b
archive_profiles id name:s spec_url:s settings_json:s limitations:s
archive_plans id fingerprint:s profile_id encoder:s zlib_version:s size crc32:s md5:s sha1:s sha256:s verified_at:s
archive_entries plan_id ordinal name:s object_id is_directory
file_archives file_id plan_id
packages id file_id dat_game_id profile_id engine:s validation_json:s created_at:s
package_members package_id ordinal dat_rom_id rom_id object_id name:s
solid_group_families group_id ordinal family_key:s
object_families object_id family_key:s basis:s
nes_hardware rom_id mapper submapper prg_rom_size chr_rom_size prg_ram_size prg_nvram_size chr_ram_size chr_nvram_size trainer_size nametable_bit alternative_nametable_bit battery console_type timing vs_ppu vs_hardware extended_console misc_rom_count expansion_device raw_json:s
snes_hardware rom_id header_offset layout:s map_mode map_mode_name:s fast_rom chipset coprocessor:s battery title:s title_hex:s rom_size_declared ram_size_declared region_code region:s developer_id maker_code:s game_code:s expansion_ram_size version checksum_declared checksum_complement checksum_computed checksum_valid raw_json:s
md_hardware rom_id system_type:s copyright:s title_domestic:s title_overseas:s serial:s checksum_declared checksum_computed checksum_valid devices:s rom_start rom_end ram_start ram_end sram_type sram_start sram_end modem:s notes:s regions:s raw_json:s
gb_hardware rom_id title:s title_hex:s manufacturer_code:s cgb_flag cgb_mode:s sgb_flag licensee_old licensee_new:s cartridge_type cartridge_type_name:s battery rtc rumble rom_size_code rom_size_declared ram_size_code ram_size_declared destination version header_checksum_declared header_checksum_computed header_checksum_valid global_checksum_declared global_checksum_computed global_checksum_valid logo_sha1:s raw_json:s
gba_hardware rom_id title:s game_code:s maker_code:s fixed_value unit_code device_type version complement_declared complement_computed complement_valid entry_hex:s logo_sha1:s save_types:s padding_byte padding_bytes raw_json:s
fds_hardware rom_id image_format:s fwnes_header fwnes_sides side_size sides valid_sides manufacturer_code game_code:s game_type:s revision disk_type manufacturing_date:s manufacturing_date_bcd:s country_code trailing_bytes sides_json:s raw_json:s
bsx_hardware rom_id header_offset mapping:s maker_code:s program_type:s title:s title_hex:s block_allocation:s limited_starts broadcast_month broadcast_day map_mode execution_type version checksum_declared checksum_complement checksum_pair_valid raw_json:s
sms_hardware rom_id header_offset region_code region:s size_code size_declared product_code:s version checksum_declared checksum_computed checksum_valid codemasters sdsc sdsc_title:s raw_json:s
ws_hardware rom_id publisher_id color game_id version rom_size_code rom_size_declared save_type_code save_type:s save_size flags orientation:s bus_width rtc checksum_declared checksum_computed checksum_valid raw_json:s
ngp_hardware rom_id license:s licensed start_address software_id sub_code color_mode color title:s title_hex:s raw_json:s
pokemini_hardware rom_id nintendo game_code:s region_code:s title:s title_hex:s two_player raw_json:s
pce_hardware rom_id copier_header rom_size banks partial_bank_bytes reset_vector raw_json:s
msx_hardware rom_id media:s header_offset init statement device text raw_json:s
vb_hardware rom_id title:s title_hex:s maker_code:s game_code:s version raw_json:s
ni_snapshots id platform_id source_id version:s db_file_id dumplog_file_id db_sha256:s dumplog_sha256:s imported_at:s
ni_archives snapshot_id archive_id:s title:s attrs_json:s
ni_files snapshot_id file_id:s format:s extension:s size crc32:s md5:s sha1:s sha256:s bad mia object_id attrs_json:s
ni_sources snapshot_id kind:s external_id:s archive_id:s source_id details_json:s serials_json:s hardware_assertion_id
ni_source_files snapshot_id kind:s external_id:s ordinal file_id:s
ni_headers snapshot_id file_id:s kind:s header:b interpretation_json:s
ni_dat_links snapshot_id file_id:s dat_rom_id
ni_archive_releases snapshot_id archive_id:s release_id basis:s
ni_dumplog snapshot_id archive_id:s status_raw:s status:s trusted_count fields_json:s
ni_dumplog_files snapshot_id archive_id:s ordinal size md5:s
ni_pair_checks snapshot_id headered_file_id:s headerless_file_id:s status:s details_json:s
ni_reconstructions snapshot_id file_id:s body_object_id result_object_id rom_id file_record_id checked_at:s
ni_anomalies id snapshot_id archive_id:s category:s details_json:s
game_chinese_names id name_cn:s
game_name_imports id platform_id source_name:s source_sha256:s resource_name:s normalization_version:s imported_at:s
game_name_entries id import_id row_number name_en_original:s name_en:s name_cn_id match_key:s
release_name_links entry_id release_id status:s match_method:s
game_name_match_decisions entry_id algorithm_version:s status:s game_id match_method:s reason:s parsed_name_json:s candidate_game_ids_json:s
ra_snapshots id console_id endpoint:s fetched_at:s response_sha256:s resource_name:s games hashes
ra_games snapshot_id ra_game_id title:s category:s num_achievements num_leaderboards points date_modified:s
ra_hashes snapshot_id md5:s ra_game_id
rom_ra_hashes rom_id ra_md5:s method:s
rom_annotations rom_id kind:s value:s source:s created_at:s
source_collections id kind:s name:s root_path:s registered_at:s
scraper_providers code:s name:s api_base:s documentation_url:s
frontend_profiles code:s name:s gamelist_filename:s documentation_url:s
frontend_platforms frontend_code:s platform_code:s system_code:s provider_code:s provider_system_id:s
frontend_fields frontend_code:s field_key:s category:s value_type:s xml_location:s provider_field:s provider_media_type:s default_extension:s notes:s
scraper_game_links release_id provider_code:s provider_game_id:s status:s raw_file_id source_url:s checked_at:s details_json:s
frontend_game_values release_id frontend_code:s field_key:s language:s region:s value_text:s provider_code:s source_file_id updated_at:s
frontend_media_slots release_id frontend_code:s field_key:s language:s region:s status:s provider_code:s provider_media_type:s media_id source_url:s export_path:s updated_at:s details_json:s
scrape_records id game_id release_id provider:s provider_key:s source_url:s raw_file_id fields_json:s fetched_at:s
media id file_id game_id release_id rom_id scrape_id role:s language:s region:s width height duration_ms codec:s source_url:s metadata_json:s
scrape_texts id sha256:s text:s
scrape_blobs sha256:s codec:s size data:b
provider_snapshots id provider_code:s scope:s source:s source_sha256:s started_at:s finished_at:s details_json:s
provider_records id provider_code:s provider_key:s content_sha256:s raw_sha256:s first_seen_at:s
provider_snapshot_records snapshot_id record_id
provider_record_values record_id field:s language:s region:s ordinal text_id
provider_record_media record_id ordinal media_type:s region:s locator:s crc32:s md5:s sha1:s size format:s
ss_record_roms record_id ss_rom_id size crc32:s md5:s sha1:s file_name:s flags:s regions:s
ss_lookups id snapshot_id sha1:s md5:s crc32:s size rom_name:s system_id account:s requested_at:s http_status outcome:s record_id ss_game_id ss_rom_id message:s
scrape_checks subject_kind:s subject_id title:s verdict:s severity:s accepted:s ss_game_id ss_method:s lb_database_id lb_method:s flags:s details_json:s checked_at:s
"""
KINDS = {"": LongType, "s": StringType, "b": BinaryType}


def _schema(columns: list[str]) -> StructType:
    return StructType([StructField(name, KINDS[kind]()) for name, _, kind in (c.partition(":") for c in columns)])


SCHEMAS: dict[str, StructType] = {line.split()[0]: _schema(line.split()[1:]) for line in MODEL.strip().splitlines()}
#: Tables that hold stored bytes; a catalog-only edition has them empty.
PAYLOAD = ("compression_groups", "chunks", "object_chunks", "nes_recipes", "solid_group_families", "scrape_blobs")
#: References that the audit checks: child table, column, parent table, key.
REFERENCES = (
    ("files", "object_id", "objects", "id"), ("roms", "object_id", "objects", "id"), ("roms", "body_object_id", "objects", "id"), ("roms", "platform_id", "platforms", "id"),
    ("games", "platform_id", "platforms", "id"), ("releases", "game_id", "games", "id"), ("rom_releases", "rom_id", "roms", "id"), ("rom_releases", "release_id", "releases", "id"),
    ("rom_components", "rom_id", "roms", "id"), ("dat_games", "dat_set_id", "dat_sets", "id"), ("dat_roms", "dat_game_id", "dat_games", "id"), ("validations", "rom_id", "roms", "id"),
    ("validations", "dat_rom_id", "dat_roms", "id"), ("release_dat_games", "dat_game_id", "dat_games", "id"), ("object_chunks", "chunk_id", "chunks", "id"), ("chunks", "group_id", "compression_groups", "id"),
    ("archive_entries", "plan_id", "archive_plans", "id"), ("package_members", "package_id", "packages", "id"), ("release_name_links", "entry_id", "game_name_entries", "id"),
    ("game_name_entries", "import_id", "game_name_imports", "id"), ("ra_games", "snapshot_id", "ra_snapshots", "id"), ("rom_ra_hashes", "rom_id", "roms", "id"),
    ("provider_record_values", "record_id", "provider_records", "id"), ("ni_archives", "snapshot_id", "ni_snapshots", "id"),
)
