"""The 57 views over the sample catalog, each with its own SQL."""

from __future__ import annotations

from .registry import ORACLES, QUERIES
from .sample import Sample, oracle
from .views import VIEWS

SUMS = ("size", "crc32", "md5", "sha1", "sha256")
_TITLED = """matched AS (SELECT l.release_id, r.game_id, r.title AS catalog_title, l.entry_id, e.name_en_original, e.name_en, e.name_cn_id, n.name_cn, l.match_method, e.import_id, e.row_number, i.source_name, i.source_sha256
FROM release_name_links l, game_name_entries e, game_name_imports i, releases r LEFT JOIN game_chinese_names n ON n.id = (SELECT max(x.name_cn_id) FROM game_name_entries x WHERE x.id = l.entry_id)
WHERE l.status = 'matched' AND l.entry_id = e.id AND e.import_id = i.id AND l.release_id = r.id)"""
_ALIASES = f"{_TITLED}, aliases AS (SELECT DISTINCT game_id, name_cn_id, name_cn FROM matched WHERE name_cn_id IS NOT NULL)"
_STATUS = f"""{_ALIASES}, judged AS (SELECT g.id AS game_id, g.platform_id, (SELECT count(*) FROM aliases a WHERE a.game_id = g.id)::BIGINT AS chinese_name_count FROM games g),
standing AS (SELECT *, CASE chinese_name_count WHEN 0 THEN 'missing' WHEN 1 THEN 'unique_translation' ELSE 'needs_review' END AS status,
 CASE WHEN chinese_name_count = 1 THEN (SELECT min(a.name_cn_id) FROM aliases a WHERE a.game_id = judged.game_id) END AS standard_name_cn_id,
 CASE WHEN chinese_name_count = 1 THEN (SELECT min(a.name_cn) FROM aliases a WHERE a.game_id = judged.game_id) END AS standard_name_cn FROM judged)"""
_EFFECTIVE = f"""{_STATUS}, effective AS (SELECT DISTINCT release_id, game_id, catalog_title, name_cn_id, name_cn, 'direct' AS name_basis FROM matched WHERE name_cn_id IS NOT NULL
UNION ALL SELECT r.id, r.game_id, r.title, s.standard_name_cn_id, s.standard_name_cn, 'group_inherited' FROM releases r JOIN standing s ON s.game_id = r.game_id AND s.chinese_name_count = 1 WHERE r.id NOT IN (SELECT release_id FROM matched WHERE name_cn_id IS NOT NULL))"""
_HASHES = """newest AS (SELECT max(id) AS s FROM ra_snapshots), known AS (SELECT h.md5, g.ra_game_id, g.title AS ra_title, g.category AS ra_category, g.num_achievements, g.points, CAST(g.num_achievements > 0 AS INT) AS has_achievements
FROM newest, ra_hashes h, ra_games g WHERE h.snapshot_id = s AND g.snapshot_id = s AND h.ra_game_id = g.ra_game_id)"""
_FRONT = """front AS (SELECT r.id AS release_id, r.game_id, r.title, p.code AS platform_code, fp.system_code, fp.provider_code, fp.provider_system_id FROM releases r, games g, platforms p, frontend_platforms fp
WHERE r.game_id = g.id AND g.platform_id = p.id AND fp.platform_code = p.code AND fp.frontend_code = 'batocera')"""
_BELOW = """below AS (SELECT c.id AS collection_id, c.kind, c.name AS collection, f.id AS file_id, f.kind AS file_kind, f.parent_file_id, f.original_name, f.source_path, f.object_id
FROM source_collections c, files f WHERE starts_with(lower(f.source_path), lower(c.root_path) || '/'))"""
_LATEST = "newest AS (SELECT * FROM provider_records WHERE id IN (SELECT max(id) FROM provider_records GROUP BY provider_code, provider_key))"
_VALUES = "valued AS (SELECT r.provider_code, r.provider_key, r.id AS record_id, v.field, v.language, v.region, v.ordinal, t.text AS value FROM provider_record_values v, provider_records r, scrape_texts t WHERE v.record_id = r.id AND v.text_id = t.id)"


def hexed(column: str, digits: int) -> str:
    return f"printf('%0{digits}X', coalesce({column}, 0)) AS {column}"


def header(table: str, shown: str, columns: str, more: str = "", joins: str = "") -> str:
    """``shown``: columns of the ROM; ``columns``: of its header, with %digits for hex."""
    cells = [hexed(n, int(d)) if d else f"h.{n}" for n, _, d in (c.partition("%") for c in columns.split())]
    return f"SELECT r.id AS rom_id, o.sha1, o.size{', r.format' if shown == 'format' else ''}, r.parse_status, {', '.join(cells)}{more} FROM {table}_hardware h, objects o, roms r {joins} WHERE h.rom_id = r.id AND r.object_id = o.id"


def logo(table: str) -> str:
    return f", CAST(h.logo_sha1 = (SELECT logo_sha1 FROM {table}_hardware GROUP BY logo_sha1 ORDER BY count(*) DESC, logo_sha1 LIMIT 1) AS INT) AS logo_is_common"


SQL = {
    "v_storage": """SELECT (SELECT sum(size) FROM objects WHERE storage_kind <> 'archive_manifest')::BIGINT AS logical_content_bytes, (SELECT sum(size) FROM objects WHERE storage_kind = 'archive_manifest')::BIGINT AS historical_zip_bytes_not_stored,
 (SELECT sum(size) FROM chunks)::BIGINT AS unique_raw_chunk_bytes, ((SELECT sum(octet_length(data)) FROM chunks) + (SELECT sum(octet_length(data)) FROM compression_groups))::BIGINT AS stored_chunk_bytes,
 (SELECT count(*) FROM nes_recipes) AS header_body_recipes, (SELECT count(*) FROM archive_plans) AS zip_plans, (SELECT count(*) FROM files) AS file_occurrences, (SELECT count(*) FROM objects) AS catalog_objects""",
    "v_file_checksums": f"""SELECT f.id AS file_id, f.kind, f.original_name, o.storage_kind, {', '.join(f'o.{s} AS source_{s}' for s in SUMS)}, {', '.join(f"CASE f.kind WHEN 'archive' THEN p.{s} ELSE o.{s} END AS export_{s}" for s in SUMS)},
 p.id AS archive_plan_id, p.encoder, p.zlib_version, CASE f.kind WHEN 'archive' THEN CAST(p.sha256 = o.sha256 AS INT) ELSE 1 END AS exported_bytes_equal_source
 FROM files f INNER JOIN objects o ON o.id = f.object_id LEFT JOIN file_archives fa ON fa.file_id = f.id LEFT JOIN archive_plans p ON p.id = fa.plan_id""",
    "v_rom_checksums": f"""SELECT r.id AS rom_id, r.format, r.header, {', '.join(f'o.{s}' for s in SUMS)}, b.id AS body_object_id, {', '.join(f'b.{s} AS body_{s}' for s in SUMS)} FROM roms r INNER JOIN objects o ON o.id = r.object_id LEFT JOIN objects b ON b.id = r.body_object_id""",
    "v_inventory": "SELECT f.object_id, f.id AS file_id, f.kind, f.original_name, f.source_path, o.size, o.sha256, o.sha1, o.md5, o.crc32, r.id AS rom_id, r.format, r.parse_status FROM files f INNER JOIN objects o ON o.id = f.object_id LEFT JOIN roms r ON r.object_id = f.object_id",
    "v_exact_duplicates": "SELECT f.object_id, count(*) AS occurrence_count, any_value(o.sha256) AS sha256, any_value(o.size) AS size FROM files f, objects o WHERE o.id = f.object_id GROUP BY f.object_id HAVING count(*) > 1",
    "v_nes_body_duplicates": "SELECT body_object_id, count(*) AS variant_count, string_agg(id::VARCHAR, ',' ORDER BY id::VARCHAR) AS rom_ids FROM roms WHERE body_object_id IS NOT NULL AND platform_id IN (SELECT id FROM platforms WHERE code = 'nes') GROUP BY ALL HAVING count(*) > 1",
    "v_nes_prg_chr_candidates": "SELECT prg_chr_sha256, prg_chr_size, count(*) AS variant_count, string_agg(id::VARCHAR, ',' ORDER BY id::VARCHAR) AS rom_ids FROM roms WHERE prg_chr_sha256 IS NOT NULL GROUP BY ALL HAVING count(*) > 1",
    "v_dat_coverage": """SELECT g.dat_set_id, m.id AS dat_rom_id, g.name AS game_name, m.name AS rom_name, CASE WHEN lower(m.status) = 'nodump' THEN 'nodump' WHEN EXISTS (SELECT 1 FROM validations v WHERE v.dat_rom_id = m.id AND v.status = 'match') THEN 'matched' ELSE 'unmatched' END AS status
 FROM dat_roms m, dat_games g, dat_sets s WHERE m.dat_game_id = g.id AND g.dat_set_id = s.id""",
    "v_nes_hardware_candidates": "SELECT q.id AS queried_rom_id, h.* FROM roms q INNER JOIN roms r ON r.body_object_id = q.body_object_id INNER JOIN nes_hardware h ON h.rom_id = r.id",
    "v_solid_groups": """SELECT c.id AS group_id, c.size AS raw_bytes, octet_length(c.data)::BIGINT AS stored_bytes, round(octet_length(c.data) / c.size, 4) AS ratio, (SELECT count(*) FROM chunks b WHERE b.group_id = c.id) AS blocks,
 (SELECT string_agg(family_key, ' | ' ORDER BY ordinal) FROM solid_group_families x WHERE x.group_id = c.id) AS families FROM compression_groups c WHERE c.codec = 'lzma2-solid'""",
    "v_snes_headers": header("snes", "", "layout map_mode_name fast_rom coprocessor battery title region maker_code game_code version rom_size_declared ram_size_declared checksum_declared%4 checksum_computed%4 checksum_valid"),
    "v_md_headers": header("md", "", "system_type copyright title_domestic title_overseas serial devices regions checksum_declared%4 checksum_computed%4 checksum_valid rom_end%6 sram_type sram_start%6 sram_end%6"),
    "v_fds_headers": header("fds", "format", "image_format fwnes_header sides valid_sides manufacturer_code game_code game_type revision disk_type manufacturing_date country_code trailing_bytes"),
    "v_bsx_headers": header("bsx", "format", "mapping maker_code title broadcast_month broadcast_day limited_starts map_mode version checksum_pair_valid"),
    "v_ws_headers": header("ws", "format", "publisher_id color game_id version rom_size_declared save_type save_size orientation bus_width rtc checksum_declared%4 checksum_computed%4 checksum_valid"),
    "v_ngp_headers": header("ngp", "format", "license licensed start_address%6 software_id%4 sub_code color title"),
    "v_pokemini_headers": header("pokemini", "", "nintendo game_code region_code title two_player"),
    "v_pce_headers": header("pce", "format", "copier_header rom_size banks partial_bank_bytes reset_vector%4"),
    "v_vb_headers": header("vb", "", "title maker_code game_code version"),
    "v_gb_headers": header("gb", "format", "title manufacturer_code cgb_mode cartridge_type_name battery rtc rumble rom_size_declared ram_size_declared destination version header_checksum_valid global_checksum_valid", ", CAST(h.sgb_flag = 3 AS INT) AS sgb_enhanced, coalesce(h.licensee_new, printf('%02X', coalesce(h.licensee_old, 0))) AS licensee" + logo("gb")),
    "v_gba_headers": header("gba", "", "title game_code maker_code version complement_valid save_types padding_byte padding_bytes", ", o.size - h.padding_bytes AS content_bytes" + logo("gba")),
    "v_sms_headers": header("sms", "", "header_offset%4 region size_declared product_code version checksum_declared%4 checksum_computed%4 checksum_valid codemasters sdsc sdsc_title", ", CASE WHEN checksum_valid IS NULL THEN NULL WHEN checksum_valid = 1 THEN 'valid' WHEN h.checksum_declared = 0 THEN 'not_declared' ELSE 'mismatch' END AS checksum_status"),
    "v_msx_headers": header("msx", "format", "media header_offset%4 init%4 statement%4 device%4 text%4", ", a.value AS platform_evidence", "LEFT JOIN rom_annotations a ON a.rom_id = r.id AND a.kind = 'platform'"),
    "v_screenscraper_games": f"""{_FRONT} SELECT f.release_id, f.game_id, f.title, f.platform_code, f.system_code, f.provider_system_id, l.provider_game_id, coalesce(l.status, 'pending') AS status, l.raw_file_id, l.source_url, l.checked_at
 FROM front f LEFT JOIN scraper_game_links l ON l.release_id = f.release_id AND l.provider_code = 'screenscraper' WHERE f.provider_code = 'screenscraper'""",
    "v_batocera_game_fields": f"""{_FRONT} SELECT f.release_id, f.game_id, f.title AS catalog_title, f.system_code, d.field_key, d.category, d.value_type, d.xml_location, coalesce(v.language, '') AS language, coalesce(v.region, '') AS region,
 CASE WHEN v.value_text IS NULL AND d.field_key = 'name' THEN f.title ELSE v.value_text END AS value_text, CASE WHEN v.value_text IS NOT NULL THEN 'populated' WHEN d.field_key = 'name' THEN 'catalog_fallback' ELSE 'pending' END AS status,
 d.provider_field, v.provider_code, v.source_file_id, v.updated_at FROM front f INNER JOIN frontend_fields d ON d.frontend_code = 'batocera' AND d.category <> 'media'
 LEFT JOIN frontend_game_values v ON v.release_id = f.release_id AND v.field_key = d.field_key AND v.frontend_code = 'batocera'""",
    "v_batocera_media_slots": f"""{_FRONT} SELECT f.release_id, f.game_id, f.title AS catalog_title, f.system_code, d.field_key, coalesce(s.language, '') AS language, coalesce(s.region, '') AS region, coalesce(s.status, 'pending') AS status,
 coalesce(s.provider_code, f.provider_code) AS provider_code, coalesce(s.provider_media_type, d.provider_media_type) AS provider_media_type, d.default_extension, s.media_id, s.source_url, s.export_path, m.file_id, m.width, m.height, m.duration_ms, m.codec,
 o.size, o.crc32, o.md5, o.sha1, o.sha256, CAST(o.id IN (SELECT object_id FROM object_chunks) AND o.id IS NOT NULL AS INT) AS payload_available
 FROM front f INNER JOIN frontend_fields d ON d.frontend_code = 'batocera' AND d.category = 'media' LEFT JOIN frontend_media_slots s ON s.release_id = f.release_id AND s.field_key = d.field_key AND s.frontend_code = 'batocera'
 LEFT JOIN media m ON m.id = s.media_id LEFT JOIN files y ON y.id = m.file_id LEFT JOIN objects o ON o.id = y.object_id""",
    "v_nointro_files": """SELECT f.*, CAST(f.object_id IS NOT NULL AS INT) AS payload_available, coalesce(hex(h.header), '') AS declared_header_hex FROM ni_files f LEFT JOIN ni_headers h ON h.snapshot_id = f.snapshot_id AND h.file_id = f.file_id AND h.kind = 'declared'""",
    "v_nointro_hardware": """SELECT s.snapshot_id, s.archive_id, a.title, s.kind, s.external_id, s.source_id, s.hardware_assertion_id, s.serials_json ->> '$.pcb_serial' AS pcb, s.serials_json ->> '$.romchip_serial1' AS romchip1, s.serials_json ->> '$.romchip_serial2' AS romchip2,
 s.serials_json ->> '$.lockout_serial' AS lockout, s.serials_json ->> '$.savechip_serial' AS savechip, s.serials_json, s.details_json FROM ni_sources s, ni_archives a WHERE s.serials_json <> '{}' AND a.snapshot_id = s.snapshot_id AND a.archive_id = s.archive_id""",
    "v_nointro_status": "SELECT d.snapshot_id, d.archive_id, a.title, d.status_raw, d.status, d.trusted_count FROM ni_dumplog d, ni_archives a WHERE a.snapshot_id = d.snapshot_id AND a.archive_id = d.archive_id",
    "v_nointro_headers": "SELECT h.snapshot_id, h.file_id, h.kind, hex(h.header) AS header_hex, h.interpretation_json, f.format, f.sha256, f.object_id FROM ni_headers h, ni_files f WHERE f.snapshot_id = h.snapshot_id AND f.file_id = h.file_id",
    "v_nointro_archives": f"SELECT snapshot_id, archive_id, title, attrs_json, {', '.join(f'''attrs_json ->> '$.{k}' AS {k}''' for k in ('name', 'name_alt', 'clone', 'region', 'languages', 'categories', 'regparent'))} FROM ni_archives",
    "v_ra_latest": "SELECT max(id) AS snapshot_id FROM ra_snapshots",
    "v_rom_ra_matches": f"""{_HASHES} SELECT x.rom_id, x.ra_md5, k.ra_game_id, k.ra_title, k.ra_category, k.num_achievements, k.points, k.has_achievements, rr.release_id, e.title AS release_title
 FROM rom_ra_hashes x INNER JOIN known k ON k.md5 = x.ra_md5 LEFT JOIN rom_releases rr ON rr.rom_id = x.rom_id LEFT JOIN releases e ON e.id = rr.release_id""",
    "v_dat_ra_matches": f"""{_HASHES} SELECT g.dat_set_id, s.version AS dat_version, g.id AS dat_game_id, g.name AS game_name, g.cloneof, m.id AS dat_rom_id, m.md5, k.ra_game_id, k.ra_title, k.ra_category, k.num_achievements, k.has_achievements,
 CAST(m.id IN (SELECT dat_rom_id FROM validations WHERE status = 'match') AS INT) AS local_rom_available FROM dat_roms m, dat_games g, dat_sets s, known k WHERE m.dat_game_id = g.id AND g.dat_set_id = s.id AND k.md5 = m.md5 AND m.size % 8192 <> 512""",
    "v_ra_unmatched_hashes": f"{_HASHES} SELECT md5, ra_game_id, ra_title AS title, ra_category AS category, num_achievements FROM known k WHERE NOT EXISTS (SELECT 1 FROM rom_ra_hashes x WHERE x.ra_md5 = k.md5) AND NOT EXISTS (SELECT 1 FROM dat_roms m WHERE m.md5 = k.md5)",
    "v_nointro_ra_matches": f"""{_HASHES} SELECT DISTINCT f.snapshot_id AS nointro_snapshot_id, f.file_id, f.bad, f.object_id, a.archive_id, a.title AS nointro_title, k.ra_game_id, k.ra_title, k.ra_category, k.num_achievements, k.has_achievements,
 CAST(EXISTS (SELECT 1 FROM dat_roms m WHERE m.md5 = f.md5) AS INT) AS in_dat FROM ni_files f, known k, ni_source_files x, ni_sources s, ni_archives a
 WHERE k.md5 = f.md5 AND x.snapshot_id = f.snapshot_id AND x.file_id = f.file_id AND s.snapshot_id = x.snapshot_id AND s.kind = x.kind AND s.external_id = x.external_id AND a.snapshot_id = s.snapshot_id AND a.archive_id = s.archive_id""",
    "v_release_game_names": f"{_TITLED} SELECT * FROM matched",
    "v_game_names": f"{_TITLED} SELECT DISTINCT game_id, name_en, name_cn FROM matched",
    "v_release_chinese_names": f"{_TITLED} SELECT DISTINCT release_id, game_id, name_cn_id, name_cn FROM matched WHERE name_cn_id IS NOT NULL",
    "v_rom_game_names": f"{_TITLED} SELECT rr.rom_id, m.* FROM rom_releases rr INNER JOIN matched m ON m.release_id = rr.release_id",
    "v_game_name_alternatives": "SELECT import_id, match_key, count(DISTINCT name_cn_id) AS chinese_name_count FROM game_name_entries GROUP BY import_id, match_key HAVING count(DISTINCT name_cn_id) > 1",
    "v_game_name_import_status": """SELECT e.*, n.name_cn, CASE WHEN m.k > 0 THEN 'matched' WHEN m.n > 0 THEN 'ambiguous' ELSE 'unmatched' END AS status, coalesce(m.k, 0)::BIGINT AS release_count
 FROM game_name_entries e LEFT JOIN game_chinese_names n ON n.id = e.name_cn_id LEFT JOIN (SELECT entry_id, count(*) AS n, count(*) FILTER (status = 'matched') AS k FROM release_name_links GROUP BY entry_id) m ON m.entry_id = e.id""",
    "v_game_chinese_name_aliases": f"{_ALIASES} SELECT * FROM aliases",
    "v_game_chinese_name_status": f"{_STATUS} SELECT * FROM standing",
    "v_release_effective_chinese_names": f"{_EFFECTIVE} SELECT * FROM effective",
    "v_rom_effective_chinese_names": f"{_EFFECTIVE} SELECT rr.rom_id, e.* FROM rom_releases rr INNER JOIN effective e ON e.release_id = rr.release_id",
    "v_game_chinese_name_evidence": f"{_TITLED} SELECT game_id, name_cn_id, name_cn, release_id AS source_release_id, catalog_title AS source_title, entry_id, import_id, row_number, source_name, source_sha256 FROM matched WHERE name_cn_id IS NOT NULL",
    "v_game_chinese_name_review": f"{_ALIASES} SELECT * FROM aliases WHERE game_id IN (SELECT game_id FROM aliases GROUP BY game_id HAVING count(*) > 1)",
    "v_game_name_match_review": """SELECT d.entry_id, e.import_id, e.row_number, e.name_en_original, n.name_cn, d.status, d.reason, d.parsed_name_json, d.candidate_game_ids_json
 FROM game_name_match_decisions d INNER JOIN game_name_entries e ON e.id = d.entry_id LEFT JOIN game_chinese_names n ON n.id = e.name_cn_id WHERE d.status <> 'matched'""",
    "v_collection_files": f"{_BELOW} SELECT * FROM below",
    "v_ra_collection": f"""{_HASHES}, {_BELOW}, least AS (SELECT md5, min(ra_game_id) AS ra_game_id FROM known GROUP BY md5), held AS (SELECT v.rom_id, string_agg(DISTINCT g.name, ',' ORDER BY g.name) AS names FROM validations v, dat_roms m, dat_games g WHERE v.status = 'match' AND v.dat_rom_id = m.id AND m.dat_game_id = g.id GROUP BY v.rom_id)
 SELECT b.collection, b.file_id, b.original_name, z.original_name AS zip_name, r.id AS rom_id, x.ra_md5, k.ra_game_id, k.ra_title, k.ra_category, k.num_achievements, held.names AS nointro_dat_games, (SELECT min(rr.release_id) FROM rom_releases rr WHERE rr.rom_id = r.id) AS release_id,
 CASE WHEN k.ra_game_id IS NULL THEN 'ra_hash_unknown' WHEN held.names IS NOT NULL THEN 'in_nointro_dat' ELSE 'ra_only' END AS status
 FROM below b INNER JOIN roms r ON r.object_id = b.object_id LEFT JOIN files z ON z.id = b.parent_file_id LEFT JOIN rom_ra_hashes x ON x.rom_id = r.id LEFT JOIN least ON least.md5 = x.ra_md5
 LEFT JOIN (SELECT DISTINCT * FROM known) k ON k.md5 = x.ra_md5 AND k.ra_game_id = least.ra_game_id LEFT JOIN held ON held.rom_id = r.id WHERE b.kind = 'retroachievements' AND b.file_kind = 'rom'""",
    "v_information_sources": f"""{_BELOW} SELECT 'existing' AS layer, 'No-Intro DAT' AS source, version, imported_at, (SELECT count(*) FROM dat_games g WHERE g.dat_set_id = s.id) AS entries, name AS detail FROM dat_sets s
 UNION ALL SELECT 'existing', 'ROM files', NULL, min(imported_at), count(*), 'local files (all kinds)' FROM files
 UNION ALL SELECT 'existing', 'Source collection: ' || kind, NULL, registered_at, (SELECT count(*) FROM below b WHERE b.collection_id = c.id AND b.parent_file_id IS NULL), name FROM source_collections c
 UNION ALL SELECT 'extended', 'No-Intro DB Export + Dump Log', version, imported_at, (SELECT count(*) FROM ni_archives a WHERE a.snapshot_id = n.id), 'snapshot ' || id FROM ni_snapshots n
 UNION ALL SELECT 'extended', 'RetroAchievements', fetched_at, fetched_at, games, 'console ' || console_id || ', ' || hashes || ' hashes' FROM ra_snapshots
 UNION ALL SELECT 'extended', 'English/Chinese names', source_sha256, imported_at, (SELECT count(*) FROM game_name_entries e WHERE e.import_id = i.id), source_name FROM game_name_imports i
 UNION ALL SELECT 'extended', 'Documented hardware assertions', NULL, min(created_at), count(*), 'from No-Intro serial fields' FROM hardware_assertions
 UNION ALL SELECT 'scraped', CASE provider_code WHEN 'launchbox' THEN 'LaunchBox Games Database' ELSE 'ScreenScraper' END, source_sha256, started_at, (SELECT count(*) FROM provider_snapshot_records r WHERE r.snapshot_id = p.id), scope || ' ' || source FROM provider_snapshots p
 UNION ALL SELECT 'future', 'Frontend values (Batocera/ScreenScraper)', NULL, max(updated_at), count(*), 'local overrides; scraped values are in provider_record_values' FROM frontend_game_values
 UNION ALL SELECT 'future', 'Frontend media slots', NULL, max(updated_at), count(*), 'placeholders until media is stored' FROM frontend_media_slots
 UNION ALL SELECT 'future', 'Scrape records', NULL, max(fetched_at), count(*), 'provider responses' FROM scrape_records""",
    "v_provider_latest_records": f"{_LATEST} SELECT * FROM newest",
    "v_provider_record_values": f"{_VALUES} SELECT * FROM valued",
    "v_scraped_media": """SELECT r.provider_code, r.provider_key, m.record_id, m.ordinal, m.media_type, m.region, m.format, m.size, m.crc32, m.md5, m.sha1, CASE r.provider_code WHEN 'launchbox' THEN 'https://images.launchbox-app.com/' ELSE 'https://neoclone.screenscraper.fr/api2/mediaJeu.php?' END || m.locator AS url_without_credentials
 FROM provider_record_media m, provider_records r WHERE m.record_id = r.id""",
    "v_subject_scraped_values": f"""{_LATEST}, {_VALUES} SELECT c.subject_kind, c.subject_id, c.title, c.severity, c.verdict, c.accepted AS provider_code, n.provider_key, v.field, v.language, v.region, v.ordinal, v.value
 FROM scrape_checks c, newest n, valued v WHERE n.provider_code = c.accepted AND n.provider_key = CASE c.accepted WHEN 'screenscraper' THEN c.ss_game_id ELSE c.lb_database_id END::VARCHAR AND v.record_id = n.id""",
    "v_scrape_check_summary": "SELECT subject_kind, severity, verdict, count(*) AS subjects FROM scrape_checks GROUP BY ALL",
}


def with_tables(sql: str) -> str:
    """Leading named parts join the WITH clause of the tables."""
    return oracle(sql) if sql.startswith("SELECT") else oracle(sql).replace(f" {sql}", f", {sql}", 1)


for _name, _view in VIEWS.items():
    QUERIES[_name] = lambda spark, folder, view=_view: view(Sample(spark, folder))
    ORACLES[_name] = with_tables(SQL[_name])
