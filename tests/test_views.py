"""The catalog's views on a small hand-made catalog."""

from __future__ import annotations

import pytest

from ark.catalog import Catalog
from ark.plans.views import VIEWS
from ark.schemas import SCHEMAS



def digest(k: int, n: int = 64) -> str:
    return f"{k:x}".rjust(n, "0")


ROWS = {
    "platforms": [{"id": 1, "code": "nes"}, {"id": 2, "code": "snes"}],
    "objects": [{"id": k, "sha256": digest(k), "sha1": digest(k, 40), "md5": digest(k, 32), "crc32": digest(k, 8), "size": 100 * k, "storage_kind": "archive_manifest" if k == 5 else "chunks"} for k in range(1, 7)],
    "files": [
        {"id": 1, "object_id": 1, "kind": "rom", "original_name": "a.nes", "source_path": "/Sets/RA/a.zip", "parent_file_id": 5},
        {"id": 2, "object_id": 2, "kind": "rom", "original_name": "b.nes", "source_path": "/sets/ra/sub/b.zip", "parent_file_id": 5},
        {"id": 3, "object_id": 2, "kind": "rom", "original_name": "b2.nes", "source_path": "/other/b.zip"},
        {"id": 4, "object_id": 6, "kind": "rom", "original_name": "c.nes", "source_path": "/sets/raX/c.zip"},
        {"id": 5, "object_id": 5, "kind": "archive", "original_name": "a.zip", "source_path": "/sets/ra/a.zip"},
    ],
    "roms": [{"id": k, "object_id": k, "platform_id": 1, "format": "ines", "parse_status": "valid", "header": b"NES\x1a", "body_object_id": 3, "prg_chr_sha256": digest(9), "prg_chr_size": 5} for k in (1, 2)] + [{"id": 3, "object_id": 6, "platform_id": 2, "format": "snes", "parse_status": "valid"}],
    "nes_hardware": [{"rom_id": 1, "mapper": 4}],
    "snes_hardware": [{"rom_id": 3, "layout": "lorom", "checksum_declared": 255}],
    "sms_hardware": [{"rom_id": 1, "checksum_valid": 0, "checksum_declared": 0}, {"rom_id": 2, "checksum_valid": 1, "checksum_declared": 7}, {"rom_id": 3}],
    "gb_hardware": [{"rom_id": k, "logo_sha1": "x" if k < 3 else "y", "licensee_old": 10, "sgb_flag": 3} for k in (1, 2, 3)],
    "archive_plans": [{"id": 1, "size": 500, "sha256": digest(5), "encoder": "e"}],
    "file_archives": [{"file_id": 5, "plan_id": 1}],
    "chunks": [{"id": 1, "size": 10, "data": b"xyz", "group_id": None}, {"id": 2, "size": 20, "group_id": 1}],
    "compression_groups": [{"id": 1, "size": 20, "codec": "lzma2-solid", "data": b"abcde"}],
    "solid_group_families": [{"group_id": 1, "ordinal": 1, "family_key": "z"}, {"group_id": 1, "ordinal": 0, "family_key": "~b"}],
    "dat_sets": [{"id": 1, "name": "S", "version": "1", "imported_at": "t"}],
    "dat_games": [{"id": k, "dat_set_id": 1, "name": f"g{k}"} for k in (1, 2, 3)],
    "dat_roms": [{"id": 1, "dat_game_id": 1, "name": "r1", "md5": "m1", "size": 100}, {"id": 2, "dat_game_id": 2, "name": "r2", "status": "NoDump", "md5": "m2", "size": 512}, {"id": 3, "dat_game_id": 3, "name": "r3", "md5": "m3"}],
    "validations": [{"id": 1, "rom_id": 1, "dat_rom_id": 1, "status": "match"}, {"id": 2, "rom_id": 2, "dat_rom_id": 3, "status": "mismatch"}],
    "games": [{"id": k, "platform_id": 1, "title": f"G{k}"} for k in (1, 2, 3)],
    "releases": [{"id": 1, "game_id": 1, "title": "G1 (USA)"}, {"id": 2, "game_id": 1, "title": "G1 (Japan)"}, {"id": 3, "game_id": 2, "title": "G2"}, {"id": 4, "game_id": 3, "title": "G3"}],
    "rom_releases": [{"rom_id": 1, "release_id": 1}, {"rom_id": 1, "release_id": 2}, {"rom_id": 3, "release_id": 4}],
    "game_chinese_names": [{"id": k, "name_cn": f"名{k}"} for k in (1, 2, 3)],
    "game_name_imports": [{"id": 1, "platform_id": 1, "source_name": "n", "source_sha256": digest(1), "imported_at": "t"}],
    "game_name_entries": [{"id": 1, "import_id": 1, "row_number": 2, "name_en": "G1", "name_cn_id": 1, "match_key": "g1"}, {"id": 2, "import_id": 1, "row_number": 3, "name_en": "G2", "name_cn_id": 2, "match_key": "g2"}, {"id": 3, "import_id": 1, "row_number": 4, "name_en": "G2", "name_cn_id": 3, "match_key": "g2"}, {"id": 4, "import_id": 1, "row_number": 5, "name_en": "no", "match_key": "no"}],
    "release_name_links": [{"entry_id": 1, "release_id": 1, "status": "matched"}, {"entry_id": 2, "release_id": 3, "status": "matched"}, {"entry_id": 3, "release_id": 3, "status": "matched"}],
    "game_name_match_decisions": [{"entry_id": 4, "status": "unmatched", "reason": "none"}, {"entry_id": 1, "status": "matched"}],
    "ra_snapshots": [{"id": 1, "console_id": 7, "games": 1, "hashes": 1}, {"id": 2, "console_id": 7, "games": 2, "hashes": 4, "fetched_at": "t"}],
    "ra_games": [{"snapshot_id": 2, "ra_game_id": 10, "title": "RA", "category": "Official", "num_achievements": 3}, {"snapshot_id": 2, "ra_game_id": 11, "title": "RB", "category": "Hack", "num_achievements": 0}, {"snapshot_id": 1, "ra_game_id": 10, "title": "old"}],
    "ra_hashes": [{"snapshot_id": 2, "md5": "m1", "ra_game_id": 10}, {"snapshot_id": 2, "md5": "m2", "ra_game_id": 11}, {"snapshot_id": 2, "md5": "lost", "ra_game_id": 11}, {"snapshot_id": 1, "md5": "m3", "ra_game_id": 10}],
    "rom_ra_hashes": [{"rom_id": 1, "ra_md5": "m1"}, {"rom_id": 2, "ra_md5": "m9"}],
    "source_collections": [{"id": 1, "kind": "retroachievements", "name": "RA", "root_path": "/sets/RA", "registered_at": "t"}, {"id": 2, "kind": "other", "name": "sub", "root_path": "/sets/ra/sub"}],
    "frontend_platforms": [{"frontend_code": "batocera", "platform_code": "nes", "system_code": "nes", "provider_code": "screenscraper"}],
    "frontend_fields": [{"frontend_code": "batocera", "field_key": "name", "category": "text"}, {"frontend_code": "batocera", "field_key": "desc", "category": "text"}, {"frontend_code": "batocera", "field_key": "image", "category": "media", "provider_media_type": "ss"}],
    "frontend_game_values": [{"release_id": 1, "frontend_code": "batocera", "field_key": "desc", "value_text": "hello", "language": "en"}],
    "frontend_media_slots": [{"release_id": 1, "frontend_code": "batocera", "field_key": "image", "media_id": 1, "status": "stored"}],
    "media": [{"id": 1, "file_id": 1, "width": 10}],
    "object_chunks": [{"object_id": 1, "ordinal": 0, "chunk_id": 1}],
    "ni_archives": [{"snapshot_id": 1, "archive_id": "7", "title": "T", "attrs_json": '{"name": "N", "region": "EU"}'}],
    "ni_sources": [{"snapshot_id": 1, "kind": "source", "external_id": "s", "archive_id": "7", "serials_json": '{"pcb_serial": "P"}'}],
    "ni_files": [{"snapshot_id": 1, "file_id": "f", "md5": "m1", "bad": 0, "object_id": 1, "sha256": "s"}],
    "ni_source_files": [{"snapshot_id": 1, "kind": "source", "external_id": "s", "ordinal": 0, "file_id": "f"}],
    "ni_headers": [{"snapshot_id": 1, "file_id": "f", "kind": "declared", "header": b"NES\x1a"}],
    "ni_dumplog": [{"snapshot_id": 1, "archive_id": "7", "status_raw": "Bad", "status": "bad"}],
    "provider_records": [{"id": k, "provider_code": "screenscraper", "provider_key": "5"} for k in (1, 2)],
    "provider_record_values": [{"record_id": 2, "field": "desc", "text_id": 1}, {"record_id": 1, "field": "desc", "text_id": 1}],
    "scrape_texts": [{"id": 1, "text": "words"}],
    "scrape_checks": [{"subject_kind": "game", "subject_id": 1, "verdict": "ok", "severity": "info", "accepted": "screenscraper", "ss_game_id": 5}],
    "provider_record_media": [{"record_id": 1, "ordinal": 0, "locator": "x=1"}],
}


@pytest.fixture(scope="module")
def catalog(spark, tmp_path_factory):
    c = Catalog(spark, str(tmp_path_factory.mktemp("catalog")))
    for name, rows in ROWS.items():
        c.append(name, spark.createDataFrame([tuple(r.get(f.name) for f in SCHEMAS[name]) for r in rows], SCHEMAS[name]))
    return c


def rows(catalog, name, *columns):
    return sorted((tuple(r) for r in VIEWS[name](catalog).select(*columns).collect()), key=repr)


def test_there_are_all_tables_and_views():
    assert len(SCHEMAS) == 91 and len(VIEWS) == 57


@pytest.mark.parametrize("name", sorted(VIEWS))
def test_runs_on_empty_tables(spark, tmp_path, name):
    df = VIEWS[name](Catalog(spark, str(tmp_path)))
    assert len(set(df.columns)) == len(df.columns)


def test_storage(catalog):
    r = VIEWS["v_storage"](catalog).collect()[0]
    assert (r.logical_content_bytes, r.historical_zip_bytes_not_stored, r.unique_raw_chunk_bytes, r.stored_chunk_bytes, r.zip_plans, r.file_occurrences) == (1600, 500, 30, 8, 1, 5)
    assert rows(catalog, "v_exact_duplicates", "object_id", "occurrence_count") == [(2, 2)]
    assert rows(catalog, "v_nes_body_duplicates", "body_object_id", "variant_count", "rom_ids") == [(3, 2, "1,2")]
    assert rows(catalog, "v_nes_prg_chr_candidates", "variant_count") == [(2,)]
    assert rows(catalog, "v_nes_hardware_candidates", "queried_rom_id", "mapper") == [(1, 4), (2, 4)]
    assert rows(catalog, "v_solid_groups", "group_id", "ratio", "blocks", "families") == [(1, 0.25, 1, "~b | z")]
    assert (5, 500, 1) in rows(catalog, "v_file_checksums", "file_id", "export_size", "exported_bytes_equal_source")
    assert (1, 300) in rows(catalog, "v_rom_checksums", "rom_id", "body_size")
    assert len(rows(catalog, "v_inventory", "file_id")) == 5


def test_coverage_and_headers(catalog):
    assert rows(catalog, "v_dat_coverage", "rom_name", "status") == [("r1", "matched"), ("r2", "nodump"), ("r3", "unmatched")]
    assert rows(catalog, "v_snes_headers", "checksum_declared", "checksum_computed") == [("00FF", "0000")]
    assert rows(catalog, "v_sms_headers", "rom_id", "checksum_status") == [(1, "not_declared"), (2, "valid"), (3, None)]
    assert rows(catalog, "v_gb_headers", "rom_id", "logo_is_common", "licensee", "sgb_enhanced") == [(1, 1, "0A", 1), (2, 1, "0A", 1), (3, 0, "0A", 1)]


def test_achievements(catalog):
    assert rows(catalog, "v_rom_ra_matches", "rom_id", "ra_game_id", "release_id", "has_achievements") == [(1, 10, 1, 1), (1, 10, 2, 1)]
    assert rows(catalog, "v_dat_ra_matches", "dat_rom_id", "local_rom_available") == [(1, 1)]
    assert rows(catalog, "v_ra_unmatched_hashes", "md5") == [("lost",)]
    assert rows(catalog, "v_nointro_ra_matches", "file_id", "in_dat", "nointro_title") == [("f", 1, "T")]
    assert rows(catalog, "v_collection_files", "collection", "file_id") == [("RA", 1), ("RA", 2), ("RA", 5), ("sub", 2)]
    assert rows(catalog, "v_ra_collection", "file_id", "zip_name", "status", "nointro_dat_games") == [(1, "a.zip", "in_nointro_dat", "g1"), (2, "a.zip", "ra_hash_unknown", None)]


def test_names(catalog):
    assert rows(catalog, "v_release_effective_chinese_names", "release_id", "name_cn", "name_basis") == [(1, "名1", "direct"), (2, "名1", "group_inherited"), (3, "名2", "direct"), (3, "名3", "direct")]
    assert rows(catalog, "v_game_chinese_name_status", "game_id", "status") == [(1, "unique_translation"), (2, "needs_review"), (3, "missing")]
    assert rows(catalog, "v_game_name_alternatives", "match_key", "chinese_name_count") == [("g2", 2)]
    assert rows(catalog, "v_game_name_import_status", "id", "status", "release_count") == [(1, "matched", 1), (2, "matched", 1), (3, "matched", 1), (4, "unmatched", 0)]
    assert rows(catalog, "v_rom_effective_chinese_names", "rom_id", "release_id") == [(1, 1), (1, 2)]
    assert rows(catalog, "v_game_chinese_name_review", "name_cn") == [("名2",), ("名3",)]
    assert rows(catalog, "v_game_name_match_review", "entry_id", "reason") == [(4, "none")]
    assert len(rows(catalog, "v_game_names", "game_id")) == 3
    assert len(rows(catalog, "v_game_chinese_name_evidence", "game_id")) == 3


def test_frontends_and_sources(catalog):
    assert ("desc", "hello", "populated") in rows(catalog, "v_batocera_game_fields", "field_key", "value_text", "status")
    assert ("name", "G3", "catalog_fallback") in rows(catalog, "v_batocera_game_fields", "field_key", "value_text", "status")
    assert (1, "stored", 1) in rows(catalog, "v_batocera_media_slots", "release_id", "status", "payload_available")
    assert {r[0] for r in rows(catalog, "v_screenscraper_games", "status")} == {"pending"}
    assert rows(catalog, "v_nointro_hardware", "pcb", "title") == [("P", "T")]
    assert rows(catalog, "v_nointro_archives", "name", "region") == [("N", "EU")]
    assert rows(catalog, "v_nointro_files", "declared_header_hex", "payload_available") == [("4E45531A", 1)]
    assert len(rows(catalog, "v_information_sources", "source")) == 1 + 1 + 2 + 2 + 1 + 1 + 0 + 3
    assert rows(catalog, "v_provider_latest_records", "id") == [(2,)]
    assert rows(catalog, "v_subject_scraped_values", "subject_id", "value") == [(1, "words")]
    assert rows(catalog, "v_scraped_media", "url_without_credentials") == [("https://neoclone.screenscraper.fr/api2/mediaJeu.php?x=1",)]
    assert rows(catalog, "v_scrape_check_summary", "verdict", "subjects") == [("ok", 1)]


def test_editions(spark, catalog, tmp_path):
    copy = catalog.without_payload(str(tmp_path / "copy"))
    assert not copy.payload_available and catalog.payload_available
    assert copy.chunks.count() == 0
    assert rows(copy, "v_dat_coverage", "rom_name", "status") == rows(catalog, "v_dat_coverage", "rom_name", "status")
    assert {r[2] for r in rows(copy, "v_batocera_media_slots", "release_id", "status", "payload_available")} == {0}
    broken = {r.constraint: r.orphans for r in catalog.audit().collect()}
    assert broken == {"ni_archives.snapshot_id": 1}
