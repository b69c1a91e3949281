"""Storage, experiments, reports, sequential diffs and header recovery."""

from __future__ import annotations

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from ark.catalog import Catalog
from ark.operators import experiments, lineage, recovery, reports, storage
from ark.operators.audit import gaps, table_digest

RNG = random.Random(6)


def contents():
    shared = RNG.randbytes(5000)
    rows = [("f1", shared + RNG.randbytes(1000)), ("f1", shared + RNG.randbytes(777)), ("f2", b"\0" * 4096), ("f2", b""), ("f3", RNG.randbytes(100)), ("f3", b"H" * 512 + shared)]
    return rows + [rows[0]]


def test_store_fetch_verify(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "c"))
    rows = contents()
    df = spark.createDataFrame(rows, "family string, content binary").withColumn("cuts", F.when(F.substr("content", F.lit(1), F.lit(1)) == b"H", F.array(F.lit(512))).otherwise(F.array().cast("array<int>")))
    first = storage.store(catalog, df, block=1000, cap=3000)
    assert first["objects"] == 6
    assert storage.store(catalog, df, block=1000, cap=3000) == {"objects": 0, "blocks": 0, "groups": 0}
    raw = {hashlib.sha256(c).hexdigest(): c for _, c in rows}
    got = catalog.objects.select(F.col("id").alias("object_id"), "sha256")
    back = {r.sha256: bytes(r.content) for r in got.join(storage.fetch(catalog, got), "object_id").collect()}
    assert back == raw
    assert storage.verify(catalog).count() == 0
    blocks = catalog.chunks.count()
    assert blocks < sum(-(-len(c) // 1000) for _, c in rows)  # shared blocks are stored once
    zeros = catalog.object_chunks.where("repeat > 1").collect()
    assert [r.repeat for r in zeros] == [4]
    assert storage.positions(catalog).count() == 5
    assert catalog.audit().count() == 0
    one = table_digest(catalog.objects, "x").collect()[0].digest
    assert one == table_digest(catalog.objects.repartition(3).select(*catalog.objects.columns[::-1]), "x").collect()[0].digest


def test_regroup(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "c"))
    storage.store(catalog, spark.createDataFrame(contents(), "family string, content binary"), block=1000, cap=2000)
    copy = storage.regroup(catalog, str(tmp_path / "d"), cap=100_000)
    assert copy.compression_groups.count() < catalog.compression_groups.count()
    assert copy.chunks.count() == catalog.chunks.count()
    assert storage.verify(copy).count() == 0


def test_pair_checks(spark):
    header, body = b"NES\x1a" + bytes(12), RNG.randbytes(99)
    good, part = f"{zlib.crc32(header + body):08x}", f"{zlib.crc32(body):08x}"
    rows = [("a", "1", header, part, 99, good), ("b", "2", header, part, 99, "00000000"), ("c", "3", header, None, None, good), ("d", "4", None, part, 99, good)]
    df = spark.createDataFrame(rows, "headered_id string, headerless_id string, header binary, body_crc32 string, body_size long, crc32 string")
    assert {r.headered_id: r.status for r in recovery.pair_checks(df).collect()} == {"a": "verified", "b": "mismatch", "c": "body_unavailable", "d": "no_header"}


def test_blocks_restart_at_cuts(spark):
    df = spark.createDataFrame([(1, b"a" * 25, [12, 0, 99])], "object_id long, content binary, cuts array<int>")
    got = [(r.offset, r.size) for r in storage.blocks_of(df, "object_id", 10, "cuts").orderBy("ordinal").collect()]
    assert got == [(0, 10), (10, 2), (12, 10), (22, 3)]
    assert gaps(storage.blocks_of(df, "object_id", 10, "cuts"), "object_id", "ordinal", "offset", "size").count() == 0


def test_experiments(spark):
    rows = [(f, k, c) for k, (f, c) in enumerate(contents()[:6])]
    files = spark.createDataFrame(rows, "family string, object_id long, content binary")
    assert experiments.sample_families(files, 2).select("family").distinct().count() == 2
    out = experiments.grid(files, [500, 1000], [2000, 4000])
    assert out.count() == 4
    assert experiments.choose(out).count() == 1


def test_sequential_diff(spark):
    kind = "pair string, id long, name string, size long, crc32 string, md5 string, sha1 string, sha256 string"
    old = [("p", 1, "A", 1, "c1", None, "s1", None), ("p", 2, "B", 2, "c2", None, "s2", None), ("p", 3, "C", 3, "c3", None, "s3", None), ("p", 4, "D", 4, "c4", None, None, None), ("p", 5, "E", 5, "c5", None, "s5", None)]
    new = [("p", 11, "A", 1, "c1", None, "s1", None), ("p", 12, "b", 2, "c2", None, "s2", None), ("p", 13, "X", 3, "c3", None, "s3", None), ("p", 14, "Y", 4, "c4", None, None, None), ("p", 15, "E", 9, "c9", None, "s9", None), ("p", 16, "a", 1, "c1", None, "s1", None)]
    out = recovery.sequential_diff(spark.createDataFrame(old, kind), spark.createDataFrame(new, kind))
    assert {(r.old_id, r.new_id, r.change) for r in out.collect()} == {(1, 11, "unchanged"), (2, 12, "case_changed"), (3, 13, "renamed"), (None, 14, "added"), (5, 15, "checksum_changed"), (None, 16, "added"), (4, None, "removed")}


def test_recovered_headers(spark):
    header, body = b"NES\x1a" + RNG.randbytes(12), RNG.randbytes(300)
    edited = bytearray(header)
    edited[6] ^= 0x40
    edited[9] ^= 0x01
    four = bytearray(header)
    for p in (4, 8, 11, 15):
        four[p] ^= 0x7F
    lost = bytes(16)
    rows = [(k, header, body, f"{zlib.crc32(bytes(h) + body):08x}", hashlib.sha1(bytes(h) + body).hexdigest()) for k, h in ((1, header), (2, edited), (3, four), (4, lost))]
    df = spark.createDataFrame(rows, "target_id long, header binary, body binary, crc32 string, sha1 string")
    out = {r.target_id: (bytes(r.header), r.method) for r in recovery.recovered_headers(df, 2, four=True).collect()}
    assert out == {1: (header, "reused"), 2: (bytes(edited), "few_bytes"), 3: (bytes(four), "four_bytes")}


def test_one_per_family(spark):
    kind = "root string, name string, region string, revision string, available boolean, has_achievements boolean"
    rows = [("r", "r (Japan)", "Japan", "", True, True), ("r", "r (USA)", "USA", "", True, True), ("r", "r (USA) (Rev 1)", "USA", "1", True, True), ("r", "r (USA) (Rev 10)", "USA", "10", False, True), ("q", "q (Korea)", "Korea", "", True, False), ("q", "q (Japan, USA)", "Japan, USA", "", True, False)]
    out = reports.one_per_family(spark.createDataFrame(rows, kind), ["USA", "Japan"])
    assert {r.name for r in out.collect()} == {"r (USA) (Rev 1)", "q (Japan, USA)"}


def test_package_members(spark):
    members = spark.createDataFrame([(1, 1, "b"), (1, 2, "A"), (2, 3, "c"), (2, 4, "d")], "game_id long, target_id long, name string")
    valid = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "target_id long, object_id long")
    out = reports.package_members(members, valid)
    assert [(r.ordinal, r.name, r.object_id) for r in out.orderBy("ordinal").collect()] == [(0, "A", 20), (1, "b", 10)]


def test_roots(spark):
    rows = [(k, k - 1 if k % 40 else None) for k in range(200)] + [(500, 999)]
    out = {r.id: (r.root, r.depth) for r in lineage.roots(spark.createDataFrame(rows, "id long, parent long")).collect()}
    assert out[39] == (0, 39) and out[41] == (40, 1) and out[500] == (500, 0)


def test_achievement_report(spark, tmp_path):
    c = Catalog(spark, str(tmp_path / "r"))
    add = lambda name, rows, cols: c.append(name, spark.createDataFrame(rows, cols))
    add("ra_snapshots", [(1,)], "id long")
    add("ra_games", [(1, k, f"G{k}", "Official", k % 5) for k in range(1, 6)], "snapshot_id long, ra_game_id long, title string, category string, num_achievements long")
    add("ra_hashes", [(1, f"m{k}", k) for k in range(1, 6)], "snapshot_id long, md5 string, ra_game_id long")
    add("rom_ra_hashes", [(1, "m1")], "rom_id long, ra_md5 string")
    add("dat_sets", [(1,)], "id long")
    add("dat_games", [(1, 1)], "id long, dat_set_id long")
    add("dat_roms", [(1, 1, 5, "m2"), (2, 1, 5, "m1")], "id long, dat_game_id long, size long, md5 string")
    out = {r.ra_game_id: r.status for r in reports.achievement_games(c, spark.createDataFrame([("m3",), ("m1",)], "md5 string")).collect()}
    assert out == {1: "local", 2: "dat_only", 3: "local_other_platform", 4: "unmatched"}
    total = reports.achievement_summary(reports.achievement_games(c)).where("category is null").collect()
    assert sum(r.games for r in total) == 4
