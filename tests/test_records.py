"""Records, links, families and routes."""

from __future__ import annotations

from ark.operators import records

GAMES = "id long, name string, cloneof string"


def test_build_and_extend(spark):
    old = spark.createDataFrame([(1, "A (USA)", None), (2, "A (Japan)", "A (USA)"), (3, "B", "gone"), (4, "C", None)], GAMES)
    made = records.build_records(old, 7)
    assert made["games"].count() == 3 and made["releases"].count() == 4 and made["release_dat_games"].count() == 4
    again = records.build_records(old, 7)
    assert {tuple(r) for r in made["releases"].collect()} == {tuple(r) for r in again["releases"].collect()}
    new = spark.createDataFrame([(11, "A (USA)", None), (12, "A (Europe)", "A (USA)"), (13, "C2", None), (14, "D", None)], GAMES)
    changes = spark.createDataFrame([(4, 13, "renamed"), (3, None, "removed")], "old long, new long, change string")
    out = {r.dat_game_id: r for r in records.linked_entries(new, made["releases"], made["release_dat_games"], 7, changes).collect()}
    assert {k: r.basis for k, r in out.items()} == {11: "name", 12: "root", 13: "diff", 14: "new"}
    by_title = {r.title: r for r in made["releases"].collect()}
    assert out[11].release_id == by_title["A (USA)"].id
    assert out[12].game_id == by_title["A (USA)"].game_id
    assert out[13].release_id == by_title["C"].id and out[13].game_id == by_title["C"].game_id


def test_families(spark):
    files = spark.createDataFrame([(1, "c1", 1, "X"), (2, "c2", 2, "X"), (3, "c3", 3, "X"), (4, "c4", 4, "Y"), (5, "c5", 5, "Zed (USA)")], "object_id long, crc32 string, size long, name string")
    lists = lambda rows: spark.createDataFrame(rows, "crc32 string, size long, family string, order long")
    blocks = spark.createDataFrame([(9, "fam", "b1"), (9, "fam", "b2"), (4, None, "b1")], "object_id long, family string, block string")
    out = records.families(files, lists([("c1", 1, "new", 1)]), lists([("c1", 1, "exp", 1), ("c2", 2, "exp", 1)]), lists([("c3", 3, "old", 2), ("c3", 3, "older", 3)]), blocks)
    assert {r.object_id: (r.family, r.basis) for r in out.collect()} == {1: ("new", "newest_list"), 2: ("exp", "export"), 3: ("old", "list"), 4: ("fam", "shared_blocks"), 5: ("~zed", "title")}


def test_routes(spark):
    files = spark.createDataFrame([(p, n, c) for p, n, c in [("1", "a", "x"), ("2", "b (MSX2)", "-"), ("3", "c", "-"), ("4", "d (Japan)", "-"), ("5", "e", "-"), ("6", "f", "-"), ("7", "g", "both"), ("8", "h", "-")]], "path string, name string, crc32 string")
    checksums = spark.createDataFrame([("x", "msx1"), ("both", "msx1"), ("both", "msx2")], "crc32 string, platform string")
    curated = spark.createDataFrame([("c", "msx2")], "name string, platform string")
    titles = spark.createDataFrame([("d", "msx1"), ("e", "msx1"), ("e", "msx2")], "base string, platform string")
    shares = spark.createDataFrame([("5", "msx2", 0.3), ("5", "msx1", 0.2), ("6", "msx1", 0.05), ("8", "msx1", 0.4), ("8", "msx2", 0.4)], "path string, platform string, share double")
    out = {r.path: (r.platform, r.basis) for r in records.routes(files, checksums, curated, titles, shares, "msx1").collect()}
    assert out == {"1": ("msx1", "list"), "2": ("msx2", "tag"), "3": ("msx2", "curated"), "4": ("msx1", "title"), "5": ("msx2", "blocks"), "6": ("msx1", "default"), "7": ("msx1", "default"), "8": ("msx1", "default")}


def test_small_ones(spark):
    files = spark.createDataFrame([("/x/RA set/a.zip",), ("/x/RA set/b.zip",), ("/x/No-Intro A/c.zip",), ("/y/z.zip",)], "source_path string")
    out = records.collections(files, {"RA": "retroachievements", "No-Intro": "nointro"})
    assert {(r.root_path, r.kind) for r in out.collect()} == {("/x/RA set", "retroachievements"), ("/x/No-Intro A", "nointro"), ("/y", "other")}
    roms = spark.createDataFrame([(1, "gb", "gb", b"abc"), (2, "gb", "auxiliary", b"x"), (3, "gb", "gb", b"y")], "rom_id long, platform string, format string, content binary")
    known = spark.createDataFrame([(3, "m")], "rom_id long, ra_md5 string")
    assert [(r.rom_id, r.ra_md5) for r in records.missing_hashes(roms, known).collect()] == [(1, "900150983cd24fb0d6963f7d28e17f72")]
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k long, v string"), spark.createDataFrame([(2, "z"), (3, "w")], "k long, v string")
    assert {tuple(r) for r in records.upsert(a, b, ["k"]).collect()} == {(1, "x"), (2, "z"), (3, "w")}
