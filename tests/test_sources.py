"""List and file sources on small synthetic files."""

from __future__ import annotations

import hashlib
import json
import random
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from ark.functions import archives, titles
from ark.functions.expressions import body_hash, category, safe_name
from ark.operators.names import resolve_names
from ark.sources import files, lists


def test_reference_list(spark, tmp_path):
    (tmp_path / "a.xml").write_text("""<?xml version="1.0"?><datafile><header><name>System (Headerless)</name><version>2</version><clrmamepro header="No-Intro_NES.xml"/></header>
<game name="One (USA)" cloneof="One (Japan)"><description>One</description><rom name="one.nes" size="0016" crc="00000001" md5="D41D8CD98F00B204E9800998ECF8427E"/></game>
<machine name="Two"><rom name="t" size="99999999999999999999" crc="zz" status="nodump"/></machine></datafile>""")
    out = lists.reference_list(spark, str(tmp_path / "a.xml"))
    s = out["sets"].collect()[0]
    assert (s.mode, s.scope, s.faults, s.version) == ("headerless", "nes_after_header", [], "2")
    assert {(g.name, g.cloneof) for g in out["games"].collect()} == {("One (USA)", "One (Japan)"), ("Two", None)}
    roms = {r.name: r for r in out["roms"].collect()}
    assert (roms["one.nes"].size, roms["one.nes"].crc32, roms["one.nes"].md5, roms["one.nes"].faults) == (16, "00000001", "d41d8cd98f00b204e9800998ecf8427e", [])
    assert roms["t"].faults == ["size", "crc32"] and roms["t"].size is None


def test_rules_and_entities_are_faults(spark, tmp_path):
    (tmp_path / "b.xml").write_text('<!DOCTYPE d [<!ENTITY x "y">]><datafile><header><name>S</name><clrmamepro header="odd.xml"/></header><game name="g"/></datafile>')
    assert set(lists.reference_list(spark, str(tmp_path / "b.xml"))["sets"].collect()[0].faults) == {"rule", "entities"}


def test_export(spark):
    text = '<?xml version="1.0"?><header><version>1</version></header><datafile><game name="G"><archive number="1" clone="P"/><source><details id="7"/><serials pcb_serial="X"/><file id="f" size="3" crc32="00000001" md5="%s" sha1="%s"/></source><release><details id="8"/><file id="f" size="4" crc32="00000001" md5="%s" sha1="%s"/></release></game></datafile>' % ("a" * 32, "b" * 40, "a" * 32, "b" * 40)
    rows = lists.export_records(spark.createDataFrame([("x", text), ("y", "<broken"), ("z", "<!ENTITY a>")], "file string, value string"))
    found = {(r.file, r.kind, r.archive_id, r.source_id, r.fault is None) for r in rows.collect()}
    assert found == {("x", "source", "1", "7", True), ("x", "release", "1", "8", True), ("y", None, None, None, False), ("z", None, None, None, False)}
    assert [r.faults for r in lists.export_files(rows).collect()] == [["conflict"], ["conflict"]]


def test_dump_log(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text('ID;Name;Size;MD5;Status;PCB Sn\n1;"A";3-4;%s-%s;Trusted (2) (Verified);P\n2;B;!no_file;!no_file;No dump;\n3;C;5;%s;Trusted (1) (Not Verified);\n4;D;5-6;%s;Odd;\n' % ("a" * 32, "B" * 32, "c" * 32, "d" * 32))
    rows = {r.ID: r for r in lists.dump_log(spark, str(path)).collect()}
    assert {k: r.state for k, r in rows.items()} == {"1": "verified", "2": "no_dump", "3": "trusted_unverified", "4": "unknown"}
    assert [(p.size, p.md5) for p in rows["1"].parts] == [(3, "a" * 32), (4, "b" * 32)] and rows["1"].trusted == 2 and rows["2"].parts == []
    assert rows["4"].faults == ["unbalanced", "identity"]
    assert json.loads(rows["1"].serials) == {"PCB Sn": "P"}
    with pytest.raises(Exception, match="unbalanced"):
        lists.dump_log(spark, str(path), strict=True).collect()


def test_names_list(spark, tmp_path):
    path = tmp_path / "names.csv"
    path.write_text("﻿Name EN,Name CN\nOne (USA),一\nTwo,二\n", encoding="utf-8")
    assert [(r.row, r.name_en, r.name_cn) for r in lists.names_list(spark, str(path)).orderBy("row").collect()] == [(2, "One (USA)", "一"), (3, "Two", "二")]
    path.write_text("A,B\nx,y\n")
    with pytest.raises(ValueError, match="columns"):
        lists.names_list(spark, str(path))


def test_achievements(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps([{"ID": 1, "Title": "~Hack~ A", "ConsoleID": 3, "NumAchievements": None, "Hashes": ["AB", "ab", "c"]}, {"ID": 2, "Title": "B", "ConsoleID": 3, "NumAchievements": 5, "Hashes": None}]))
    games, hashes = lists.achievement_games(spark, str(path), 3)
    assert {(g.game_id, g.category, g.achievements) for g in games.collect()} == {(1, "Hack", 0), (2, "Official", 5)}
    assert {(h.hash, h.game_id) for h in hashes.collect()} == {("ab", 1), ("c", 1)}
    with pytest.raises(Exception, match="another console"):
        lists.achievement_games(spark, str(path), 4)[0].collect()


def test_members(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a (20240101-120000).zip", "w") as z:
        z.writestr("x.bin", b"abc")
        z.writestr("../bad", b"no")
    (tmp_path / "b.bin").write_bytes(b"plain")
    (tmp_path / "c.zip").write_bytes(b"not a zip")
    rows = {(r.path.rsplit("/", 1)[1], r.name): r for r in files.members(spark, str(tmp_path)).collect()}
    assert len(rows) == 4
    assert sorted((k[1], None if r.content is None else bytes(r.content), r.fault is None) for k, r in rows.items()) == [("../bad", None, False), ("b.bin", b"plain", True), ("c.zip", None, False), ("x.bin", b"abc", True)]


def test_stamps_and_unchanged(spark):
    left = spark.createDataFrame([("DB (20240101-120000).xml",), ("DB (20240102-120000).xml",)], "path string")
    right = spark.createDataFrame([("Log (20240101-120000).csv",)], "path string")
    assert {(r.stamp, r.right is None) for r in files.paired(left, right).collect()} == {("20240101-120000", False), ("20240102-120000", True)}
    a = spark.createDataFrame([("p", "x", "1"), ("p", "y", "2"), ("q", "x", "1")], "path string, name string, crc32 string")
    b = spark.createDataFrame([("p", "y", "2"), ("p", "x", "1"), ("q", "x", "9")], "path string, name string, crc32 string")
    assert [r.path for r in files.unchanged(a, b).collect()] == ["p"]


def test_canonical_zip(spark, tmp_path):
    members = [("b/two.bin", b"2" * 1000), ("A.bin", b"one"), ("b/", b"")]
    data = archives.canonical_zip(members)
    assert data == archives.canonical_zip(members[::-1])
    path = tmp_path / "z.zip"
    path.write_bytes(data)
    with zipfile.ZipFile(path) as z:
        assert z.namelist() == ["A.bin", "b/two.bin"] and z.testzip() is None
        assert z.comment.startswith(b"TORRENTZIPPED-") and len(z.comment) == 22
        assert z.infolist()[0].date_time == (1996, 12, 24, 23, 32, 0)
        start = z.start_dir
    assert z.comment[14:].decode() == f"{zlib.crc32(data[start : data.rindex(b'PK' + bytes([5, 6]))]):08X}"
    for bad in ([("x", b""), ("X", b"")], [("../x", b"")], []):
        with pytest.raises(ValueError, match="member|case|unsafe|1 to"):
            archives.canonical_zip(bad)
    plans = spark.createDataFrame([(1, n, c) for n, c in members], "plan_id long, name string, content binary")
    row = files.archive_bytes(plans).collect()[0]
    assert bytes(row["data"]) == data and row["sha256"] == hashlib.sha256(data).hexdigest()


def test_export_never_overwrites(spark, tmp_path):
    rows = [("d/a.bin", b"abc", hashlib.sha256(b"abc").hexdigest()), ("b.bin", b"x", "0" * 64), ("../c", b"x", "0" * 64)]
    df = spark.createDataFrame(rows, "name string, content binary, sha256 string")
    assert {r.name: r.status for r in files.export_files(df, str(tmp_path)).collect()} == {"d/a.bin": "written", "b.bin": "corrupt", "../c": "unsafe"}
    assert not (tmp_path / "b.bin").exists()
    assert {r.name: r.status for r in files.export_files(df, str(tmp_path)).collect()}["d/a.bin"] == "present"


def test_crc_algebra():
    rng = random.Random(3)
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(40)), rng.randbytes(rng.randrange(3000))
        assert archives.crc_shift(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


def test_header_search():
    rng = random.Random(4)
    header, body = b"NES\x1a" + rng.randbytes(12), rng.randbytes(500)
    for changed in (1, 2, 3):
        real = bytearray(header)
        for p in rng.sample(range(4, 16), changed):
            real[p] ^= rng.randrange(1, 256)
        found = archives.header_edits(header, zlib.crc32(body), len(body), zlib.crc32(bytes(real) + body), changed)
        assert bytes(real) in set(found)
    real = bytearray(header)
    for p in (4, 7, 9, 15):
        real[p] ^= 0x55
    target = zlib.crc32(bytes(real) + body)
    found = list(archives.header_edits(header, zlib.crc32(body), len(body), target, 4, least=4))
    assert bytes(real) in found
    assert all(zlib.crc32(h + body) == target for h in found)


@pytest.mark.parametrize(("name", "base", "expected"), [
    ("Game (USA, Europe) (Rev 1)", "game", {"regions": ["europe", "usa"], "version": ["rev 1"]}),
    ("Straße (Unl) (Some Maker)", "strasse", {"version": ["unl"], "identity": ["some maker"]}),
    ("A (Beta 2) (1990-xx-xx)", "a", {"version": ["1990-xx-xx", "beta 2"], "stage": ["beta"]}),
    ("B （日本 (x)） (En,Ja)", "b", {"languages": ["en", "ja"], "identity": ["日本 (x)"]}),
    ("C (open", "c (open", {"tags": []}),
    ("D (Bullet-Proof)", "d", {"identity": ["bulletproof"]}),
])
def test_title_evidence(name, base, expected):
    out = titles.parse_title(name)
    assert out["base"] == base
    for k, v in expected.items():
        assert out[k] == v


def test_resolve_names(spark):
    known = [(1, 1, "G (USA)"), (2, 1, "G (Japan)"), (3, 2, "H (USA)"), (4, 3, "H (Japan)"), (5, 4, "K (Vol. 1)"), (6, 5, "L (USA) (Beta)"), (7, 6, "L (USA) (Rev 1)")]
    t = spark.createDataFrame([(r, g, "p", n) for r, g, n in known], "release_id long, game_id long, platform string, title string")
    asked = {1: "g  (usa)", 2: "G", 3: "H", 4: "H (Japan) (Rev 2)", 5: "K", 6: "none", 7: "L (USA) (Beta 2)"}
    e = spark.createDataFrame([(k, "p", n) for k, n in asked.items()], "entry_id long, platform string, name string")
    out = {r.entry_id: (r.status, r.method, r.game_id) for r in resolve_names(e, t).collect()}
    assert out == {1: ("matched", "exact_title", 1), 2: ("matched", "qualified_title", 1), 3: ("ambiguous", "qualified_title", None), 4: ("matched", "qualified_title", 3), 5: ("ambiguous", "normalized_title", None), 6: ("unmatched", "normalized_title", None), 7: ("matched", "qualified_title", 5)}


def test_expressions(spark):
    row = spark.createDataFrame([("~Hack~~Demo~ X", "a/b.bin", b"NES\x1a" + bytes(12) + b"body")], "t string, n string, c binary")
    r = row.select(category(F.col("t")).alias("a"), safe_name(F.col("n")).alias("b"), safe_name(F.lit("/x")).alias("c"), body_hash(F.lit("nes"), F.col("c")).alias("d"), titles.casefold("t").alias("e")).collect()[0]
    assert (r.a, r.b, r.c, r.d, r.e) == ("Hack/Demo", True, False, hashlib.md5(b"body").hexdigest(), "~hack~~demo~ x")
