"""Deltas, encodings, reports and the gate."""

from __future__ import annotations

import random

import pytest

from ark.catalog import Catalog
from ark.functions import encodings
from ark.operators import deltas, release
from ark.schemas import SCHEMAS

RNG = random.Random(9)


def test_encodings_come_back():
    base = RNG.randbytes(2000)
    for data in (b"\0" * 500, b"ab" * 400, RNG.randbytes(300), b"x", base[:100] + b"!" + base[101:]):
        codec, packed = encodings.plain(data)
        assert encodings.decode(codec, packed, len(data)) == data
    near = base[:100] + b"!" + base[101:]
    codec, packed = encodings.difference(near, base)
    assert encodings.decode(codec, packed, 2000, base) == near and len(packed) < 100
    assert encodings.plain(b"\7" * 9) == ("fill", b"\7")
    for bad in (lambda: encodings.decode("raw", b"x", 2), lambda: encodings.decode(codec, packed, 2000), lambda: encodings.decode("odd", b"", 0), lambda: encodings.difference(b"a", b"ab")):
        with pytest.raises(ValueError, match="block|base|codec"):
            bad()


def test_similar_blocks_become_differences(spark):
    base = RNG.randbytes(4000)
    rows = [(0, base)] + [(k, base[:k] + bytes([base[k] ^ 1]) + base[k + 1 :]) for k in range(1, 6)] + [(10, RNG.randbytes(4000)), (11, b"\0" * 4000), (12, b"tiny")]
    blocks = spark.createDataFrame([(k, len(d), d) for k, d in rows], "id long, size long, data binary")
    out = deltas.encode_blocks(blocks)
    got = {r.id: r for r in out.collect()}
    assert got[11].codec == "fill" and got[0].base is None and got[10].base is None
    assert any(r.base is not None and len(r.data) < 200 for r in got.values())
    assert {r.id: bytes(r.content) for r in deltas.decode_blocks(out).collect()} == dict(rows)


def test_gate(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "c"))
    catalog.append("platforms", spark.createDataFrame([(1, "nes")], "id long, code string"))
    text = spark.createDataFrame([("hello",)], "value string")
    catalog.append("resources", release.resource("r", "text", text))
    digests = catalog.digests()
    expected = spark.createDataFrame(digests.collect(), digests.schema)
    assert expected.count() == len(SCHEMAS)
    assert release.gate(catalog, expected).count() == 0
    catalog.append("games", spark.createDataFrame([(1, 9, "G")], "id long, platform_id long, title string"))
    catalog.append("resources", spark.createDataFrame([("bad", "text", "x", "0")], SCHEMAS["resources"]))
    assert {tuple(r) for r in release.gate(catalog, expected).collect()} == {("table changed", "games"), ("table changed", "resources"), ("audit", "games.platform_id"), ("resource", "bad")}
    assert {r.subject for r in release.gate(catalog, expected, ["games", "resources"]).collect()} == {"games.platform_id", "bad"}


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k long, v string")
    release.write_report(df, str(tmp_path / "r"), ["k"])
    files = list((tmp_path / "r").glob("*.csv"))
    assert len(files) == 1 and files[0].read_text() == "k,v\n1,a\n2,b\n"
    matches = spark.createDataFrame([(1, 1, "d/A.nes", "a.nes"), (2, 2, "b.nes", "b.nes"), (3, 3, "x", "y")], "file_id long, target_id long, original_name string, name string")
    assert {(r.file_id, r.reason) for r in release.naming_decisions(matches).collect()} == {(1, "case_only"), (3, "dat_name")}
    resolved = spark.createDataFrame([("matched",), ("matched",), ("unmatched",)], "status string")
    assert {r.status: r.percent for r in release.name_summary(resolved).collect()} == {"matched": 66.67, "unmatched": 33.33}
    names = spark.createDataFrame([(1, "x"), (1, "x"), (2, "x"), (2, "y"), (3, None)], "game_id long, name string")
    assert {r.status: r.n for r in release.group_coverage(names).collect()} == {"unique_translation": 1, "needs_review": 1, "missing": 1}
