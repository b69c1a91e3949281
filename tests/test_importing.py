"""Files into a catalog, end to end."""

from __future__ import annotations

import zipfile

from pyspark.sql import functions as F

from ark.catalog import Catalog
from ark.operators import importing, storage
from ark.plans.views import VIEWS
from ark.platforms import PLATFORMS, belongs, cuts
from ark.sources import files
from test_headers import disk_side, snes_image


def test_import(spark, tmp_path):
    rom = snes_image()
    (tmp_path / "in").mkdir()
    with zipfile.ZipFile(tmp_path / "in/Game (USA).zip", "w") as z:
        z.writestr("Game (USA).sfc", rom)
    with zipfile.ZipFile(tmp_path / "in/Copy.zip", "w") as z:
        z.writestr("Game (USA).smc", bytes(512) + rom)
    (tmp_path / "in/Other.bs").write_bytes(b"not mine")
    catalog = Catalog(spark, str(tmp_path / "c"))
    members = files.members(spark, str(tmp_path / "in"))
    first = importing.import_files(catalog, members, "snes", "2024-01-01")
    assert (first["objects"], first["roms"], first["left_out"]) == (2, 2, 1)
    assert catalog.chunks.count() == 9  # eight blocks of the body, shared, and the copier header
    again = importing.import_files(catalog, members, "snes", "2024-01-02")
    assert (again["objects"], again["roms"], catalog.files.count(), catalog.roms.count()) == (0, 0, 2, 2)
    shown = VIEWS["v_snes_headers"](catalog).collect()
    assert {(r.layout, r.game_code, r.checksum_valid) for r in shown} == {("lorom", "ATSE", 1)} and len(shown) == 2
    assert len({r.ra_md5 for r in catalog.rom_ra_hashes.collect()}) == 1
    assert catalog.rom_components.where("kind = 'copier_header'").count() == 1
    assert storage.verify(catalog).count() == 0
    assert len(VIEWS["v_inventory"](catalog).collect()) == 2


def test_cuts_and_names(spark):
    two = disk_side() + disk_side(1)
    df = spark.createDataFrame([(1, two), (2, b"FDS\x1a" + bytes(12) + two)], "k long, c binary")
    assert {r.k: r.x for r in df.select("k", cuts("fds", F.col("c")).alias("x")).collect()} == {1: [0, 65500], 2: [16, 65516]}
    names = spark.createDataFrame([("a.SFC",), ("b.bs",), ("c.txt",)], "n string")
    assert [r.n for r in names.where(belongs("snes", F.col("n"))).collect()] == ["a.SFC"]
    assert len(PLATFORMS) == 23
