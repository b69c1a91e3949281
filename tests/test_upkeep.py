"""Parents, compaction, the full audit, and the command line."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from ark.__main__ import main
from ark.catalog import Catalog
from ark.operators import parents, storage, upkeep


def test_compaction_respects_the_limit(spark):
    loose = spark.createDataFrame([("a", k, 40) for k in range(5)] + [("b", 9, 70)], "family string, block long, size long")
    groups = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "b", 30)], "group_id long, family string, size long")
    out = {(r.family, r.block): (r.into, r.group_no, r.offset) for r in upkeep.compaction_plan(loose, groups, 100).collect()}
    assert out[("b", 9)] == (3, 0, 30)  # the newest group has room for all of it
    assert [out[("a", k)] for k in range(5)] == [(None, 0, 0), (None, 0, 40), (None, 1, 0), (None, 1, 40), (None, 2, 0)]


def test_clone_order(spark):
    rows = [(1, "G (USA)", None, True), (2, "G (Europe)", "G (USA)", True), (3, "G (World) (Rev 2)", "G (USA)", True), (4, "G (World) (Rev 10)", "G (USA)", True), (5, "G (Japan)", "G (USA)", False)]
    games = spark.createDataFrame(rows, "id long, name string, cloneof string, available boolean")
    own = spark.createDataFrame([(2, 7), (3, 7), (4, 7), (5, 8)], "game_id long, ra_game_id long")
    assert sorted(tuple(r) for r in parents.selection(games, own).collect()) == [(4, "clone", 7), (5, "clone", 8)]
    assert parents.selection(games, own, clones=False).count() == 0


def test_command_line(spark, tmp_path, capsys):
    folder = str(tmp_path / "c")
    catalog = Catalog(spark, folder)
    storage.store(catalog, spark.createDataFrame([("f", b"abc" * 50), ("f", b"x")], "family string, content binary"), block=64, cap=4096)
    catalog.append("files", catalog.objects.select(F.col("id"), F.col("id").alias("object_id"), F.lit("rom").alias("kind"), F.concat("size", F.lit(".bin")).alias("original_name")))
    assert main([folder, "full-audit"]) == 0 and main([folder, "audit"]) == 0
    capsys.readouterr()
    assert main([folder, "export", "--path", str(tmp_path / "out")]) == 0
    assert json.loads(capsys.readouterr().out) == {"written": 2}
    assert (tmp_path / "out/150.bin").read_bytes() == b"abc" * 50
    assert main([folder, "regroup", "--path", str(tmp_path / "d"), "--cap", "100000"]) == 0
    assert json.loads(capsys.readouterr().out) == {"groups": 1}
    catalog.append("compression_groups", catalog.compression_groups.limit(1).withColumn("sha256", F.unhex(F.lit("00"))).withColumn("id", F.lit(5)))
    assert main([folder, "full-audit"]) == 1
