"""Work grows with the rows, not with the rows of a group times each other."""

from __future__ import annotations

import lzma
import time

from pyspark.sql import functions as F

from ark.functions import encodings
from ark.operators import titles
from ark.sources import lists


def test_a_response_of_many_games(spark, tmp_path):
    """The digest of a response is taken once, not for each of its games."""
    n = 20_000
    game = F.struct(F.col("id").alias("ID"), F.concat(F.lit("Game "), "id").alias("Title"), F.lit(7).alias("ConsoleID"), F.array(F.upper(F.md5(F.col("id").cast("string"))), F.md5(F.col("id").cast("string"))).alias("Hashes"))
    spark.range(n).agg(F.to_json(F.collect_list(game)).alias("value")).write.text(str(tmp_path / "games"))
    began = time.monotonic()
    games, hashes = lists.achievement_games(spark, str(tmp_path / "games"), 7)
    assert hashes.select("hash").distinct().count() == hashes.count() == n
    assert games.select("snapshot").distinct().count() == 1
    assert time.monotonic() - began < 40


def test_many_small_exports(spark):
    """Records are handed over in batches, not file by file."""
    n = 40_000
    text = F.concat(F.lit('<header/><datafile><game name="g"><archive number="'), "id", F.lit('"/><source><details id="s"/><file id="f'), "id", F.lit('" size="1"/></source></game></datafile>'))
    began = time.monotonic()
    out = lists.export_records(spark.range(0, n, 1, 1).select(F.col("id").cast("string").alias("file"), text.alias("value")))
    assert out.where("archive_id = file and source_id = 's' and files[0]['size'] = '1' and fault is null").count() == n
    assert time.monotonic() - began < 60


def test_exports_are_parsed_once(spark):
    """The digests' check reads the records that are there, and does not parse every file again."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    text = '<header/><datafile><game name="g"><archive number="1"/><source><details id="s"/><file id="f" size="1"/></source></game></datafile>'
    texts = spark.createDataFrame([(str(k), text) for k in range(10)], "file string, value string").mapInPandas(count, "file string, value string")
    assert [r.faults for r in lists.export_files(lists.export_records(texts)).collect()] == [[]] * 10
    assert seen.value == 10


def test_titles_of_one_base(spark):
    """Entries read counts of titles: one base of many titles is not squared."""
    n = 60_000
    name = F.concat(F.lit("Same"), F.when(F.col("id") % 3 == 0, F.concat(F.lit(" (v"), "id", F.lit(")"))).when(F.col("id") % 3 == 1, " (USA)").otherwise(""))
    rows = spark.range(n).select("id", name.alias("name"))
    began = time.monotonic()
    out = titles.resolve(rows.toDF("entry_id", "name"), rows.toDF("game_id", "title")).groupBy("tier", "status", "n_games").count().collect()
    assert {tuple(r) for r in out} == {(0, "matched", 1, n // 3), (0, "ambiguous", n // 3, 2 * n // 3)}
    assert time.monotonic() - began < 60


def test_an_entry_of_several_names(spark):
    """The games of all its names in the best tier count, each once."""
    entries = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A (USA)"), (2, "B (USA)"), (3, "C"), (4, "A"), (4, "A (USA)"), (5, None)], "entry_id long, name string")
    games = spark.createDataFrame([(7, "A"), (7, "B"), (8, "B"), (9, "A (Japan)")], "game_id long, title string")
    out = {(r.entry_id, r.tier, r.status, r.game_id, r.n_games) for r in titles.resolve(entries, games).collect()}
    assert out == {(1, 0, "ambiguous", None, 2), (2, 3, "ambiguous", None, 3), (3, None, "unmatched", None, 0), (4, 0, "matched", 7, 1), (5, None, "unmatched", None, 0)}


def test_small_blocks_take_small_dictionaries():
    """The bytes are those of the preset's own dictionary, without the time to set one of 64 MiB up for each block."""
    blocks = [(f"block {k} " * 400).encode()[: 3000 + k] for k in range(300)]
    began = time.monotonic()
    assert [encodings.decode(c, d, len(b)) for b, (c, d) in zip(blocks, map(encodings.plain, blocks), strict=True)] == blocks
    assert time.monotonic() - began < 5
    coded = [encodings._lzma(b) for b in blocks]
    assert coded[::60] == [lzma.compress(b, lzma.FORMAT_RAW, filters=encodings.FILTERS) for b in blocks[::60]]
    codec, packed = encodings.difference(blocks[9], blocks[9][::-1])
    assert encodings.decode(codec, packed, len(blocks[9]), blocks[9][::-1]) == blocks[9]
    assert [encodings.decode("lzma", c, len(b)) for b, c in zip(blocks, coded, strict=True)] == blocks
    assert encodings.decode("lzma", encodings._lzma(b""), 0) == b""
