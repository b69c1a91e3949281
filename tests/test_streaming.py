"""Ingest and windows over streams and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ark.streaming import ingest


def test_appends_only_what_is_new(spark, tmp_path):
    target = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string")
    assert ingest.append_new(first, target, ["k"]) == 2
    assert ingest.append_new(spark.createDataFrame([(2, "z"), (3, "c")], "k long, v string"), target, ["k"]) == 1
    assert {tuple(r) for r in spark.read.parquet(target).collect()} == {(1, "a"), (2, "b"), (3, "c")}


def test_windows_are_equal_for_streams_and_tables(spark, tmp_path):
    rows = spark.range(50).select(F.timestamp_seconds(F.col("id") * 40).alias("ts"), (F.col("id") % 3).alias("k"))
    rows.write.parquet(str(tmp_path / "in"))
    table = {tuple(r) for r in ingest.windowed_counts(rows, "ts", "k", "10 minutes", "1 hour").collect()}
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run = ingest.windowed_counts(stream, "ts", "k", "10 minutes", "1 hour").writeStream.outputMode("complete").format("memory").queryName("windows").trigger(availableNow=True).start()
    run.awaitTermination()
    assert {tuple(r) for r in spark.table("windows").collect()} == table
