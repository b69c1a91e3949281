"""Reports, resources and the gate before a catalog is published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from .audit import changed_tables
from .titles import name_status


def resource(name: str, kind: str, text: DataFrame) -> DataFrame:
    """A resources row from a frame with one ``value`` (such as ``spark.read.text(path, wholetext=True)``)."""
    return text.select(F.lit(name).alias("name"), F.lit(kind).alias("kind"), F.col("value").alias("content"), F.sha2("value", 256).alias("sha256"))


def broken_resources(catalog: Catalog) -> DataFrame:
    return catalog.resources.where(F.sha2("content", 256) != F.col("sha256")).select("name")


def gate(catalog: Catalog, expected: DataFrame, may_change: list[str] | None = None) -> DataFrame:
    """(check, subject) of everything that stands against publishing; empty is good.

    Tables whose digests (name, digest) differ from the expected ones and may not, broken references, payload in an
    edition without, resources that are not what their digests say.
    """
    changed = changed_tables(expected, catalog.digests()).where(~F.col("name").isin(may_change or [""]))
    return (
        changed.select(F.concat(F.lit("table "), "change").alias("check"), F.col("name").alias("subject"))
        .union(catalog.audit().select(F.lit("audit"), "constraint"))
        .union(broken_resources(catalog).select(F.lit("resource"), "name"))
    )


def write_report(df: DataFrame, path: str, order: list[str]) -> None:
    """A sorted CSV with header. Reports are short, so one file; a table that is not short is written as Parquet."""
    df.repartitionByRange(1, *order).sortWithinPartitions(*order).write.mode("overwrite").option("header", True).csv(path)


def naming_decisions(matches: DataFrame) -> DataFrame:
    """(file_id, target_id, canonical_name, reason) of matched files (original_name, name) whose name is not the published one."""
    base = F.regexp_extract("original_name", r"([^/]*)$", 1)
    low = lambda c: F.lower(F.upper(c))
    reason = F.when(low(base) == low(F.col("name")), "case_only").otherwise("dat_name")
    return matches.where(base != F.col("name")).select("file_id", "target_id", F.col("name").alias("canonical_name"), reason.alias("reason"))


def name_summary(resolved: DataFrame) -> DataFrame:
    """(status, entries, percent) of resolved names."""
    n = resolved.groupBy("status").agg(F.count("*").alias("entries"))
    total = n.agg(F.sum("entries").alias("total"))
    return n.join(F.broadcast(total), F.lit(True)).select("status", "entries", F.round(100 * F.col("entries") / F.col("total"), 2).alias("percent"))  # one row


def group_coverage(releases: DataFrame) -> DataFrame:
    """(status, n) of games by how many names their releases (game_id, name) have."""
    return name_status(releases, "game_id", "name").groupBy("status").agg(F.count("*").alias("n"))
