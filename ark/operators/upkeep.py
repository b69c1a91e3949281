"""Keeping a catalog in order: links worked out anew, import counts, the full audit, loose blocks packed, assets and resources."""

from __future__ import annotations

import hashlib
import lzma
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.archives import canonical_zip
from ..plans import views
from .groups import filters, next_fit
from .names import resolve_names
from .storage import fetch, verify

# Names -----------------------------------------------------------------------------------------------------


def refresh_matches(catalog: Catalog) -> tuple[DataFrame, DataFrame]:
    """(links, decisions) of all stored entries against the releases' titles and the names their list entries have."""
    games = catalog.games.select(F.col("id").alias("game_id"), F.col("platform_id").alias("platform"))
    releases = catalog.releases.select(F.col("id").alias("release_id"), "game_id", "title").join(games, "game_id")
    alias = catalog.release_dat_games.join(catalog.dat_games.select(F.col("id").alias("dat_game_id"), "name"), "dat_game_id").select("release_id", "name")
    titles = releases.select("release_id", "game_id", "platform", "title").union(releases.join(alias, "release_id").select("release_id", "game_id", "platform", "name")).distinct()
    platform = catalog.game_name_imports.select(F.col("id").alias("import_id"), F.col("platform_id").alias("platform"))
    entries = catalog.game_name_entries.join(platform, "import_id").select(F.col("id").alias("entry_id"), "platform", F.col("name_en_original").alias("name"))
    found = resolve_names(entries.withColumn("platform", F.col("platform").cast("string")), titles.withColumn("platform", F.col("platform").cast("string")))
    decisions = found.select("entry_id", "status", F.col("method").alias("match_method"), "game_id")
    links = found.select("entry_id", "status", F.col("method").alias("match_method"), F.explode("release_ids").alias("release_id"))
    return links, decisions


def import_counts(catalog: Catalog) -> DataFrame:
    """One row of counters for each import of names. Every source is reduced to its imports before they meet."""
    status = views.game_name_import_status(catalog).groupBy("import_id").agg(
        F.count("*").alias("rows"), F.count("name_cn_id").alias("rows_with_chinese"), F.count_distinct("name_cn_id").alias("unique_chinese_names"), F.count_distinct("match_key").alias("normalized_titles"),
        *[F.count_if(F.col("status") == s).alias(f"{s}_rows") for s in ("matched", "ambiguous", "unmatched")], F.count_if((F.col("status") == "matched") & F.col("name_cn").isNotNull()).alias("matched_rows_with_chinese"))
    names = views.release_game_names(catalog).groupBy("import_id").agg(
        F.count_distinct("release_id").alias("matched_releases"), F.count_distinct(F.when(F.col("name_cn").isNotNull(), F.col("release_id"))).alias("releases_with_chinese"),
        F.count_distinct("game_id").alias("matched_games"), F.count("*").alias("matched_links"))
    roms = views.rom_game_names(catalog).groupBy("import_id").agg(F.count_distinct("rom_id").alias("matched_roms"))
    of = catalog.game_name_entries.select(F.col("id").alias("entry_id"), "import_id")
    ambiguous = catalog.release_name_links.where("status = 'ambiguous'").join(of, "entry_id").groupBy("import_id").agg(F.count("*").alias("ambiguous_links"))
    out = catalog.game_name_imports.select(F.col("id").alias("import_id"), "source_name")
    for part in (status, names, roms, ambiguous):
        out = out.join(part, "import_id", "left")
    return out.fillna(0)


# Audit -----------------------------------------------------------------------------------------------------


def broken_groups(catalog: Catalog) -> DataFrame:
    """(id, problem) of solid groups whose bytes are not what their digest and size say; each is decoded once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for i, data, size, digest in zip(batch["id"], batch["data"], batch["size"], batch["sha256"], strict=True):
                try:
                    raw = lzma.decompress(bytes(data), lzma.FORMAT_RAW, filters=filters(int(size)))
                    good = len(raw) == size and hashlib.sha256(raw).digest() == bytes(digest)
                    out += [] if good else [(i, "different")]
                except lzma.LZMAError as error:
                    out.append((i, str(error)))
            yield pd.DataFrame(out, columns=["id", "problem"])

    return catalog.compression_groups.where("codec = 'lzma2-solid'").select("id", "data", "size", "sha256").mapInPandas(run, "id long, problem string")


def broken_plans(catalog: Catalog) -> DataFrame:
    """(id, problem) of archive plans whose ZIP, made anew from the stored members, is not the published one."""
    entries = catalog.archive_entries.select("plan_id", "name", "object_id", F.coalesce("is_directory", F.lit(0)).alias("folder"))
    held = fetch(catalog, entries.where("object_id is not null").select("object_id"))
    rows = entries.join(held, "object_id", "left").join(catalog.archive_plans.select(F.col("id").alias("plan_id"), "sha256"), "plan_id")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        plan, lost = group["plan_id"].iloc[0], group["content"].isna() & (group["folder"] == 0)
        if lost.any():
            return pd.DataFrame([(plan, "member missing")], columns=["id", "problem"])
        data = canonical_zip([(n, b"" if d else bytes(c)) for n, c, d in zip(group["name"], group["content"], group["folder"], strict=True)])
        bad = hashlib.sha256(data).hexdigest() != group["sha256"].iloc[0]
        return pd.DataFrame([(plan, "regenerated archive differs")] if bad else [], columns=["id", "problem"])

    return rows.groupBy("plan_id").applyInPandas(run, "id long, problem string")


def full_audit(catalog: Catalog) -> DataFrame:
    """(kind, id, problem) of all that is not in order: references, objects, groups, plans, archives without a plan."""
    kind = lambda df, name, key="id": df.select(F.lit(name).alias("kind"), F.col(key).cast("string").alias("id"), "problem")
    planless = catalog.files.where("kind = 'archive'").join(catalog.file_archives.select(F.col("file_id").alias("id")), "id", "left_anti").withColumn("problem", F.lit("no archive plan"))
    orphans = catalog.audit().withColumn("problem", F.concat("orphans", F.lit(" orphans")))
    parts = [kind(verify(catalog), "object", "object_id"), kind(broken_groups(catalog), "group"), kind(broken_plans(catalog), "plan"), kind(planless, "file"), kind(orphans, "reference", "constraint")]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


# Compaction ------------------------------------------------------------------------------------------------


def worth_grouping(groups: DataFrame) -> DataFrame:
    """Adds keep: is a group (stored, members, before) smaller than its members were, their references counted?"""
    return groups.withColumn("keep", F.col("stored") + 16 * F.col("members") + 128 < F.col("before"))


def compaction_plan(loose: DataFrame, groups: DataFrame, limit: int) -> DataFrame:
    """(family, block, size, into, group_no, offset): where the loose blocks of each family go.

    ``loose``: family, block, size; ``groups``: group_id, family, size. A family's newest group takes all of its
    loose blocks if they fit (into is that group); else they are packed into new groups by next fit. Only sizes move.
    """
    newest = groups.groupBy("family").agg(F.max(F.struct("group_id", F.col("size").alias("held"))).alias("g")).select("family", "g.*")
    total = loose.groupBy("family").agg(F.sum("size").alias("new")).join(newest, "family", "left")
    target = total.select("family", F.when(F.col("held") + F.col("new") <= limit, F.col("group_id")).alias("into"), F.coalesce("held", F.lit(0)).alias("held"))
    kept = target.where("into is not null")
    refill = next_fit(loose.join(kept.select("family"), "family", "left_semi"), "family", "block", "size", limit).join(kept, "family")
    fresh = next_fit(loose.join(kept.select("family"), "family", "left_anti"), "family", "block", "size", limit)
    return refill.select("family", "block", "size", "into", F.lit(0).cast("long").alias("group_no"), (F.col("offset") + F.col("held")).alias("offset")).union(
        fresh.select("family", "block", "size", F.lit(None).cast("long").alias("into"), "group_no", "offset"))


# Resources -------------------------------------------------------------------------------------------------


def put_resources(known: DataFrame, new: DataFrame) -> DataFrame:
    """The resources (name, kind, content, sha256) with the new ones (name, kind, content) in place of their names."""
    new = new.select("name", "kind", "content", F.sha2("content", 256).alias("sha256"))
    return new.unionByName(known.select("name", "kind", "content", "sha256").join(new.select("name"), "name", "left_anti"))


def sidecars(members: DataFrame, largest: int = 64 << 20) -> DataFrame:
    """(path, name, kind, size, sha256) of files beside the archives, kept as metadata; larger ones are faults."""
    size = F.octet_length("content")
    rows = members.where("member_index = -1").where(~F.endswith(F.lower("name"), F.lit(".zip")))
    return rows.select("path", "name", F.when(size <= largest, "metadata").otherwise("too large").alias("kind"), size.cast("long").alias("size"), F.sha2("content", 256).alias("sha256"))


def settings_changes(meta: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, old, new) of the settings (key, value) that are not as wanted; applying them twice changes nothing."""
    both = wanted.select("key", F.col("value").alias("new")).join(meta.select("key", F.col("value").alias("old")), "key", "left")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("key", "old", "new")
