"""From reference lists to catalog records: games, releases, their links, families and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import base_title, body_hash
from .blocks import shared_block_family
from .lineage import first_wins, roots
from .select import cascade
from .storage import id_of


def record_id(*parts: Column) -> Column:
    """An id that follows from what it names, so records built twice are equal."""
    return id_of(F.sha2(F.concat_ws("\x1f", *[p.cast("string") for p in parts]).cast("binary"), 256))


def family_roots(games: DataFrame) -> DataFrame:
    """(name, root) of a list's games (name, cloneof): the last parent that is in the list. Of equal names the last row counts."""
    one = games.groupBy("name").agg(F.max_by("cloneof", "id").alias("cloneof"))
    return roots(one.select(F.col("name").alias("id"), F.col("cloneof").alias("parent"))).select(F.col("id").alias("name"), "root")


def build_records(games: DataFrame, platform_id: int) -> dict[str, DataFrame]:
    """games (one per root), releases (one per name) and release_dat_games of a list given as id, name, cloneof."""
    rooted = games.join(family_roots(games), "name").withColumn("game_id", record_id(F.lit(platform_id), F.col("root"))).withColumn("release_id", record_id(F.lit(platform_id), F.col("root"), F.col("name")))
    return {
        "games": rooted.select(F.col("game_id").alias("id"), F.lit(platform_id).alias("platform_id"), base_title(F.col("root")).alias("title")).dropDuplicates(["id"]),
        "releases": rooted.select(F.col("release_id").alias("id"), "game_id", F.col("name").alias("title")).dropDuplicates(["id"]),
        "release_dat_games": rooted.select("release_id", F.col("id").alias("dat_game_id")).distinct(),
    }


def linked_entries(games: DataFrame, releases: DataFrame, links: DataFrame, platform_id: int, changes: DataFrame | None = None) -> DataFrame:
    """(dat_game_id, release_id, game_id, basis) of another list's entries (id, name, cloneof).

    An entry that a diff (old, new) ties to a linked one keeps its release; one with a release's name joins it; others
    get a release in the game of their root, or in a new game.
    """
    rooted = games.join(family_roots(games), "name")
    kept = rooted.select("id").limit(0).withColumn("kept", F.lit(None).cast("long"))
    if changes is not None:
        kept = changes.where("change <> 'removed'").select(F.col("old").alias("dat_game_id"), F.col("new").alias("id")).join(links, "dat_game_id").groupBy("id").agg(F.min("release_id").alias("kept"))
    named = releases.groupBy(F.col("title").alias("name")).agg(F.min("id").alias("same"))
    at_root = releases.groupBy(F.col("title").alias("root")).agg(F.min("game_id").alias("root_game"))
    game_of = releases.select(F.col("id").alias("release_id"), F.col("game_id").alias("known_game"))
    rows = rooted.join(kept, "id", "left").join(named, "name", "left").join(at_root, "root", "left")
    new_game = F.coalesce("root_game", record_id(F.lit(platform_id), F.col("root")))
    rows = rows.withColumn("release_id", F.coalesce("kept", "same", record_id(F.lit(platform_id), F.col("root"), F.col("name")))).withColumn("new_game", new_game)
    basis = cascade([(F.col("kept").isNotNull(), "diff"), (F.col("same").isNotNull(), "name"), (F.col("root_game").isNotNull(), "root")], "new")
    return rows.join(game_of, "release_id", "left").select(F.col("id").alias("dat_game_id"), "release_id", F.coalesce("known_game", "new_game").alias("game_id"), basis.alias("basis"))


def families(files: DataFrame, newest: DataFrame, exported: DataFrame, older: DataFrame, blocks: DataFrame) -> DataFrame:
    """(object_id, family, basis) of objects: by checksum in the newest list, the export, older lists; then by shared blocks; then by title.

    ``files``: object_id, crc32, size, name; the lists: crc32, size, family, order; ``blocks``: object_id, family, block
    (family null where not known yet).
    """
    keyed = lambda df: df.select(F.concat_ws("/", "crc32", "size").alias("key"), "family", "order")
    index = first_wins([keyed(newest), keyed(exported), keyed(older)], "key", ["family"], "order")
    listed = F.element_at(F.array(*map(F.lit, ("newest_list", "export", "list"))), F.col("source") + 1)
    rows = files.withColumn("key", F.concat_ws("/", "crc32", "size")).join(index.select("key", "family", listed.alias("basis")), "key", "left")
    shared = shared_block_family(blocks, "object_id", "family", "block").where("candidate is not null").select("object_id", F.col("candidate").alias("by_block"))
    title = F.concat(F.lit("~"), F.lower(F.upper(base_title(F.col("name")))))
    rows = rows.join(shared, "object_id", "left")
    basis = F.coalesce("basis", F.when(F.col("by_block").isNotNull(), "shared_blocks"), F.lit("title"))
    return rows.select("object_id", F.coalesce("family", "by_block", title).alias("family"), basis.alias("basis"))


def missing_hashes(roms: DataFrame, known: DataFrame) -> DataFrame:
    """(rom_id, ra_md5) of ROMs (rom_id, platform, parse_status, format, content) that have none yet; auxiliary files get none."""
    fresh = roms.where("format <> 'auxiliary'").join(known.select("rom_id"), "rom_id", "left_anti")
    return fresh.select("rom_id", body_hash(F.col("platform"), F.col("content")).alias("ra_md5"))


def collections(files: DataFrame, known_roots: dict[str, str]) -> DataFrame:
    """(root_path, kind) of the folders that files came from; ``known_roots`` maps a prefix of the folder's name to its kind."""
    folder = F.regexp_replace("source_path", r"/[^/]*$", "")
    name = F.regexp_extract(folder, r"([^/]*)$", 1)
    kind = cascade([(F.startswith(name, F.lit(prefix)), k) for prefix, k in known_roots.items()], "other")
    return files.select(folder.alias("root_path"), kind.alias("kind")).distinct()


def routes(files: DataFrame, checksums: DataFrame, curated: DataFrame, titles: DataFrame, shares: DataFrame, default: str, least: float = 0.1) -> DataFrame:
    """(path, platform, basis) of archives that could belong to two platforms.

    In order: a member is in one platform's list; a tag in the name; the curated table; the title is one platform's only;
    at least a tenth of the blocks are one platform's, and more than the other's; else the default.
    ``files``: path, name, crc32; ``checksums``: crc32, platform; ``curated``: name, platform; ``titles``: base, platform;
    ``shares``: path, platform, share.
    """
    single = lambda df, key, name: df.select(*key, "platform").distinct().groupBy(*key).agg(F.count("*").alias("n"), F.min("platform").alias(name)).where("n = 1").drop("n")
    by_list = single(files.join(checksums, "crc32"), ["path"], "by_list")
    ranked = shares.where(F.col("share") >= least).groupBy("path").agg(F.max("share").alias("share"))
    by_block = single(shares.join(ranked, ["path", "share"]), ["path"], "by_block")
    one = files.groupBy("path").agg(F.min("name").alias("name"))
    tag = F.regexp_extract("name", r"(?i)\[(msx2?)\]|\((msx2?)\)", 0)
    by_tag = F.when(tag != "", F.regexp_replace(F.lower(tag), r"[^a-z0-9]", ""))
    rows = one.withColumn("by_tag", F.when(by_tag == "msx", "msx1").otherwise(by_tag)).withColumn("base", F.lower(base_title(F.col("name"))))
    rows = rows.join(by_list, "path", "left").join(curated.select("name", F.col("platform").alias("by_hand")).dropDuplicates(["name"]), "name", "left")
    rows = rows.join(single(titles, ["base"], "by_title"), "base", "left").join(by_block, "path", "left")
    found = [("by_list", "list"), ("by_tag", "tag"), ("by_hand", "curated"), ("by_title", "title"), ("by_block", "blocks")]
    return rows.select("path", F.coalesce(*[F.col(c) for c, _ in found], F.lit(default)).alias("platform"), cascade([(F.col(c).isNotNull(), b) for c, b in found], "default").alias("basis"))


def upsert(known: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """The new rows, and the known ones whose key they lack: written to a new version of the table, never in place."""
    return new.unionByName(known.join(new.select(*key), key, "left_anti"))
