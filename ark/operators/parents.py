"""Parents of a list for export: those with achievements, or in their place the clones that have them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions.expressions import revision, title_tags
from .exporting import export_set
from .select import best_per_key

#: Regions in the order in which a clone is preferred; others come last.
PREFERRED = ("USA", "World", "Europe", "Japan")


def achievements_of(members: DataFrame, hashes: DataFrame, twins: DataFrame | None = None) -> DataFrame:
    """(game_id, ra_game_id), once each, of games by their members' MD5s.

    ``members``: game_id, name (of the game), md5, size; copies with a copier header say nothing. ``hashes``: md5,
    ra_game_id. A headered list's games also take the hashes of their headerless ``twins`` (name, md5), by name.
    """
    own = members.where("size % 8192 <> 512").select("game_id", F.lower("md5").alias("md5"))
    if twins is not None:
        named = members.select("game_id", "name").distinct()
        own = own.union(named.join(twins.select("name", F.lower("md5").alias("md5")), "name").select("game_id", "md5"))
    return own.distinct().join(hashes.select(F.lower("md5").alias("md5"), "ra_game_id"), "md5").select("game_id", "ra_game_id").distinct()


def clone_order() -> list[Column]:
    """Clones of one game, best first: available, by region, the longest and then the latest revision, by name."""
    regions = F.transform(F.split(F.get(title_tags(F.col("name")), F.lit(0)), ","), lambda r: F.trim(r))
    rank = F.coalesce(*[F.when(F.array_contains(regions, r), F.lit(k)) for k, r in enumerate(PREFERRED)], F.lit(len(PREFERRED)))
    rev = F.when(F.col("name").contains("(Rev "), revision(F.col("name"))).otherwise("")
    return [F.desc("available"), rank, F.desc(F.length(rev)), F.desc(rev), F.col("name")]


def selection(games: DataFrame, achievements: DataFrame, clones: bool = True) -> DataFrame:
    """(game_id, role, ra_game_id): each parent with achievements; for a parent without any, of each achievement game
    its clones have the best clone. ``games``: id, name, cloneof (null for parents), available."""
    named = games.select(F.col("id").alias("game_id"), "name", "cloneof", "available")
    has = named.join(achievements, "game_id")
    parents = has.where("cloneof is null").select("game_id", "name", F.lit("parent").alias("role"), "ra_game_id")
    if not clones:
        return parents.drop("name")
    bare = named.where("cloneof is null").join(parents.select("game_id").distinct(), "game_id", "left_anti").select(F.col("name").alias("cloneof"))
    each = has.join(bare, "cloneof").withColumn("family", F.struct("cloneof", "ra_game_id"))
    best = best_per_key(each, "family", clone_order()).select("game_id", F.lit("clone").alias("role"), "ra_game_id")
    return parents.drop("name").union(best)


def export_parents(catalog: Catalog, games: DataFrame, members: DataFrame, achievements: DataFrame, folder: str, clones: bool = True) -> DataFrame:
    """The selected games as canonical ZIPs, a folder for each role. ``members``: game_id, name, object_id. Returns the manifest."""
    chosen = selection(games, achievements, clones).select("game_id", "role").distinct()
    titled = chosen.join(games.select(F.col("id").alias("game_id"), F.col("name").alias("title")), "game_id")
    rows = titled.join(members, "game_id").select(F.concat_ws("/", "role", "title").alias("game"), "name", "object_id")
    return export_set(catalog, rows, folder, archives=True)


def family_order(family: str = "family") -> list[Column]:
    """Families by their letters, marks of derived ones aside; equal letters by the whole key."""
    return [F.lower(F.upper(F.ltrim(F.col(family), F.lit("~")))), F.col(family)]
