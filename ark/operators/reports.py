"""Coverage reports and the choice of what to export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..catalog import Catalog
from ..plans.views import dat_ra_matches, nointro_ra_matches, ra_latest, rom_ra_matches
from .select import best_per_key, cascade


def achievement_games(catalog: Catalog, siblings: DataFrame | None = None, shared_console: bool = False) -> DataFrame:
    """(ra_game_id, title, category, num_achievements, status) of the latest snapshot's games with achievements.

    local, then dat_only, then nointro_db_only, then unmatched. ``siblings`` (md5 held on other platforms) turns games
    that are not local into local_other_platform; on a shared console these and the unmatched are another's games.
    """
    last = F.broadcast(ra_latest(catalog))
    games = catalog.ra_games.join(last, "snapshot_id", "left_semi").where("num_achievements > 0")
    held = lambda df, name: df.select("ra_game_id").distinct().withColumn(name, F.lit(True))
    rows = games.join(held(rom_ra_matches(catalog), "local"), "ra_game_id", "left").join(held(dat_ra_matches(catalog), "dat"), "ra_game_id", "left").join(held(nointro_ra_matches(catalog), "db"), "ra_game_id", "left")
    other = F.lit(False)
    if siblings is not None:
        hashes = catalog.ra_hashes.join(last, "snapshot_id", "left_semi").join(siblings.select("md5").distinct(), "md5", "left_semi")
        rows, other = rows.join(held(hashes, "sibling"), "ra_game_id", "left"), F.col("sibling")
    status = cascade([(F.col("local"), "local"), (other, "local_other_platform"), (F.col("dat"), "dat_only"), (F.col("db"), "nointro_db_only")], "unmatched")
    out = rows.select("ra_game_id", "title", "category", "num_achievements", status.alias("status"))
    return out.where(~F.col("status").isin("unmatched", "local_other_platform")) if shared_console else out


def achievement_summary(games: DataFrame) -> DataFrame:
    """(category, status, games, achievements), with category null for the totals."""
    return games.rollup("status", "category").agg(F.count("*").alias("games"), F.sum("num_achievements").alias("achievements")).where("status is not null").select("category", "status", "games", "achievements")


def one_per_family(games: DataFrame, regions: list[str], achievements: bool = True) -> DataFrame:
    """The best variant of each family (1G1R).

    ``games``: root, name, region, revision, available, has_achievements. In order: available ones, ones with
    achievements, the regions as given, the longer and then the later revision, the name.
    """
    rank = F.coalesce(*[F.when(F.array_contains(F.transform(F.split("region", ","), lambda r: F.trim(r)), r), F.lit(k)) for k, r in enumerate(regions)], F.lit(len(regions)))
    order: list[Column] = [F.desc("available")]
    if achievements:
        order.append(F.desc("has_achievements"))
    return best_per_key(games, "root", [*order, rank, F.desc(F.length("revision")), F.desc("revision"), F.col("name")])


def package_members(members: DataFrame, validated: DataFrame) -> DataFrame:
    """(game_id, ordinal, name, object_id) of games all of whose members have a match, in the order of lower-case names.

    ``members``: game_id, target_id, name; ``validated``: target_id, object_id.
    """
    rows = members.join(validated.select("target_id", "object_id"), "target_id", "left")
    whole = rows.groupBy("game_id").agg(F.bool_and(F.col("object_id").isNotNull()).alias("ok")).where("ok").select("game_id")
    place = Window.partitionBy("game_id").orderBy(F.lower("name"), "name")
    return rows.join(whole, "game_id", "left_semi").select("game_id", (F.row_number().over(place) - 1).alias("ordinal"), "name", "object_id")
