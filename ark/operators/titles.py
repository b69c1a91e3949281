"""Titles: structure, tiered resolution, and names that a group hands down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.expressions import base_title, revision, title_tags
from ..shared import stored


def parsed(df: DataFrame, name: str) -> DataFrame:
    """Adds base, tags, region (the first tag's first part) and revision."""
    tags = title_tags(F.col(name))
    first = F.trim(F.split(F.coalesce(F.get(tags, F.lit(0)), F.lit("")), ",")[0])
    return df.withColumns({"base": F.lower(base_title(F.col(name))), "tags": F.array_join(tags, "|"), "region": first, "revision": revision(F.col(name))})


def _keyed(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, base, tier, value) of the titles: what an equal must share to be of that tier, once each."""
    of = lambda tier, value: F.struct(F.lit(tier).alias("tier"), value.alias("value"))
    tiers = F.array(of(0, F.lower(name)), of(1, F.col("tags")), of(2, F.col("region")), of(3, F.lit("")))
    return parsed(df, name).select(key, "base", F.explode(tiers).alias("k")).select(key, "base", "k.tier", "k.value").distinct()


def resolve(entries: DataFrame, titles: DataFrame) -> DataFrame:
    """(entry_id, tier, status, game_id, n_games): the best tier of each entry's candidates.

    ``entries``: entry_id, name; ``titles``: game_id, title. Tier 0 is the exact title, 1 equal base and tags, 2 equal
    base and region, 3 equal base. One game in the best tier is a match, more are ambiguous, none is unmatched.

    Games are counted once for each base, tier and value, and entries read the counts: the first tier that has any
    games has them all, so entries and titles of a common base never meet in pairs. Only an entry_id with several names
    whose best tier has several counts is held against the games themselves.
    """
    keys = ["base", "tier", "value"]
    mine, games = _keyed(entries, "entry_id", "name"), _keyed(titles, "game_id", "title")
    counted = games.groupBy(*keys).agg(F.count_distinct("game_id").alias("n_games"), F.min("game_id").alias("game_id"))
    met = mine.join(counted, keys)
    each = met.groupBy("entry_id", "tier").agg(F.count("*").alias("counts"), F.max("n_games").alias("n_games"), F.min("game_id").alias("game_id"))
    best = each.groupBy("entry_id").agg(F.min(F.struct("tier", "counts", "n_games", "game_id")).alias("b")).select("entry_id", "b.*")
    best = stored(best, "best")  # read twice below
    several = best.where("counts > 1").select("entry_id", "tier").join(mine, ["entry_id", "tier"]).join(games, keys)
    several = several.groupBy("entry_id").agg(F.count_distinct("game_id").alias("all_games"))
    best = best.join(several, "entry_id", "left").select("entry_id", "tier", "game_id", F.coalesce("all_games", "n_games").alias("n_games"))
    status = F.when(F.col("n_games").isNull(), "unmatched").when(F.col("n_games") == 1, "matched").otherwise("ambiguous")
    out = entries.select("entry_id").join(best, "entry_id", "left").withColumn("status", status)
    return out.select("entry_id", "tier", "status", F.when(F.col("status") == "matched", F.col("game_id")).alias("game_id"), F.coalesce("n_games", F.lit(0)).cast("long").alias("n_games"))


def name_status(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, n_names, status): missing, unique_translation or needs_review."""
    n = F.count_distinct(name)
    status = F.when(n == 0, "missing").when(n == 1, "unique_translation").otherwise("needs_review")
    return df.groupBy(key).agg(n.alias("n_names"), status.alias("status"))


def effective_names(members: DataFrame, names: DataFrame, member: str, group: str) -> DataFrame:
    """(member, name, basis): a member's own names, and its group's only name where it has none.

    ``members``: member, group; ``names``: member, name.
    """
    own = names.select(member, "name").distinct()
    direct = own.join(members, member, "left_semi").select(member, "name", F.lit("direct").alias("basis"))
    only = members.join(own, member).groupBy(group).agg(F.count_distinct("name").alias("n"), F.min("name").alias("name")).where("n = 1")
    inherited = members.join(own, member, "left_anti").join(only, group).select(member, "name", F.lit("inherited").alias("basis"))
    return direct.unionByName(inherited)


def alternatives(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, all_values) of the keys with more than one value."""
    return df.select(key, value).distinct().groupBy(key).agg(F.count("*").alias("n"), F.sort_array(F.collect_list(value)).alias("v")).where("n > 1").select(key, "n", F.array_join("v", " | ").alias("all_values"))


def newest_first(df: DataFrame, key: str, version: str, tie: str) -> DataFrame:
    """Adds place: 1 for each key's newest version, the largest id first of equals."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(version), F.desc(tie))))
