"""Resolving names against titles with full tag evidence, never across games."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.titles import parsed_title, tier
from ..shared import stored


def resolve_names(entries: DataFrame, titles: DataFrame) -> DataFrame:
    """(entry_id, status, method, game_id, release_ids) of each entry.

    ``entries``: entry_id, platform, name; ``titles``: release_id, game_id, platform, title. Among the titles with an
    entry's base the best tier counts. In the third tier regions, then versions and stages, narrow the candidates if
    they can. One game is a match; more are ambiguous, and so are titles whose identity is at odds; none is unmatched.
    """
    e = entries.withColumn("s", parsed_title("name")).select("entry_id", "platform", "name", "s", F.col("s.base").alias("base"))
    t = titles.withColumn("c", parsed_title("title")).select("release_id", "game_id", "platform", "title", "c", F.col("c.base").alias("base"))
    met = e.join(t, ["platform", "base"]).withColumn("tier", tier(F.col("s"), F.col("c"), F.col("name"), F.col("title")))
    shared = F.arrays_overlap("s.regions", "c.regions")
    met = met.select("entry_id", "release_id", "game_id", F.coalesce("tier", F.lit(3)).alias("tier"), F.coalesce(shared, F.lit(False)).alias("near"),
                     (F.col("s.version") == F.col("c.version")).alias("same"), ((F.size("s.stage") > 0) & (F.col("s.stage") == F.col("c.stage"))).alias("staged"))
    met = stored(met, "met")  # read several times below
    best = met.groupBy("entry_id").agg(F.min("tier").alias("tier"))
    kept = _narrow(met.join(best, ["entry_id", "tier"]), "near", always=True)
    kept = _narrow(_narrow(kept, "same"), "staged")
    each = kept.groupBy("entry_id", "tier").agg(F.count_distinct("game_id").alias("games"), F.min("game_id").alias("game_id"), F.sort_array(F.collect_set("release_id")).alias("release_ids"))
    method = F.element_at(F.array(*map(F.lit, ("exact_title", "structured_title", "qualified_title", "normalized_title"))), F.col("tier") + 1)
    one = (F.col("games") == 1) & (F.col("tier") < 3)
    return entries.select("entry_id").join(each, "entry_id", "left").select(
        "entry_id", F.when(F.col("games").isNull(), "unmatched").when(one, "matched").otherwise("ambiguous").alias("status"),
        F.coalesce(method, F.lit("normalized_title")).alias("method"), F.when(one, F.col("game_id")).alias("game_id"), "release_ids")


def _narrow(rows: DataFrame, flag: str, always: bool = False) -> DataFrame:
    """In the third tier keep the flagged candidates of entries that have any; otherwise only where games compete."""
    has = rows.groupBy("entry_id").agg(F.bool_or(flag).alias("__any"), F.count_distinct("game_id").alias("__games"))
    use = F.col("__any") & (F.col("tier") == 2) & (F.lit(always) | (F.col("__games") > 1))
    return rows.join(has, "entry_id").where(~use | F.col(flag)).drop("__any", "__games")
