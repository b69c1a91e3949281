"""Parents and clones, names worked out anew, audits, compaction, resources: queries with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..operators import parents, storage, upkeep
from ..shared import fresh_path, stored
from ..sources import files
from .registry import Tables, query
from .roundtrips import local, pick
from .sample import Sample
from .view_queries import _TITLED, with_tables

NAMED = "'P' || p_partkey || ' (' || (['USA', 'Japan', 'Europe', 'Korea'])[p_partkey % 4 + 1] || ')' || CASE WHEN p_partkey % 5 = 0 THEN ' (Rev ' || p_partkey % 12 || ')' ELSE '' END"


def _variants(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Families of four, and the achievement games that some of their members have."""
    k = F.col("p_partkey")
    name = lambda k, c: F.concat(F.lit("P"), k, F.lit(" ("), c, F.lit(")"), F.when(k % 5 == 0, F.concat(F.lit(" (Rev "), k % 12, F.lit(")"))).otherwise(""))
    games = t.part.select(k.alias("id"), name(k, pick(4, "p_partkey", "USA", "Japan", "Europe", "Korea")).alias("name"), F.when(k % 4 > 0, name(k - k % 4, F.lit("USA"))).alias("cloneof"), (k % 3 > 0).alias("available"))
    own = t.part.where((k % 4 > 0) | (k % 8 == 0)).select(k.alias("game_id"), (k - k % 4).alias("ra_game_id"))
    return games, own.union(t.part.where(k % 4 == 2).select(k.alias("game_id"), (k + 1000000).alias("ra_game_id")))


@query(f"""WITH g AS (SELECT p_partkey AS id, p_partkey - p_partkey % 4 AS parent, {NAMED} AS name, p_partkey % 3 > 0 AS available, p_partkey % 4 AS place, CASE WHEN p_partkey % 5 = 0 THEN (p_partkey % 12)::VARCHAR ELSE '' END AS rev FROM part),
has AS (SELECT id, parent AS ra FROM g WHERE place > 0 OR id % 8 = 0 UNION ALL SELECT id, id + 1000000 FROM g WHERE place = 2)
SELECT id AS game_id, 'parent' AS role, ra AS ra_game_id FROM g JOIN has USING (id) WHERE place = 0
UNION ALL SELECT id, 'clone', ra FROM (SELECT id, ra, row_number() OVER (PARTITION BY parent, ra ORDER BY available DESC, CASE place WHEN 2 THEN 2 WHEN 1 THEN 3 ELSE 4 END, length(rev) DESC, rev DESC, name) AS k FROM g JOIN has USING (id) WHERE place > 0 AND parent % 8 <> 0) WHERE k = 1""")
def parent_selection(t: Tables) -> DataFrame:
    """Parents with achievements; for the others the best clone for each achievement game."""
    return parents.selection(*_variants(t))


@query("""SELECT CASE WHEN p_partkey % 4 = 0 THEN 'parent' ELSE 'clone' END AS role, count(*)::BIGINT AS n FROM part WHERE p_partkey % 8 = 0 GROUP BY 1""")
def parent_export(t: Tables) -> DataFrame:
    """Parents as canonical archives from the store, a folder for each role; the manifest, by role."""
    catalog = Catalog(t.spark, fresh_path(t.spark, "catalog"))
    content = F.concat(F.lit("content of "), "p_partkey").cast("binary")
    storage.store(catalog, t.part.select(F.col("p_brand").alias("family"), content.alias("content")), block=4096, cap=1 << 20)
    ids = catalog.objects.select(F.col("id").alias("object_id"), "sha256")
    members = t.part.select(F.col("p_partkey").alias("game_id"), F.lit("a.bin").alias("name"), F.sha2(content, 256).alias("sha256")).join(ids, "sha256").drop("sha256")
    games, own = _variants(t)
    manifest = stored(parents.export_parents(catalog, games, members, own, local(fresh_path(t.spark, "parents")), clones=False), "manifest")
    return manifest.where("status = 'written'").groupBy(F.substring_index("name", "/", 1).alias("role")).agg(F.count("*").alias("n"))


@query("""SELECT DISTINCT p_partkey AS game_id, p_partkey + 7 AS ra_game_id FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 3 = 1 AND p_partkey % 2 = 0""")
def headerless_twins(t: Tables) -> DataFrame:
    """A headered game has achievements by its own hashes or by those of its headerless twin."""
    k = F.col("p_partkey")
    members = t.part.select(k.alias("game_id"), F.concat(F.lit("g"), k).alias("name"), F.md5(F.when(k % 3 == 0, k).otherwise(-k).cast("string")).alias("md5"), F.lit(100).cast("long").alias("size"))
    twins = t.part.where((k % 3 == 1) & (k % 2 == 0)).select(F.concat(F.lit("g"), k).alias("name"), F.upper(F.md5(k.cast("string"))).alias("md5"))
    return parents.achievements_of(members, t.part.select(F.md5(k.cast("string")).alias("md5"), (k + 7).alias("ra_game_id")), twins)


@query("""SELECT row_number() OVER (ORDER BY lower(ltrim(f, '~')), f) AS place, f AS family FROM (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN '~' ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS f FROM part)""")
def family_places(t: Tables) -> DataFrame:
    """Families in their order; marks of derived ones and case do not count."""
    from pyspark.sql.window import Window

    k = F.col("p_partkey")
    rows = t.part.select(F.concat(F.when(k % 2 == 0, "~").otherwise(""), F.when(k % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))).alias("family")).distinct()
    return rows.select(F.row_number().over(Window.orderBy(*parents.family_order())).cast("long").alias("place"), "family")


_FOUND = """found AS (SELECT e.id AS entry_id, r.id AS release_id, r.game_id FROM game_name_entries e INNER JOIN game_name_imports i ON i.id = e.import_id LEFT JOIN (SELECT a.*, g.platform_id FROM releases a INNER JOIN games g ON g.id = a.game_id) r ON r.title = e.name_en_original AND r.platform_id = i.platform_id)"""


@query(with_tables(f"{_FOUND} SELECT entry_id, CASE WHEN game_id IS NULL THEN 'unmatched' ELSE 'matched' END AS status, CASE WHEN game_id IS NULL THEN 'normalized_title' ELSE 'exact_title' END AS match_method, game_id FROM found"))
def refreshed_decisions(t: Tables) -> DataFrame:
    return upkeep.refresh_matches(Sample(t.spark, t.folder))[1]


@query(with_tables(f"{_FOUND} SELECT entry_id, 'matched' AS status, 'exact_title' AS match_method, release_id FROM found WHERE game_id IS NOT NULL"))
def refreshed_links(t: Tables) -> DataFrame:
    return upkeep.refresh_matches(Sample(t.spark, t.folder))[0]


@query(with_tables(f"""{_TITLED}, state AS (SELECT e.import_id, e.name_cn_id, e.match_key, n.name_cn, CASE WHEN bool_or(l.status = 'matched') THEN 'matched' WHEN count(l.entry_id) > 0 THEN 'ambiguous' ELSE 'unmatched' END AS s
FROM game_name_entries e LEFT JOIN game_chinese_names n ON n.id = e.name_cn_id LEFT JOIN release_name_links l ON l.entry_id = e.id GROUP BY e.id, e.import_id, e.name_cn_id, e.match_key, n.name_cn)
SELECT i.id AS import_id, i.source_name, (SELECT count(*) FROM state WHERE import_id = i.id) AS "rows", (SELECT count(name_cn_id) FROM state WHERE import_id = i.id AND name_cn IS NOT NULL) AS rows_with_chinese, (SELECT count(DISTINCT name_cn_id) FROM state WHERE import_id = i.id) AS unique_chinese_names, (SELECT count(DISTINCT match_key) FROM state WHERE import_id = i.id) AS normalized_titles,
(SELECT count(*) FROM state WHERE import_id = i.id AND s = 'matched') AS matched_rows, (SELECT count(*) FROM state WHERE import_id = i.id AND s = 'ambiguous') AS ambiguous_rows, (SELECT count(*) FROM state WHERE import_id = i.id AND s = 'unmatched') AS unmatched_rows, (SELECT count(*) FROM state WHERE import_id = i.id AND s = 'matched' AND name_cn IS NOT NULL) AS matched_rows_with_chinese,
(SELECT count(DISTINCT release_id) FROM matched m WHERE m.import_id = i.id) AS matched_releases, (SELECT count(DISTINCT release_id) FROM matched m WHERE m.import_id = i.id AND name_cn IS NOT NULL) AS releases_with_chinese, (SELECT count(DISTINCT game_id) FROM matched m WHERE m.import_id = i.id) AS matched_games, (SELECT count(*) FROM matched m WHERE m.import_id = i.id) AS matched_links,
(SELECT count(DISTINCT rr.rom_id) FROM matched m INNER JOIN rom_releases rr ON rr.release_id = m.release_id WHERE m.import_id = i.id) AS matched_roms, (SELECT count(*) FROM release_name_links l INNER JOIN game_name_entries e ON e.id = l.entry_id WHERE l.status = 'ambiguous' AND e.import_id = i.id) AS ambiguous_links FROM game_name_imports i"""))
def import_counters(t: Tables) -> DataFrame:
    """Fourteen counters of each import of names."""
    return upkeep.import_counts(Sample(t.spark, t.folder))


@query("""SELECT 'plan' AS kind, sha256('text of ' || n_name) AS sha256, 'regenerated archive differs' AS problem FROM nation WHERE n_nationkey % 5 = 0 UNION ALL SELECT 'file', sha256('text of ' || n_name), 'no archive plan' FROM nation WHERE n_nationkey % 5 = 1 UNION ALL SELECT 'group', '', 'different'""")
def audit_findings(t: Tables) -> DataFrame:
    """Archives made anew from the stored members, groups decoded, archives without a plan: what is wrong is found, and nothing else."""
    catalog = Catalog(t.spark, fresh_path(t.spark, "catalog"))
    text, k = F.concat(F.lit("text of "), "n_name").cast("binary"), F.col("n_nationkey")
    storage.store(catalog, t.nation.select(F.lit("f").alias("family"), text.alias("content")), block=4096, cap=1 << 20)
    ids = catalog.objects.select(F.col("id").alias("object_id"), "sha256")
    named = t.nation.select(k.cast("long").alias("k"), text.alias("content"), F.sha2(text, 256).alias("sha256")).join(ids, "sha256")
    made = files.archive_bytes(named.select(F.col("object_id").alias("plan_id"), F.lit("a.bin").alias("name"), "content")).select(F.col("plan_id").alias("object_id"), F.col("sha256").alias("zip"))
    plans = named.where("k % 5 <> 1").join(made, "object_id").select(F.col("object_id").alias("id"), F.when(F.col("k") % 5 == 0, "0").otherwise(F.col("zip")).alias("sha256"))
    catalog.append("archive_plans", plans)
    catalog.append("archive_entries", plans.select(F.col("id").alias("plan_id"), F.lit(0).alias("ordinal"), F.lit("a.bin").alias("name"), F.col("id").alias("object_id")))
    catalog.append("files", named.select(F.col("object_id").alias("id"), "object_id", F.lit("archive").alias("kind")))
    catalog.append("file_archives", plans.select(F.col("id").alias("file_id"), F.col("id").alias("plan_id")))
    bad = catalog.compression_groups.limit(1).select(F.lit(1).alias("id"), "data", "size", F.lit("lzma2-solid").alias("codec"), F.unhex(F.lit("00")).alias("sha256"))  # one group's bytes under another digest
    catalog.append("compression_groups", stored(bad, "bad"))
    found = upkeep.full_audit(catalog).withColumn("object_id", F.when(F.col("kind") != "group", F.col("id").try_cast("long")))
    return found.join(ids, "object_id", "left").select("kind", F.coalesce("sha256", F.lit("")).alias("sha256"), "problem")


@query("""SELECT p_brand AS family, p_partkey AS block, (100 * p_size)::BIGINT AS size, CASE WHEN p_brand < 'Brand#2' THEN 2 END::BIGINT AS "into", 0::BIGINT AS group_no, (CASE WHEN p_brand < 'Brand#2' THEN 1000 ELSE 0 END + coalesce(sum(100 * p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS "offset" FROM part""")
def loose_blocks(t: Tables) -> DataFrame:
    """Loose blocks fill their family's newest group, or make new ones."""
    loose = t.part.select(F.col("p_brand").alias("family"), F.col("p_partkey").alias("block"), (100 * F.col("p_size")).cast("long").alias("size"))
    some = loose.where("family < 'Brand#2'").select("family").distinct()
    groups = some.select(F.lit(2).cast("long").alias("group_id"), "family", F.lit(1000).cast("long").alias("size")).union(some.select(F.lit(1).cast("long"), "family", F.lit(5).cast("long")))
    return upkeep.compaction_plan(loose, groups, 1 << 40)


@query("""SELECT p_partkey, p_size * 10 + 16 * (p_partkey % 9) + 128 < 400 AS keep FROM part""")
def worthwhile_groups(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", (F.col("p_size") * 10).alias("stored"), (F.col("p_partkey") % 9).alias("members"), F.lit(400).alias("before"))
    return upkeep.worth_grouping(rows).select("p_partkey", "keep")


@query("""SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'new' ELSE 'old' END AS kind, sha256(CASE WHEN n_nationkey % 2 = 0 THEN 'b' ELSE 'a' END || n_name) AS sha256 FROM nation""")
def kept_resources(t: Tables) -> DataFrame:
    known = t.nation.select(F.col("n_name").alias("name"), F.lit("old").alias("kind"), F.concat(F.lit("a"), "n_name").alias("content"), F.sha2(F.concat(F.lit("a"), "n_name"), 256).alias("sha256"))
    new = t.nation.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"), F.lit("new").alias("kind"), F.concat(F.lit("b"), "n_name").alias("content"))
    return upkeep.put_resources(known, new).select("name", "kind", "sha256")


@query("""SELECT page_id || '.txt' AS name, CASE WHEN octet_length(encode(html)) <= 2000 THEN 'metadata' ELSE 'too large' END AS kind, octet_length(encode(html))::BIGINT AS size, sha256(html) AS sha256 FROM pages WHERE page_id % 2 = 0""")
def sidecar_files(t: Tables) -> DataFrame:
    """Files beside the archives are kept as metadata; those too large are faults."""
    name = F.concat("page_id", F.when(F.col("page_id") % 2 == 0, ".txt").otherwise(".ZIP"))
    rows = t.pages.select(name.alias("path"), name.alias("name"), F.lit(-1).alias("member_index"), F.col("html").cast("binary").alias("content"))
    return upkeep.sidecars(rows, 2000).select("name", "kind", "size", "sha256")


@query("""SELECT 'k' || n_nationkey AS key, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 'old' END AS "old", n_name AS "new" FROM nation WHERE n_nationkey % 3 < 2""")
def settings(t: Tables) -> DataFrame:
    """Settings that are missing or not as wanted."""
    key = F.concat(F.lit("k"), "n_nationkey").alias("key")
    meta = t.nation.where("n_nationkey % 3 > 0").select(key, F.when(F.col("n_nationkey") % 3 == 1, "old").otherwise(F.col("n_name")).alias("value"))
    return upkeep.settings_changes(meta, t.nation.select(key, F.col("n_name").alias("value")))
