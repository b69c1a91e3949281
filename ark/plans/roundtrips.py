"""Sources, sinks, storage and link operators: what was written, stored or built is read back and equals plain SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import Catalog
from ..functions import titles
from ..functions.expressions import category, safe_name
from ..operators import deltas, experiments, exporting, importing, records, recovery, release, reports, storage
from ..schemas import REFERENCES, SCHEMAS
from ..shared import fresh_path, stored
from ..sources import files, lists
from .images import images
from .registry import Tables, query
from .sample import ROWS, Sample, oracle
from .view_queries import _HASHES, with_tables


def local(path: str) -> str:
    return path.removeprefix("file://")


def pick(n: int, key: str, *values: str) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.col(key) % n + 1).cast("int"))


# Published lists -------------------------------------------------------------------------------------------


def _xml_folder(t: Tables) -> str:
    """A reference list for each brand."""
    k = F.col("p_partkey")
    rom = F.concat(F.lit('<rom name="r'), k, F.lit('.bin" size="00'), "p_size", F.lit('" crc="'), F.lpad(F.hex(k), 8, "0"), F.lit('" md5="'), F.upper(F.md5("p_name")), F.lit('"'), F.when(k % 9 == 0, ' status="nodump"').otherwise(""), F.lit("/>"))
    game = F.concat(F.lit('<game name="'), "p_name", F.lit(" "), k, F.lit('"'), F.when(k % 2 == 0, F.concat(F.lit(' cloneof="c'), k, F.lit('"'))).otherwise(""), F.lit(">"), rom, F.lit("</game>"))
    head = F.concat(F.lit('<?xml version="1.0"?><datafile><header><name>'), "p_brand", F.lit(" (Headerless)</name><version>1</version></header>"))
    texts = t.part.groupBy("p_brand").agg(F.array_join(F.collect_list(game), "").alias("g")).select("p_brand", F.concat(head, "g", F.lit("</datafile>")).alias("value"))
    folder = fresh_path(t.spark, "xml")
    texts.write.partitionBy("p_brand").text(folder)
    return f"{folder}/*"


@query("""SELECT p_name || ' ' || p_partkey AS game, 'r' || p_partkey || '.bin' AS name, p_size::BIGINT AS size, printf('%08x', p_partkey) AS crc32, md5(p_name) AS md5, CASE WHEN p_partkey % 9 = 0 THEN 'nodump' END AS status, '' AS faults FROM part""")
def xml_lists(t: Tables) -> DataFrame:
    return lists.reference_list(t.spark, _xml_folder(t))["roms"].select("game", "name", "size", "crc32", "md5", "status", F.array_join("faults", ",").alias("faults"))


@query("""SELECT DISTINCT p_brand || ' (Headerless)' AS name, '1' AS version, 'headerless' AS mode, 'nes_after_header' AS scope, '' AS faults FROM part""")
def xml_sets(t: Tables) -> DataFrame:
    return lists.reference_list(t.spark, _xml_folder(t))["sets"].select("name", "version", "mode", "scope", F.array_join("faults", ",").alias("faults"))


def _exports(t: Tables) -> DataFrame:
    k = F.col("p_partkey").cast("string")
    text = F.concat(F.lit('<?xml version="1.0"?><header><version>1</version></header><datafile><game name="'), "p_name", F.lit('"><archive number="'), k, F.lit('" clone="P"/><source><details id="s'), k, F.lit('"/><serials pcb_serial="S'), k,
                    F.lit('"/><file id="f'), k, F.lit('" size="'), "p_size", F.lit('" md5="'), F.upper(F.md5("p_name")), F.lit('"/></source><release><details id="r'), k, F.lit('"/></release></game></datafile>'))
    return t.part.select(k.alias("file"), F.when(F.col("p_partkey") % 50 == 0, "<broken").when(F.col("p_partkey") % 50 == 1, "<!ENTITY a>").otherwise(text).alias("value"))


@query("""SELECT p_partkey::VARCHAR AS file, CASE WHEN p_partkey % 50 > 1 THEN kind END AS kind, CASE WHEN p_partkey % 50 > 1 THEN p_partkey::VARCHAR END AS archive_id, CASE WHEN p_partkey % 50 > 1 THEN p_name END AS title, CASE WHEN p_partkey % 50 > 1 THEN kind[1] || p_partkey END AS source_id,
CASE WHEN p_partkey % 50 > 1 AND kind = 'source' THEN 'S' || p_partkey END AS pcb, p_partkey % 50 < 2 AS broken FROM part, (VALUES ('source'), ('release')) v(kind) WHERE p_partkey % 50 > 1 OR kind = 'source'""")
def export_records(t: Tables) -> DataFrame:
    """Broken files and entity declarations give one row with a fault."""
    return lists.export_records(_exports(t)).select("file", "kind", "archive_id", "title", "source_id", F.col("serials")["pcb_serial"].alias("pcb"), F.col("fault").isNotNull().alias("broken"))


@query("""SELECT p_partkey::VARCHAR AS archive_id, 's' || p_partkey AS source_id, 'f' || p_partkey AS file_id, p_size::BIGINT AS size, md5(p_name) AS md5, '' AS faults FROM part WHERE p_partkey % 50 > 1""")
def export_file_rows(t: Tables) -> DataFrame:
    return lists.export_files(lists.export_records(_exports(t))).select("archive_id", "source_id", "file_id", "size", "md5", F.array_join("faults", ",").alias("faults"))


@query("""SELECT p_partkey::VARCHAR AS "ID", p_name AS "Name", (['verified', 'trusted_unverified', 'unverified', 'bad', 'no_dump', 'unknown'])[p_partkey % 6 + 1] AS state, CASE p_partkey % 6 WHEN 0 THEN 2 WHEN 1 THEN 1 END AS trusted,
CASE WHEN p_partkey % 6 = 4 THEN 0 ELSE 1 + p_partkey % 2 END AS n_parts, CASE WHEN p_partkey % 6 <> 4 THEN md5(p_name) END AS first_md5, '' AS faults FROM part""")
def dump_log_rows(t: Tables) -> DataFrame:
    status = pick(6, "p_partkey", "Trusted (2) (Verified)", "Trusted (1) (Not Verified)", "Not verified", "Bad", "No dump", "Odd")
    two = lambda c: F.when(F.col("p_partkey") % 2 == 1, F.concat(c, F.lit("-"), c)).otherwise(c)
    none = F.col("p_partkey") % 6 == 4
    rows = t.part.select(F.col("p_partkey").alias("ID"), F.col("p_name").alias("Name"), F.when(none, "!no_file").otherwise(two(F.col("p_size").cast("string"))).alias("Size"), F.when(none, "!no_file").otherwise(two(F.upper(F.md5("p_name")))).alias("MD5"), status.alias("Status"), F.col("p_brand").alias("PCB Sn"))
    folder = fresh_path(t.spark, "log")
    rows.write.option("header", True).option("sep", ";").option("quoteAll", True).csv(folder)
    return lists.dump_log(t.spark, folder).select("ID", "Name", "state", "trusted", F.size("parts").alias("n_parts"), F.get("parts", F.lit(0))["md5"].alias("first_md5"), F.array_join("faults", ",").alias("faults"))


@query("""SELECT row_number() OVER (ORDER BY c_custkey) + 1 AS "row", 'Game ' || c_custkey || ', one' AS name_en, '名' || c_custkey AS name_cn FROM customer""")
def names_csv(t: Tables) -> DataFrame:
    folder = fresh_path(t.spark, "names")
    t.customer.select("c_custkey", F.concat(F.lit("Game "), "c_custkey", F.lit(", one")).alias("Name EN"), F.concat(F.lit("名"), "c_custkey").alias("Name CN")).repartition(1).sortWithinPartitions("c_custkey").drop("c_custkey").write.option("header", True).csv(folder)
    return lists.names_list(t.spark, folder)


def _achievements(t: Tables) -> tuple[DataFrame, DataFrame]:
    k = F.col("p_partkey")
    game = F.struct(k.alias("ID"), F.when(k % 5 == 0, F.concat(F.lit("~Hack~ "), "p_name")).otherwise(F.col("p_name")).alias("Title"), F.lit(7).alias("ConsoleID"), F.when(k % 3 > 0, k % 3).alias("NumAchievements"), F.array(F.upper(F.md5(k.cast("string"))), F.md5(k.cast("string"))).alias("Hashes"))
    folder = fresh_path(t.spark, "achievements")
    t.part.groupBy("p_brand").agg(F.to_json(F.collect_list(game)).alias("value")).write.partitionBy("p_brand").text(folder)
    return lists.achievement_games(t.spark, f"{folder}/*", 7)


@query("""SELECT p_partkey AS game_id, CASE WHEN p_partkey % 5 = 0 THEN '~Hack~ ' ELSE '' END || p_name AS title, CASE WHEN p_partkey % 5 = 0 THEN 'Hack' ELSE 'Official' END AS category, p_partkey % 3 AS achievements FROM part""")
def achievements_json(t: Tables) -> DataFrame:
    return _achievements(t)[0].select("game_id", "title", "category", F.col("achievements").cast("long").alias("achievements"))


@query("""SELECT p_partkey AS game_id, md5(p_partkey::VARCHAR) AS hash FROM part""")
def achievement_hashes(t: Tables) -> DataFrame:
    """Each hash once, in lower case."""
    return _achievements(t)[1].select("game_id", "hash")


# Files and archives ----------------------------------------------------------------------------------------


def _plans(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_nationkey").cast("long").alias("plan_id"), F.concat(F.lit("F"), "c_custkey", F.lit(".txt")).alias("name"), F.col("c_name").cast("binary").alias("content"))


def _write_zips(t: Tables, folder: str) -> DataFrame:
    zips = files.archive_bytes(_plans(t)).select(F.concat(F.lit("d/"), "plan_id", F.lit(".zip")).alias("name"), F.col("data").alias("content"), "sha256")
    return stored(files.export_files(stored(zips, "zips"), local(folder)), "written")


@query("""SELECT c_nationkey || '.zip' AS archive, 'F' || c_custkey || '.txt' AS name, row_number() OVER (PARTITION BY c_nationkey ORDER BY 'f' || c_custkey || '.txt') - 1 AS member_index, 8 AS method, sha256(c_name) AS sha256, NULL::VARCHAR AS fault FROM customer""")
def zip_members(t: Tables) -> DataFrame:
    """Canonical archives are written, found again, unpacked and checked."""
    folder = fresh_path(t.spark, "archives")
    _write_zips(t, folder)
    out = files.members(t.spark, folder)
    return out.select(F.substring_index("path", "/", -1).alias("archive"), "name", F.col("member_index").cast("long").alias("member_index"), "method", F.sha2("content", 256).alias("sha256"), "fault")


@query("""SELECT 'd/' || n || '.zip' AS name, 'written' AS first_status, 'present' AS second_status FROM (SELECT DISTINCT c_nationkey AS n FROM customer)""")
def verified_export(t: Tables) -> DataFrame:
    """The first write makes the files, the second finds them."""
    folder = fresh_path(t.spark, "archives")
    first, second = _write_zips(t, folder), _write_zips(t, folder)
    return first.withColumnRenamed("status", "first_status").join(second.withColumnRenamed("status", "second_status"), "name")


@query("""SELECT c_nationkey::BIGINT AS plan_id FROM customer GROUP BY 1 HAVING count(*) FILTER (c_custkey % 97 = 0) = 0""")
def unchanged_archives(t: Tables) -> DataFrame:
    """Archives whose members are those already known, in any order."""
    listed = t.customer.select(F.col("c_nationkey").cast("string").alias("path"), F.col("c_name").alias("name"), F.md5("c_name").alias("crc32"), "c_custkey")
    known = listed.withColumn("crc32", F.when(F.col("c_custkey") % 97 == 0, "other").otherwise(F.col("crc32")))
    return files.unchanged(listed, known).select(F.col("path").cast("long").alias("plan_id"))


@query("""SELECT coalesce(a.d, b.d) AS stamp, 'DB (' || a.d || ').xml' AS "left", 'Log (' || b.d || ').csv' AS "right" FROM (SELECT strftime(o_orderdate, '%Y%m%d') || '-120000' AS d FROM orders WHERE o_orderkey % 3 < 2 GROUP BY 1) a FULL JOIN (SELECT strftime(o_orderdate, '%Y%m%d') || '-120000' AS d FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1) b ON a.d = b.d""")
def paired_stamps(t: Tables) -> DataFrame:
    """Two kinds of files by the stamp in their names; what has no partner stays."""
    name = lambda where, a, b: t.orders.where(where).select(F.concat(F.lit(a), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(b)).alias("path")).distinct()
    return files.paired(name("o_orderkey % 3 < 2", "DB (", "-120000).xml"), name("o_orderkey % 3 > 0", "Log (", "-120000).csv"))


@query("""SELECT string_agg(n_nationkey || ',' || n_name || chr(10), '' ORDER BY n_nationkey) AS lines FROM (SELECT -1 AS n_nationkey, '' AS n_name WHERE false UNION ALL SELECT n_nationkey, n_name FROM nation)""")
def csv_report(t: Tables) -> DataFrame:
    """A report is one sorted file with a header."""
    folder = fresh_path(t.spark, "report")
    release.write_report(t.nation.select("n_nationkey", "n_name"), folder, ["n_nationkey"])
    return t.spark.read.text(f"{folder}/*.csv", wholetext=True).select(F.regexp_replace("value", "^n_nationkey,n_name\n", "").alias("lines"))


# Storage ---------------------------------------------------------------------------------------------------


def _stored_documents(t: Tables) -> Catalog:
    catalog = Catalog(t.spark, fresh_path(t.spark, "catalog"))
    storage.store(catalog, _contents(t), block=4096, cap=1 << 20)
    return catalog


def _contents(t: Tables) -> DataFrame:
    return t.documents.select(F.coalesce("source", F.lit("")).alias("family"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))


_BYTES = "SELECT DISTINCT sha256(coalesce(text, '')) AS sha256, hex(encode(coalesce(text, ''))) AS h FROM documents"
_BLOCKS = f"SELECT sha256 AS object, o, unhex(substr(h, 1 + 2 * o, 8192)) AS b FROM (SELECT sha256, h, unnest(range(0, len(h) // 2, 4096)) AS o FROM ({_BYTES}))"


@query(f"""SELECT sha256, len(h) // 2 AS size, sha256 AS read_back FROM ({_BYTES})""")
def store_fetch(t: Tables) -> DataFrame:
    """Every content is stored once and given back from its extents, blocks and groups."""
    catalog = _stored_documents(t)
    ids = catalog.objects.select(F.col("id").alias("object_id"), "sha256", "size")
    return ids.join(storage.fetch(catalog, ids), "object_id").select("sha256", "size", F.sha2("content", 256).alias("read_back"))


@query(f"""SELECT sha256(b) AS sha256, octet_length(b)::BIGINT AS size FROM ({_BLOCKS}) GROUP BY b""")
def store_chunks(t: Tables) -> DataFrame:
    """Blocks that several contents share are stored once."""
    return _stored_documents(t).chunks.select(F.lower(F.hex("sha256")).alias("sha256"), "size")


@query(f"""SELECT object AS sha256, count(*)::BIGINT AS blocks, max(o)::BIGINT AS last_offset FROM ({_BLOCKS}) GROUP BY object""")
def store_extents(t: Tables) -> DataFrame:
    catalog = _stored_documents(t)
    runs = catalog.object_chunks.join(catalog.objects.select(F.col("id").alias("object_id"), "sha256"), "object_id")
    return runs.groupBy("sha256").agg(F.sum("repeat").alias("blocks"), F.max(F.col("offset") + (F.col("repeat") - 1) * 4096).alias("last_offset"))


@query(f"""SELECT count(*)::BIGINT AS objects, count(*) FILTER (len(h) > 0)::BIGINT AS placed, 0::BIGINT AS problems, 0::BIGINT AS orphans, 0::BIGINT AS added_again FROM ({_BYTES})""")
def store_audit(t: Tables) -> DataFrame:
    """All objects read back right, each has a place, nothing dangles, and storing again adds nothing."""
    catalog = _stored_documents(t)
    again = storage.store(catalog, _contents(t), block=4096, cap=1 << 20)
    n = lambda df, name: df.agg(F.count("*").alias(name))
    one = n(catalog.objects, "objects").join(n(storage.positions(catalog), "placed"), F.lit(True)).join(n(storage.verify(catalog), "problems"), F.lit(True)).join(n(catalog.audit(), "orphans"), F.lit(True))  # one row each
    return one.withColumn("added_again", F.lit(sum(again.values())).cast("long"))


@query(f"""SELECT (SELECT count(*) FROM ({_BYTES}))::BIGINT AS objects, (SELECT count(DISTINCT b) FROM ({_BLOCKS}))::BIGINT AS blocks, 0::BIGINT AS problems, true AS fewer_groups""")
def store_regroup(t: Tables) -> DataFrame:
    """The same blocks in larger groups: identities stay, and all objects read back."""
    catalog = Catalog(t.spark, fresh_path(t.spark, "catalog"))
    storage.store(catalog, _contents(t), block=4096, cap=1 << 13)
    copy = storage.regroup(catalog, fresh_path(t.spark, "catalog"), cap=1 << 20)
    n = lambda df, name: df.agg(F.count("*").alias(name))
    one = n(copy.objects, "objects").join(n(copy.chunks, "blocks"), F.lit(True)).join(n(storage.verify(copy), "problems"), F.lit(True))  # one row each
    groups = n(copy.compression_groups, "b").join(n(catalog.compression_groups, "a"), F.lit(True)).select((F.col("b") < F.col("a")).alias("fewer_groups"))
    return one.join(groups, F.lit(True))


@query(f"""SELECT name, n FROM (SELECT 'objects' AS name, count(*)::BIGINT AS n FROM ({_BYTES}) UNION ALL SELECT 'object_families', count(*) FROM ({_BYTES}) UNION ALL SELECT 'meta', 1 UNION ALL SELECT unnest(['chunks', 'object_chunks', 'compression_groups', 'solid_group_families']), 0)""")
def catalog_edition(t: Tables) -> DataFrame:
    """A copy for queries only: what identifies stays, payload does not."""
    copy = _stored_documents(t).without_payload(fresh_path(t.spark, "edition"))
    return copy.stats().where(F.col("name").isin("objects", "object_families", "meta", "chunks", "object_chunks", "compression_groups", "solid_group_families"))


@query("""SELECT doc_id, sha256(text) AS sha256 FROM documents""")
def block_deltas(t: Tables) -> DataFrame:
    """Contents alone or as differences to similar ones, decoded."""
    rows = t.documents.select(F.col("doc_id").alias("id"), F.octet_length("text").cast("long").alias("size"), F.col("text").cast("binary").alias("data"))
    return deltas.decode_blocks(stored(deltas.encode_blocks(rows), "deltas")).select(F.col("id").alias("doc_id"), F.sha2("content", 256).alias("sha256"))


@query("""SELECT (CASE WHEN upper(substr(source, 1, 1)) BETWEEN 'A' AND 'Z' THEN upper(substr(source, 1, 1)) ELSE '#' END) || '/' || source || '-' || doc_id || '.txt' AS name, octet_length(encode(text))::BIGINT AS size, sha256(text) AS sha256, 'written' AS status FROM documents""")
def set_export(t: Tables) -> DataFrame:
    """A set from the store as plain files, by first letters, with its manifest."""
    catalog = _stored_documents(t)
    ids = catalog.objects.select(F.col("id").alias("object_id"), "sha256")
    members = t.documents.select(F.col("source").alias("game"), F.concat("source", F.lit("-"), "doc_id", F.lit(".txt")).alias("name"), F.sha2("text", 256).alias("sha256")).join(ids, "sha256").select("game", "name", "object_id")
    return stored(exporting.export_set(catalog, members, local(fresh_path(t.spark, "set")), layout="letter"), "manifest")


@query("""SELECT printf('%05d', s_suppkey) AS title, sha256('x') <> '' AS linked, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END AS left_out FROM supplier WHERE s_suppkey % 2 = 1""")
def import_images(t: Tables) -> DataFrame:
    """Files of one platform come into a catalog with their readings; others are left out; a second import adds nothing."""
    catalog = Catalog(t.spark, fresh_path(t.spark, "catalog"))
    found = images(t.supplier, "s_suppkey", "snes")
    ends = F.when(F.col("path") % 2 == 1, ".sfc").otherwise(".txt")
    rows = found.select(F.concat(F.lit("/in/"), "path", ends).alias("path"), F.lit(-1).alias("member_index"), F.concat("path", ends).alias("name"), F.crc32("content").cast("string").alias("crc32"), F.lit(0).alias("method"), F.lit(0).alias("flags"), "content", F.lit(None).cast("string").alias("fault"))
    for day in ("2024-01-01", "2024-01-02"):
        importing.import_files(catalog, rows, "snes", day)
    roms = catalog.roms.select(F.col("id").alias("rom_id")).join(catalog.snes_hardware, "rom_id").join(catalog.rom_ra_hashes.select("rom_id", "ra_md5"), "rom_id")
    return roms.select(F.substring("title", 7, 5).alias("title"), F.col("ra_md5").isNotNull().alias("linked"), F.lit(0).alias("left_out"))


# Experiments -----------------------------------------------------------------------------------------------


@query("\nUNION ALL ".join(f"SELECT {b} AS block, {c} AS cap, count(DISTINCT b)::BIGINT AS unique_blocks FROM ({_BLOCKS.replace('8192', str(2 * b)).replace('4096', str(b))})" for b in (2048, 4096) for c in (65536, 262144)))
def block_cap_grid(t: Tables) -> DataFrame:
    """The unique blocks of each setting; the grid also has groups and stored bytes, which depend on the encoder."""
    rows = t.documents.select(F.coalesce("source", F.lit("")).alias("family"), F.col("doc_id").alias("object_id"), F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    return experiments.grid(rows, [2048, 4096], [65536, 262144]).select("block", "cap", F.col("unique_blocks").cast("long").alias("unique_blocks"))


@query("""SELECT p_partkey AS block, p_size AS cap, total FROM (SELECT p_partkey, p_size, CAST(100000 + 10 * p_size AS BIGINT) AS total FROM part) WHERE total <= 1.005 * (SELECT min(100000 + 10 * p_size) FROM part) ORDER BY p_partkey, p_size LIMIT 1""")
def choice_rule(t: Tables) -> DataFrame:
    """The smallest block, then the smallest cap, within half a percent of the best."""
    rows = t.part.select(F.col("p_partkey").alias("block"), F.col("p_size").alias("cap"), (F.lit(100000) + 10 * F.col("p_size")).cast("long").alias("total"))
    return experiments.choose(rows).select("block", "cap", "total")


@query("""SELECT count(DISTINCT source)::BIGINT AS families, count(*)::BIGINT AS members FROM documents WHERE source IN (SELECT source FROM documents)""")
def family_sample(t: Tables) -> DataFrame:
    """A sample as large as the table keeps whole families."""
    rows = t.documents.select(F.col("source").alias("family"), F.col("doc_id").alias("object_id"))
    return experiments.sample_families(rows, 1_000_000).agg(F.count_distinct("family").alias("families"), F.count("*").alias("members"))


# Links -----------------------------------------------------------------------------------------------------


@query("""SELECT p_brand AS pair, CASE WHEN p_partkey % 6 <> 5 THEN p_partkey END AS old_id, CASE WHEN p_partkey % 6 <> 4 THEN p_partkey + 1000000 END AS new_id, (['unchanged', 'case_changed', 'renamed', 'checksum_changed', 'removed', 'added'])[p_partkey % 6 + 1] AS change FROM part""")
def sequential_diffs(t: Tables) -> DataFrame:
    """Lists compared in order: each old entry is taken once, by name or else by its digests."""
    k = F.col("p_partkey")
    name = F.concat(F.lit("part "), k)
    sums = lambda salt: [F.lit(1).cast("long").alias("size"), F.md5(F.concat(k, salt)).alias("crc32"), F.lit(None).cast("string").alias("md5"), F.sha1(F.concat(k, salt)).alias("sha1"), F.lit(None).cast("string").alias("sha256")]
    old = t.part.where(k % 6 != 5).select(F.col("p_brand").alias("pair"), k.alias("id"), name.alias("name"), *sums(F.lit("")))
    renamed = F.when(k % 6 == 1, F.upper(name)).when(k % 6 == 2, F.concat(name, F.lit(" new"))).otherwise(name)
    new = t.part.where(k % 6 != 4).select(F.col("p_brand").alias("pair"), (k + 1000000).alias("id"), renamed.alias("name"), *sums(F.when(k % 6 == 3, "!").otherwise("")))
    return recovery.sequential_diff(old, new)


@query("""SELECT 'h' || p_partkey AS headered_id, (['verified', 'mismatch', 'body_unavailable', 'no_header'])[p_partkey % 4 + 1] AS status FROM part""")
def header_pairs(t: Tables) -> DataFrame:
    """Does a known header before a body give the published CRC? No body is read."""
    n, head, body = F.col("p_partkey") % 4, F.lit(b"NES\x1a............"), F.col("p_name").cast("binary")
    crc = lambda c: F.lpad(F.hex(F.crc32(c)), 8, "0")
    rows = t.part.select(F.concat(F.lit("h"), "p_partkey").alias("headered_id"), F.concat(F.lit("b"), "p_partkey").alias("headerless_id"), F.when(n != 3, head).alias("header"), F.when(n != 2, crc(body)).alias("body_crc32"),
                         F.when(n != 2, F.octet_length(body)).cast("long").alias("body_size"), F.when(n == 1, "00000000").otherwise(crc(F.concat(head, body))).alias("crc32"))
    return recovery.pair_checks(rows).select("headered_id", "status")


@query("""SELECT n_nationkey::BIGINT AS target_id, CASE n_nationkey % 2 WHEN 0 THEN '4E45531A2E2E2E2E2E2E2E2E2E2E2E2E' ELSE '4E45531A2E2E' || '6E' || '2E2E' || '2F' || '2E2E2E2E2E2E' END AS header, CASE n_nationkey % 2 WHEN 0 THEN 'reused' ELSE 'few_bytes' END AS method FROM nation""")
def header_recovery(t: Tables) -> DataFrame:
    """Headers that differ from a known one in two bytes are found from the published CRC and settled by the SHA-1."""
    head, body = F.lit(b"NES\x1a............"), F.col("n_name").cast("binary")
    real = F.when(F.col("n_nationkey") % 2 == 0, head).otherwise(F.lit(b"NES\x1a..\x6e..\x2f......"))
    rows = t.nation.select(F.col("n_nationkey").cast("long").alias("target_id"), head.alias("header"), body.alias("body"), F.lpad(F.hex(F.crc32(F.concat(real, body))), 8, "0").alias("crc32"), F.sha1(F.concat(real, body)).alias("sha1"))
    return recovery.recovered_headers(rows, 2).select("target_id", F.hex("header").alias("header"), "method")


def _games(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.part.select(k.alias("id"), F.concat(F.lit("P"), k, F.lit(" (USA)")).alias("name"), F.when(k % 4 > 0, F.concat(F.lit("P"), k - k % 4, F.lit(" (USA)"))).alias("cloneof"))


@query("""SELECT p_partkey AS dat_game_id, 'P' || p_partkey || ' (USA)' AS release, 'P' || (p_partkey - p_partkey % 4) AS game FROM part""")
def built_records(t: Tables) -> DataFrame:
    """One game for each root, one release for each name."""
    made = records.build_records(_games(t), 7)
    releases = made["releases"].select(F.col("id").alias("release_id"), "game_id", F.col("title").alias("release"))
    return made["release_dat_games"].join(releases, "release_id").join(made["games"].select(F.col("id").alias("game_id"), F.col("title").alias("game")), "game_id").select("dat_game_id", "release", "game")


@query("""SELECT p_partkey + 1000000 AS dat_game_id, CASE WHEN p_partkey % 5 = 0 THEN 'diff' WHEN p_partkey % 5 = 1 THEN 'root' WHEN p_partkey % 5 = 2 THEN 'new' ELSE 'name' END AS basis, CASE WHEN p_partkey % 5 IN (0, 3, 4) THEN 'P' || p_partkey || ' (USA)' END AS release FROM part""")
def extended_records(t: Tables) -> DataFrame:
    """Another list's entries join what is there: by diff, by name, by root; others are new."""
    made, k = records.build_records(_games(t).withColumn("cloneof", F.lit(None).cast("string")), 7), F.col("p_partkey")
    n = k % 5
    name = F.when(n == 0, F.concat(F.lit("moved "), k)).when(n == 1, F.concat(F.lit("P"), k, F.lit(" (Europe)"))).when(n == 2, F.concat(F.lit("own "), k)).otherwise(F.concat(F.lit("P"), k, F.lit(" (USA)")))
    # even ids are a part's entry, odd ones its parent: no key is so large that the two meet
    parents = t.part.where(n == 1).select((2 * k + 1).alias("id"), F.concat(F.lit("P"), k, F.lit(" (USA)")).alias("name"), F.lit(None).cast("string").alias("cloneof"))
    new = t.part.select((2 * k).alias("id"), name.alias("name"), F.when(n == 1, F.concat(F.lit("P"), k, F.lit(" (USA)"))).alias("cloneof")).union(parents)
    changes = t.part.where(n == 0).select(k.alias("old"), (2 * k).alias("new"), F.lit("renamed").alias("change"))
    out = records.linked_entries(new, made["releases"], made["release_dat_games"], 7, changes).where("dat_game_id % 2 = 0").withColumn("dat_game_id", F.shiftright("dat_game_id", 1) + 1000000)
    return out.join(made["releases"].select(F.col("id").alias("release_id"), F.col("title").alias("release")), "release_id", "left").select("dat_game_id", "basis", "release")


@query("""SELECT p_partkey AS object_id, (['new' || p_partkey, 'exp' || p_partkey, 'old' || p_partkey, 'fam' || p_partkey, '~title ' || p_partkey])[p_partkey % 5 + 1] AS family, (['newest_list', 'export', 'list', 'shared_blocks', 'title'])[p_partkey % 5 + 1] AS basis FROM part""")
def object_families(t: Tables) -> DataFrame:
    """By checksum in the newest list, the export and older lists; by shared blocks; by title."""
    k = F.col("p_partkey")
    key, n = F.md5(k.cast("string")), k % 5
    rows = t.part.select((2 * k).alias("object_id"), key.alias("crc32"), F.lit(1).cast("long").alias("size"), F.concat(F.lit("Title "), k, F.lit(" (USA)")).alias("name"))
    listed = lambda where, word: t.part.where(where).select(key.alias("crc32"), F.lit(1).cast("long").alias("size"), F.concat(F.lit(word), k).alias("family"), F.lit(1).cast("long").alias("order"))
    # even ids are the parts, odd ones the objects whose family is known
    own = t.part.where(n == 3).select((2 * k + 1).alias("object_id"), F.concat(F.lit("fam"), k).alias("family"), F.concat(F.lit("b"), k).alias("block"))
    shared = t.part.where(n == 3).select((2 * k).alias("object_id"), F.lit(None).cast("string").alias("family"), F.concat(F.lit("b"), k).alias("block"))
    found = records.families(rows, listed(n == 0, "new"), listed(n <= 1, "exp"), listed(n <= 2, "old"), own.union(shared))
    return found.withColumn("object_id", F.shiftright("object_id", 1))


@query("""SELECT p_partkey::VARCHAR AS path, (['msx1', 'msx2', 'msx2', 'msx1', 'msx2', 'msx1'])[p_partkey % 6 + 1] AS platform, (['list', 'tag', 'curated', 'title', 'blocks', 'default'])[p_partkey % 6 + 1] AS basis FROM part""")
def archive_routes(t: Tables) -> DataFrame:
    """Which of two platforms an archive belongs to, by the strongest evidence."""
    k = F.col("p_partkey")
    n, path, base = k % 6, k.cast("string"), F.concat(F.lit("t"), k)
    rows = t.part.select(path.alias("path"), F.when(n == 1, F.concat(base, F.lit(" (MSX2)"))).otherwise(base).alias("name"), F.md5(path).alias("crc32"))
    sums = t.part.where(n == 0).select(F.md5(path).alias("crc32"), F.lit("msx1").alias("platform"))
    curated = t.part.where(n == 2).select(base.alias("name"), F.lit("msx2").alias("platform"))
    by_title = t.part.where(n == 3).select(base.alias("base"), F.lit("msx1").alias("platform"))
    shares = t.part.where(n >= 4).select(path.alias("path"), F.lit("msx2").alias("platform"), F.when(n == 4, 0.3).otherwise(0.05).alias("share"))
    return records.routes(rows, sums, curated, by_title, shares, "msx1")


@query("""SELECT doc_id AS rom_id, md5(text) AS ra_md5 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)""")
def hash_backfill(t: Tables) -> DataFrame:
    """Hashes of the ROMs that have none yet."""
    roms = t.documents.select(F.col("doc_id").alias("rom_id"), F.lit("gb").alias("platform"), F.lit("valid").alias("parse_status"), F.lit("gb").alias("format"), F.col("text").cast("binary").alias("content"))
    return records.missing_hashes(roms, t.labels.select(F.col("doc_id").alias("rom_id"), F.lit("known").alias("ra_md5")))


@query("""SELECT DISTINCT '/sets/' || source || ' ' || lang AS root_path, CASE WHEN source || ' ' || lang LIKE 'src1%' THEN 'first' WHEN source || ' ' || lang LIKE 'src2%' THEN 'second' ELSE 'other' END AS kind FROM documents""")
def found_collections(t: Tables) -> DataFrame:
    rows = t.documents.select(F.concat(F.lit("/sets/"), "source", F.lit(" "), "lang", F.lit("/"), "doc_id").alias("source_path"))
    return records.collections(rows, {"src1": "first", "src2": "second"})


@query("""SELECT c_custkey, 'new' AS v FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 = 1""")
def upserted(t: Tables) -> DataFrame:
    new = t.customer.where("c_custkey % 3 = 0").select("c_custkey", F.lit("new").alias("v"))
    return records.upsert(t.customer.where("c_custkey % 3 < 2").select("c_custkey", F.col("c_name").alias("v")), new, ["c_custkey"])


@query("""SELECT p_partkey AS file_id, p_partkey + 5 AS target_id, 'Part ' || p_partkey AS canonical_name, CASE WHEN p_partkey % 3 = 1 THEN 'case_only' ELSE 'dat_name' END AS reason FROM part WHERE p_partkey % 3 > 0""")
def naming(t: Tables) -> DataFrame:
    """Matched files whose name is not the published one."""
    k = F.col("p_partkey")
    own = F.when(k % 3 == 0, F.concat(F.lit("d/Part "), k)).when(k % 3 == 1, F.concat(F.lit("d/part "), k)).otherwise("x")
    return release.naming_decisions(t.part.select(k.alias("file_id"), (k + 5).alias("target_id"), own.alias("original_name"), F.concat(F.lit("Part "), k).alias("name")))


@query("""SELECT o_orderstatus AS status, count(*)::BIGINT AS entries, round(100.0 * count(*) / (SELECT count(*) FROM orders), 2)::DOUBLE AS percent FROM orders GROUP BY 1""")
def resolved_summary(t: Tables) -> DataFrame:
    return release.name_summary(t.orders.select(F.col("o_orderstatus").alias("status")))


@query("""SELECT CASE WHEN k = 0 THEN 'missing' WHEN k = 1 THEN 'unique_translation' ELSE 'needs_review' END AS status, count(*)::BIGINT AS n FROM (SELECT o_custkey, count(DISTINCT CASE WHEN o_custkey % 4 > 0 THEN o_orderpriority END) AS k FROM orders GROUP BY 1) GROUP BY 1""")
def name_coverage(t: Tables) -> DataFrame:
    return release.group_coverage(t.orders.select(F.col("o_custkey").alias("game_id"), F.when(F.col("o_custkey") % 4 > 0, F.col("o_orderpriority")).alias("name")))


@query("""SELECT root, name FROM (SELECT c_nationkey::VARCHAR AS root, c_name AS name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal > 0 DESC, c_custkey % 5 > 0 DESC, CASE c_custkey % 3 WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END, length(r) DESC, r DESC, c_name) AS k FROM (SELECT *, (c_custkey % 12)::VARCHAR AS r FROM customer)) WHERE k = 1""")
def best_of_family(t: Tables) -> DataFrame:
    """One variant of each family: available, with achievements, by region, then the latest revision."""
    k = F.col("c_custkey")
    region = F.when(k % 3 == 1, "World, USA").when(k % 3 == 2, "Japan").otherwise("Korea")
    rows = t.customer.select(F.col("c_nationkey").cast("string").alias("root"), F.col("c_name").alias("name"), region.alias("region"), (k % 12).cast("string").alias("revision"), (F.col("c_acctbal") > 0).alias("available"), (k % 5 > 0).alias("has_achievements"))
    return reports.one_per_family(rows, ["USA", "Japan"]).select("root", "name")


@query("""SELECT l_orderkey AS game_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY lower(n), n) - 1 AS ordinal, n AS name, l_linenumber + 100::BIGINT AS object_id FROM (SELECT *, CASE WHEN l_linenumber % 2 = 0 THEN 'a' ELSE 'B' END || l_linenumber AS n, bool_and(l_returnflag <> 'R') OVER (PARTITION BY l_orderkey) AS ok FROM lineitem) WHERE ok""")
def package_rows(t: Tables) -> DataFrame:
    """Games all of whose members have a match, their members in the order of lower-case names."""
    target = F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.monotonically_increasing_id().cast("string"))
    lines = stored(t.lineitem.select(F.col("l_orderkey").alias("game_id"), target.alias("target_id"), F.concat(F.when(F.col("l_linenumber") % 2 == 0, "a").otherwise("B"), "l_linenumber").alias("name"), "l_returnflag", (F.col("l_linenumber") + 100).cast("long").alias("object_id")), "lines")
    out = reports.package_members(lines.select("game_id", "target_id", "name"), lines.where("l_returnflag <> 'R'").select("target_id", "object_id"))
    return out.withColumn("ordinal", F.col("ordinal").cast("long"))


# Catalog ---------------------------------------------------------------------------------------------------


@query(oracle("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS name, {f'(SELECT count(*) FROM {n})' if n in ROWS else '0'}::BIGINT AS n" for n in SCHEMAS) + ")"))
def catalog_stats(t: Tables) -> DataFrame:
    return Sample(t.spark, t.folder).stats()


@query(oracle("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}.{k}' AS \"constraint\", count(*)::BIGINT AS orphans FROM {c} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {q} FROM {p} WHERE {q} IS NOT NULL)" for c, k, p, q in REFERENCES if c in ROWS) + ") WHERE orphans > 0"))
def catalog_audit(t: Tables) -> DataFrame:
    """Every broken reference of the sample catalog."""
    return Sample(t.spark, t.folder).audit()


@query(with_tables(f"""{_HASHES}, of_dat AS (SELECT DISTINCT k.ra_game_id FROM known k, dat_roms m, dat_games g, dat_sets s WHERE m.md5 = k.md5 AND m.size % 8192 <> 512 AND g.id = m.dat_game_id AND s.id = g.dat_set_id),
of_db AS (SELECT DISTINCT k.ra_game_id FROM known k, ni_files f, ni_source_files x, ni_sources s, ni_archives a WHERE f.md5 = k.md5 AND x.snapshot_id = f.snapshot_id AND x.file_id = f.file_id AND s.snapshot_id = x.snapshot_id AND s.kind = x.kind AND s.external_id = x.external_id AND a.snapshot_id = s.snapshot_id AND a.archive_id = s.archive_id),
of_rom AS (SELECT DISTINCT k.ra_game_id FROM known k, rom_ra_hashes x WHERE x.ra_md5 = k.md5)
SELECT g.ra_game_id, g.title, g.category, g.num_achievements, CASE WHEN g.ra_game_id IN (SELECT ra_game_id FROM of_rom) THEN 'local' WHEN g.ra_game_id IN (SELECT ra_game_id FROM of_dat) THEN 'dat_only' WHEN g.ra_game_id IN (SELECT ra_game_id FROM of_db) THEN 'nointro_db_only' ELSE 'unmatched' END AS status
FROM ra_games g, newest WHERE g.snapshot_id = newest.s AND g.num_achievements > 0"""))
def achievement_report(t: Tables) -> DataFrame:
    return reports.achievement_games(Sample(t.spark, t.folder))


# Titles ----------------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, lower(p_name) || ' ' || p_partkey AS base, 'europe,usa' AS regions, 'en,ja' AS languages, CASE WHEN p_partkey % 2 = 0 THEN 'maker ' || p_partkey ELSE '' END AS identity, CASE WHEN p_partkey % 3 = 0 THEN 'beta 2' ELSE 'rev ' || p_partkey END AS version, CASE WHEN p_partkey % 3 = 0 THEN 'beta' ELSE '' END AS stage FROM part""")
def title_evidence(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    name = F.concat(F.upper("p_name"), F.lit("  "), k, F.lit(" (USA, Europe) (En,Ja)"), F.when(k % 2 == 0, F.concat(F.lit(" (Maker "), k, F.lit(")"))).otherwise(""), F.when(k % 3 == 0, " (Beta 2)").otherwise(F.concat(F.lit(" (Rev "), k, F.lit(")"))))
    rows = t.part.select("p_partkey", titles.parsed_title(name).alias("e"))
    return rows.select("p_partkey", "e.base", *[F.array_join(F.col("e")[c], ",").alias(c) for c in ("regions", "languages", "identity", "version", "stage")])


@query("""SELECT p_partkey, p_partkey % 5 = 0 AS safe, CASE p_partkey % 3 WHEN 0 THEN 'Official' WHEN 1 THEN 'Hack' ELSE 'Hack/Demo' END AS category, lower(p_name) AS folded FROM part""")
def name_rules(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    member = F.concat(pick(5, "p_partkey", "a/", "../", "/", "c:", "a//"), "p_name")
    marked = F.concat(pick(3, "p_partkey", "", "~Hack~ ", "~Hack~~Demo~ "), "p_name")
    return t.part.select("p_partkey", safe_name(member).alias("safe"), category(marked).alias("category"), titles.casefold(F.upper("p_name")).alias("folded")).where(k.isNotNull())
