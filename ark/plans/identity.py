"""Queries on object identity, blocks, groups, storage and audit."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import crc32_hex, hashes, hex_or_zero
from ..operators import audit, blocks, groups, select
from ..shared import fresh_path
from ..streaming import ingest
from .registry import Tables, query


@query("""SELECT doc_id, octet_length(encode(text))::BIGINT AS size, sha256(text) AS sha256, sha1(text) AS sha1, md5(text) AS md5 FROM documents""")
def object_identity(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", *hashes(F.col("text"))).drop("crc32")


@query()
def checksum_crc(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", crc32_hex(F.col("text")).alias("crc32"))


@query("""SELECT sha256(text) AS sha256, count(*)::BIGINT AS n, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1""")
def exact_duplicates(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("sha256")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("""SELECT sha256(substr(text, 17)) AS body, count(*)::BIGINT AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS doc_ids FROM documents GROUP BY 1 HAVING count(*) > 1""")
def variant_groups(t: Tables) -> DataFrame:
    body = F.sha2(F.expr("substr(text, 17)").cast("binary"), 256).alias("body")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("doc_id")), lambda x: x.cast("string")), ",")
    return t.documents.groupBy(body).agg(F.count("*").alias("n"), ids.alias("doc_ids")).where("n > 1")


@query("""WITH o AS (SELECT 'documents' AS layer, text AS c FROM documents UNION ALL SELECT 'pages', html FROM pages),
g AS (SELECT layer, md5(c) AS d, max(length(c)) AS size, count(*) AS n FROM o GROUP BY 1, 2)
SELECT layer, sum(n)::BIGINT AS objects, count(*)::BIGINT AS unique_objects, sum(n * size)::BIGINT AS logical, sum(size)::BIGINT AS stored, sum((n - 1) * size)::BIGINT AS saved FROM g GROUP BY 1""")
def storage_totals(t: Tables) -> DataFrame:
    rows = t.documents.select(F.lit("documents").alias("layer"), F.col("text").alias("c")).union(t.pages.select(F.lit("pages"), "html"))
    each = rows.groupBy("layer", F.md5(F.col("c").cast("binary")).alias("d")).agg(F.max(F.length("c")).alias("size"), F.count("*").alias("n"))
    return each.groupBy("layer").agg(
        F.sum("n").alias("objects"), F.count("*").alias("unique_objects"), F.sum(F.expr("n * size")).alias("logical"), F.sum("size").cast("long").alias("stored"), F.sum(F.expr("(n - 1) * size")).alias("saved"))


@query("""SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)""")
def inventory(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left").select("doc_id", "lang", "source", "quality", "toxic")


@query("""WITH b AS (SELECT lang, substr(text, (p + 1)::BIGINT, 64) AS block FROM (SELECT lang, text, unnest(range(0, greatest(length(text), 1), 64)) AS p FROM documents))
SELECT lang, count(*)::BIGINT AS refs, count(DISTINCT block)::BIGINT AS uniq, round(count(DISTINCT block) / count(*), 4) AS ratio FROM b GROUP BY 1""")
def block_dedup(t: Tables) -> DataFrame:
    return blocks.block_stats(blocks.split_blocks(t.documents, ["doc_id", "lang"], "text", 64), "lang")


@query("""WITH a AS (SELECT *, CASE WHEN lag(o_orderstatus) OVER w IS NOT DISTINCT FROM o_orderstatus AND row_number() OVER w > 1 THEN 0 ELSE 1 END AS new FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
b AS (SELECT *, sum(new) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::BIGINT AS run FROM a)
SELECT o_custkey, run, min(o_orderstatus) AS o_orderstatus, count(*)::BIGINT AS repeat, min(o_orderkey) AS first_o_orderkey FROM b GROUP BY 1, 2""")
def object_extents_rle(t: Tables) -> DataFrame:
    return blocks.run_lengths(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, coalesce(sum(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM lineitem""")
def block_offsets(t: Tables) -> DataFrame:
    rows = blocks.running_offsets(t.lineitem, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"], "l_quantity")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.col("offset").cast("long").alias("offset"))


@query("""WITH r AS (SELECT DISTINCT doc_id, source, line FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE line <> ''),
f AS (SELECT r.* FROM r JOIN (SELECT line FROM r GROUP BY line HAVING count(*) BETWEEN 2 AND 32) USING (line)),
m AS (SELECT a.doc_id, b.source AS candidate, count(DISTINCT a.line) AS shared FROM f a JOIN f b ON a.line = b.line AND a.doc_id <> b.doc_id GROUP BY 1, 2),
t AS (SELECT doc_id, count(*) AS total FROM r GROUP BY 1)
SELECT doc_id, candidate, shared::BIGINT AS shared, total::BIGINT AS total FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY shared DESC, candidate) AS k FROM m JOIN t USING (doc_id) WHERE shared >= greatest(1.0, 0.1 * total)) WHERE k = 1""")
def shared_block_family(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", "source", F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    return blocks.shared_block_family(lines, "doc_id", "source", "line")


@query("""WITH two AS (SELECT doc_id, text FROM documents UNION ALL SELECT doc_id + 100000000, substr(text, 1, (length(text) - 1)::BIGINT) || '#' FROM documents), one AS (SELECT text, min(doc_id) AS doc_id FROM two WHERE length(text) >= 8 GROUP BY text),
s AS (SELECT doc_id, length(text) AS size, band, md5(substr(text, (band * (length(text) // 8) + 1)::BIGINT, (length(text) // 8)::BIGINT)) AS digest FROM one, range(8) r(band))
SELECT a.doc_id AS a, b.doc_id AS b, count(*)::BIGINT AS bands FROM s a JOIN s b ON a.size = b.size AND a.band = b.band AND a.digest = b.digest AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING count(*) >= 2""")
def band_candidates(t: Tables) -> DataFrame:
    """Each document, and itself with another last character."""
    changed = t.documents.select((F.col("doc_id") + 100000000).alias("doc_id"), F.expr("concat(substr(text, 1, length(text) - 1), '#')").alias("text"))
    return blocks.band_candidates(t.documents.select("doc_id", "text").union(changed), "doc_id", "text")


@query("""WITH RECURSIVE m AS (SELECT source, doc_id, octet_length(encode(text))::BIGINT AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
g(source, k, doc_id, size, group_no, "offset") AS (SELECT source, k, doc_id, size, 0::BIGINT, 0::BIGINT FROM m WHERE k = 1
UNION ALL SELECT m.source, m.k, m.doc_id, m.size, CASE WHEN g."offset" + g.size + m.size > 65536 THEN g.group_no + 1 ELSE g.group_no END, CASE WHEN g."offset" + g.size + m.size > 65536 THEN 0 ELSE g."offset" + g.size END
FROM g JOIN m ON m.source = g.source AND m.k = g.k + 1)
SELECT source, doc_id, size, group_no, "offset" FROM g""")
def group_plan(t: Tables) -> DataFrame:
    sizes = t.documents.select("source", "doc_id", F.octet_length("text").cast("long").alias("size"))
    return groups.next_fit(sizes, "source", "doc_id", "size", 65536)


@query("""SELECT doc_id, sha256(text) AS sha256, true AS same FROM documents""")
def group_roundtrip(t: Tables) -> DataFrame:
    """Encode all documents into solid groups, decode them, and compare digests."""
    rows = t.documents.select("doc_id", "source", F.col("text").cast("binary").alias("content"))
    plan = groups.next_fit(rows.select("doc_id", "source", F.octet_length("content").cast("long").alias("size")), "source", "doc_id", "size", 1 << 20)
    members = plan.join(rows.drop("source"), "doc_id")
    packed = groups.encode_groups(members, ["source", "group_no"], "offset", "content")
    back = groups.decode_members(packed, members.drop("content"), ["source", "group_no"], "doc_id")
    return rows.select("doc_id", F.sha2("content", 256).alias("sha256")).join(back, "doc_id", "left").select("doc_id", "sha256", (F.sha2("content", 256) == F.col("sha256")).alias("same"))


@query("""SELECT 'lineitem_orders' AS "constraint", count(*)::BIGINT AS orphans FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'orders_customer', count(*) FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'labels_documents', count(*) FROM labels WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM documents)
UNION ALL SELECT 'nation_region', count(*) FROM nation WHERE n_regionkey IS NOT NULL AND n_regionkey NOT IN (SELECT r_regionkey FROM region)
UNION ALL SELECT 'order_user', count(*) FROM events WHERE user_id IS NOT NULL AND user_id NOT IN (SELECT c_custkey FROM customer)""")
def fk_audit(t: Tables) -> DataFrame:
    return audit.orphans([
        ("lineitem_orders", t.lineitem, "l_orderkey", t.orders, "o_orderkey"), ("orders_customer", t.orders, "o_custkey", t.customer, "c_custkey"),
        ("labels_documents", t.labels, "doc_id", t.documents, "doc_id"), ("nation_region", t.nation, "n_regionkey", t.region, "r_regionkey"),
        ("order_user", t.events, "user_id", t.customer, "c_custkey"),
    ])


def _digest_sql(table: str, columns: list[str]) -> str:
    line = " || '|' || ".join(f"coalesce({c}::VARCHAR, '~')" for c in sorted(columns))
    return f"""SELECT '{table}' AS name, coalesce(sum(n), 0)::BIGINT AS n_rows, md5(string_agg(d, ',' ORDER BY p)) AS digest FROM
(SELECT substr(r, 1, 4) AS p, md5(string_agg(r || 'x' || n::VARCHAR, ',' ORDER BY r || 'x' || n::VARCHAR)) AS d, sum(n) AS n FROM (SELECT md5({line}) AS r, count(*) AS n FROM {table} GROUP BY 1) GROUP BY 1)"""


DIGESTED = {
    "region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"], "labels": ["doc_id", "quality", "toxic"],
    "benchmark": ["item_id", "text"], "pages": ["page_id", "url", "html"], "documents": ["doc_id", "text", "lang", "source", "n_chars"], "conversations": ["conv_id", "turn", "role", "text"],
}


@query("\nUNION ALL ".join(_digest_sql(n, c) for n, c in DIGESTED.items()))
def table_digest(t: Tables) -> DataFrame:
    out = None
    for name in DIGESTED:
        one = audit.table_digest(getattr(t, name), name)
        out = one if out is None else out.union(one)
    return out


@query("""SELECT o_orderkey, printf('%08X', coalesce(o_custkey, 0)) AS custkey_hex, printf('%04X', coalesce(CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 65536 END, 0)) AS low_hex FROM orders""")
def hex_format(t: Tables) -> DataFrame:
    low = F.when(F.col("o_orderkey") % 5 == 0, None).otherwise(F.col("o_orderkey") % 65536)
    return t.orders.select("o_orderkey", hex_or_zero(F.col("o_custkey"), 8).alias("custkey_hex"), hex_or_zero(low, 4).alias("low_hex"))


@query("""WITH m AS (SELECT l_suppkey, l_returnflag AS mode FROM (SELECT l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, l_returnflag) AS k FROM lineitem GROUP BY 1, 2) WHERE k = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, mode, l_returnflag = mode AS is_common FROM lineitem JOIN m USING (l_suppkey)""")
def mode_flag(t: Tables) -> DataFrame:
    common = select.modes(t.lineitem, "l_suppkey", "l_returnflag")
    return t.lineitem.join(common, "l_suppkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "mode", (F.col("l_returnflag") == F.col("mode")).alias("is_common"))


@query("""SELECT event_type, count(*)::BIGINT AS n, count(DISTINCT event_id)::BIGINT AS ids FROM events GROUP BY 1""")
def ingest_idempotent(t: Tables) -> DataFrame:
    """Two ingests of the same events, and one of a copy under another name, store each event once."""
    folder = fresh_path(t.spark, "ingest")
    events = t.events
    events.write.parquet(f"{folder}/in/one")
    for step in ("one", "one", "two"):
        if step == "two":
            events.write.parquet(f"{folder}/in/two")
        ingest.ingest(t.spark, f"{folder}/in/*", events.schema, f"{folder}/out", f"{folder}/state", ["event_id"])
    return t.spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"))
