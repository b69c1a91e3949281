"""Queries on matching, lineage, selection, titles, coverage and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import under_root
from ..operators import lineage, match, select, titles
from .registry import Tables, query

TARGETS = """t AS (SELECT doc_id AS target_id, (length(text) + CASE WHEN doc_id % 11 = 0 THEN 1 ELSE 0 END)::BIGINT AS size, CASE WHEN doc_id % 5 <> 0 THEN sha256(text) END AS sha256,
CASE WHEN doc_id % 2 = 0 THEN sha1(text) END AS sha1, CASE WHEN doc_id % 15 <> 0 THEN md5(text) END AS md5, doc_id % 13 = 0 AS nodump FROM documents),
o AS (SELECT min(doc_id) AS object_id, length(text)::BIGINT AS size, sha256(text) AS sha256, sha1(text) AS sha1, md5(text) AS md5 FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || '~' ELSE text END AS text FROM documents) GROUP BY text),
s AS (SELECT *, CASE WHEN sha256 IS NOT NULL THEN 'sha256' WHEN sha1 IS NOT NULL THEN 'sha1' WHEN md5 IS NOT NULL THEN 'md5' END AS strength FROM t),
v AS (SELECT s.target_id, o.object_id, s.strength, CASE WHEN s.nodump THEN 'unverifiable' WHEN s.size = o.size AND coalesce(s.sha256 = o.sha256, true) AND coalesce(s.sha1 = o.sha1, true) AND coalesce(s.md5 = o.md5, true) THEN 'match' ELSE 'mismatch' END AS status
FROM s JOIN o ON (s.strength = 'sha256' AND s.sha256 = o.sha256) OR (s.strength = 'sha1' AND s.sha1 = o.sha1) OR (s.strength = 'md5' AND s.md5 = o.md5))"""
HASHES = ("sha256", "sha1", "md5")


def _targets(t: Tables) -> tuple[DataFrame, DataFrame]:
    d, text = t.documents, F.col("text").cast("binary")
    only = lambda condition, value: F.when(F.expr(condition), value)
    targets = d.select(
        F.col("doc_id").alias("target_id"), (F.length("text") + F.when(F.col("doc_id") % 11 == 0, 1).otherwise(0)).cast("long").alias("size"),
        only("doc_id % 5 <> 0", F.sha2(text, 256)).alias("sha256"), only("doc_id % 2 = 0", F.sha1(text)).alias("sha1"), only("doc_id % 15 <> 0", F.md5(text)).alias("md5"), F.expr("doc_id % 13 = 0").alias("nodump"))
    d = d.select("doc_id", F.expr("CASE WHEN doc_id % 3 = 0 THEN text || '~' ELSE text END").alias("text"))  # a third has other contents
    objects = d.groupBy(F.sha2(text, 256).alias("sha256"), F.sha1(text).alias("sha1"), F.md5(text).alias("md5"), F.length("text").cast("long").alias("size")).agg(F.min("doc_id").alias("object_id"))
    return targets, objects


@query(f"""WITH {TARGETS} SELECT status, count(*)::BIGINT AS n FROM (SELECT status FROM v UNION ALL SELECT 'unverifiable' FROM s WHERE strength IS NULL
UNION ALL SELECT 'no_candidate' FROM s WHERE strength IS NOT NULL AND target_id NOT IN (SELECT target_id FROM v)) GROUP BY 1""")
def scan_status(t: Tables) -> DataFrame:
    return match.scan(*_targets(t), HASHES)


@query(f"""WITH {TARGETS} SELECT target_id, object_id, strength FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY CASE strength WHEN 'sha256' THEN 0 WHEN 'sha1' THEN 1 ELSE 2 END, object_id) AS k FROM v WHERE status = 'match') WHERE k = 1""")
def validation_best(t: Tables) -> DataFrame:
    return match.best_validations(match.validations(*_targets(t), HASHES))


@query("""SELECT o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN 'nodump' WHEN EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R') THEN 'matched' ELSE 'unmatched' END AS status, count(*)::BIGINT AS n FROM orders GROUP BY ALL""")
def coverage(t: Tables) -> DataFrame:
    returned = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("hit", F.lit(True))
    status = F.when(F.col("o_orderstatus") == "P", "nodump").when(F.col("hit"), "matched").otherwise("unmatched")
    return t.orders.join(returned, "o_orderkey", "left").groupBy("o_orderpriority", status.alias("status")).agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, count(*)::BIGINT AS members FROM lineitem GROUP BY 1 HAVING bool_and(l_linestatus = 'F')""")
def complete_packages(t: Tables) -> DataFrame:
    return select.all_members(t.lineitem, "l_orderkey", F.col("l_linestatus") == "F")


@query("""WITH o AS (SELECT p_partkey AS id, p_name || '#' || p_partkey AS name, p_partkey::VARCHAR || '/' || p_size AS sign FROM part WHERE p_partkey % 10 <> 0),
n AS (SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 1 THEN 'new ' || p_name || '#' || p_partkey WHEN 2 THEN upper(p_name) || '#' || p_partkey ELSE p_name || '#' || p_partkey END AS name,
p_partkey::VARCHAR || '/' || CASE WHEN p_partkey % 6 = 5 THEN p_size + 100 ELSE p_size END AS sign FROM part WHERE p_partkey % 9 <> 0),
m AS (SELECT o.id AS old_id, n.id AS new_id, CASE WHEN o.sign <> n.sign THEN 'checksum_changed' WHEN o.name = n.name THEN 'unchanged' ELSE 'case_changed' END AS change FROM o JOIN n ON lower(o.name) = lower(n.name)),
r AS (SELECT a.id AS old_id, b.id AS new_id, CASE WHEN b.id IS NULL THEN 'removed' WHEN a.id IS NULL THEN 'added' ELSE 'renamed' END AS change
FROM (SELECT * FROM o WHERE id NOT IN (SELECT old_id FROM m)) a FULL JOIN (SELECT * FROM n WHERE id NOT IN (SELECT new_id FROM m)) b ON a.sign = b.sign)
SELECT * FROM m UNION ALL SELECT * FROM r""")
def snapshot_diff(t: Tables) -> DataFrame:
    key, name = F.col("p_partkey"), F.concat("p_name", F.lit("#"), F.col("p_partkey").cast("string"))
    old = t.part.where("p_partkey % 10 <> 0").select(key.alias("id"), name.alias("name"), key.cast("string").alias("a"), F.col("p_size").alias("b"))
    fresh = F.when(key % 4 == 1, F.concat(F.lit("new "), name)).when(key % 4 == 2, F.concat(F.upper("p_name"), F.lit("#"), key.cast("string"))).otherwise(name)
    new = t.part.where("p_partkey % 9 <> 0").select(key.alias("id"), fresh.alias("name"), key.cast("string").alias("a"), F.when(key % 6 == 5, F.col("p_size") + 100).otherwise(F.col("p_size")).alias("b"))
    return match.snapshot_diff(old, new, ["a", "b"])


@query("""WITH RECURSIVE n AS (SELECT doc_id AS id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id // 3 END AS parent FROM documents),
w(id, root, depth) AS (SELECT id, id, 0::BIGINT FROM n WHERE parent IS NULL OR parent NOT IN (SELECT id FROM n) UNION ALL SELECT n.id, w.root, w.depth + 1 FROM n JOIN w ON n.parent = w.id)
SELECT id, root, depth FROM w""")
def clone_root(t: Tables) -> DataFrame:
    return lineage.roots(t.documents.select(F.col("doc_id").alias("id"), F.expr("CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id div 3 END").alias("parent")))


@query("""SELECT DISTINCT o_custkey, l_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_returnflag = 'R' AND (o_custkey, l_suppkey) NOT IN (SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey)""")
def release_links(t: Tables) -> DataFrame:
    known = t.customer.join(t.supplier, F.col("c_nationkey") == F.col("s_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("s_suppkey").alias("l_suppkey"))
    items = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey")
    return lineage.links(t.orders.select("o_orderkey", "o_custkey"), items, "o_orderkey", ["o_custkey", "l_suppkey"], known)


@query("""WITH u AS (SELECT floor(p_retailprice)::BIGINT AS key, 0 AS source, p_partkey AS o, p_brand AS family FROM part WHERE p_size > 40 UNION ALL SELECT floor(p_retailprice)::BIGINT, 1, p_partkey, p_type FROM part WHERE p_size > 20 UNION ALL SELECT floor(p_retailprice)::BIGINT, 2, p_partkey, p_name FROM part)
SELECT key, source, family FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY source, o) AS k FROM u) WHERE k = 1""")
def family_index(t: Tables) -> DataFrame:
    rows = t.part.select(F.floor("p_retailprice").cast("long").alias("key"), "p_size", "p_partkey", "p_brand", "p_type", "p_name")
    pick = lambda where, column: rows.where(where).select("key", "p_partkey", F.col(column).alias("family"))
    return lineage.first_wins([pick("p_size > 40", "p_brand"), pick("p_size > 20", "p_type"), pick("true", "p_name")], "key", ["family"], "p_partkey")


@query("""SELECT source, doc_id, lang, n_chars, labelled FROM (SELECT d.*, l.doc_id IS NOT NULL AS labelled, row_number() OVER (PARTITION BY source ORDER BY l.doc_id IS NULL, CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE 3 END, n_chars DESC, d.doc_id) AS k FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE k = 1""")
def clone_best_pick(t: Tables) -> DataFrame:
    """One document per source: labelled before not, then by language, length and id."""
    rows = t.documents.select("doc_id", "lang", "source", "n_chars").join(t.labels.select("doc_id").distinct().withColumn("labelled", F.lit(True)), "doc_id", "left").fillna(False, ["labelled"])
    place = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "de", 1).when(F.col("lang") == "fr", 2).otherwise(3)
    best = select.best_per_key(rows, "source", [F.desc("labelled"), place, F.desc("n_chars"), F.col("doc_id")])
    return best.select("source", "doc_id", "lang", "n_chars", "labelled")


@query("""SELECT p_partkey, p_name, p_type FROM part WHERE regexp_matches(p_name, '[a-m]') AND NOT regexp_matches(p_name, '^.{0,3}x') AND p_size BETWEEN 10 AND 30""")
def set_filter(t: Tables) -> DataFrame:
    return select.choose(t.part, "p_name", "[a-m]", "^.{0,3}x", F.col("p_size").between(10, 30)).select("p_partkey", "p_name", "p_type")


def _passages(t: Tables) -> DataFrame:
    """(item_id, doc_id) of passages inside documents: met by a run of up to five whole words within the passage, then compared.

    A passage's first and last word may be parts of longer ones in a document, so they are no key. One of one or two
    words has no inner word: such passages are few or none, and are looked for one by one in the same scan.
    """
    inner = lambda c: F.split(c, r"\s+")
    items = t.benchmark.select("item_id", F.col("text").alias("passage")).withColumn("w", inner("passage")).withColumn("k", F.least(F.size("w") - 2, F.lit(5)))
    lengths = sorted(r.k for r in items.select("k").distinct().collect() if r.k and r.k > 0)  # five at most
    keyed = items.where("k > 0").withColumn("key", F.xxhash64("k", F.array_join(F.slice("w", F.lit(2), F.col("k")), " ")))
    words = t.documents.select("doc_id", "text").withColumn("w", inner("text"))

    def runs_of(k: int):
        run = lambda i: F.xxhash64(F.lit(k), F.array_join(F.slice("w", i, k), " "))
        return F.when(F.size("w") >= k, F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - (k - 1), F.lit(1))), run)).otherwise(F.array().cast("array<long>"))

    runs = [runs_of(k) for k in lengths]
    keys = F.array_distinct(F.concat(*runs)) if runs else F.array().cast("array<long>")
    met = words.select("doc_id", F.explode(keys).alias("key")).join(keyed.select("item_id", "passage", "key"), "key").select("doc_id", "item_id", "passage").distinct()
    found = t.documents.select("doc_id", "text").join(met, "doc_id").where(F.contains("text", "passage")).select("item_id", "doc_id")
    short = items.where("k <= 0").select("item_id", "passage")
    if short.isEmpty():
        return found
    listed = short.agg(F.collect_list(F.struct("item_id", "passage")).alias("short"))
    few = t.documents.select("doc_id", "text").join(F.broadcast(listed), F.lit(True)).select("doc_id", F.explode(F.filter("short", lambda s: F.contains(F.col("text"), s["passage"]))).alias("s"))  # one row of passages
    return found.union(few.select("s.item_id", "doc_id")).distinct()


@query("""SELECT b.item_id, d.doc_id, d.doc_id IN (SELECT doc_id FROM labels) AS labelled FROM benchmark b JOIN documents d ON contains(d.text, b.text)""")
def reference_matches(t: Tables) -> DataFrame:
    known = t.labels.select("doc_id").distinct().withColumn("labelled", F.lit(True))
    return _passages(t).join(known, "doc_id", "left").fillna(False, ["labelled"]).select("item_id", "doc_id", "labelled")


@query("""SELECT item_id, length(text)::BIGINT AS size FROM benchmark b WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text))""")
def reference_unmatched(t: Tables) -> DataFrame:
    return t.benchmark.join(_passages(t), "item_id", "left_anti").select("item_id", F.length("text").cast("long").alias("size"))


@query("""WITH s AS (SELECT o_custkey, bool_or(o_orderstatus = 'F') AS f, bool_or(o_orderstatus = 'O') AS o, bool_or(o_orderstatus = 'P') AS p FROM orders GROUP BY 1)
SELECT c_mktsegment, CASE WHEN f THEN 'local' WHEN o THEN 'dat_only' WHEN p THEN 'db_only' ELSE 'unmatched' END AS status, count(*)::BIGINT AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY c_mktsegment), 2)::DOUBLE AS percent
FROM customer LEFT JOIN s ON o_custkey = c_custkey GROUP BY 1, 2""")
def coverage_report(t: Tables) -> DataFrame:
    flags = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(*[F.bool_or(F.col("o_orderstatus") == s).alias(s.lower()) for s in "FOP"])
    status = select.cascade([(F.col("f"), "local"), (F.col("o"), "dat_only"), (F.col("p"), "db_only")], "unmatched")
    n = t.customer.join(flags, "c_custkey", "left").groupBy("c_mktsegment", status.alias("status")).agg(F.count("*").alias("n"))
    total = n.groupBy("c_mktsegment").agg(F.sum("n").alias("total"))
    return n.join(total, "c_mktsegment").select("c_mktsegment", "status", "n", F.round(100.0 * F.col("n") / F.col("total"), 2).cast("double").alias("percent"))


@query("""SELECT n_name, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1""")
def distinct_concat(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").distinct().join(t.nation, "n_nationkey")
    return rows.groupBy("n_name").agg(F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ",").alias("segments"))


@query("""SELECT event_id, user_id, event_type, value FROM events WHERE ts::DATE = (SELECT max(ts)::DATE FROM events)""")
def latest_snapshot(t: Tables) -> DataFrame:
    last = t.events.agg(F.max("ts").cast("date").alias("day"))
    return t.events.join(F.broadcast(last), F.col("ts").cast("date") == F.col("day")).select("event_id", "user_id", "event_type", "value")  # one row


@query("""SELECT conv_id, turn, role, length(text)::BIGINT AS size FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS k FROM conversations) WHERE k = 1""")
def latest_record(t: Tables) -> DataFrame:
    return select.latest_per_key(t.conversations.withColumn("size", F.length("text").cast("long")), ["conv_id"], "turn", ["role", "size"])


NAMED = """p_name || CASE p_partkey % 3 WHEN 0 THEN ' (Europe)' WHEN 1 THEN ' (Japan, USA)' ELSE '' END || CASE WHEN p_partkey % 5 = 0 THEN ' (Rev ' || p_partkey % 7 || ')' ELSE '' END"""
PARSED = """lower(trim(regexp_replace(title, '\\s*\\(.*$', ''))) AS base, array_to_string(regexp_extract_all(title, '\\(([^()]*)\\)', 1), '|') AS tags, trim(string_split(regexp_extract(title, '\\(([^()]*)\\)', 1), ',')[1]) AS region, regexp_extract(title, '\\((?:Rev |v)([0-9A-Za-z.]+)\\)', 1) AS revision"""


def _titles(t: Tables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("id"), F.expr(NAMED.replace("|| p_partkey % 7 ||", "|| cast(p_partkey % 7 as string) ||")).alias("title"))


@query(f"""SELECT id, title, {PARSED} FROM (SELECT p_partkey AS id, {NAMED} AS title FROM part)""")
def title_parse(t: Tables) -> DataFrame:
    return titles.parsed(_titles(t), "title").select("id", "title", "base", "tags", "region", "revision")


@query(f"""WITH g AS (SELECT id AS game_id, title, {PARSED} FROM (SELECT p_partkey AS id, {NAMED} AS title FROM part)),
e AS (SELECT id AS entry_id, title, {PARSED} FROM (SELECT p_partkey AS id, {NAMED} AS title FROM part)),
m AS (SELECT entry_id, game_id, CASE WHEN lower(e.title) = lower(g.title) THEN 0 WHEN e.tags = g.tags THEN 1 WHEN e.region = g.region THEN 2 ELSE 3 END AS tier FROM e JOIN g USING (base)),
c AS (SELECT entry_id, tier, count(DISTINCT game_id) AS n_games, min(game_id) AS game_id FROM m GROUP BY 1, 2),
b AS (SELECT * FROM c JOIN (SELECT entry_id, min(tier) AS tier FROM m GROUP BY 1) USING (entry_id, tier))
SELECT entry_id, tier, CASE WHEN n_games IS NULL THEN 'unmatched' WHEN n_games = 1 THEN 'matched' ELSE 'ambiguous' END AS status, CASE WHEN n_games = 1 THEN game_id END AS game_id, coalesce(n_games, 0)::BIGINT AS n_games FROM (SELECT entry_id FROM e) LEFT JOIN b USING (entry_id)""")
def title_resolve(t: Tables) -> DataFrame:
    rows = _titles(t)
    return titles.resolve(rows.toDF("entry_id", "name"), rows.toDF("game_id", "title"))


@query("""SELECT p_brand, count(DISTINCT CASE WHEN p_size > 45 THEN p_type END)::BIGINT AS n_names, CASE count(DISTINCT CASE WHEN p_size > 45 THEN p_type END) WHEN 0 THEN 'missing' WHEN 1 THEN 'unique_translation' ELSE 'needs_review' END AS status FROM part GROUP BY 1""")
def name_status(t: Tables) -> DataFrame:
    return titles.name_status(t.part.withColumn("name", F.expr("CASE WHEN p_size > 45 THEN p_type END")), "p_brand", "name")


@query("""WITH n AS (SELECT DISTINCT p_partkey, p_type AS name FROM part WHERE p_size > 45), g AS (SELECT p_brand, min(name) AS name FROM part JOIN n USING (p_partkey) GROUP BY 1 HAVING count(DISTINCT name) = 1)
SELECT p_partkey, name, 'direct' AS basis FROM n UNION ALL SELECT p_partkey, name, 'inherited' FROM part JOIN g USING (p_brand) WHERE p_partkey NOT IN (SELECT p_partkey FROM n)""")
def effective_names(t: Tables) -> DataFrame:
    return titles.effective_names(t.part.select("p_partkey", "p_brand"), t.part.where("p_size > 45").select("p_partkey", F.col("p_type").alias("name")), "p_partkey", "p_brand")


@query("""SELECT p_size, count(DISTINCT p_brand)::BIGINT AS n, string_agg(DISTINCT p_brand, ' | ' ORDER BY p_brand) AS all_values FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1""")
def alternatives(t: Tables) -> DataFrame:
    return titles.alternatives(t.part, "p_size", "p_brand")


LAYERS = {"catalog": ("region", "nation", "customer", "part", "supplier"), "orders": ("orders", "lineitem"), "text": ("documents", "pages", "benchmark", "conversations"), "evidence": ("labels", "events", "embeddings")}


@query("\nUNION ALL ".join(f"SELECT '{layer}' AS layer, '{n}' AS name, count(*)::BIGINT AS n FROM {n}" for layer, names in LAYERS.items() for n in names))
def source_inventory(t: Tables) -> DataFrame:
    out = None
    for layer, names in LAYERS.items():
        for n in names:
            one = getattr(t, n).agg(F.lit(layer).alias("layer"), F.lit(n).alias("name"), F.count("*").alias("n"))
            out = one if out is None else out.unionByName(one)
    return out


@query("""WITH r AS (SELECT DISTINCT regexp_extract(url, '^([a-z]+://[^/]+)', 1) AS root FROM pages) SELECT root, page_id, url FROM pages JOIN r ON starts_with(lower(url), lower(root) || '/')""")
def collection_files(t: Tables) -> DataFrame:
    """Pages under the roots: met by host, then compared as prefixes."""
    host = F.regexp_extract("url", r"^([a-z]+://[^/]+)", 1)
    roots = t.pages.select(host.alias("root")).distinct()
    return t.pages.withColumn("host", F.lower(host)).join(roots, F.col("host") == F.lower("root")).where(under_root(F.col("url"), F.col("root"))).select("root", "page_id", "url")


FIELDS = (("name", 1), ("type", 2), ("brand", 3), ("rating", 4))


@query(f"""SELECT p_partkey, field, position, CASE field WHEN 'name' THEN p_name WHEN 'type' THEN p_type WHEN 'brand' THEN p_brand END AS value, CASE WHEN field = 'rating' THEN 'missing' ELSE 'present' END AS status
FROM part, (VALUES {', '.join(f"('{n}', {k})" for n, k in FIELDS)}) f(field, position)""")
def field_matrix(t: Tables) -> DataFrame:
    """Each part by each field of a fixed list: an explode, not a join."""
    values = {"name": F.col("p_name"), "type": F.col("p_type"), "brand": F.col("p_brand")}
    cells = F.array(*[F.struct(F.lit(n).alias("field"), F.lit(k).alias("position"), values.get(n, F.lit(None).cast("string")).alias("value")) for n, k in FIELDS])
    return t.part.select("p_partkey", F.explode(cells).alias("c")).select("p_partkey", "c.*", F.when(F.col("c.value").isNull(), "missing").otherwise("present").alias("status"))


@query("""SELECT json_extract_string(props, '$.k')::BIGINT AS k, event_type, count(*)::BIGINT AS n, sum(value::DECIMAL(18,2))::DOUBLE AS total FROM events GROUP BY 1, 2""")
def json_fields(t: Tables) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long").alias("k")
    return t.events.groupBy(k, "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))


@query("""SELECT CASE WHEN regexp_matches(o_orderpriority, '^[12]-') THEN 'verified' WHEN regexp_matches(o_orderpriority, '^3-') THEN 'trusted_unverified' WHEN regexp_matches(o_orderpriority, '^4-') THEN 'unverified' WHEN regexp_matches(o_orderpriority, '^5-') THEN 'no_dump' ELSE 'unknown' END AS status,
regexp_extract(o_orderpriority, '^([0-9])', 1)::INTEGER AS trusted, count(*)::BIGINT AS n FROM orders GROUP BY 1, 2""")
def dump_status(t: Tables) -> DataFrame:
    p = F.col("o_orderpriority")
    status = select.cascade([(p.rlike("^[12]-"), "verified"), (p.rlike("^3-"), "trusted_unverified"), (p.rlike("^4-"), "unverified"), (p.rlike("^5-"), "no_dump")], "unknown")
    return t.orders.groupBy(status.alias("status"), F.regexp_extract(p, "^([0-9])", 1).cast("int").alias("trusted")).agg(F.count("*").alias("n"))


@query("""SELECT page_id, CASE WHEN regexp_matches(html, '<article') THEN 'article' WHEN regexp_matches(html, '(?i)<title>[^<]*home') THEN 'home' WHEN regexp_matches(url, '[?]') THEN 'query' WHEN length(html) > 4000 THEN 'long' ELSE 'default' END AS route FROM pages""")
def route_cascade(t: Tables) -> DataFrame:
    html = F.col("html")
    rules = [(html.rlike("<article"), "article"), (html.rlike("(?i)<title>[^<]*home"), "home"), (F.col("url").rlike("[?]"), "query"), (F.length(html) > 4000, "long")]
    return t.pages.select("page_id", select.cascade(rules, "default").alias("route"))


@query("""SELECT quality, toxic, count(*)::BIGINT AS n, min(doc_id) AS first_id FROM labels GROUP BY 1, 2""")
def check_summary(t: Tables) -> DataFrame:
    return t.labels.groupBy("quality", "toxic").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
