"""Operator 2, benchmark decontamination: a distributed positional inverted index, in DataFrame operations only.

Postings of the rarest test terms are stored with their neighbouring words. A phrase search joins an item's
anchor term with its postings, adjusts each posting by the term's offset in the item, and keeps the aligned
runs of equal words that are long enough. Every window of an item has its rarest term (by the corpus' own
counts) among the item's anchors, so no occurrence is missed. ``proximity_matches`` reads the same index.

Scale: the corpus is read twice (term counts, postings) and never shuffled; only postings of rare terms and one
row per document are. Term sets are broadcast in blocks of a fixed size, so a larger test set costs more passes.

Defined cases: null and empty texts have no words; an item without words matches nothing; repeated documents
are returned each, repeated items count once per item_id; null item_ids are ignored; other columns are ignored;
without any item every document is clean, without documents the result is empty. Of equally rare terms the first in
letter order is the anchor, then the first in place; very long texts are read whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import documents_only, sheltered, stored

WINDOW = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Terms of one broadcast block: some 10 MB at most.
BLOCK = 200_000
#: Stands for "this document exists" among the postings; no word is empty.
DOCUMENT = ""


def words(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, APART), "")


def blocks(terms: DataFrame) -> list[DataFrame]:
    """Distinct terms (column term) in parts that are small enough to broadcast."""
    terms = stored(terms.select("term").distinct(), "terms")
    n = -(-terms.count() // BLOCK)
    if n <= 1:
        return [terms]
    part = F.pmod(F.xxhash64("term"), F.lit(2 * n))  # twice as many as needed: hashing is not quite even
    return [terms.where(part == k) for k in range(2 * n)]


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def item_words(items: DataFrame) -> DataFrame:
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), words(F.col("text")).alias("item"))
    return rows.where(F.col("item_id").isNotNull() & (F.size("item") > 0)).distinct()


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how often each term stands in the corpus, over all documents."""
    each = documents_only(docs).select(F.explode(words(F.col("text"))).alias("term"))
    return union([each.join(F.broadcast(b), "term", "left_semi").groupBy("term").agg(F.count("*").alias("n")) for b in blocks(terms)])


def ranked_items(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item_id, item, ranked): ranked has (n, term, at) of each item word, in order; n is the corpus count."""
    each = items.select("item_id", "item", F.posexplode("item").alias("at", "term")).join(counts, "term", "left")
    ranked = F.sort_array(F.collect_list(F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), "term")))
    return each.groupBy("item_id", "item").agg(ranked.alias("r")).select(
        "item_id", "item", F.transform("r", lambda x: F.struct(x["n"].alias("n"), x["term"].alias("term"), x["at"].alias("at"))).alias("ranked"))


def anchors(ranked: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, term, before, after, need): the rarest word of each window, once, with its neighbours nearest first."""
    need = F.least(F.size("item"), F.lit(window))
    rarest = F.transform(F.sequence(F.lit(1), F.size("item") - need + 1), lambda k: F.array_min(F.slice("ranked", k, need)))
    out = ranked.select("item_id", "item", need.alias("need"), F.explode(F.array_distinct(rarest)).alias("a"))
    return out.select("item_id", "need", F.col("a.term").alias("term"), *neighbours(F.col("item"), F.col("a.at"), window))


def neighbours(array: Column, at: Column, window: int) -> list[Column]:
    """Up to window - 1 elements before (nearest first) and after index ``at``."""
    k = window - 1
    before = F.reverse(F.slice(array, F.greatest(at - (k - 1), F.lit(1)), F.least(at, F.lit(k))))
    return [before.alias("before"), F.slice(array, at + 2, F.lit(k)).alias("after")]


def build_index(docs: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """Stored postings (term, doc_id, mark, at, before, after) of the terms, and one row with n_words per document.

    ``mark`` hashes the text: documents of one id but different texts stay apart.
    """
    rows = documents_only(docs).select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), words(F.col("text")).alias("w"))
    parts = []
    for k, block in enumerate(blocks(terms)):
        wanted = block.union(block.sparkSession.createDataFrame([(DOCUMENT,)], "term string")) if k == 0 else block
        each = rows.select("doc_id", "mark", "w", F.posexplode(F.concat(F.array(F.lit(DOCUMENT)), F.col("w"))).alias("pos", "term"))
        found = each.join(F.broadcast(wanted), "term")
        real = F.col("term") != DOCUMENT
        at = F.when(real, F.col("pos") - 1)
        parts.append(found.select("term", "doc_id", "mark", at.alias("at"), *[F.when(real, c).alias(n) for c, n in zip(neighbours(F.col("w"), F.col("pos") - 1, window), ("before", "after"), strict=True)], F.when(~real, F.size("w")).alias("n_words")))
    return stored(union(parts), "postings")


def run_length(a: Column, b: Column) -> Column:
    """How many leading elements are equal."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(same, False)
    return F.when(stop == 0, F.size(same)).otherwise(stop - 1).cast("int")


def phrase_matches(index: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc_id, mark, item_id, first, last): aligned runs of equal words around an anchor that hold a whole window."""
    wanted = anchors.select("item_id", "need", "term", F.col("before").alias("i_before"), F.col("after").alias("i_after"))
    met = index.where(F.col("term") != DOCUMENT).join(wanted, "term")
    met = met.select("doc_id", "mark", "item_id", "at", "need", run_length(F.col("before"), F.col("i_before")).alias("l"), run_length(F.col("after"), F.col("i_after")).alias("r"))
    return met.where("l + r + 1 >= need").select("doc_id", "mark", "item_id", F.expr("at - l").alias("first"), F.expr("at + r").alias("last"))


def proximity_matches(docs: DataFrame, items: DataFrame, terms: int = 3, span: int = 30) -> DataFrame:
    """(doc_id, item_id): documents in which an item's rarest ``terms`` different words stand within ``span`` words."""
    texts = item_words(items)
    counts = term_counts(docs, texts.select(F.explode("item").alias("term")))
    few = F.slice(F.array_sort(F.array_distinct(F.transform("ranked", lambda x: F.struct(x["n"].alias("n"), x["term"].alias("term"))))), 1, terms)
    wanted = stored(ranked_items(texts, counts).select("item_id", F.size(few).alias("need"), F.explode(few).alias("t")).select("item_id", "need", "t.term"), "near")
    met = build_index(docs, wanted).join(wanted, "term")
    near = Window.partitionBy("doc_id", "mark", "item_id").orderBy("at").rangeBetween(1 - span, 0)
    return met.withColumn("seen", F.size(F.collect_set("term").over(near))).where("seen = need").select("doc_id", "item_id").distinct()


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and mark, a hash of its text."""
    texts = stored(item_words(items), "items")
    counts = term_counts(docs, texts.select(F.explode("item").alias("term")))
    found = stored(anchors(ranked_items(texts, counts), window), "anchors")
    index = build_index(docs, found, window)
    hits = phrase_matches(index, found).select("doc_id", "mark", F.lit(None).cast("int").alias("n_words"), "item_id", F.struct("first", "last").alias("run"))
    run = T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])
    every = index.where(F.col("term") == DOCUMENT).select("doc_id", "mark", "n_words", F.lit(None).cast("long").alias("item_id"), F.lit(None).cast(run).alias("run"))
    each = every.union(hits).groupBy("doc_id", "mark").agg(
        F.max("n_words").alias("n_words"), F.count("n_words").alias("copies"), F.collect_set("item_id").alias("ids"), F.collect_set("run").alias("runs"))
    hit = F.size(F.array_distinct(F.flatten(F.transform("runs", lambda r: F.sequence(r["first"], r["last"])))))
    names = F.array_join(F.array_sort(F.transform("ids", lambda i: i.cast("string"))), ",")
    out = each.select("doc_id", "mark", F.col("n_words").cast("long").alias("n_words"), hit.cast("long").alias("n_hit"), F.size("ids").cast("long").alias("n_items"),
                      F.sha2(names.cast("binary"), 256).alias("items_sha256"), F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "mark")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows, with all their columns, in which no window of an item occurs."""
    bad = stored(decontaminate(docs, items, window).where("contaminated").select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct(), "contaminated")
    mark = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = sheltered(docs).join(bad, F.col("doc_id").eqNullSafe(F.col("__id")) & (mark == F.col("__mark")), "left_anti")
    return kept.toDF(*docs.columns)
