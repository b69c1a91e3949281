"""Governance: orphans, uniqueness, contiguity, table digests."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def orphans(checks: list[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(constraint, orphans) for each (name, child, column, parent, key)."""
    each = [child.where(F.col(c).isNotNull()).join(parent.select(F.col(k).alias(c)), c, "left_anti").agg(F.lit(name).alias("constraint"), F.count("*").alias("orphans")) for name, child, c, parent, k in checks]
    return reduce(DataFrame.union, each)


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def gaps(df: DataFrame, key: str, order: str, offset: str, size: str) -> DataFrame:
    """Extents that do not start where the one before ends."""
    w = Window.partitionBy(key).orderBy(order)
    due = F.coalesce(F.lag(F.col(offset) + F.col(size)).over(w), F.lit(0))
    return df.withColumn("due", due).where(F.col(offset) != F.col("due"))


#: Of a table without rows.
EMPTY_DIGEST = hashlib.md5(b"").hexdigest()


def table_digest(df: DataFrame, name: str) -> DataFrame:
    """(name, rows, digest), whatever the order of rows and columns: md5 over the sorted md5s of the rows.

    Rows are first reduced to one md5 for each of 65,536 leading digits, so one task sees that many at most.
    """
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in sorted(df.columns)])
    rows = df.select(F.md5(line.cast("binary")).alias("r")).groupBy("r").agg(F.count("*").alias("n"))
    listed = F.sort_array(F.collect_list(F.concat("r", F.lit("x"), F.col("n").cast("string"))))
    parts = rows.groupBy(F.substring("r", 1, 4).alias("p")).agg(F.md5(F.array_join(listed, ",").cast("binary")).alias("d"), F.sum("n").alias("n"))
    whole = F.md5(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p", "d"))), lambda x: x["d"]), ",").cast("binary"))
    return parts.agg(F.lit(name).alias("name"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), whole.alias("digest"))


def changed_tables(before: DataFrame, after: DataFrame) -> DataFrame:
    """(name, change) of tables whose digests differ or that one side lacks."""
    b, a = before.select("name", F.col("digest").alias("b")), after.select("name", F.col("digest").alias("a"))
    change = F.when(F.col("b").isNull(), "added").when(F.col("a").isNull(), "removed").when(F.col("a") != F.col("b"), "changed")
    return b.join(a, "name", "full").select("name", change.alias("change")).where("change is not null")
