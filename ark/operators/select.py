"""Choosing one of many: best variant of a family, filters, latest rows, cascades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def best_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__k = 1").drop("__k")


def latest_per_key(df: DataFrame, key: list[str], order: str, values: list[str]) -> DataFrame:
    """The values of each key's largest order; an aggregate, so rows are reduced before they are shuffled."""
    return df.groupBy(*key).agg(F.max(F.col(order)).alias(order), *[F.max_by(v, order).alias(v) for v in values])


def choose(df: DataFrame, name: str, include: str | None = None, exclude: str | None = None, having: Column | None = None) -> DataFrame:
    """Rows whose name matches one pattern and not the other."""
    for pattern, wanted in ((include, True), (exclude, False)):
        if pattern is not None:
            df = df.where(F.col(name).rlike(pattern) == wanted)
    return df if having is None else df.where(having)


def cascade(rules: list[tuple[Column, str]], default: str) -> Column:
    """The label of the first rule that holds."""
    out = F
    for condition, label in rules:
        out = out.when(condition, label)
    return out.otherwise(default)


def all_members(df: DataFrame, key: str, matched: Column) -> DataFrame:
    """(key, members) of the keys whose members all match."""
    return df.groupBy(key).agg(F.bool_and(matched).alias("ok"), F.count("*").alias("members")).where("ok").drop("ok")


def modes(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, mode): the most frequent value, the smallest of equals."""
    n = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return n.groupBy(key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias("mode"))
