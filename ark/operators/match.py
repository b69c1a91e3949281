"""Matching published targets with objects, by the strongest hash that a target names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.expressions import STRENGTHS, agrees, strongest

RANK = {"sha256": 0, "sha1": 1}


def _met(targets: DataFrame, objects: DataFrame, names: tuple[str, ...], how: str) -> DataFrame:
    """Targets with the objects that have their strongest hash, and the status of each pair. One join on (kind, hash)."""
    fields = ["size", *names]
    t = targets.withColumn("strength", strongest({n: F.col(n) for n in names}))
    t = t.withColumn("value", F.lower(F.coalesce(*[F.when(F.col("strength") == n, F.col(n)) for n in names])))
    hashes = F.explode(F.array(*[F.struct(F.lit(n).alias("strength"), F.lower(n).alias("value")) for n in names])).alias("h")
    o = objects.select("object_id", *[F.col(n).alias(f"o_{n}") for n in fields], hashes).where("h.value is not null").select("*", "h.*").drop("h")
    same = agrees({n: F.col(n) for n in fields}, {n: F.col(f"o_{n}") for n in fields})
    found = F.when(F.col("nodump"), "unverifiable").when(same, "match").otherwise("mismatch")
    status = F.when(F.col("strength").isNull(), "unverifiable").when(F.col("object_id").isNull(), "no_candidate").otherwise(found)
    return t.join(o, ["strength", "value"], how).select("target_id", "object_id", "strength", status.alias("status"))


def validations(targets: DataFrame, objects: DataFrame, names: tuple[str, ...] = STRENGTHS) -> DataFrame:
    """(target_id, object_id, strength, status) of every object that has a target's strongest hash.

    ``targets``: target_id, size, hashes, nodump; ``objects``: object_id, size, hashes. A nodump target, or one
    without hashes, is unverifiable even where all is equal.
    """
    return _met(targets, objects, names, "inner")


def scan(targets: DataFrame, objects: DataFrame, names: tuple[str, ...] = STRENGTHS) -> DataFrame:
    """(status, n): validations by outcome, targets without a hash, and targets without an object."""
    return _met(targets, objects, names, "left").groupBy("status").agg(F.count("*").alias("n"))


def best_validations(found: DataFrame) -> DataFrame:
    """The match of each target that rests on the strongest hash, the smallest object of equals."""
    rank = F.coalesce(F.create_map(*[F.lit(x) for k in RANK.items() for x in k])[F.col("strength")], F.lit(2))
    w = Window.partitionBy("target_id").orderBy(rank, "object_id")
    return found.where("status = 'match'").withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k", "status")


def snapshot_diff(old: DataFrame, new: DataFrame, signature: list[str]) -> DataFrame:
    """(old_id, new_id, change) between two snapshots of unique names and signatures.

    By name without case first, then one to one by equal signature among what is left: unchanged, case_changed,
    checksum_changed, renamed, added, removed. Missing parts of a signature are equal.
    """
    sign = F.struct(*[F.col(c) for c in signature])
    o = old.select(F.col("id").alias("old_id"), F.col("name").alias("old_name"), sign.alias("old_sign"), F.lower(F.upper("name")).alias("key"))
    n = new.select(F.col("id").alias("new_id"), F.col("name").alias("new_name"), sign.alias("new_sign"), F.lower(F.upper("name")).alias("key"))
    named = o.join(n, "key")
    same = F.col("old_sign").eqNullSafe(F.col("new_sign"))
    change = F.when(~same, "checksum_changed").when(F.col("old_name") == F.col("new_name"), "unchanged").otherwise("case_changed")
    out = named.select("old_id", "new_id", change.alias("change"))
    o_left, n_left = o.join(n, "key", "left_anti"), n.join(o, "key", "left_anti")
    # one old row for one new row of a signature, in the order of their ids; an empty signature pairs nothing
    said = lambda c: F.greatest(*[F.col(c)[f].isNotNull() for f in signature]) if len(signature) > 1 else F.col(c)[signature[0]].isNotNull()
    place = lambda side: F.when(said(f"{side}_sign"), F.row_number().over(Window.partitionBy(f"{side}_sign").orderBy(f"{side}_id")))
    o_left, n_left = o_left.drop("key").withColumn("o_k", place("old")), n_left.drop("key").withColumn("n_k", place("new"))
    pairs = o_left.join(n_left, same & (F.col("o_k") == F.col("n_k")), "full")
    rest = F.when(F.col("new_id").isNull(), "removed").when(F.col("old_id").isNull(), "added").otherwise("renamed")
    return out.union(pairs.select("old_id", "new_id", rest.alias("change")))


def agreeing(a: DataFrame, b: DataFrame, keys: list[list[str]], fields: list[str]) -> DataFrame:
    """(a_id, b_id): equal in one of the candidate keys and in no field at odds, nulls aside."""
    left = a.select(F.col("id").alias("a_id"), *[F.col(f).alias(f"a_{f}") for f in fields])
    right = b.select(F.col("id").alias("b_id"), *[F.col(f).alias(f"b_{f}") for f in fields])
    ok = agrees({f: F.col(f"a_{f}") for f in fields}, {f: F.coalesce(F.col(f"b_{f}"), F.col(f"a_{f}")) for f in fields})
    parts = [left.join(right, reduce(lambda x, y: x & y, [F.col(f"a_{k}") == F.col(f"b_{k}") for k in key])).where(ok).select("a_id", "b_id") for key in keys]
    return reduce(DataFrame.union, parts).distinct()
