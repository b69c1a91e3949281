"""Solid groups: planned on sizes, encoded and decoded one group to a task."""

from __future__ import annotations

import hashlib
import lzma
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of the dictionary at most; the encoder takes some eleven times as much memory.
DICTIONARY = 64 << 20


def filters(size: int) -> list[dict]:
    """Raw LZMA2, one stream for each group: the dictionary holds the whole group up to ``DICTIONARY``."""
    return [{"id": lzma.FILTER_LZMA2, "preset": 6, "lc": 3, "lp": 0, "pb": 0, "nice_len": 273, "mf": lzma.MF_BT4, "dict_size": min(DICTIONARY, max(4096, 1 << max(0, size - 1).bit_length()))}]


def next_fit(df: DataFrame, family: str, order: str, size: str, cap: int) -> DataFrame:
    """Members of each family in order, a new group whenever the next would pass the cap.

    Only ids and sizes move. Families are streamed from sorted partitions, so none has to fit in memory.
    """
    kinds = dict(df.select(family, order, size).dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, group, used = None, 0, 0
        for batch in batches:
            groups, offsets = [], []
            for f, n in zip(batch[family], batch[size], strict=True):
                if now is None or f != now[0]:
                    now, group, used = (f,), 0, 0
                elif used and used + n > cap:
                    group, used = group + 1, 0
                groups.append(group)
                offsets.append(used)
                used += int(n)
            yield batch.assign(group_no=groups, offset=offsets)

    rows = df.select(family, order, size).repartition(family).sortWithinPartitions(family, order)
    return rows.mapInPandas(run, f"`{family}` {kinds[family]}, `{order}` {kinds[order]}, `{size}` {kinds[size]}, group_no long, offset long")


def encode_groups(df: DataFrame, group: list[str], order: str, content: str) -> DataFrame:
    """One row per group: raw and stored size, digest of the raw bytes, data. Groups are capped, so one fits a task."""
    kinds = ", ".join(f"`{n}` {k}" for n, k in df.select(*group).dtypes)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        raw = b"".join(map(bytes, rows[content]))
        data = lzma.compress(raw, lzma.FORMAT_RAW, filters=filters(len(raw)))
        if lzma.decompress(data, lzma.FORMAT_RAW, filters=filters(len(raw))) != raw:
            raise ValueError("a group does not come back from its encoding")
        return pd.DataFrame([(*rows.iloc[0][group], len(raw), len(data), hashlib.sha256(raw).hexdigest(), data)], columns=[*group, "raw_size", "stored_size", "sha256", "data"])

    return df.select(*group, order, content).groupBy(*group).applyInPandas(run, f"{kinds}, raw_size long, stored_size long, sha256 string, data binary")


def decode_members(groups: DataFrame, members: DataFrame, group: list[str], key: str) -> DataFrame:
    """(key, content): each group (data, sha256, and raw_size or size) is decoded once and cut at its members' offset and size."""
    size = F.col("raw_size" if "raw_size" in groups.columns else "size").cast("long").alias("size")
    kind = dict(members.dtypes)[key]
    plan = members.groupBy(*group).agg(F.collect_list(F.struct(F.col(key).alias("key"), F.col("offset").cast("long").alias("offset"), F.col("size").cast("long").alias("size"))).alias("members"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, size, digest, wanted in zip(batch["data"], batch["size"], batch["sha256"], batch["members"], strict=True):
                raw = lzma.decompress(bytes(data), lzma.FORMAT_RAW, filters=filters(int(size)))
                if hashlib.sha256(raw).hexdigest() != digest:
                    raise ValueError("a group's bytes do not have its digest")
                yield pd.DataFrame({key: [m["key"] for m in wanted], "content": [raw[m["offset"] : m["offset"] + m["size"]] for m in wanted]})

    return groups.select(*group, "data", "sha256", size).join(plan, group).select("data", "size", "sha256", "members").mapInPandas(run, f"`{key}` {kind}, content binary")
