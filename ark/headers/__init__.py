"""Header readers as a DataFrame operator."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .readers import READERS

RESULT = "format string, parse_status string, components array<struct<kind:string,offset:long,size:long>>, hardware string, warnings array<string>"


def read_headers(files: DataFrame, key: str = "path") -> DataFrame:
    """(key, platform, format, parse_status, components, hardware, warnings) of rows with key, platform and content.

    Content is read by Arrow batches; a file that a reader chokes on is invalid with the error as its warning, and
    the others go on. Unknown platforms are read as plain files.
    """
    kind = dict(files.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, platform, content in zip(batch[key], batch["platform"], batch["content"], strict=True):
                try:
                    row = READERS.get(platform, READERS["supracan"])(bytes(content or b"")).row()
                except Exception as error:  # noqa: BLE001  one bad file must not end the scan
                    row = {"format": "unknown", "parse_status": "invalid", "components": [], "hardware": None, "warnings": [f"error: {error}"]}
                rows.append({key: k, "platform": platform} | row)
            yield pd.DataFrame(rows)

    return files.select(key, "platform", "content").mapInPandas(run, f"`{key}` {kind}, platform string, {RESULT}")


def components(files: DataFrame, read: DataFrame, key: str = "path") -> DataFrame:
    """One row per component with its digest; cut in the JVM."""
    parts = read.select(key, F.posexplode("components").alias("ordinal", "c")).select(key, "ordinal", "c.*")
    cut = F.substr(F.col("content"), (F.col("offset") + 1).cast("int"), F.col("size").cast("int"))
    return parts.join(files.select(key, "content"), key).select(key, "ordinal", "kind", "offset", "size", F.sha2(cut, 256).alias("sha256"))
