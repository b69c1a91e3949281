"""What the operators share: tables, shared storage, bounded Arrow batches."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch: long texts must not pile up in a worker.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
#: Bytes of what a worker remembers in one place, by estimate, and the longest key that is worth it.
MEMO_BYTES, LONG_KEY = 64 << 20, 1_024


class Memo(dict):
    """What a worker has met before. It is emptied when it would take more than ``most`` bytes."""

    def __init__(self, most: int = MEMO_BYTES):
        super().__init__()
        self.most, self.held = most, 0

    def room(self, size: int) -> bool:
        """Count ``size`` bytes more; whether the memo was emptied for them."""
        full = self.held + size > self.most
        if full:
            self.clear()
            self.held = 0
        self.held += size
        return full


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a temporary folder is used in local mode; a cluster without one is refused, since
    its executors would not see each other's files.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith(("local[", "local")) or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="ark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/ark-{spark.sparkContext.applicationId}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it again.

    Cuts the lineage, survives lost executors, and gives the planner the table's true size.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def trim() -> None:
    """Give memory that a task has freed back to the system: workers wait for their next stage with little."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for ``mapInPandas`` that leaves its worker small."""

    def held(batches: Iterator) -> Iterator:
        yield from run(batches)
        trim()

    return held


def map_batches(df: DataFrame, make: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """``mapInPandas`` with a function that each task makes once."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = make()
        for batch in batches:
            if len(batch):
                yield step(batch)

    return df.mapInPandas(lean(run), schema)


def text_bytes(text: object) -> bytes:
    """UTF-8 of a text; null is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def documents_only(df: DataFrame) -> DataFrame:
    """doc_id and text: columns with clashing names never meet an operator's own."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sheltered(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """The same columns in the same order; all but ``keep`` get names that no operator uses inside.

    ``toDF(*docs.columns)`` of a result with these columns gives them back.
    """
    return docs.toDF(*[c if c in keep else f"__other_{k}" for k, c in enumerate(docs.columns)])


def fold_of(column: str, parts: int):
    """crc32 of the id as text, modulo parts; null ids are of fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(0))


def with_keys(rows: DataFrame, counted: DataFrame, on: list[str], total: int) -> DataFrame:
    """The rows whose key is among ``counted`` (key columns and n, their rows in ``rows``).

    Keys with over a thousandth of all rows, so a thousand at most, are broadcast: such a key's rows stay where they
    are and no task gathers them. The others are joined by shuffle.
    """
    hot = F.broadcast(counted.where(F.col("n") > total / 1000).select(*on))
    rest = rows.join(hot, on, "left_anti").join(counted.select(*on), on, "left_semi")
    return rows.join(hot, on, "left_semi").union(rest)


def with_counts(rows: DataFrame, counted: DataFrame, on: str, total: int) -> DataFrame:
    """The rows whose key is among ``counted``, each with its key's n; hot keys as in ``with_keys``."""
    hot = F.broadcast(counted.where(F.col("n") > total / 1000).select(on, "n"))
    rest = rows.join(hot.select(on), on, "left_anti").join(counted.where(F.col("n") <= total / 1000).select(on, "n"), on)
    return rows.join(hot, on).select(*rows.columns, "n").union(rest.select(*rows.columns, "n"))


def forget(*tables: DataFrame) -> None:
    """Delete tables written by ``stored`` that no plan reads any more."""
    for df in tables:
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
