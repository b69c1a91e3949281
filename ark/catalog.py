"""A catalog: a folder with one Parquet table for each of the model's tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import audit
from .schemas import PAYLOAD, REFERENCES, SCHEMAS


class Catalog:
    """``c.objects`` is a table; a table that was never written is empty. Tables are only ever appended to."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.table(name)

    def written(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def table(self, name: str) -> DataFrame:
        if self.written(name):
            return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}")
        return self.spark.createDataFrame([], SCHEMAS[name])

    def append(self, name: str, rows: DataFrame) -> None:
        rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]]).write.mode("append").parquet(f"{self.folder}/{name}")

    @property
    def payload_available(self) -> bool:
        found = self.meta.where("key = 'payload_available'").select("value").head()
        return found is None or found[0] != "false"

    def _each(self, names: list[str], of: Callable[[str], DataFrame], schema: str, empty: Callable[[str], tuple]) -> DataFrame:
        """One row for each table; tables that were never written need no job."""
        rest = self.spark.createDataFrame([empty(n) for n in names if not self.written(n)], schema)
        return reduce(DataFrame.union, [of(n) for n in names if self.written(n)], rest)

    def stats(self) -> DataFrame:
        """(name, n) of every table."""
        return self._each(list(SCHEMAS), lambda n: self.table(n).agg(F.lit(n).alias("name"), F.count("*").alias("n")), "name string, n long", lambda n: (n, 0))

    def audit(self) -> DataFrame:
        """(constraint, orphans) that are broken: references, and payload in a catalog-only edition."""
        checks = [(f"{t}.{c}", self.table(t), c, self.table(p), k) for t, c, p, k in REFERENCES if self.written(t)]
        out = self.spark.createDataFrame([], "constraint string, orphans long")
        if checks:
            out = out.union(audit.orphans(checks))
        if not self.payload_available:
            for name in filter(self.written, PAYLOAD):
                out = out.union(self.table(name).agg(F.lit(f"{name} without payload"), F.count("*")))
        return out.where("orphans > 0")

    def digests(self) -> DataFrame:
        """(name, n_rows, digest) of every table: equal for equal contents, whatever the order."""

        def one(name: str) -> DataFrame:
            df = self.table(name)
            for f in SCHEMAS[name]:
                if f.dataType.typeName() == "binary":
                    df = df.withColumn(f.name, F.hex(f.name))
            return audit.table_digest(df, name)

        return self._each(list(SCHEMAS), one, "name string, n_rows long, digest string", lambda n: (n, 0, audit.EMPTY_DIGEST))

    def without_payload(self, folder: str) -> Catalog:
        """A copy for queries only: payload tables stay empty, and the meta table says so."""
        copy = Catalog(self.spark, folder)
        for name in filter(self.written, SCHEMAS):
            if name not in (*PAYLOAD, "meta"):
                copy.append(name, self.table(name))
        note = self.spark.createDataFrame([("payload_available", "false")], SCHEMAS["meta"])
        copy.append("meta", self.meta.where("key <> 'payload_available'").union(note))
        return copy
