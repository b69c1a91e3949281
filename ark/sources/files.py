"""Files and archives as rows, their discovery by time stamps, and verified export."""

from __future__ import annotations

import hashlib
import io
import json
import os
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.archives import canonical_zip
from ..functions.titles import is_safe_name

LARGEST_FILE, LARGEST_ARCHIVE = 256 << 20, 2 << 30
MEMBER = "path string, member_index int, name string, crc32 string, method int, flags int, content binary, fault string"


def members(spark: SparkSession, path: str) -> DataFrame:
    """Plain files and the members of ZIP files, one row each. A bad archive or member is a row with a fault."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files, large = found.where(F.col("length") <= LARGEST_ARCHIVE), found.where(F.col("length") > LARGEST_ARCHIVE)

    def unpack(path: str, data: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            infos = [i for i in z.infolist() if not i.is_dir()]
            if sum(i.file_size for i in infos) > LARGEST_ARCHIVE:
                raise ValueError("archive too large")
            for k, info in enumerate(infos):
                if not is_safe_name(info.filename):
                    yield path, k, info.filename, None, info.compress_type, info.flag_bits, None, "unsafe name"
                    continue
                if info.file_size > LARGEST_FILE:
                    yield path, k, info.filename, None, info.compress_type, info.flag_bits, None, "too large"
                    continue
                content = z.read(info)
                ok = zlib.crc32(content) == info.CRC
                yield path, k, info.filename, f"{info.CRC:08x}", info.compress_type, info.flag_bits, content if ok else None, None if ok else "checksum"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in MEMBER.split(", ")]
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                data = bytes(content)
                if not path.lower().endswith(".zip"):
                    yield pd.DataFrame([(path, -1, os.path.basename(path), f"{zlib.crc32(data):08x}", 0, 0, data, None)], columns=names)
                    continue
                try:
                    for row in unpack(path, data):
                        yield pd.DataFrame([row], columns=names)
                except (zipfile.BadZipFile, ValueError, zlib.error, NotImplementedError, RuntimeError) as error:
                    yield pd.DataFrame([(path, -1, os.path.basename(path), None, 0, 0, None, str(error))], columns=names)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    none = {n: F.lit(None).cast(k).alias(n) for n, k in (c.split() for c in MEMBER.split(", "))}
    faults = none | {"path": F.col("path"), "member_index": F.lit(-1).alias("member_index"), "name": F.substring_index("path", "/", -1).alias("name"), "fault": F.lit("too large").alias("fault")}
    return files.select("path", "content").mapInPandas(run, MEMBER).unionByName(large.select(*faults.values()))


def by_stamp(files: DataFrame, column: str = "path") -> DataFrame:
    """Adds stamp: the (YYYYMMDD-HHMMSS) of a name, or null."""
    found = F.regexp_extract(column, r"\((\d{8}-\d{6})\)", 1)
    return files.withColumn("stamp", F.when(found != "", found))


def paired(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides by stamp; what has no partner stays, so it can be reported."""
    return by_stamp(left).select("stamp", F.col("path").alias("left")).join(by_stamp(right).select("stamp", F.col("path").alias("right")), "stamp", "full")


def unchanged(new: DataFrame, known: DataFrame) -> DataFrame:
    """Paths whose members (name and checksum, in any order) are those already known."""
    listed = lambda df, name: df.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("name", "crc32"))).alias(name))
    return listed(new, "a").join(listed(known, "b"), "path").where("a = b").select("path")


def archive_bytes(plans: DataFrame) -> DataFrame:
    """(plan_id, data, size, sha256) of canonical ZIPs; ``plans``: plan_id, name, content."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        data = canonical_zip([(n, bytes(c)) for n, c in zip(rows["name"], rows["content"], strict=True)])
        return pd.DataFrame([(rows["plan_id"].iloc[0], data, len(data), hashlib.sha256(data).hexdigest())], columns=["plan_id", "data", "size", "sha256"])

    return plans.select("plan_id", "name", "content").groupBy("plan_id").applyInPandas(build, "plan_id long, data binary, size long, sha256 string")


def plan_fingerprints(plans: DataFrame) -> DataFrame:
    """(plan_id, fingerprint): sha256 of the members' names and digests as JSON with sorted members."""

    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        listed = sorted(zip(rows["name"], rows["sha256"], strict=True), key=lambda m: m[0].lower())
        return pd.DataFrame([(rows["plan_id"].iloc[0], hashlib.sha256(json.dumps(listed, ensure_ascii=False).encode()).hexdigest())], columns=["plan_id", "fingerprint"])

    return plans.select("plan_id", "name", "sha256").groupBy("plan_id").applyInPandas(mark, "plan_id long, fingerprint string")


def export_files(files: DataFrame, folder: str) -> DataFrame:
    """Write (name, content, sha256) below a shared folder and return (name, status). Never overwrites; checks what it wrote."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, content, digest in zip(batch["name"], batch["content"], batch["sha256"], strict=True):
                path, status = os.path.join(folder, name), "written"
                if not is_safe_name(name):
                    status = "unsafe"
                elif os.path.exists(path):
                    with open(path, "rb") as f:  # a task that runs again finds its own file
                        status = "present" if hashlib.sha256(f.read()).hexdigest() == digest else "different"
                else:
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    part = f"{path}.{os.getpid()}.part"
                    with open(part, "wb") as f:
                        f.write(bytes(content))
                    with open(part, "rb") as f:
                        good = hashlib.sha256(f.read()).hexdigest() == digest
                    if not good:
                        status = "corrupt"
                    else:
                        try:
                            os.link(part, path)  # fails where another task has made the file meanwhile
                        except FileExistsError:
                            with open(path, "rb") as f:
                                status = "present" if hashlib.sha256(f.read()).hexdigest() == digest else "different"
                    os.unlink(part)
                out.append((name, status))
            yield pd.DataFrame(out, columns=["name", "status"])

    return files.select("name", "content", "sha256").mapInPandas(write, "name string, status string")
