"""Set export and snapshot links."""

from __future__ import annotations

import hashlib
import zipfile

from pyspark.sql import functions as F

from ark.catalog import Catalog
from ark.operators import exporting, storage


def test_export_and_links(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "c"))
    data = {"One.bin": b"1" * 3000, "Two.bin": b"2" * 10, "~hack.bin": b"h"}
    storage.store(catalog, spark.createDataFrame([("f", c) for c in data.values()], "family string, content binary"), block=1000, cap=2000)
    ids = {r.sha256: r.id for r in catalog.objects.collect()}
    rows = [("Game A", n, ids[hashlib.sha256(c).hexdigest()]) for n, c in data.items()]
    members = spark.createDataFrame(rows, "game string, name string, object_id long")
    out = {r.name: r for r in exporting.export_set(catalog, members, str(tmp_path / "plain"), layout="letter").collect()}
    assert {k: r.status for k, r in out.items()} == {"O/One.bin": "written", "T/Two.bin": "written", "H/~hack.bin": "written"}
    assert (tmp_path / "plain/O/One.bin").read_bytes() == data["One.bin"]
    zips = exporting.export_set(catalog, members, str(tmp_path / "zips"), archives=True).collect()
    assert [(z.name, z.status) for z in zips] == [("Game A.zip", "written")]
    with zipfile.ZipFile(tmp_path / "zips/Game A.zip") as z:
        assert {n: z.read(n) for n in z.namelist()} == data
    files = catalog.objects.select(F.concat(F.lit("x"), F.substring("sha256", 1, 4)).alias("id"), "size", F.upper("crc32").alias("crc32"), F.lit(None).cast("string").alias("md5"), "sha1", F.lit(None).cast("string").alias("sha256"))
    links = exporting.snapshot_links(catalog, files)
    assert links["objects"].count() == 3 and links["entries"].count() == 0 and links["anomalies"].count() == 3
    wrong = files.withColumn("crc32", F.lit("00000000"))
    assert exporting.snapshot_links(catalog, wrong)["objects"].count() == 0
