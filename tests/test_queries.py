"""Every registered query equals its DuckDB SQL on the fixture tables."""

from __future__ import annotations

import os

import pytest

import oracle
from ark import plans

FOLDER = os.environ.get("ARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_equals_sql(spark, con, name):
    assert oracle.difference(plans.QUERIES[name](spark, FOLDER), con, plans.ORACLES[name]) == ""


def test_checksums_are_zlib_s(spark):
    import zlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    for r in plans.QUERIES["checksum_crc"](spark, FOLDER).collect():
        assert r.crc32 == f"{zlib.crc32(texts[r.doc_id].encode()):08x}"


def test_groups_come_back(spark):
    rows = plans.QUERIES["group_roundtrip"](spark, FOLDER)
    assert rows.where("same is not true").count() == 0
    assert rows.count() == 200


def test_ingest_is_idempotent(spark):
    rows = plans.QUERIES["ingest_idempotent"](spark, FOLDER).collect()
    assert sum(r.n for r in rows) == 1000
    assert all(r.n == r.ids for r in rows)
