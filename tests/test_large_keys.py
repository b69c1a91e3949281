"""Queries whose made-up ids must not meet the keys of a large table."""

from __future__ import annotations

import os

import pytest

import oracle
from ark import plans

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables, with the parts twice: the second time a million further on."""
    made = str(tmp_path_factory.mktemp("large"))
    for name in os.listdir(SMALL):
        if name != "part.parquet":
            os.symlink(f"{SMALL}/{name}", f"{made}/{name}")
    part = spark.read.parquet(f"{SMALL}/part.parquet")
    part.union(part.selectExpr("p_partkey + 1000000 as p_partkey", *part.columns[1:])).write.parquet(f"{made}/part.parquet")
    return made


@pytest.mark.parametrize("name", ["extended_records", "object_families"])
def test_keys_over_a_million(spark, folder, name):
    assert oracle.difference(plans.QUERIES[name](spark, folder), oracle.duck(folder), plans.ORACLES[name]) == ""
