"""A Spark session with the settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """AQE and ANSI stay on, times are UTC; shuffle partitions are left to the cluster unless given."""
    builder = SparkSession.builder.appName("ark")
    if master:
        builder = builder.master(master)
    fixed = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    return builder.config(map=fixed | conf).getOrCreate()
