"""A session with the settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive plans; master and partitions only where a cluster does not set them."""
    b = SparkSession.builder.appName("gridloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
