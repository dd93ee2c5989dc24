"""The folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side that was counted is broadcast.
BROADCAST_ROWS = 100_000


def new_folder(spark: SparkSession) -> str:
    """A new path in ``spark.checkpoint.dir``; a temporary folder of this process in local mode only."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/gridloom-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="gridloom-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def kept(df: DataFrame) -> DataFrame:
    """Written and read back: computed once, its lineage cut, safe against lost executors."""
    path = f"{new_folder(df.sparkSession)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side for broadcast after counting it; beyond ``limit`` rows Spark joins it by a shuffle, split where it is skewed."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
