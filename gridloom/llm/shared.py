"""Tables and broadcasts that all executors can rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows up to which a side that was counted is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a folder of this process where it is unset (local mode, tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        _own_dirs[app] = tempfile.mkdtemp(prefix="gridloom-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return _own_dirs[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/gridloom/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, lineage cut, safe against lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def limit_batches(spark: SparkSession, rows: int = 1024) -> None:
    """From now on Arrow batches of at most ``rows`` rows in this session: whole texts are large rows, and executors small."""
    now = int(spark.conf.get(BATCH_KEY))
    if now <= 0 or now > rows:
        spark.conf.set(BATCH_KEY, str(rows))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for what runs inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what runs inside: whole texts are large rows."""
    now = int(spark.conf.get(BATCH_KEY))
    with setting(spark, BATCH_KEY, str(rows if now <= 0 or now > rows else now)):
        yield


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a side for broadcast after counting it; beyond ``limit`` rows Spark joins it by a shuffle, split where it is skewed."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def running_sums(df: DataFrame, order: str, values: list[str], keys: list[str] | None = None, block: int = 4096) -> DataFrame:
    """``df`` with ``<value>_before``: the sum of each value over the rows before it in ``order``, whole numbers from 0, within ``keys``.

    Sums go by blocks of ``block`` numbers, then over the blocks, so that no
    task sees more than a block of a key, or one row a block and key.
    """
    keys = keys or []
    rows = df.withColumn("gl_block", F.floor(F.col(order) / block))
    upto = (Window.unboundedPreceding, -1)
    whole = rows.groupBy(*keys, "gl_block").agg(*(F.sum(v).alias(v) for v in values))
    over = Window.partitionBy(*keys).orderBy("gl_block").rowsBetween(*upto)
    whole = whole.select(*(F.col(k).alias(f"gl_key_{k}") for k in keys), F.col("gl_block").alias("gl_at"), *(F.coalesce(F.sum(v).over(over), F.lit(0)).alias(f"gl_{v}") for v in values))
    inside = Window.partitionBy(*keys, "gl_block").orderBy(order).rowsBetween(*upto)
    rows = rows.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values})
    same = F.col("gl_block") == F.col("gl_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"gl_key_{k}"))
    both = rows.join(broadcast_if_small(saved(whole, "blocks")), same).withColumns({f"{v}_before": (F.col(f"{v}_before") + F.col(f"gl_{v}")).cast("long") for v in values})
    return both.drop("gl_block", "gl_at", *(f"gl_{v}" for v in values), *(f"gl_key_{k}" for k in keys))


def tasks_for(pieces: int, most: int = 20_000) -> int:
    """Tasks for ``pieces`` that are worked on one after the other: one a piece, beyond ``most`` several a task."""
    per = -(-max(1, pieces) // most)
    return -(-max(1, pieces) // per)


def text_digest(text: Column) -> Column:
    """Which rows have the same text; null equals empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
