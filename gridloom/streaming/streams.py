"""Streams of observations: windows, sessions, same-day scenes, progress.

An extension: the batch engine has no streams of its own; these give its
composites, gaps and trackers over data that still arrives.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def observations(spark: SparkSession, path: str, schema, files_per_batch: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def windowed(stream: DataFrame, keys: list[str], time: str, width: str, late: str, value: str, slide: str | None = None) -> DataFrame:
    """Composites by window: n, largest, mean.  State of windows past the watermark is dropped."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    out = stream.withWatermark(time, late).groupBy(w, *keys).agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("maxv"), F.avg(value).alias("avg"))
    return out.select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "maxv", "avg")


def sessions(stream: DataFrame, keys: list[str], time: str, gap: str, late: str) -> DataFrame:
    """Runs of observations without a gap."""
    out = stream.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def once_a_day(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """The first scene of each day."""
    return stream.withColumn("day", F.to_date(time)).withWatermark(time, late).dropDuplicatesWithinWatermark([*keys, "day"])


def tracked(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]):
    """Each batch is written once; the checkpoint is the tracker that a stopped job resumes from."""
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def drained(stream: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """All that a stream gives for the data there now, as a table in memory (tests and small reports)."""
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return stream.sparkSession.table(name)
