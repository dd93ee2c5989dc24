"""Reading and writing the engine's tables."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

OBS = "cell_id int, row int, col int, scene_id string, sensor string, acq_date date, blue int, green int, red int, nir int, swir1 int, swir2 int"
SERIES = "cell_id int, row int, col int, si string, date date, value int"
MASK = "scene_id string, row int, col int, mask smallint"


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None, schema: str | T.StructType | None = None) -> DataFrame:
    """A Parquet table; columns and filters reach the scan."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    """CSV, plain or gzipped, with a given schema: nothing is read to infer it."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, size and time of files; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def scene_index(spark: SparkSession, path: str, schema: str, box: tuple[float, float, float, float], start: str, end: str, sensors: list[str], out: str) -> DataFrame:
    """A (gzipped) scene index cut to a box, dates and sensors, written once as Parquet."""
    rows = csv(spark, path, schema)
    near = (F.col("west") <= box[2]) & (F.col("east") >= box[0]) & (F.col("south") <= box[3]) & (F.col("north") >= box[1])
    rows.filter(near & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & F.col("sensor").isin(sensors)).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def write_series(df: DataFrame, path: str) -> None:
    """A series table in folders by index and year, in files of neighbouring cells sorted by pixel, so that a cell or a window of pixels is a few row groups.

    Files follow the size of the data and not the number of cells, which may be many.
    """
    order = ["si", "year", "cell_id", "row", "col"]
    rows = df.withColumn("year", F.year("date"))
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("si", "year").parquet(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """A table bucketed by pixel, so that joins of such tables need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet").saveAsTable(table)


def compressed(spark: SparkSession, path: str, out: str, codec: str = "zstd") -> None:
    spark.read.parquet(path).write.mode("overwrite").option("compression", codec).parquet(out)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Entries of an append-only log with the time of the call: one atomic write, which parallel writers don't disturb."""
    df.withColumn("logged", F.lit(datetime.now(UTC).replace(tzinfo=None))).write.mode("append").parquet(path)


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last entry of each key in such a log, the largest of equal times."""
    rows = spark.read.parquet(path)
    rest = [c for c in rows.columns if c not in (*keys, "logged")]
    return rows.groupBy(*keys).agg(F.max(F.struct("logged", *rest)).alias("gl_e")).select(*keys, *(F.col(f"gl_e.{c}").alias(c) for c in rest))


def append_scores(df: DataFrame, path: str) -> None:
    """Scores of models (``model`` and measures); the last entry of a model counts."""
    append_log(df, path)


def merge_progress(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` (grid, step, status) put into a progress table by key: appended, the last entry of a key counts.  The table as it is then."""
    append_log(rows, path)
    return latest(spark, path, ["grid", "step"])
