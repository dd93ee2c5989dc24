"""The driver's tables in the roles of the engine's: observations, series, classes, rasters.

lineitem holds scenes of pixels (l_suppkey) over seven years, events a month of
daily values of users, orders yearly classes of customers, part a raster of 50
columns, supplier and nation zones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.indices import index
from ..operators.series import merge_same_day, tasks
from ..plans.calendar import Calendar

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
CALENDAR, YEARS = Calendar(), list(range(1994, 2002))
CODES = [143, 221, 75, 114, 40, 30, 150, 74, 164, 207, 250, 215, 148, 98, 161, 184]


def query(name: str, sql: str | None = None):
    def add(f):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def obs(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return table(spark, sf, "lineitem").select(
        c("l_suppkey").alias("px"), c("l_shipdate").cast("date").alias("date"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("scene"),
        (c("l_tax") * 10).alias("blue"), (c("l_discount") * 10).alias("green"), (c("l_quantity") / 50.0).alias("red"), (c("l_extendedprice") / 105000.0).alias("nir"),
        ((c("l_orderkey") % 100) / 100.0).alias("swir1"), ((c("l_partkey") % 100) / 100.0).alias("swir2"),
    )


OBS = """obs AS (SELECT l_suppkey AS px, CAST(l_shipdate AS DATE) AS date, l_orderkey * 10 + l_linenumber AS scene, l_tax * 10 AS blue, l_discount * 10 AS green,
 l_quantity / 5e1 AS red, l_extendedprice / 105e3 AS nir, (l_orderkey % 100) / 1e2 AS swir1, (l_partkey % 100) / 1e2 AS swir2 FROM lineitem)"""
NDVI = "CASE WHEN nir - red = 0 THEN 0e0 ELSE (1 + (nir - red) / (nir + red + 1e-9)) / 2 END"


def ts(spark: SparkSession, sf: str) -> DataFrame:
    """px, date, value: scenes of a day merged, scaled to whole numbers."""
    rows = obs(spark, sf)
    return merge_same_day(rows, ["px"], (index("ndvi") * 10000).cast("int"), parts=tasks(rows))


TS = f"{OBS}, ts AS (SELECT px, date, max(CAST(trunc(({NDVI}) * 10000) AS INTEGER)) AS value FROM obs GROUP BY px, date)"


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """px, date, value of users by day."""
    e = table(spark, sf, "events")
    return e.groupBy(F.col("user_id").alias("px"), F.col("ts").cast("date").alias("date")).agg((F.max("value") * 20).cast("int").alias("value"))


DAILY = "daily AS (SELECT user_id AS px, CAST(ts AS DATE) AS date, CAST(trunc(max(value) * 20) AS INTEGER) AS value FROM events GROUP BY user_id, CAST(ts AS DATE))"


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """daily with days of few values missing."""
    return daily(spark, sf).withColumn("value", F.when(F.col("value") > 300, F.col("value")))


GAPPY = f"{DAILY}, gappy AS (SELECT px, date, CASE WHEN value > 300 THEN value END AS value FROM daily)"


def classes(spark: SparkSession, sf: str) -> DataFrame:
    """px, year, class: the code of the latest order of each year."""
    o = table(spark, sf, "orders")
    last = F.max(F.struct("o_orderdate", "o_orderkey"))["o_orderkey"]
    rows = o.groupBy(F.col("o_custkey").alias("px"), F.year("o_orderdate").alias("year")).agg(last.alias("k"))
    return rows.select("px", "year", F.get(F.array(*map(F.lit, CODES)), (F.col("k") % len(CODES)).cast("int")).alias("class"))


CLASSES = f"""cls AS (SELECT o_custkey AS px, CAST(year(o_orderdate) AS INTEGER) AS year, [{", ".join(map(str, CODES))}][CAST(max({{'d': o_orderdate, 'k': o_orderkey}}).k % {len(CODES)} AS INTEGER) + 1] AS class
 FROM orders GROUP BY o_custkey, year(o_orderdate))"""


def raster(spark: SparkSession, sf: str) -> DataFrame:
    """row, col, value, price and the zone of each pixel."""
    p = table(spark, sf, "part")
    key = F.col("p_partkey")
    return p.select(F.floor(key / 50).cast("int").alias("row"), (key % 50).cast("int").alias("col"), F.col("p_size").alias("value"), F.col("p_retailprice").alias("price"), F.col("p_type").alias("zone"))


RASTER = "ras AS (SELECT CAST(p_partkey // 50 AS INTEGER) AS row, CAST(p_partkey % 50 AS INTEGER) AS col, p_size AS value, p_retailprice AS price, p_type AS zone FROM part)"
N_COLS = 50


def n_rows(df: DataFrame) -> int:
    """Rows of a raster, from its largest row number."""
    return df.agg(F.max("row")).first()[0] + 1
