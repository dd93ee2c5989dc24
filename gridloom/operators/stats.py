"""Statistics of pixel series, all from one aggregation.

Only the statistics asked for are computed; whole numbers are truncated towards
zero, as the bands that they become are integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import cosine_day, season_day, start_day
from .series import backward_fill, by, forward_fill

VALID = (0, 10000)


def valid(value: str) -> Column:
    return F.when((F.col(value) > VALID[0]) & (F.col(value) < VALID[1]), F.col(value))


def trunc(x: Column) -> Column:
    return x.cast("int")


def _day_of(value: str, day: str, most: bool, first_month: int) -> Column:
    """Day of the season of the first largest (smallest) value."""
    key = F.struct((-F.col(value) if most else F.col(value)).alias("v"), F.col(day).alias("d"))
    return season_day(F.min(key)["d"], start_day(first_month))


def statistics(names: list[str], value: str = "value", day: str = "date", first_month: int = 6, n_images: int | Column | None = None) -> list[Column]:
    """Aggregates by their public names."""
    v = F.col(value)
    avg, sd = trunc(F.avg(v)), trunc(F.round(F.stddev_pop(v), 6))  # rounded first: noise must not cost a unit
    top = lambda: _day_of(value, day, True, first_month)
    low = lambda: _day_of(value, day, False, first_month)
    images = F.lit(n_images) if isinstance(n_images, int) else n_images
    made = {
        "maxv": lambda: F.max(v), "minv": lambda: F.min(v), "amp": lambda: F.max(v) - F.min(v), "avg": lambda: avg, "med": lambda: trunc(F.median(v)),
        "sd": lambda: sd, "cv": lambda: trunc(F.when(avg != 0, sd / avg * 10000)),
        "maxd": top, "mind": low, "maxdc": lambda: cosine_day(top()), "mindc": lambda: cosine_day(low()),
        "numobs": lambda: F.count(v), "perclear": lambda: trunc(100 * F.count(v) / images),
        "gapavg": lambda: trunc((F.datediff(F.max(day), F.min(day)) + 1) / F.when(F.count(v) > 0, F.count(v))),
        "slp": lambda: trunc(F.round(F.regr_slope(v, F.unix_date(day)), 6)),
        "p5": lambda: F.percentile(v, 0.05), "p95": lambda: F.percentile(v, 0.95),
        "energy": lambda: F.sum(v * v) / F.when(F.max(v) != 0, F.max(v) * F.max(v) * F.count(v)),
        "posmin": lambda: F.coalesce(F.min(F.when(v > 0, v)), F.lit(VALID[1])), "posmed": lambda: trunc(F.median(F.when(v > 0, v))),
    }
    return [made[n]().alias(n) for n in names]


def season_statistics(df: DataFrame, seasons: DataFrame, keys: list[str], names: list[str], value: str = "value", day: str = "date", first_month: int = 6) -> DataFrame:
    """Statistics by key, season and year: one exchange for all seasons."""
    from ..plans.calendar import in_seasons

    return in_seasons(df, seasons, day).groupBy(*keys, F.col("name").alias("season"), "year").agg(*statistics(names, value, day, first_month))


def composite(stats: DataFrame, keys: list[str], names: list[str], seasons: list[str]) -> DataFrame:
    """One row a pixel and year, one column ``<stat>-<season>`` each."""
    out = stats.groupBy(*keys, "year").pivot("season", seasons).agg(*(F.first(n).alias(n) for n in names))
    if len(names) == 1:
        return out.select(*keys, "year", *(F.col(f"`{s}`").alias(f"{names[0]}-{s}") for s in seasons))
    return out.select(*keys, "year", *(F.col(f"`{s}_{n}`").alias(f"{n}-{s}") for s in seasons for n in names))


def year_bands(stats: DataFrame, keys: list[str], name: str, years: list[int]) -> DataFrame:
    """One column a year of one statistic."""
    out = stats.groupBy(*keys).pivot("year", years).agg(F.first(name))
    return out.select(*keys, *(F.col(f"`{y}`").alias(f"{name}_{y}") for y in years))


def longest_gap(df: DataFrame, keys: list[str], value: str = "value", day: str = "date") -> DataFrame:
    """gapmax: most days between valid observations that follow each other."""
    rows = df.filter(valid(value).isNotNull()).withColumn("gl_gap", F.datediff(day, F.lag(day).over(by(keys, day))))
    return rows.groupBy(*keys).agg(F.max("gl_gap").alias("gapmax"))


def change_share(df: DataFrame, keys: list[str], threshold: int, value: str = "value", day: str = "date", limit: int = 2, checked: bool = True) -> DataFrame:
    """numdelta: percent of steps past a threshold (down if negative) among observations, after short gaps are filled.

    Values outside of ``VALID`` are gaps; with ``checked`` False only nulls are.
    """
    filled = df.withColumn("gl_v", valid(value) if checked else F.col(value)).withColumn("gl_f", forward_fill("gl_v", keys, limit, day))
    filled = filled.withColumn("gl_f", F.coalesce("gl_f", backward_fill("gl_f", keys, limit, day)))
    step = F.col("gl_f") - F.lag("gl_f").over(by(keys, day))
    filled = filled.withColumn("gl_s", step)
    past = F.col("gl_s") <= threshold if threshold < 0 else F.col("gl_s") >= threshold
    return filled.groupBy(*keys).agg(trunc(100 * F.count_if(past) / F.when(F.count("gl_v") > 0, F.count("gl_v"))).alias("numdelta"))


def large_sum(value: str, limit: float) -> Column:
    return F.when(F.sum(value) >= limit, 1).otherwise(0)


def mean_step(df: DataFrame, keys: list[str], value: str = "value", day: str = "date") -> DataFrame:
    """Mean absolute difference of neighbours."""
    return df.withColumn("gl_s", F.abs(F.col(value) - F.lag(value).over(by(keys, day)))).groupBy(*keys).agg(F.avg("gl_s").alias("mean_step"))


def quarter_slopes(df: DataFrame, keys: list[str], value: str = "value", day: str = "date") -> DataFrame:
    """Absolute slope by position in each quarter of a series."""
    rows = df.withColumn("i", F.row_number().over(by(keys, day)) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    bound = lambda k: F.floor(0.25 * F.col("n") * k)
    part = lambda k: (F.col("i") >= bound(k)) & (F.col("i") < bound(k + 1))
    return rows.groupBy(*keys).agg(*(F.abs(F.regr_slope(F.when(part(k), F.col(value)), F.col("i"))).alias(f"slope_q{k + 1}") for k in range(4)))


def residuals(df: DataFrame, keys: list[str], value: str = "value", day: str = "date", legacy: bool = False) -> DataFrame:
    """sum_rss: squared residuals of a line by position, over range squared times n.  ``legacy`` applies the slope twice."""
    w = Window.partitionBy(*keys)
    rows = df.withColumn("i", F.row_number().over(by(keys, day)) - 1)
    rows = rows.withColumn("b1", F.regr_slope(value, "i").over(w)).withColumn("b0", F.regr_intercept(value, "i").over(w))
    x = F.col("b1") * F.col("i") if legacy else F.col("i")
    err = F.pow(F.col(value) - (F.col("b0") + F.col("b1") * x), F.lit(2))
    spread = F.max(value) - F.min(value)
    return rows.groupBy(*keys).agg((F.sum(err) / F.when(spread != 0, spread * spread * F.count(value))).alias("sum_rss"))


def nearest_to_day(df: DataFrame, keys: list[str], day_of_year: int, value: str = "value", day: str = "date") -> DataFrame:
    """The value of the image nearest to a day of the year, by key and year."""
    order = F.struct(F.abs(F.dayofyear(day) - day_of_year).alias("d"), F.col(day).alias("t"))
    return df.groupBy(*keys, F.year(day).alias("year")).agg(F.min_by(value, order).alias("value"))


def row_median(df: DataFrame, value: str = "value", day: str = "date") -> DataFrame:
    """Median and sample deviation over all series, by date."""
    return df.groupBy(day).agg(F.median(value).alias("ALL"), F.stddev_samp(value).alias("std"))
