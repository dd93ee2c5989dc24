"""Best available pixel, medoid, reference images, gap filling and blending of sensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEAST = 0.1


def logistic(x: Column, x0: float, r: float) -> Column:
    return 1 / (1 + F.exp(-r * (x - x0)))


def floored(x: Column) -> Column:
    """A score of at least ``LEAST``; 1 where its input is missing."""
    return F.coalesce(F.greatest(x, F.lit(LEAST)), F.lit(1.0))


def day_score(days: Column, most: float) -> Column:
    return F.greatest(F.exp(-0.5 * F.pow(days / (0.33 * most), F.lit(2))), F.lit(LEAST))


def year_score(years: Column) -> Column:
    return F.when(years == 0, 1.0).when(years == 1, 0.68).when(years == 2, 0.42).otherwise(LEAST)


def spectral_score(ref: Column, value: Column) -> Column:
    return floored(logistic(F.abs(ref - value), 0.2, -20.0))


def cloud_score(distance: Column, most: float) -> Column:
    return floored(logistic(distance / most, 0.5, 10.0))


def haze_score(blue: Column, red: Column) -> Column:
    hot = blue - 0.5 * red - 0.08
    return floored(logistic(1 - 1 / (1 + F.exp(20.0 * (hot + 0.075))), 0.5, -10.0))


def sun_score(zenith: Column) -> Column:
    return floored(1 / (1 + F.exp(10.0 * (F.radians(zenith) - 0.5))))


def total_score(cloud: Column, day: Column, year: Column, spectral: Column, haze: Column, sun: Column) -> Column:
    return (cloud + day + year + 2 * spectral + haze + sun) / 7


def best_pixel(df: DataFrame, keys: list[str], score: str, order: str, value: str) -> DataFrame:
    """The value with the highest score, the first in order of equal ones; missing values are 0."""
    key = F.struct(F.col(score).alias("s"), (-F.col(order)).alias("o"))
    return df.groupBy(*keys).agg(F.coalesce(F.max_by(value, key), F.lit(0)).alias("bap"), F.max(score).alias("score"))


def medoid(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The value with the least sum of absolute differences to all others of its pixel, the first in order of equal ones.

    Sorted by value, the sum for the i-th of n is v (2 i - n) - 2 * (sum of
    smaller ones) + sum of all, so no pairs are made.
    """
    rows = df.filter(F.col(value).isNotNull())
    w = Window.partitionBy(*keys).orderBy(value, order)
    every = Window.partitionBy(*keys)
    v = F.col(value)
    i, n = F.row_number().over(w), F.count(F.lit(1)).over(every)
    below = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("gl_far", v * (2 * i - n) - 2 * below + F.sum(value).over(every))
    return rows.groupBy(*keys).agg(F.min_by(value, F.struct(F.round("gl_far", 9), order)).alias("medoid"))


def vector_medoid(df: DataFrame, group: str, key: str, vector: str) -> DataFrame:
    """The vector with the least sum of absolute differences, summed over dimensions, to all others of its group: group, key, far.

    Per dimension the sum over sorted values gives each row's share, so the work is n log n a dimension.
    """
    long = df.select(group, key, F.posexplode(vector).alias("gl_d", "gl_v"))
    long = long.withColumn("gl_v", F.col("gl_v").cast("double"))
    w = Window.partitionBy(group, "gl_d").orderBy("gl_v", key)
    every = Window.partitionBy(group, "gl_d")
    i, n = F.row_number().over(w), F.count(F.lit(1)).over(every)
    below = F.sum("gl_v").over(w.rowsBetween(Window.unboundedPreceding, 0))
    far = long.withColumn("gl_f", F.col("gl_v") * (2 * i - n) - 2 * below + F.sum("gl_v").over(every))
    total = far.groupBy(group, key).agg(F.round(F.sum("gl_f"), 4).alias("far"))
    return total.groupBy(group).agg(F.min(F.struct("far", key)).alias("m")).select(group, f"m.{key}", "m.far")


def reference_image(df: DataFrame, keys: list[str], bands: list[str]) -> DataFrame:
    """The temporal median of each band."""
    return df.groupBy(*keys).agg(*(F.median(b).alias(b) for b in bands))


def nearest_images(df: DataFrame, keys: list[str], day: str, target: Column, n: int, most: int) -> DataFrame:
    """The ``n`` images nearest to a date, at most ``most`` days from it."""
    rows = df.withColumn("gl_d", F.abs(F.datediff(F.col(day), target))).filter(F.col("gl_d") <= most)
    w = Window.partitionBy(*keys).orderBy("gl_d", day)
    return rows.withColumn("gl_n", F.row_number().over(w)).filter(F.col("gl_n") <= n).drop("gl_n", "gl_d")


def fill_from_nearest(df: DataFrame, keys: list[str], value: str, day: str, most: int) -> DataFrame:
    """Missing values by the value nearest in time, the earlier of equal ones, at most ``most`` days away."""
    w = Window.partitionBy(*keys).orderBy(day)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(day).alias("d"), F.col(value).alias("v")))
    a = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    falling = Window.partitionBy(*keys).orderBy(F.col(day).desc())
    b = F.last(known, ignorenulls=True).over(falling.rowsBetween(Window.unboundedPreceding, 0))
    rows = df.withColumn("gl_a", a).withColumn("gl_b", b)
    da, db = F.datediff(F.col(day), F.col("gl_a.d")), F.datediff(F.col("gl_b.d"), F.col(day))
    use_a = F.col("gl_b").isNull() | (F.col("gl_a").isNotNull() & (da <= db))
    near = F.when(use_a & (da <= most), F.col("gl_a.v")).when(~use_a & (db <= most), F.col("gl_b.v"))
    return rows.withColumn(value, F.coalesce(F.col(value), near)).drop("gl_a", "gl_b")


def blended(fine: DataFrame, coarse: DataFrame, keys: list[str], half: int, value: str = "value") -> DataFrame:
    """Spatial and temporal adaptive blending: the fine image of the base day plus the coarse change, weighted over a window.

    ``fine`` has row, col and value; ``coarse`` has row, col, ``then`` (base day)
    and ``now``.  Neighbours weigh by spectral, temporal and spatial distance
    (published form: 1 / (S * T * D)).
    """
    both = fine.join(coarse, [*keys, "row", "col"])
    s, t = F.abs(F.col(value) - F.col("then")) + 1e-4, F.abs(F.col("now") - F.col("then")) + 1e-4
    both = both.withColumn("gl_w", 1 / (s * t)).withColumn("gl_p", F.col(value) + F.col("now") - F.col("then"))
    near = both.select(*keys, "row", "col", "gl_w", "gl_p")
    steps = F.array(*(F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc"), F.lit(1 + (dr * dr + dc * dc) ** 0.5 / max(1, half)).alias("d")) for dr in range(-half, half + 1) for dc in range(-half, half + 1)))
    # Each pixel adds to the (2 half + 1)^2 around it; sums by target pixel.
    out = near.select(*keys, F.explode(steps).alias("s"), "row", "col", "gl_w", "gl_p")
    out = out.select(*keys, (F.col("row") + F.col("s.dr")).alias("row"), (F.col("col") + F.col("s.dc")).alias("col"), (F.col("gl_w") / F.col("s.d")).alias("w"), "gl_p")
    sums = out.groupBy(*keys, "row", "col").agg((F.sum(F.col("w") * F.col("gl_p")) / F.sum("w")).alias("blended"))
    return fine.join(sums, [*keys, "row", "col"])


def shifts(pairs: DataFrame, cell: str, ref: str, img: str) -> DataFrame:
    """cell, shift_row, shift_col: how far an image lies from the reference, by phase correlation of whole cells.

    A cell's pixels are one group, bounded by the size of an image.
    """
    import numpy as np
    import pandas as pd

    def one(key: tuple, px: pd.DataFrame) -> pd.DataFrame:
        n, m = px["row"].max() + 1, px["col"].max() + 1
        a, b = np.zeros((n, m)), np.zeros((n, m))
        a[px["row"], px["col"]], b[px["row"], px["col"]] = px[ref].fillna(0), px[img].fillna(0)
        cross = np.fft.fft2(b) * np.conj(np.fft.fft2(a))
        peak = np.fft.ifft2(cross / np.maximum(np.abs(cross), 1e-12)).real
        r, c = np.unravel_index(peak.argmax(), peak.shape)
        return pd.DataFrame({cell: [key[0]], "shift_row": [int(r - n if r > n // 2 else r)], "shift_col": [int(c - m if c > m // 2 else c)]})

    return pairs.groupBy(cell).applyInPandas(one, f"`{cell}` {pairs.schema[cell].dataType.simpleString()}, shift_row int, shift_col int")


def fused(sensors: dict[str, DataFrame], keys: list[str], value: str = "value", day: str = "date", linear: dict[str, tuple[float, float]] | None = None, most: int = 0) -> DataFrame:
    """keys, day, value, sensor of several sensors' series: of each day the first sensor, in the order given, that has a value; values of a sensor
    in ``linear`` are adjusted by its (gain, offset) first.  Days on which all are missing are filled from the nearest day, up to ``most`` days away."""
    every = None
    for i, (name, df) in enumerate(sensors.items()):
        gain, offset = (linear or {}).get(name, (1.0, 0.0))
        rows = df.select(*keys, day, (F.col(value) * gain + offset).alias(value), F.lit(i).alias("gl_i"), F.lit(name).alias("sensor"))
        every = rows if every is None else every.unionByName(rows)
    best = F.min(F.when(F.col(value).isNotNull(), F.struct("gl_i", value, "sensor")))
    out = every.groupBy(*keys, day).agg(best.alias("gl_b")).select(*keys, day, F.col(f"gl_b.{value}").alias(value), "gl_b.sensor")
    return fill_from_nearest(out, keys, value, day, most) if most else out
