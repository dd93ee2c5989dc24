"""Neighbourhood operators on rasters as tables (keys, row, col, value).

Square kernels are separable: a range window along the row, then one along the
column.  A window holds one line of a raster cell, so its size is that of the
image, not of the data.  Mirrored edges are rows copied outwards first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import checked_broadcast, kept


def mirrored(df: DataFrame, half: int, n_rows: int, n_cols: int, repeat_edge: bool = True) -> DataFrame:
    """Pixels and their mirror images up to ``half`` beyond the edges; the edge pixel itself is repeated or not."""
    shift = 1 if repeat_edge else 0

    def images(c: str, n: int) -> Column:
        low, high = F.lit(-shift) - F.col(c), F.lit(2 * n - 2 + shift) - F.col(c)
        return F.array_distinct(F.filter(F.array(F.col(c).cast("int"), low.cast("int"), high.cast("int")), lambda x: x.between(-half, n - 1 + half)))

    return df.withColumn("row", F.explode(images("row", n_rows))).withColumn("col", F.explode(images("col", n_cols)))


def cropped(df: DataFrame, n_rows: int, n_cols: int) -> DataFrame:
    return df.filter(F.col("row").between(0, n_rows - 1) & F.col("col").between(0, n_cols - 1))


def lines(keys: list[str], along: str, low: int, high: int):
    across = "col" if along == "row" else "row"
    return Window.partitionBy(*keys, across).orderBy(along).rangeBetween(low, high)


def square(df: DataFrame, keys: list[str], half: int, how: Callable[[Column], Column], value: str = "value", name: str = "focal") -> DataFrame:
    """An aggregate that is its own aggregate (sum, max, min) over the (2 half + 1)^2 pixels around each."""
    rows = df.withColumn(name, how(F.col(value)).over(lines(keys, "col", -half, half)))
    return rows.withColumn(name, how(F.col(name)).over(lines(keys, "row", -half, half)))


def focal_mean(df: DataFrame, keys: list[str], half: int, n_rows: int, n_cols: int, value: str = "value", name: str = "focal") -> DataFrame:
    """Mean with mirrored edges."""
    out = square(mirrored(df, half, n_rows, n_cols), keys, half, F.sum, value, name)
    return cropped(out, n_rows, n_cols).withColumn(name, F.col(name) / (2 * half + 1) ** 2)


def focal_max(df: DataFrame, keys: list[str], half: int, value: str = "value", name: str = "focal") -> DataFrame:
    return square(df, keys, half, F.max, value, name)


def dilated(df: DataFrame, keys: list[str], times: int, value: str = "value", name: str = "focal") -> DataFrame:
    """A mask grown by ``times`` pixels in all eight directions."""
    return square(df, keys, times, F.max, value, name)


def crossed(df: DataFrame, keys: list[str], how: Callable[..., Column], value: str = "value", name: str = "focal") -> DataFrame:
    """greatest (dilate) or least (erode) over a pixel and its four neighbours."""
    step = lambda along, k: F.max(value).over(lines(keys, along, k, k))
    return df.withColumn(name, how(F.col(value), *(step(a, k) for a in ("row", "col") for k in (-1, 1))))


def cleaned(df: DataFrame, keys: list[str], value: str = "value", name: str = "focal") -> DataFrame:
    """Opened, then closed, with the cross."""
    for i, how in enumerate((F.least, F.greatest, F.greatest, F.least)):
        df = crossed(df, keys, how, value if i == 0 else name, "gl_next").drop(*([name] if i else [])).withColumnRenamed("gl_next", name)
    return df


def distance_to(df: DataFrame, keys: list[str], target: Column, most: int = 10, name: str = "distance") -> DataFrame:
    """Distance to the nearest target pixel, at most ``most``: along rows by windows, then over the rows within reach."""
    w = lambda a, b: Window.partitionBy(*keys, "row").orderBy("col").rangeBetween(a, b)
    at = F.when(target, F.col("col"))
    rows = df.withColumn("gl_d", F.least(F.col("col") - F.max(at).over(w(-most, 0)), F.min(at).over(w(0, most)) - F.col("col")))
    by_col = Window.partitionBy(*keys, "col").orderBy("row")
    parts = [F.max(F.col("gl_d") * F.col("gl_d")).over(by_col.rangeBetween(k, k)) + k * k for k in range(-most, most + 1)]
    return rows.withColumn(name, F.least(F.sqrt(F.coalesce(F.least(*parts), F.lit(float(most * most)))), F.lit(float(most)))).drop("gl_d")


def forest_edges(df: DataFrame, keys: list[str], dense: list[int], mature: int, edge: int, cls: str = "class") -> DataFrame:
    """``dense`` forest beside a pixel that is no forest (a class of ``mature`` or less) becomes ``edge``; other forest stays."""
    rows = focal_max(df.withColumn("gl_o", F.when(F.col(cls) > mature, 0).otherwise(1)), keys, 1, "gl_o", "gl_e")
    return rows.withColumn(cls, F.when(F.col(cls).isin(dense) & (F.col("gl_e") == 1), F.lit(edge)).otherwise(F.col(cls))).drop("gl_o", "gl_e")


def small_fields(df: DataFrame, low_crops: list[int], big_crops: list[int], small: int, cls: str = "majority", size: str = "size", around: str = "around") -> DataFrame:
    """``cls`` with small fields as ``small``: low crops below 5 ha, and big crops of 2 ha or less where fields around are below 20 ha on average.

    Sizes are in tenths of a hectare; big crops where fields around are above 20 ha are left alone.
    """
    big = F.col(cls).isin(big_crops)
    low = F.col(cls).isin(low_crops) & (F.col(size) < 50) & ~(big & (F.col(around) > 200))
    return df.withColumn(cls, F.when((big & (F.col(size) <= 20) & (F.col(around) < 200)) | low, F.lit(small)).otherwise(F.col(cls)))


def refined_area(df: DataFrame, keys: list[str], buffer: int = 0, area: str = "area", shape: str | None = "APrEf", name: str = "area10") -> DataFrame:
    """Field areas a tenth as large, to whole numbers (half to even), of polygons that hold several fields a half (shape of 200 or more) or
    a third (400 or more), and spread by ``buffer`` pixels."""
    part = F.col(area).cast("double")
    if shape:
        part = F.when(F.col(shape) >= 400, part / 3).when(F.col(shape) >= 200, part / 2).otherwise(part)
    rows = df.withColumn(name, F.bround(part / 10, 0).cast("int"))
    return square(rows, keys, buffer, F.max, name, name) if buffer else rows


def mean_field_size(df: DataFrame, keys: list[str], half: int, n_rows: int, n_cols: int, area: str = "area10", name: str = "around") -> DataFrame:
    """Mean area over a neighbourhood with mirrored edges, to whole numbers; none is 0."""
    rows = focal_mean(df.withColumn("gl_a", F.coalesce(F.col(area), F.lit(0))), keys, half, n_rows, n_cols, "gl_a", name)
    return rows.withColumn(name, F.bround(F.round(name, 9), 0).cast("int")).drop("gl_a")


def slope_aspect(df: DataFrame, keys: list[str], res: float, value: str = "elev") -> DataFrame:
    """``slope`` and ``aspect`` in radians by Horn's third-order differences; null at the edges."""
    shifted = df.withColumns({f"gl_{k}": F.max(value).over(lines(keys, "col", k, k)) for k in (-1, 0, 1)})
    at = lambda r, c: F.max(f"gl_{c}").over(lines(keys, "row", r, r))
    dx = ((at(-1, 1) + 2 * at(0, 1) + at(1, 1)) - (at(-1, -1) + 2 * at(0, -1) + at(1, -1))) / (8 * res)
    dy = ((at(1, -1) + 2 * at(1, 0) + at(1, 1)) - (at(-1, -1) + 2 * at(-1, 0) + at(-1, 1))) / (8 * res)
    rows = shifted.withColumn("dx", dx).withColumn("dy", dy)
    return rows.withColumn("slope", F.atan(F.hypot("dx", "dy"))).withColumn("aspect", F.atan2(F.col("dy"), -F.col("dx"))).drop("dx", "dy", "gl_-1", "gl_0", "gl_1")


def illumination(slope: Column, aspect: Column, zenith: float, azimuth: float) -> Column:
    """Cosine of the angle between sun and slope."""
    z, a = np.deg2rad(zenith), np.deg2rad(azimuth)
    return F.cos(slope) * float(np.cos(z)) + F.sin(slope) * float(np.sin(z)) * F.cos(F.lit(float(a)) - aspect)


def self_shadow(light: Column) -> Column:
    return F.when(light <= 0, 1).otherwise(0)


TOWARD = {"north": 0.0, "east": 90.0, "south": 180.0, "west": 270.0}


def cast_shadow(df: DataFrame, keys: list[str], elevation_angle: float, toward: str | float, res: float, value: str = "elev") -> DataFrame:
    """``shadow`` where terrain towards the sun stands above the ray; the sun's azimuth in degrees from north, clockwise, or a name.

    Pixels of one ray towards the sun are told by the line they lie on, to the nearest pixel across it.  A pixel is dark if some
    pixel before it on its ray has a height, less distance * tan(angle), above its own: a running maximum.  A sun that is not above the
    horizon leaves all dark.
    """
    if elevation_angle <= 0:
        return df.withColumn("shadow", F.lit(1))
    azimuth = np.deg2rad(TOWARD[toward] if isinstance(toward, str) else float(toward))
    east, north = float(np.round(np.sin(azimuth), 12)), float(np.round(np.cos(azimuth), 12))
    if abs(north) >= abs(east):  # one step is a row; northwards rows fall
        along, across, slope, step, back = "row", "col", east / north, abs(north), north < 0
    else:
        along, across, slope, step, back = "col", "row", north / east, abs(east), east > 0
    ray = F.round(F.col(across) + F.col(along) * slope).cast("long")
    rise = F.col(along) * (res / step * float(np.tan(np.deg2rad(elevation_angle))))
    level = F.col(value) - rise if back else F.col(value) + rise
    order = F.col(along).desc() if back else F.col(along).asc()
    w = Window.partitionBy(*keys, "gl_ray").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    dark = F.max("gl_level").over(w) > F.col("gl_level")
    return df.withColumn("gl_ray", ray).withColumn("gl_level", level).withColumn("shadow", F.when(dark, 1).otherwise(0)).drop("gl_ray", "gl_level")


def saliency(df: DataFrame, keys: list[str], n_rows: int, n_cols: int, value: str = "value", name: str = "saliency") -> DataFrame:
    """How far a smoothed image (weights 1, 4, 6, 4, 1 each way, edges mirrored without the edge pixel) lies from the mean of its values that are not 0,
    with values of 0 to 10,000 as 0 to 255."""
    rows = df.withColumn("gl_v", F.col(value) * 0.0255)
    mean = rows.groupBy(*keys).agg(F.avg(F.when(F.col("gl_v") != 0, F.col("gl_v"))).alias("gl_mean")) if keys else rows.agg(F.avg(F.when(F.col("gl_v") != 0, F.col("gl_v"))).alias("gl_mean"))
    rows = mirrored(rows, 2, n_rows, n_cols, repeat_edge=False)
    for along in ("col", "row"):
        taps = [F.max("gl_v").over(lines(keys, along, k, k)) * x for k, x in zip(range(-2, 3), (1, 4, 6, 4, 1), strict=True)]
        rows = rows.withColumn("gl_v", (taps[0] + taps[1] + taps[2] + taps[3] + taps[4]) / 16)
    rows = cropped(rows, n_rows, n_cols)
    both = rows.join(checked_broadcast(mean), keys) if keys else rows.crossJoin(F.broadcast(mean))  # a row a cell
    return both.withColumn(name, F.abs(F.col("gl_v") - F.col("gl_mean"))).drop("gl_v", "gl_mean")


def padded(df: DataFrame, pad: int, n_rows: int, n_cols: int, value: str = "value", scale: float = 1.0) -> DataFrame:
    """Pixels and their mirror images, the edge pixel repeated, up to ``pad`` beyond the edges; values scaled."""
    return mirrored(df, pad, n_rows, n_cols, repeat_edge=True).withColumn(value, F.col(value).cast("double") * scale)


def cubic_weights(n: int, m: int) -> list[tuple[int, int, float]]:
    """(out, source, weight) from ``n`` to ``m`` pixels by cubic convolution (a = -0.75), with edge pixels repeated."""
    out: dict[tuple[int, int], float] = {}
    for i in range(m):
        at = (i + 0.5) * n / m - 0.5
        first = int(np.floor(at))
        for k in range(first - 1, first + 3):
            x = abs(at - k)
            w = 1.25 * x**3 - 2.25 * x**2 + 1 if x <= 1 else -0.75 * x**3 + 3.75 * x**2 - 6 * x + 3
            key = (i, min(max(k, 0), n - 1))
            out[key] = out.get(key, 0.0) + w
    return [(i, k, w) for (i, k), w in out.items()]


def cubic(df: DataFrame, keys: list[str], size: tuple[int, int], to: tuple[int, int], value: str = "value", bad: Column | None = None, nodata: float | None = None) -> DataFrame:
    """An image of ``size`` (rows, columns) resampled to ``to`` by cubic convolution; values where ``bad`` holds, or outside 0 to 10,000, are ``nodata`` first if that is given.

    Weights are four a row and four a column of the new image.
    """
    spark = df.sparkSession
    v = F.col(value).cast("double")
    if nodata is not None:
        v = F.when((v < 0) | (v > 10_000) | (F.lit(False) if bad is None else bad), F.lit(float(nodata))).otherwise(v)
    rows = df.select(*keys, "row", "col", v.alias("gl_v"))
    for along, other, n, m in (("row", "col", size[0], to[0]), ("col", "row", size[1], to[1])):
        weights = F.broadcast(spark.createDataFrame(cubic_weights(n, m), f"gl_new int, {along} int, gl_w double"))
        rows = rows.join(weights, along).groupBy(*keys, other, F.col("gl_new").alias(along)).agg(F.sum(F.col("gl_v") * F.col("gl_w")).alias("gl_v"))
    return rows.select(*keys, "row", "col", F.col("gl_v").alias(value))


def topographic_correction(df: DataFrame, scene: list[str], value: str, light: str, zenith: float) -> DataFrame:
    """C-correction: value * (cos z + c) / (cos i + c), c from the regression of the value on the light of each scene."""
    fit = df.groupBy(*scene).agg((F.regr_intercept(value, light) / F.when(F.regr_slope(value, light) != 0, F.regr_slope(value, light))).alias("gl_c"))
    both = df.join(fit, scene)  # a row a scene
    top, down = float(np.cos(np.deg2rad(zenith))) + F.col("gl_c"), F.col(light) + F.col("gl_c")
    return both.withColumn("corrected", F.coalesce(F.col(value) * top / F.when(down != 0, down), F.col(value))).drop("gl_c")


def gray_levels(df: DataFrame, value: str, levels: int, name: str = "gray") -> DataFrame:
    """0 to ``levels``, truncated, by the range of the whole image (one row)."""
    limits = df.agg(F.min(value).alias("gl_a"), F.max(value).alias("gl_b"))
    part = (F.col(value) - F.col("gl_a")) / F.when(F.col("gl_b") > F.col("gl_a"), F.col("gl_b") - F.col("gl_a"))
    return df.crossJoin(F.broadcast(limits)).withColumn(name, F.coalesce((part * levels).cast("int"), F.lit(0))).drop("gl_a", "gl_b")


LINEAR_TEXTURES: dict[str, Callable[[Column, Column], Column]] = {
    "contrast": lambda i, j: (i - j) * (i - j),
    "dissimilarity": lambda i, j: F.abs(i - j),
    "homogeneity": lambda i, j: 1 / (1 + (i - j) * (i - j)),
}


def linear_textures(df: DataFrame, keys: list[str], half: int, n_rows: int, n_cols: int, names: list[str], gray: str = "gray") -> DataFrame:
    """GLCM textures that are means over pairs of horizontal neighbours inside each window, as focal means; edges mirrored without the edge pixel."""
    halo = mirrored(df, half, n_rows, n_cols, repeat_edge=False)
    right = F.max(gray).over(lines(keys, "col", 1, 1))
    halo = halo.withColumn("gl_r", right)
    pairs = (2 * half + 1) * 2 * half
    for n in names:
        halo = halo.withColumn(n, LINEAR_TEXTURES[n](F.col(gray), F.col("gl_r")).cast("double"))
        halo = halo.withColumn(n, F.sum(n).over(lines(keys, "col", -half, half - 1)))
        halo = halo.withColumn(n, F.sum(n).over(lines(keys, "row", -half, half)) / pairs)
    return cropped(halo, n_rows, n_cols).drop("gl_r")


def pair_textures(df: DataFrame, keys: list[str], half: int, n_rows: int, n_cols: int, names: list[str], levels: int, block: int = 64, gray: str = "gray") -> DataFrame:
    """GLCM textures that need pair counts (entropy, energy, asm, correlation, variance), symmetric, horizontal neighbours.

    Blocks of pixels with their halo go to NumPy; a halo pixel is copied to the
    blocks that it borders.
    """
    halo = mirrored(df, half, n_rows, n_cols, repeat_edge=False)
    of = lambda c, n: F.array_distinct(F.transform(F.array(F.lit(-half), F.lit(half)), lambda k: F.floor(F.least(F.greatest(F.col(c) + k, F.lit(0)), F.lit(n - 1)) / block).cast("int")))
    halo = halo.withColumn("gl_br", F.explode(of("row", n_rows))).withColumn("gl_bc", F.explode(of("col", n_cols)))
    cells = halo.groupBy(*keys, "gl_br", "gl_bc").agg(F.collect_list(F.struct("row", "col", gray)).alias("gl_px"))  # (block + 2 half)^2 pixels

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for rec in b.to_dict("records"):
                px = np.array([(p["row"], p["col"], p[gray]) for p in rec["gl_px"]], np.int64)
                r0, c0 = rec["gl_br"] * block, rec["gl_bc"] * block
                h, w = min(block, n_rows - r0), min(block, n_cols - c0)
                img = np.zeros((h + 2 * half, w + 2 * half), np.int64)
                px = px[(px[:, 0] >= r0 - half) & (px[:, 0] < r0 + h + half) & (px[:, 1] >= c0 - half) & (px[:, 1] < c0 + w + half)]
                img[px[:, 0] - r0 + half, px[:, 1] - c0 + half] = px[:, 2]
                pair = img[:, :-1] * (levels + 1) + img[:, 1:]
                size = 2 * half + 1
                counts = np.zeros((levels + 1, levels + 1, h, w))
                for k in np.unique(pair):  # of each pair of levels, its count in every window by summed areas
                    s = np.zeros((pair.shape[0] + 1, pair.shape[1] + 1))
                    s[1:, 1:] = (pair == k).cumsum(axis=0).cumsum(axis=1)
                    n = s[size:, size - 1 :] - s[:-size, size - 1 :] - s[size:, : -(size - 1)] + s[:-size, : -(size - 1)]
                    counts[k // (levels + 1), k % (levels + 1)] += n
                    counts[k % (levels + 1), k // (levels + 1)] += n
                out = glcm_properties(counts / (2 * size * (size - 1)), names)
                rr, cc = np.meshgrid(np.arange(r0, r0 + h), np.arange(c0, c0 + w), indexing="ij")
                yield pd.DataFrame({**{k: rec[k] for k in keys}, "row": rr.ravel(), "col": cc.ravel(), **{n: v.ravel() for n, v in out.items()}})

    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys), "row int, col int", *(f"{n} double" for n in names)])
    return cells.mapInPandas(run, schema)


def glcm_properties(p: np.ndarray, names: list[str]) -> dict[str, np.ndarray]:
    """Properties of matrices [level, level, ...] that sum to 1."""
    i, j = (x.reshape(x.shape + (1,) * (p.ndim - 2)) for x in np.indices(p.shape[:2]))
    over = lambda x: x.sum(axis=(0, 1))
    mean, asm = over(i * p), over(p * p)
    var = over((i - mean) ** 2 * p)
    made = {
        "entropy": lambda: -over(p * np.log2(p + 1e-10)), "asm": lambda: asm, "energy": lambda: np.sqrt(asm), "variance": lambda: var, "std": lambda: np.sqrt(var),
        "correlation": lambda: np.where(var > 1e-12, over((i - mean) * (j - mean) * p) / np.maximum(var, 1e-12), 1.0),
        "contrast": lambda: over((i - j) ** 2 * p), "dissimilarity": lambda: over(np.abs(i - j) * p), "homogeneity": lambda: over(p / (1 + (i - j) ** 2)),
    }
    return {n: made[n]() for n in names}


def equalised(df: DataFrame, ref: DataFrame, value: str, name: str = "matched") -> DataFrame:
    """Histogram matching: each value becomes the smallest reference value whose cumulative share is at least its own.

    Both histograms are tables of distinct values.  Cumulative counts go by ranges of values, so that no task orders them all;
    each reference value owns the shares from that of the one before it, and a value looks its share up there.
    """

    def shares(t: DataFrame) -> DataFrame:
        counts = kept(t.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n")))
        total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
        parts = kept(counts.repartitionByRange(64, value).withColumn("part", F.spark_partition_id()))
        before = parts.groupBy("part").agg(F.sum("n").alias("sum")).withColumn("before", F.coalesce(F.sum("sum").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # 64 rows
        upto = F.sum("n").over(Window.partitionBy("part").orderBy(value))
        return parts.withColumn("upto", upto).join(F.broadcast(before.select("part", "before")), "part").select(value, F.round((F.col("upto") + F.col("before")) / total, 12).alias("s"))

    # The shares of both meet in one order: of 1,000 ranges of shares each, so that a range is a key of its own.
    a = shares(df).select("s", F.col(value).alias("from"), F.lit(None).cast(ref.schema[value].dataType).alias("to"))
    b = shares(ref).select("s", F.lit(None).cast(df.schema[value].dataType).alias("from"), F.col(value).alias("to"))
    both = kept(a.unionByName(b).withColumn("bin", F.floor(F.col("s") * 1000).cast("int")))
    bins = both.groupBy("bin").agg(F.min(F.when(F.col("to").isNotNull(), F.struct("s", "to")))["to"].alias("least"))
    falling = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    following = bins.withColumn("next", F.last("least", ignorenulls=True).over(falling)).select(F.col("bin").alias("b"), "next")  # 1,001 rows
    inside = Window.partitionBy("bin").orderBy(F.col("s").desc(), F.col("to").isNotNull().desc()).rowsBetween(Window.unboundedPreceding, 0)
    lut = both.withColumn("own", F.last("to", ignorenulls=True).over(inside)).filter(F.col("from").isNotNull()).join(F.broadcast(following), F.col("bin") == F.col("b"))
    lut = lut.select(F.col("from").alias(value), F.coalesce("own", "next").alias(name))
    return df.join(checked_broadcast(kept(lut)), value, "left")


def resampled(df: DataFrame, keys: list[str], factor: int, value: str = "value", how: str = "avg") -> DataFrame:
    """Pixels ``factor`` times as large: their average, or the pixel at their corner."""
    out = df.withColumn("gl_r", F.floor(F.col("row") / factor).cast("int")).withColumn("gl_c", F.floor(F.col("col") / factor).cast("int"))
    agg = F.avg(value) if how == "avg" else F.min_by(value, F.struct("row", "col"))
    return out.groupBy(*keys, F.col("gl_r").alias("row"), F.col("gl_c").alias("col")).agg(agg.alias(value))


def smallholder_context(
    df: DataFrame, keys: list[str], crops: list[int], low_crops: list[int], big_crops: list[int], small: list[int], mixed_edge: int, crop_edge: int, sugar: int, edge_size: float = 3.0,
) -> DataFrame:
    """``class`` after five decisions in order, from ``majority`` (of the polygon; 0 outside), ``buffer`` (the crop of the polygon nearby; 0 without),
    ``size`` (focal), ``distance`` (to a block of small fields), ``near_high`` (1 beside high vegetation) and ``excluded``; the first of ``small`` is stored.

    1. In polygons crops become the polygon's crop.  2. In buffers of low crops, low crops in areas of small fields become small
    fields; crops in the buffer of a larger sugar field become sugar.  3. So do low crops outside of both.  4. Small fields away
    from a block become mixed edge: beside high vegetation, in the buffer of big crops, or alone.  5. Crop edge is what of the
    mixed edge borders crops.
    """
    cls, was = F.col("class"), F.col("gl_was")
    rows = df.withColumn("gl_was", cls)
    in_poly, in_buffer, low = F.col("majority") > 0, F.col("buffer") > 0, was.isin(low_crops)
    low_small = (F.col("size") <= 50) & low & ~F.col("excluded")
    inside = F.when(F.col("majority").isin(crops) & was.isin(crops), F.col("majority")).otherwise(was)
    nearby = F.when((F.col("size") > 30) & (F.col("buffer") == sugar) & was.isin(crops), F.lit(sugar)).when(low_small & F.col("buffer").isin(low_crops), F.lit(small[0])).otherwise(was)
    outside = F.when(low_small, F.lit(small[0])).otherwise(was)
    rows = rows.withColumn("class", F.when(~in_buffer, outside).when(in_poly, inside).otherwise(nearby))
    far, is_small = F.col("distance") > 1, cls.isin(small)
    halo = far & ((F.col("near_high") == 1) | (~in_poly & F.col("buffer").isin(big_crops)))
    alone = (F.col("distance") > edge_size) & ~in_buffer & ~low
    rows = rows.withColumn("class", F.when(is_small & (halo | alone), F.lit(mixed_edge)).otherwise(cls))
    rows = rows.withColumn("class", F.when(cls == crop_edge, F.lit(mixed_edge)).otherwise(cls))
    near_crop = focal_max(rows.withColumn("gl_c", F.when(cls.isin(crops), 1).otherwise(0)), keys, 1, "gl_c", "gl_n")
    return near_crop.withColumn("class", F.when((cls == mixed_edge) & (F.col("gl_n") == 1), F.lit(crop_edge)).otherwise(cls)).drop("gl_c", "gl_n", "gl_was")
