"""Masks, quality bits, and checks of scenes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bits of the quality band.
QA_BITS = {"fill": 0, "clear": 1, "water": 2, "shadow": 3, "snow": 4, "cloud": 5}


class MaskError(Exception):
    """A scene has no mask."""


class TimeSeriesError(Exception):
    """A series is missing or empty."""


def qa_mask(qa: Column, names: list[str]) -> Column:
    """Whether any of the named bits is set."""
    return qa.bitwiseAND(F.lit(sum(1 << QA_BITS[n] for n in names))) != 0


def apply_mask(df: DataFrame, mask: DataFrame, keys: list[str], values: list[str], low: int, high: int, missing: str = "skip") -> DataFrame:
    """Values where the mask is in low..high become null; ``missing="fail"`` raises where a scene has no mask."""
    if missing == "fail" and df.select(keys[0]).distinct().join(mask.select(keys[0]).distinct(), keys[0], "left_anti").limit(1).count():
        raise MaskError("a scene has no mask")
    both = df.join(mask.select(*keys, F.col("mask").alias("gl_m")), keys, "left")
    hit = F.coalesce(F.col("gl_m").between(low, high), F.lit(False))
    return both.select(*df.drop(*values).columns, *(F.when(hit, None).otherwise(F.col(v)).alias(v) for v in values))


def binary_mask(value: Column, mask: Column) -> Column:
    return value * mask


def combine_masks(masks: list[DataFrame], keys: list[str]) -> DataFrame:
    """The product of masks: 1 where all are 1; pixels that a mask lacks are 0."""
    one = reduce(DataFrame.unionByName, [m.select(*keys, "mask") for m in masks])
    return one.groupBy(*keys).agg(F.when((F.min("mask") > 0) & (F.count(F.lit(1)) == len(masks)), 1).otherwise(0).alias("mask"))


def missed_nodata(df: DataFrame, scene: str, row: str, col: str, bands: list[str]) -> DataFrame:
    """Rows whose line or column has no variance in any band: stripes that were not marked as missing."""
    flat = lambda line: df.groupBy(scene, line).agg(F.greatest(*(F.var_pop(b) for b in bands), F.lit(0.0)).alias("v"), F.count(F.lit(1)).alias("n")).filter("v = 0 and n > 1").select(scene, line)
    rows, cols = flat(row).withColumn("gl_r", F.lit(True)), flat(col).withColumn("gl_c", F.lit(True))
    both = df.join(rows, [scene, row], "left").join(cols, [scene, col], "left")
    return both.withColumn("missed", F.col("gl_r").isNotNull() | F.col("gl_c").isNotNull()).drop("gl_r", "gl_c")


def block_means(df: DataFrame, scene: str, row: str, col: str, value: str, n_rows: int, n_cols: int) -> DataFrame:
    """Mean of a band in a scene and in its quarters; null where a quarter has no value."""
    top, left = F.col(row) < n_rows / 2, F.col(col) < n_cols / 2
    mean = lambda c: F.avg(F.when(c, F.col(value)))
    return df.groupBy(scene).agg(
        F.avg(value).alias("whole"), mean(top & left).alias("nw"), mean(top & ~left).alias("ne"), mean(~top & left).alias("sw"), mean(~top & ~left).alias("se")
    )


def valid_percent(df: DataFrame, scene: str, value: str, pixels: int, most: int = 10000) -> DataFrame:
    """valid_pix: truncated percent of pixels below ``most``."""
    return df.groupBy(scene).agg((100 * F.count_if(F.col(value) < most) / pixels).cast("int").alias("valid_pix"))


def skip_reasons(catalog: DataFrame, least_percent: int = 10, least_size: int = 0, least_pixels: int = 200_000) -> DataFrame:
    """``skip`` and ``skip_reason`` of scenes by file size, valid pixels in percent (-99: not known) and number of pixels (``numpix``; null: not known)."""
    pct = F.coalesce("valid_pix", F.lit(-99))
    few = ((pct > -1) & (pct < least_percent)) | F.coalesce(F.col("numpix") < least_pixels, F.lit(False))
    reason = F.when(F.col("file_size") < least_size, "file size").when(few, "not enough valid data")
    return catalog.withColumn("skip_reason", reason).withColumn("skip", reason.isNotNull())


def rerun_flag(numpix: Column, before: Column, after: Column) -> Column:
    """Whether most of a scene was lost on the way."""
    return (numpix > 200_000) & ((before + 1) / (after + 1) >= 2)


def check_complete(wanted: DataFrame, there: DataFrame, keys: list[str]) -> None:
    """Raise unless every wanted key is there."""
    lost = wanted.select(*keys).join(there.select(*keys), keys, "left_anti").limit(5).collect()
    if lost:
        raise TimeSeriesError(f"missing: {[tuple(r) for r in lost]}")


def probability_mask(probs: list[Column], codes: list[int], least: float) -> Column:
    """The code of the most probable class if it reaches ``least``, else 0; the first of equal ones."""
    top = F.greatest(*probs)
    out = F.when(top < least, F.lit(0))
    for p, code in zip(probs, codes, strict=True):
        out = out.when(p == top, F.lit(code))
    return out


def sliding_batches(scenes: DataFrame, keys: list[str], n: int = 7, day: str = "date", name: str = "scene_id") -> DataFrame:
    """keys, batch, scene, day: batches of scenes with ``n`` days each, one from every scene on but the last ``n``, in order of day and name, and one of the last ``n`` scenes.

    A batch holds all scenes of its days from its first scene on.
    """
    order = Window.partitionBy(*keys).orderBy(day, name)
    rows = scenes.select(*keys, day, name).withColumn("gl_i", F.row_number().over(order) - 1).withColumn("gl_d", F.dense_rank().over(Window.partitionBy(*keys).orderBy(day)))
    rows = rows.withColumn("gl_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    # The scenes of the last n days up to a scene's own are the batches that it may be in.
    starts = F.collect_list("gl_i").over(Window.partitionBy(*keys).orderBy("gl_d").rangeBetween(1 - n, 0))
    rows = rows.withColumn("batch", F.filter(starts, lambda s: (s <= F.col("gl_i")) & (s < F.col("gl_n") - n)))
    last = F.when(F.col("gl_i") >= F.col("gl_n") - n, F.array(F.greatest(F.col("gl_n") - n, F.lit(0)))).otherwise(F.array().cast("array<bigint>"))
    return rows.select(*keys, F.explode(F.array_distinct(F.concat(F.col("batch").cast("array<bigint>"), last.cast("array<bigint>")))).alias("batch"), name, day)


def probability_over(prob: Column, limit: float = 60, nodata: int = 255) -> Column:
    """1 where a cloud probability in percent is above the limit, 0 elsewhere, and nodata where it is nodata or missing."""
    return F.when(prob.isNull() | (prob == nodata), nodata).when(prob > limit, 1).otherwise(0)


def shade_mask(dem: DataFrame, scenes: list[tuple[str, float | None, float | None]], keys: list[str], res: float, buffer: int = 1, value: str = "elev") -> DataFrame:
    """keys, scene_id, row, col, mask: cast or own shadow in each scene (its name, sun zenith and azimuth), spread by ``buffer`` pixels.

    Scenes without sun angles have no mask.  All scenes share the slopes of the terrain; each is one pass over its rays.
    """
    from . import focal

    slopes = focal.slope_aspect(dem, keys, res, value)
    out = None
    for scene, zenith, azimuth in scenes:
        if zenith is None or azimuth is None:
            continue
        dark = focal.cast_shadow(slopes, keys, 90.0 - zenith, azimuth, res, value)
        own = F.coalesce(focal.self_shadow(focal.illumination(F.col("slope"), F.col("aspect"), zenith, azimuth)), F.lit(0))
        rows = focal.dilated(dark.withColumn("gl_m", F.greatest("shadow", own)), keys, buffer, "gl_m", "mask")
        rows = rows.select(*keys, F.lit(scene).alias("scene_id"), "row", "col", F.col("mask").cast("smallint").alias("mask"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise MaskError("no scene has sun angles")
    return out


def on_template(mask: DataFrame, template: DataFrame, keys: list[str], column: str = "mask", nodata: int = 255) -> DataFrame:
    """A mask on the grid of a template: pixels that the mask lacks are nodata, pixels outside the template go."""
    grid = template.select(*keys, "row", "col").distinct()
    return grid.join(mask.select(*keys, "row", "col", column), [*keys, "row", "col"], "left").withColumn(column, F.coalesce(F.col(column), F.lit(nodata)).cast("smallint"))
