"""Scene catalogs, progress and status tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grammar import scene_date, scene_sensor


def from_names(files: DataFrame, name: str = "scene_id") -> DataFrame:
    """Sensor, date and year of scenes by their names."""
    return files.withColumn("sensor", scene_sensor(F.col(name))).withColumn("date", scene_date(F.col(name))).withColumn("year", F.year("date"))


def matching(catalog: DataFrame, sensors: list[str], flags: list[str], name: str = "scene_id") -> DataFrame:
    """Scenes of these sensors whose name does not end in a skip flag."""
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")
    return catalog.filter(F.col("sensor").isin(sensors) & ~F.right(stem, F.lit(1)).isin(flags))


def rebuilt(catalog: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """``state`` of every scene in a catalog or a listing: kept, missing (no file) or new (no record)."""
    a, b = catalog.select(key).distinct().withColumn("gl_a", F.lit(1)), files.select(key).distinct().withColumn("gl_b", F.lit(1))
    both = a.join(b, key, "full_outer")
    return both.select(key, F.when(F.col("gl_a").isNull(), "new").when(F.col("gl_b").isNull(), "missing").otherwise("kept").alias("state"))


def records(files: DataFrame, name: str = "name") -> DataFrame:
    """Records of files by their names (level_sensor_place_date...): the scene's download id, its file without the part that
    co-registration adds, and flags; notes, pixel counts and shifts can't be had from names."""
    part = lambda i: F.get(F.split(F.col(name), "_"), F.lit(i))
    place = part(2)
    landsat = F.concat_ws("_", part(1), F.lit("L2SP"), F.substring(place, 5, 6), part(3), F.substring(place, 11, 2), F.substring(place, 13, 2))
    other = F.concat_ws("_", part(1), F.substring(place, 5, 5), part(3), F.substring(place, 10, 1), F.substring(place, 11, 3))
    brdf = F.concat(F.element_at(F.split(F.element_at(F.split(F.col(name), "_coreg"), 1), "X"), 1), F.lit(".tif"))
    return files.select(
        F.when(part(1).startswith("L"), landsat).otherwise(other).alias("scene_id"), brdf.alias("brdf_id"), F.lit(True).alias("brdf"),
        F.when(part(0) == "L3B", True).when(part(0) == "L3A", False).alias("bandpass"), F.lit(True).alias("beforeDB"), F.lit(False).alias("redownload"),
        F.col(name).contains("_coreg").alias("coreg"),
    )


def merged(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new``, and rows of ``old`` whose key it lacks: an upsert by key."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def without(catalog: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return catalog.join(gone, key, "left_anti")


def marked(catalog: DataFrame, sensors: list[str], start: str, end: str, except_ids: list[str], column: str) -> DataFrame:
    """Set a flag on scenes of these sensors in a range of dates."""
    hit = F.col("sensor").isin(sensors) & F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")) & ~F.col("scene_id").isin(except_ids)
    return catalog.withColumn(column, F.when(hit, True).otherwise(F.col(column)))


def window_state(series: DataFrame, wanted: int) -> DataFrame:
    """State of each cell and index by images and empty blocks: no ts, missing images, missing windows or clean."""
    n = series.groupBy("cell_id", "si").agg(F.count_distinct("date").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"), F.min("block_mean").alias("low"))
    state = F.when(F.col("n") == 0, "no ts").when(F.col("n") < wanted, "missing images").when(F.col("low") == 0, "missing windows").otherwise("clean")
    return n.select("cell_id", "si", "n", "first", "last", state.alias("state"))


def status(progress: DataFrame, clean: DataFrame) -> DataFrame:
    """The furthest step of each cell: n, p, p_preprocess, or p_sis_ with its finished indices in order."""
    done = progress.groupBy("grid").agg(F.max(F.when(F.col("step") == "download", F.col("status") == "y")).alias("d"), F.max(F.when(F.col("step") == "preprocess", F.col("status") == "y")).alias("p"))
    sis = clean.filter("state = 'clean'").groupBy(F.col("cell_id").cast("string").alias("grid")).agg(F.concat_ws(",", F.sort_array(F.collect_set("si"))).alias("sis"))
    both = done.join(sis, "grid", "left")
    return both.select("grid", F.when(F.col("sis").isNotNull(), F.concat(F.lit("p_sis_"), "sis")).when(F.col("p"), "p_preprocess").when(F.col("d"), "p").otherwise("n").alias("status"))


def in_box(df: DataFrame, box: tuple[float, float, float, float], cols: list[str]) -> DataFrame:
    """Rows whose box overlaps ``box`` (left, bottom, right, top): four comparisons that reach the scan."""
    w, s, e, n = (F.col(c) for c in cols)
    return df.filter((w <= box[2]) & (e >= box[0]) & (s <= box[3]) & (n >= box[1]))


def mosaic(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """One row a pixel, of the first part that has it."""
    every = None
    for i, p in enumerate(parts):
        p = p.withColumn("gl_p", F.lit(i))
        every = p if every is None else every.unionByName(p)
    w = Window.partitionBy(*keys).orderBy("gl_p")
    return every.withColumn("gl_n", F.row_number().over(w)).filter("gl_n = 1").drop("gl_n", "gl_p")


def interior(df: DataFrame, row: str, col: str, n_rows: int, n_cols: int, buffer: int) -> DataFrame:
    """Pixels of a cell without its buffer."""
    return df.filter(F.col(row).between(buffer, n_rows - buffer - 1) & F.col(col).between(buffer, n_cols - buffer - 1))


def thumbnail(df: DataFrame, step: int, bands: list[str], gamma: float = 1.0) -> DataFrame:
    """Every ``step``-th pixel, each band scaled to 0..1 by its range, then raised to 1 / gamma."""
    some = df.filter((F.col("row") % step == 0) & (F.col("col") % step == 0))
    limits = some.agg(*(f(b).alias(f"{n}_{b}") for b in bands for n, f in (("lo", F.min), ("hi", F.max))))  # one row
    both = some.crossJoin(F.broadcast(limits))
    scaled = lambda b: F.pow((F.col(b) - F.col(f"lo_{b}")) / F.when(F.col(f"hi_{b}") > F.col(f"lo_{b}"), F.col(f"hi_{b}") - F.col(f"lo_{b}")), F.lit(1 / gamma))
    return both.select("row", "col", *(F.coalesce(scaled(b), F.lit(0.0)).alias(b) for b in bands))


def min_max_scaled(df: DataFrame, value: str, name: str, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """``name``: a value scaled by the whole table's range, which is one row."""
    limits = df.agg(F.min(value).alias("gl_a"), F.max(value).alias("gl_b"))
    both = df.crossJoin(F.broadcast(limits))
    part = (F.col(value) - F.col("gl_a")) / F.when(F.col("gl_b") > F.col("gl_a"), F.col("gl_b") - F.col("gl_a"))
    return both.withColumn(name, low + (high - low) * part).drop("gl_a", "gl_b")


def runtime_totals(runs: DataFrame, cell: str, seconds: str, cores: str | None = None) -> DataFrame:
    """Hours and core minutes of each cell's runs; a run without cores has one."""
    n = F.coalesce(F.col(cores), F.lit(1)) if cores else F.lit(1)
    return runs.groupBy(cell).agg((F.sum(seconds) / 3600).alias("dltime"), (F.sum(F.col(seconds) * n) / 60).alias("dlcoremin"))


def log_states(lines: DataFrame, job: str = "job", line: str = "line", order: str = "at") -> DataFrame:
    """The state of each job by the lines of its log: failed with the first error, done, running, and its last line."""
    low = F.lower(F.col(line))
    error, done = low.contains("error") | low.contains("traceback"), low.contains("all done")
    out = lines.groupBy(job).agg(
        F.min(F.when(error, F.struct(order, line))).alias("gl_e"), F.max(done).alias("gl_d"), F.max(F.struct(order, line)).alias("gl_l"), F.count(F.lit(1)).alias("lines")
    )
    state = F.when(F.col("gl_e").isNotNull(), "failed").when(F.col("gl_d"), "done").otherwise("running")
    return out.select(job, state.alias("state"), F.col(f"gl_e.{line}").alias("error"), F.col(f"gl_l.{line}").alias("last"), "lines")


def clipped_to_polygons(pixels: DataFrame, polys: DataFrame, key: str, box: list[str], ring: str, x: str, y: str, cell: float) -> DataFrame:
    """Pixels whose centre lies in a polygon, with its key; a pixel in two polygons comes twice."""
    from .joins import point_in_polygon, points_in_boxes

    near = points_in_boxes(pixels, polys.select(key, *box, ring), x, y, box, cell)
    return near.filter(point_in_polygon(F.col(x).cast("double"), F.col(y).cast("double"), F.col(ring))).drop(*box, ring)


def chip_pixels(cells: DataFrame, chips: DataFrame, box: list[str], x: str, y: str, size: float) -> DataFrame:
    """Pixels of each chip (half-open boxes), from all cells that it straddles; of a pixel that cells share one, of the smallest cell."""
    from .joins import points_in_boxes

    near = points_in_boxes(cells, chips, x, y, box, size).filter((F.col(x) < F.col(box[2])) & (F.col(y) < F.col(box[3])))
    names = [c for c in chips.columns if c not in box]
    rest = [c for c in cells.columns if c not in ("cell_id", x, y)]
    one = near.groupBy(*names, x, y).agg(F.min(F.struct("cell_id", *rest)).alias("gl_p"))
    return one.select(*names, x, y, *(F.col(f"gl_p.{c}").alias(c) for c in ("cell_id", *rest)))
