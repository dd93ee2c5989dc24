"""Joins by time, place and prefix, each on an equality that Spark can hash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_distance


def beside(events: DataFrame, obs: DataFrame, keys: list[str], event_day: str, obs_day: str, value: str, before: str | None, after: str | None) -> DataFrame:
    """Every event with ``gl_a``, the latest observation before it, and ``gl_b``, the earliest after it: struct(d, v).  Each side is None, "near" (the
    event's own day counts) or "strict".

    Events and observations are put in one order per key and the last observation is carried along, onwards and backwards, so an event
    never meets all observations of its key: one shuffle, a sort for each side, no pairs.  Of one day the larger value counts.
    """
    carried = [c for c in events.columns if c not in keys]
    e = events.select(*keys, F.struct(*carried).alias("gl_e"), F.col(event_day).alias("gl_t"), F.lit(None).cast(obs.schema[value].dataType).alias("gl_v"), F.lit(False).alias("gl_is"))
    o = obs.filter(F.col(value).isNotNull()).select(*keys, F.lit(None).cast(e.schema["gl_e"].dataType).alias("gl_e"), F.col(obs_day).alias("gl_t"), F.col(value).alias("gl_v"), F.lit(True).alias("gl_is"))
    found = F.when(F.col("gl_is"), F.struct(F.col("gl_t").alias("d"), F.col("gl_v").alias("v")))
    rows = e.unionByName(o)
    for side, time, name in ((before, F.col("gl_t").asc(), "gl_a"), (after, F.col("gl_t").desc(), "gl_b")):
        if side:
            first = F.col("gl_is").desc() if side == "near" else F.col("gl_is").asc()
            w = Window.partitionBy(*keys).orderBy(time, first, F.col("gl_v").asc()).rowsBetween(Window.unboundedPreceding, 0)
            rows = rows.withColumn(name, F.last(found, ignorenulls=True).over(w))
    sides = [n for n, s in (("gl_a", before), ("gl_b", after)) if s]
    return rows.filter(~F.col("gl_is")).select(*keys, *(F.col(f"gl_e.`{c}`").alias(c) for c in carried), *sides)


def as_of(events: DataFrame, obs: DataFrame, keys: list[str], event_day: str, obs_day: str, value: str, direction: str = "backward", strict: bool = False) -> DataFrame:
    """Every event with ``asof_day`` and ``asof_value``: the latest observation up to it (``backward``) or the earliest from it on (``forward``); ``strict`` leaves out the same day."""
    side = "strict" if strict else "near"
    back = direction == "backward"
    out, name = beside(events, obs, keys, event_day, obs_day, value, side if back else None, None if back else side), "gl_a" if back else "gl_b"
    return out.withColumn("asof_day", F.col(f"{name}.d")).withColumn("asof_value", F.col(f"{name}.v")).drop(name)


def pre_post(events: DataFrame, obs: DataFrame, keys: list[str], event_day: str, obs_day: str, value: str) -> DataFrame:
    """Events with the latest positive value before them and the earliest from them on, and the days between (pre negative)."""
    both = beside(events, obs.filter(F.col(value) > 0), keys, event_day, obs_day, value, "strict", "near")
    both = both.withColumns({"pre_day": F.col("gl_a.d"), "pre": F.col("gl_a.v"), "post_day": F.col("gl_b.d"), "post": F.col("gl_b.v")}).drop("gl_a", "gl_b")
    return both.withColumn("predelta", F.datediff("pre_day", event_day)).withColumn("postdelta", F.datediff("post_day", event_day))


def usable(prepost: DataFrame, max_pre: int, max_post: int) -> DataFrame:
    return prepost.filter((F.col("predelta") > -max_pre) & (F.col("postdelta") < max_post))


def nearest(left: DataFrame, right: DataFrame, keys: list[str], left_day: str, right_day: str, value: str) -> DataFrame:
    """Each row of ``left`` with the value of the nearest day, the earlier of two."""
    both = beside(left, right, keys, left_day, right_day, value, "near", "near")
    da, db = F.datediff(left_day, "gl_a.d"), F.datediff("gl_b.d", left_day)
    near = F.when(F.col("gl_b").isNull() | (da <= db), F.col("gl_a")).otherwise(F.col("gl_b"))
    return both.withColumn("gl_n", near).withColumn("near_day", F.col("gl_n.d")).withColumn("near_value", F.col("gl_n.v")).drop("gl_a", "gl_b", "gl_n")


def within_days_of_year(left: DataFrame, right: DataFrame, keys: list[str], left_day: str, right_day: str, days: int, years: int) -> DataFrame:
    """Pairs whose days of the year are at most ``days`` apart, in years at most ``years`` apart.

    Days of the year fall into bins as wide as ``days``; a row on the left looks
    into its own bin and the two beside it, around the turn of the year.
    """
    n = -(-366 // max(1, days))
    bin_of = lambda d: F.floor((F.dayofyear(d) - 1) / max(1, days))
    l = left.withColumn("gl_b", F.explode(F.array_distinct(F.transform(F.array(*map(F.lit, (-2, -1, 0, 1, 2))), lambda k: F.pmod(bin_of(left_day) + k, F.lit(n))))))  # noqa: E741
    r = right.withColumn("gl_b", F.pmod(bin_of(right_day), F.lit(n)))
    near = (day_distance(F.col(left_day), F.col(right_day)) <= days) & (F.abs(F.year(left_day) - F.year(right_day)) <= years)
    return l.join(r, [*keys, "gl_b"]).filter(near).drop("gl_b")


def by_prefix(files: DataFrame, records: DataFrame, name: str, key: str, length: int) -> tuple[DataFrame, DataFrame]:
    """Files whose name begins with a record's key, and files that match none; an equality on the first ``length`` characters."""
    f = files.withColumn("gl_k", F.substring(name, 1, length))
    r = records.withColumn("gl_k", F.substring(key, 1, length))
    on = (f["gl_k"] == r["gl_k"]) & F.startswith(f[name], r[key])
    return f.join(r, on).drop("gl_k"), f.join(r, on, "left_anti").drop("gl_k")


def boxes_overlap(a: list[Column], b: list[Column]) -> Column:
    """Whether two boxes (left, bottom, right, top) share a point."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


#: Pairs of rows in one cell that a task compares, about.
TASK_PAIRS = 5_000_000


def _cell_sides(sides: list[tuple[DataFrame, list[str]]], most: float, share: float) -> list[float]:
    """Width and height of the cells of a grid: a share of the root mean square of the boxes' sides, ``most`` at most.

    Cells fit the boxes on each axis, so few pairs of a cell do not meet; by the mean of squares all boxes together touch at most a few cells a box.
    """
    out = [0.0, 0.0]
    for df, box in sides:
        row = df.agg(*(F.sqrt(F.avg(F.pow(F.col(box[k + 2]).cast("double") - F.col(box[k]), F.lit(2)))) for k in (0, 1))).first()
        out = [max(o, share * (r or 0.0)) for o, r in zip(out, row, strict=True)]
    return [min(most, o) if o > 0 else most for o in out]


def _gridded(df: DataFrame, box: list[str], size: list[float]) -> DataFrame:
    """Rows once for each cell that their box touches."""
    over = lambda k: F.explode(F.sequence(F.floor(F.col(box[k]) / size[k]).cast("long"), F.floor(F.col(box[k + 2]) / size[k]).cast("long")))
    return df.withColumn("gl_cx", over(0)).withColumn("gl_cy", over(1))


def _in_cells(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of rows in the same cell.  Cells are counted first: tasks grow with the pairs, not with the rows that make them, and rows of crowded
    cells are dealt out over several tasks."""
    cell = ["gl_cx", "gl_cy"]
    n = a.groupBy(*cell).agg(F.count(F.lit(1)).cast("double").alias("n")).join(b.groupBy(*cell).agg(F.count(F.lit(1)).cast("double").alias("m")), cell)
    total, most = n.agg(F.sum(F.col("n") * F.col("m")), F.max(F.col("n") * F.col("m"))).first()
    parts = max(a.sparkSession.sparkContext.defaultParallelism, min(int((total or 0) // TASK_PAIRS) + 1, 20_000))
    deals = min(int((most or 0) // (4 * TASK_PAIRS)) + 1, 1000)
    if deals > 1:
        a, b = a.withColumn("gl_s", F.pmod(F.xxhash64(*a.columns), F.lit(deals))), b.withColumn("gl_s", F.explode(F.sequence(F.lit(0), F.lit(deals - 1)).cast("array<long>")))
        cell = [*cell, "gl_s"]
    return a.repartition(parts, *cell).join(b.repartition(parts, *cell), cell).drop("gl_s")


def points_in_boxes(points: DataFrame, boxes: DataFrame, x: str, y: str, box: list[str], cell: float) -> DataFrame:
    """Points with the boxes that hold them, by the grid cells (sides up to ``cell``) that a box touches."""
    size = _cell_sides([(boxes, box)], cell, 0.5)
    p = points.withColumn("gl_cx", F.floor(F.col(x) / size[0]).cast("long")).withColumn("gl_cy", F.floor(F.col(y) / size[1]).cast("long"))
    inside = F.col(x).between(F.col(box[0]), F.col(box[2])) & F.col(y).between(F.col(box[1]), F.col(box[3]))
    return _in_cells(p, _gridded(boxes, box, size)).filter(inside).drop("gl_cx", "gl_cy")


def overlapping_boxes(a: DataFrame, b: DataFrame, box: list[str], cell: float, other: list[str]) -> DataFrame:
    """Pairs of boxes that share a point, each pair once: it counts in the cell (sides up to ``cell``) of the corner where they begin to overlap."""
    size = _cell_sides([(a, box), (b, other)], cell, 1.0)
    both = _in_cells(_gridded(a, box, size), _gridded(b, other, size))
    first = (F.floor(F.greatest(box[0], other[0]) / size[0]) == F.col("gl_cx")) & (F.floor(F.greatest(box[1], other[1]) / size[1]) == F.col("gl_cy"))
    return both.filter(boxes_overlap([F.col(c) for c in box], [F.col(c) for c in other]) & first).drop("gl_cx", "gl_cy")


def point_in_polygon(x: Column, y: Column, ring: Column, strict: bool = False) -> Column:
    """Ray casting; ``ring`` is an array of struct(x, y), closed or not.

    Of points on an edge those on the left and lower ones are inside; with ``strict`` none is.  Strict edges are met in shares of their extent
    (x over the width plus y over the height against 1), which is without rounding on the vertices of a ring about its own corner.
    """
    n = F.size(ring)

    def crosses(i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        cut = (a["y"] > y) != (b["y"] > y)
        rise = F.when(b["y"] == a["y"], F.lit(1.0)).otherwise(b["y"] - a["y"])
        return F.when(cut & (x < (b["x"] - a["x"]) * (y - a["y"]) / rise + a["x"]), 1).otherwise(0)

    def meets(i: Column) -> Column:
        """1 if a ray to the right crosses an edge, 1,000,000 if the point lies on it."""
        a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
        p = F.when(a["x"] >= b["x"], a).otherwise(b)  # right end
        q = F.when(a["x"] >= b["x"], b).otherwise(a)
        width, height = p["x"] - q["x"], q["y"] - p["y"]
        share = (x - q["x"]) / F.when(width != 0, width) + (y - p["y"]) / F.when(height != 0, height)
        cut = (a["y"] > y) != (b["y"] > y)
        beside = y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"])) & x.between(q["x"], p["x"])
        on = beside & F.when((width == 0) | (height == 0), F.lit(True)).otherwise(share == 1)
        left = F.when(width == 0, x < q["x"]).otherwise(share < 1)
        return F.when(on, 1_000_000).when(cut & left, 1).otherwise(0)

    met = F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), meets if strict else crosses), F.lit(0), lambda s, v: s + v)
    return (met % 2 == 1) & (met < 1_000_000) if strict else met % 2 == 1


def ring_area(ring: Column) -> Column:
    """Shoelace area of a ring."""
    n = F.size(ring)
    part = lambda i: F.get(ring, i)["x"] * F.get(ring, (i + 1) % n)["y"] - F.get(ring, (i + 1) % n)["x"] * F.get(ring, i)["y"]
    return F.abs(F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), part), F.lit(0.0), lambda s, v: s + v)) / 2


def largest_overlap(pairs: DataFrame, ref: str, pred: str) -> DataFrame:
    """Per reference the prediction that shares most pixels, the smaller id of equal ones: ref, pred, shared."""
    n = pairs.groupBy(ref, pred).agg(F.count(F.lit(1)).alias("shared"))
    return n.groupBy(ref).agg(F.max(F.struct("shared", (-F.col(pred)).alias("p"))).alias("m")).select(ref, (-F.col("m.p")).alias(pred), "m.shared")


def clipped_ring(ring: Column, box: list[Column]) -> Column:
    """A ring (array of struct(x, y)) cut to a box (x0, y0, x1, y1), side by side; empty if nothing is left."""

    def side(points: Column, axis: str, limit: Column, upper: bool) -> Column:
        inside = lambda p: p[axis] <= limit if upper else p[axis] >= limit
        other = "y" if axis == "x" else "x"

        def crossing(p: Column, q: Column) -> Column:
            part = (limit - p[axis]) / (q[axis] - p[axis])
            at = p[other] + (q[other] - p[other]) * part
            return F.struct(limit.alias("x"), at.alias("y")) if axis == "x" else F.struct(at.alias("x"), limit.alias("y"))

        def step(p: Column, i: Column) -> Column:
            q = F.element_at(points, (i + 1) % F.size(points) + 1)
            mixed = F.array(crossing(p, q))
            none = F.array().cast("array<struct<x:double,y:double>>")
            return F.when(inside(p) & inside(q), F.array(q)).when(inside(p), mixed).when(inside(q), F.concat(mixed, F.array(q))).otherwise(none)

        return F.flatten(F.transform(points, step))

    def cut(axis: str, limit: Column, upper: bool) -> Callable[[Column], Column]:
        return lambda points: side(points, axis, limit, upper)

    # Arrays of one: each ring is computed once.
    out = ring
    for axis, limit, upper in (("x", box[0], False), ("x", box[2], True), ("y", box[1], False), ("y", box[3], True)):
        out = F.transform(F.array(out), cut(axis, limit, upper))[0]
    return out


def clipped_to_cells(polys: DataFrame, cells: DataFrame, ring: str, box: list[str], cell_box: list[str], size: float, year: str | None = None, years: list[int] | None = None) -> DataFrame:
    """Polygons (of some years) and the cells that they overlap, with ``ring`` cut to the cell and its ``area``; what only touches a cell is left out."""
    rows = polys.filter(F.col(year).isin(years)) if year and years else polys
    both = overlapping_boxes(rows, cells, box, size, cell_box)
    both = both.withColumn(ring, clipped_ring(F.col(ring), [F.col(b).cast("double") for b in cell_box]))
    return both.withColumn("area", F.when(F.size(ring) > 2, F.abs(ring_area(F.col(ring)))).otherwise(0.0)).filter("area > 0")
