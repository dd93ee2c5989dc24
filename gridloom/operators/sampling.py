"""Sample points: priorities, balance, hold-outs, splits, joins with features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def priority(scarce: Column, stratum: Column, checked: Column, entry: Column, doubts: list[Column], main_stratum: str | None = "BH") -> Column:
    """1 (scarce classes of a checked source, and strata other than the main one, unless that is None), 2 (checked twice), 3; 4 for any doubt."""
    one = scarce & checked if main_stratum is None else (scarce & checked) | (stratum != main_stratum)
    doubt = F.lit(False)
    for d in doubts:
        doubt = doubt | F.coalesce(d == 1, F.lit(False))
    return F.when(doubt, 4).when(one, 1).when(checked & (entry > 1), 2).otherwise(3)


def balance(samples: DataFrame, cls: str, shares: DataFrame, least: int = 200, min_balance: float = 1.0, reduce: float = 0.0, mixed: list | None = None) -> DataFrame:
    """Rows with ``rand`` below the draw of their priority.

    Each class is cut to its share of the commonest class, but not below
    ``least`` rows; the better priorities are drawn first and 4 is never drawn.
    ``shares`` (class, share) is a row a class.
    """
    n = samples.groupBy(cls).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("priority") == 1).alias("n1"), F.count_if(F.col("priority") == 2).alias("n2"))
    top = shares.agg(F.max_by(cls, F.struct("share", cls)).alias("t"), F.max("share").alias("top_share"))
    n = n.join(F.broadcast(shares), cls, "left").crossJoin(F.broadcast(top)).withColumn("nmax", F.max(F.when(F.col(cls) == F.col("t"), F.col("n"))).over(Window.partitionBy()))  # a row a class
    p = F.coalesce("share", F.lit(0.0)) / F.col("top_share") * (1 - reduce)
    want = p * F.col("nmax")
    ratio = F.when(F.col("n") < least, 1.0).when(want < F.col("n"), F.greatest(F.lit(float(least)), want) / F.col("n")).otherwise(1.0)
    if mixed:
        ratio = F.when(F.col(cls).isin(mixed), min_balance * want / F.col("n")).otherwise(ratio)
    n = n.withColumn("ratio", F.round(ratio, 3)).withColumn("k", F.col("ratio") * F.col("n"))
    n1, n2, k = F.col("n1"), F.col("n2"), F.col("k")
    n3 = F.col("n") - n1 - n2
    d1 = F.when(n1 == 0, 0.0).when(n1 <= k, 1.0).otherwise(k / F.when(n1 > 0, n1))
    d2 = F.when(n2 == 0, 0.0).when(n1 + n2 < k, 1.0).otherwise(F.greatest(F.lit(0.0), (k - n1) / F.when(n2 > 0, n2)))
    d3 = F.when(n1 + n2 > k, 0.0).otherwise((k - n1 - n2) / F.when(n3 > 0, n3))
    draws = n.select(cls, d1.alias("d1"), d2.alias("d2"), d3.alias("d3"))
    draw = F.when(F.col("priority") == 1, F.col("d1")).when(F.col("priority") == 2, F.col("d2")).when(F.col("priority") == 3, F.col("d3")).otherwise(0.0)
    return samples.join(F.broadcast(draws), cls).filter(F.col("rand") < draw).drop("d1", "d2", "d3")


def holdout(samples: DataFrame, percent: float, rand: str = "rand2") -> tuple[DataFrame, DataFrame]:
    """(held out, rest) by a random number that belongs to the row, so the split is the same in every run."""
    return samples.filter(F.col(rand) < percent / 100), samples.filter(F.col(rand) >= percent / 100)


def field_holdout(samples: DataFrame, held: DataFrame, field: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(held out, rest): all points of fields that have a point in ``held``."""
    fields = held.filter(F.col(field).isNotNull()).select(field).distinct()
    out = samples.join(fields, field, "left_semi").unionByName(held.filter(F.col(field).isNull()))
    return out, samples.join(out.select(key), key, "left_anti")


def purest(samples: DataFrame, keys: list[str], measure: str, tie: str) -> DataFrame:
    """The row of highest purity of each point and class."""
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc(), F.col(tie))
    return samples.withColumn("gl_n", F.row_number().over(w)).filter("gl_n = 1").drop("gl_n")


def per_class(samples: DataFrame, cls: str, n: int, rand: str = "rand", tie: str | None = None) -> DataFrame:
    """The first ``n`` rows of each class in random order."""
    order = [F.col(rand)] + ([F.col(tie)] if tie else [])
    return samples.withColumn("gl_n", F.row_number().over(Window.partitionBy(cls).orderBy(*order))).filter(F.col("gl_n") <= n).drop("gl_n")


def stable_random(key: Column, seed: int) -> Column:
    """A number in 0..1 that depends on the key and the seed only."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def train_test(samples: DataFrame, train: DataFrame, key: str) -> DataFrame:
    """Rows that are not in the training set."""
    return samples.join(train.select(key), key, "left_anti")


def at_pixels(points: DataFrame, raster: DataFrame, x: str, y: str, x0: float, y0: float, res: float, keys: list[str] | None = None) -> DataFrame:
    """Points with the values of the pixel that holds them."""
    p = points.withColumn("col", F.floor((F.col(x) - x0) / res).cast("int")).withColumn("row", F.floor((F.lit(y0) - F.col(y)) / res).cast("int"))
    return p.join(raster, [*(keys or []), "row", "col"])


def valid_class(cls: Column, binary: bool = False) -> Column:
    ok = (cls > 0) & (cls < 256) & (cls != 98)
    return ok & (cls <= 100) if binary else ok


def nearest_pixels(points: DataFrame, raster: DataFrame, x: str, y: str, x0: float, y0: float, res: float, tolerance: float, keys: list[str] | None = None) -> DataFrame:
    """Points with the values of the pixel whose centre is nearest, if it is no further than ``tolerance`` along x and along y; null elsewhere.

    ``x0`` and ``y0`` are the centre of the pixel in row 0 and column 0.
    """
    col, row = F.round((F.col(x) - x0) / res).cast("int"), F.round((F.lit(y0) - F.col(y)) / res).cast("int")
    p = points.withColumn("gl_c", col).withColumn("gl_r", row)
    near = (F.abs(F.col(x) - (x0 + F.col("gl_c") * res)) <= tolerance) & (F.abs(F.col(y) - (y0 - F.col("gl_r") * res)) <= tolerance)
    grid = raster.withColumnsRenamed({"row": "gl_row", "col": "gl_col", **{k: f"gl_{k}" for k in keys or []}})
    same = (F.col("gl_r") == F.col("gl_row")) & (F.col("gl_c") == F.col("gl_col")) & near
    for k in keys or []:
        same = same & F.col(k).eqNullSafe(F.col(f"gl_{k}"))
    return p.join(grid, same, "left").drop("gl_c", "gl_r", "gl_row", "gl_col", *(f"gl_{k}" for k in keys or []))


def with_variables(points: DataFrame, variables: DataFrame, key: str) -> DataFrame:
    """Points that have variables, with them; columns of both but the key come from the points."""
    return points.join(variables.drop(*(c for c in points.columns if c != key)), key)


def feature_set(points: DataFrame, variables: list[DataFrame], key: str, label: str, wanted: list[str] | None = None, skip: list | None = None) -> DataFrame:
    """key, label and the wanted ``var_`` columns of points with a label (not one of ``skip``) that have all tables of variables and no missing one."""
    rows = points.filter(F.col(label).isNotNull() & (~F.col(label).isin(skip) if skip else F.lit(True))).select(key, label)
    for t in variables:
        rows = with_variables(rows, t, key)
    names = wanted or [c for c in rows.columns if c.startswith("var_")]
    return rows.select(key, label, *names).dropna(subset=names)


def training_chips(chips: DataFrame, polys: DataFrame, size: float, within: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Chips and polygons to train segmentation on.

    ``chips``: region, x0, y0, x1, y1, state: ready where both sides are ``size``, adjusted (the far sides are moved) where they are within
    ``within`` of it, skipped else.  The polygons: region, name, class and box of those that overlap a chip that is not skipped; a chip with
    class 0 only has one, the chip 50 m beyond its sides.
    """
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    state = F.when((dx == size) & (dy == size), "ready").when((F.abs(dx - size) < within) & (F.abs(dy - size) < within), "adjusted").otherwise("skipped")
    out = chips.withColumn("state", state)
    fit = F.col("state") == "adjusted"
    out = out.withColumn("x1", F.when(fit, F.col("x0") + size).otherwise(F.col("x1"))).withColumn("y1", F.when(fit, F.col("y0") + size).otherwise(F.col("y1")))
    from .joins import overlapping_boxes

    box = ["x0", "y0", "x1", "y1"]
    mine = polys.withColumnsRenamed({c: f"p_{c}" for c in polys.columns})
    pairs = overlapping_boxes(out.filter("state <> 'skipped'"), mine, box, size, [f"p_{c}" for c in box])
    crops = Window.partitionBy("region")
    rows = pairs.withColumn("gl_any", F.max(F.col("p_class") != 0).over(crops)).withColumn("gl_n", F.row_number().over(crops.orderBy(*(f"p_{c}" for c in polys.columns))))
    rows = rows.filter(F.col("gl_any") | (F.col("gl_n") == 1))
    far = {"x0": -50.0, "y0": -50.0, "x1": 50.0, "y1": 50.0}
    sides = [F.when(F.col("gl_any"), F.col(f"p_{c}")).otherwise(F.col(c) + d).alias(c) for c, d in far.items()]
    return out, rows.select("region", F.concat(F.col("region").cast("string"), F.lit("_poly")).alias("name"), F.col("p_class").alias("class"), *sides)


def points_in_polygons(polys: DataFrame, key: str, box: list[str], ring: str, n: int, seed: int, tries: int = 8) -> DataFrame:
    """``n`` points inside each polygon, from points drawn in its box: rounds of ``n * tries`` until every polygon has them.  A polygon without an area is an error."""
    from ..sources.shared import kept
    from .joins import point_in_polygon, ring_area

    empty = polys.filter(F.abs(ring_area(F.col(ring))) <= 0).limit(1).count()
    if empty:
        raise ValueError("a polygon has no area")
    u = lambda s: F.pmod(F.xxhash64(F.col(key), F.col("i"), F.lit(seed + s)), F.lit(1 << 30)) / float(1 << 30)
    found, open_, first = None, polys, 1
    while True:
        drawn = open_.withColumn("i", F.explode(F.sequence(F.lit(first), F.lit(first + n * tries - 1))))
        drawn = drawn.withColumn("x", F.col(box[0]) + (F.col(box[2]) - F.col(box[0])) * u(0)).withColumn("y", F.col(box[1]) + (F.col(box[3]) - F.col(box[1])) * u(1))
        new = drawn.filter(point_in_polygon(F.col("x"), F.col("y"), F.col(ring))).select(key, "i", "x", "y")
        found = kept(new if found is None else found.unionByName(new))
        full = found.groupBy(key).agg(F.count(F.lit(1)).alias("gl_n")).filter(F.col("gl_n") >= n).select(key)
        open_ = kept(polys.join(full, key, "left_anti"))
        if not open_.limit(1).count():
            break
        first, tries = first + n * tries, tries * 4
    w = Window.partitionBy(key).orderBy("i")
    return found.withColumn("gl_n", F.row_number().over(w)).filter(F.col("gl_n") <= n).select(key, F.col("gl_n").alias("point"), "x", "y")
