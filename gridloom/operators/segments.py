"""Field segments: connected components on a grid, instances, shapes."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import kept


def instance_score(extent: Column, boundary: Column) -> Column:
    return 1 + extent - boundary


def instance_mask(extent: Column, boundary: Column, least: float) -> Column:
    return F.when(instance_score(extent, boundary) >= least, 1).otherwise(0)


def connected(df: DataFrame, keys: list[str], mask: Column, width: int) -> DataFrame:
    """row, col, segment of masked pixels that touch by an edge; the segment is its first pixel (row * width + col).

    Runs along a row are one node by a window, so only runs are linked, by
    overlaps with the row below; large-star and small-star rounds then join
    them, a logarithm of the longest chain of runs.
    """
    from pyspark.sql import Window

    px = df.filter(mask).select(*keys, "row", "col")
    w = Window.partitionBy(*keys, "row").orderBy("col")
    px = px.withColumn("gl_new", F.when(F.coalesce(F.col("col") - F.lag("col").over(w), F.lit(2)) > 1, F.col("col")))
    px = px.withColumn("gl_c", F.last("gl_new", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    px = kept(px.withColumn("node", F.col("row").cast("long") * width + F.col("gl_c")).drop("gl_new", "gl_c"))
    below = px.select(*keys, (F.col("row") - 1).alias("row"), "col", F.col("node").alias("other"))
    links = px.join(below, [*keys, "row", "col"]).select(*keys, F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v"))
    edges, before = kept(links.filter("u <> v").distinct()), None
    while True:  # to the smallest of a node's neighbours, then of its smaller ones, until nothing moves
        both = edges.unionByName(edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        small = large.join(least, [*keys, "u"]).filter("v <> m").select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(small.unionByName(least.select(*keys, "u", F.col("m").alias("v"))).distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    labels = edges.select(*keys, F.col("u").alias("node"), F.col("v").alias("label"))
    return px.join(labels, [*keys, "node"], "left").select(*keys, "row", "col", F.coalesce("label", "node").alias("segment"))


def shapes(segments: DataFrame, keys: list[str], res: float, min_area: float = 0.0) -> DataFrame:
    """segment, area, perimeter (pixel edges), APR, APrEf of segments of at least ``min_area``."""
    from .focal import lines

    here = segments.withColumn("gl_s", F.col("segment"))
    same = lambda along, k: F.coalesce(F.max("gl_s").over(lines(keys, along, k, k)) == F.col("segment"), F.lit(False)).cast("int")
    edges = here.withColumn("gl_e", 4 - same("row", -1) - same("row", 1) - same("col", -1) - same("col", 1))
    out = edges.groupBy(*keys, "segment").agg((F.count(F.lit(1)) * res * res).alias("area"), (F.sum("gl_e") * res).alias("perimeter"))
    out = out.filter(F.col("area") >= min_area)
    return out.withColumn("APR", F.col("area") / F.col("perimeter")).withColumn("APrEf", 100 * F.col("perimeter") / (4 * F.sqrt("area")))


def cut_fields(df: DataFrame, keys: list[str], mask: str, width: int, shrink: int = 1) -> DataFrame:
    """Segments of a mask after it is eroded by ``shrink`` pixels, then grown back over the mask: narrow bridges part fields."""
    from .focal import square

    eroded = square(df, keys, shrink, F.min, mask, "gl_core")
    core = connected(eroded, keys, F.col("gl_core") == 1, width)
    grown = eroded.filter(F.col(mask) == 1).select(*keys, "row", "col").join(core, [*keys, "row", "col"], "left")
    grown = square(grown, keys, shrink, F.max, "segment", "gl_near")
    return grown.select(*keys, "row", "col", F.coalesce("segment", "gl_near").alias("segment")).filter("segment is not null")


def extent_mask(extent: Column, boundary: Column, boundary_over: float, extent_over: float, most: float = 1000.0) -> Column:
    """1 where the extent is above its limit and the boundary is not above its own, both as shares of ``most``."""
    return F.when((extent > extent_over * most) & ~(boundary > boundary_over * most), 1).otherwise(0)


def flooded(height: np.ndarray, mask: np.ndarray, seed: int) -> np.ndarray:
    """Basins of an image: markers are the largest pixels of the mask in a square of ``seed`` pixels (touching ones are one marker), numbered
    by rows; from them pixels join the basin of the neighbour that reaches them first, the highest first and of equal ones the earliest."""
    n, m = height.shape
    half = int(seed) // 2
    markers = np.zeros((n, m), np.int64)
    tops = np.zeros((n, m), bool)
    for r, c in zip(*np.nonzero(mask), strict=True):
        box = (slice(max(0, r - half), r + half + 1), slice(max(0, c - half), c + half + 1))
        near = mask[box] > 0
        tops[r, c] = height[r, c] >= height[box][near].max()
    count = 0
    for r, c in zip(*np.nonzero(tops), strict=True):
        if markers[r, c]:
            continue
        count += 1
        todo = [(r, c)]
        markers[r, c] = count
        while todo:
            i, j = todo.pop()
            for a, b in ((i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)):
                if 0 <= a < n and 0 <= b < m and tops[a, b] and not markers[a, b]:
                    markers[a, b] = count
                    todo.append((a, b))
    heap = [(-height[r, c], i, r, c) for i, (r, c) in enumerate(zip(*np.nonzero(markers), strict=True))]
    heapq.heapify(heap)
    order = len(heap)
    while heap:
        _, _, r, c = heapq.heappop(heap)
        for a, b in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
            if 0 <= a < n and 0 <= b < m and mask[a, b] and not markers[a, b]:
                markers[a, b] = markers[r, c]
                heapq.heappush(heap, (-height[a, b], order, a, b))
                order += 1
    return markers


def watershed(df: DataFrame, keys: list[str], height: str, mask: str, seed: int = 5) -> DataFrame:
    """keys, row, col, basin of masked pixels by flooding from local tops of ``height``; basins are numbered from 1 in each image.

    An image is one group, bounded by its size; keys name the images.
    """

    def one(px: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = px["row"].min(), px["col"].min()
        size = (px["row"].max() - r0 + 1, px["col"].max() - c0 + 1)
        h, inside = np.full(size, -np.inf), np.zeros(size, np.int64)
        at = (px["row"] - r0, px["col"] - c0)
        h[at], inside[at] = px[height].fillna(-np.inf), px[mask].fillna(0) > 0
        return px[[*keys, "row", "col"]].assign(basin=flooded(h, inside, seed)[at]).query("basin > 0")

    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in (*keys, "row", "col"))
    return df.select(*keys, "row", "col", height, mask).groupBy(*keys).applyInPandas(one, schema + ", basin long")
