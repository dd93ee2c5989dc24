"""Queries on rasters: neighbourhoods, textures, zones, segments, mosaics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, focal, fusion, masks, rules, scores, segments, zonal
from ..sources.shared import checked_broadcast
from .base import N_COLS, RASTER, n_rows, query, raster, table

r6 = lambda c: F.round(c, 6)
c = F.col
_LINES = "max(row) OVER () AS mr"


def _window(agg: str, half: int, value: str = "value", src: str = "ras") -> str:
    """SQL of a square aggregate by a join of offsets."""
    return f"SELECT a.row, a.col, {agg.format(v='b.' + value)} AS focal FROM {src} a JOIN {src} b ON b.row BETWEEN a.row - {half} AND a.row + {half} AND b.col BETWEEN a.col - {half} AND a.col + {half} GROUP BY a.row, a.col"


def _halo(half: int, edge: int, cols: str = "value", src: str = "ras") -> str:
    """Mirrored edges: edge 1 repeats the edge pixel, 0 does not."""
    return f"""dims AS (SELECT max(row) + 1 AS nr, max(col) + 1 AS nc FROM {src}), hr AS (SELECT DISTINCT unnest([row, -{edge} - row, 2 * nr - 2 + {edge} - row]) AS r, row, col, {cols} FROM {src}, dims),
 hc AS (SELECT DISTINCT r, unnest([col, -{edge} - col, 2 * nc - 2 + {edge} - col]) AS k, row, col, {cols} FROM hr, dims), halo AS (SELECT CAST(r AS INTEGER) AS row, CAST(k AS INTEGER) AS col, {cols} FROM hc, dims WHERE r BETWEEN -{half} AND nr - 1 + {half} AND k BETWEEN -{half} AND nc - 1 + {half})"""


@query("op_F1_focal_mean", f"WITH {RASTER}, {_halo(2, 1)} SELECT a.row, a.col, round(avg(b.value), 6) AS focal FROM ras a JOIN halo b ON b.row BETWEEN a.row - 2 AND a.row + 2 AND b.col BETWEEN a.col - 2 AND a.col + 2 GROUP BY a.row, a.col")
def _(spark, sf):
    r = raster(spark, sf)
    return focal.focal_mean(r, [], 2, n_rows(r), N_COLS).select("row", "col", r6("focal").alias("focal"))


@query("op_F2_focal_max", f"WITH {RASTER} {_window('max({v})', 1)}")
def _(spark, sf):
    return focal.focal_max(raster(spark, sf), [], 1).select("row", "col", "focal")


@query("op_F3_dilated", f"WITH {RASTER}, m AS (SELECT row, col, CASE WHEN value > 45 THEN 1 ELSE 0 END AS value FROM ras) {_window('max({v})', 2, 'value', 'm')}")
def _(spark, sf):
    r = raster(spark, sf).withColumn("value", F.when(c("value") > 45, 1).otherwise(0))
    return focal.dilated(r, [], 2).select("row", "col", "focal")


@query("op_F4_distance", f"WITH {RASTER}, t AS (SELECT row, col FROM ras WHERE value > 47) SELECT a.row, a.col, round(least(coalesce(min(sqrt((a.row - t.row) * (a.row - t.row) + (a.col - t.col) * (a.col - t.col))), 6), 6), 6) AS distance FROM ras a LEFT JOIN t ON abs(a.row - t.row) <= 6 AND abs(a.col - t.col) <= 6 GROUP BY a.row, a.col")
def _(spark, sf):
    return focal.distance_to(raster(spark, sf), [], c("value") > 47, 6).select("row", "col", r6("distance").alias("distance"))


_CROSS = lambda f, src, out: f"{out} AS (SELECT a.row, a.col, {f}(b.value) AS value FROM {src} a JOIN {src} b ON abs(a.row - b.row) + abs(a.col - b.col) <= 1 GROUP BY a.row, a.col)"


@query("op_F5_cleaned", f"WITH {RASTER}, m0 AS (SELECT row, col, CASE WHEN value > 20 THEN 1 ELSE 0 END AS value FROM ras), {_CROSS('min', 'm0', 'm1')}, {_CROSS('max', 'm1', 'm2')}, {_CROSS('max', 'm2', 'm3')}, {_CROSS('min', 'm3', 'm4')} SELECT row, col, value AS focal FROM m4")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", F.when(c("value") > 20, 1).otherwise(0).alias("value"))
    return focal.cleaned(r, []).select("row", "col", "focal")


_GRAY = f"{RASTER}, g AS (SELECT row, col, CAST(trunc((value - lo) / CAST(hi - lo AS DOUBLE) * 8) AS INTEGER) AS gray FROM ras, (SELECT min(value) AS lo, max(value) AS hi FROM ras))"


def _textures_sql() -> str:
    f = {"contrast": "pow(x.gray - y.gray, 2)", "dissimilarity": "abs(x.gray - y.gray)", "homogeneity": "1 / (1 + pow(x.gray - y.gray, 2))"}
    cols = ", ".join(f"round(sum({s}) / 6, 6) AS {n}" for n, s in f.items())
    return f"WITH {_GRAY}, {_halo(1, 0, 'gray', 'g')} SELECT a.row, a.col, {cols} FROM g a JOIN halo x ON x.row BETWEEN a.row - 1 AND a.row + 1 AND x.col BETWEEN a.col - 1 AND a.col JOIN halo y ON y.row = x.row AND y.col = x.col + 1 GROUP BY a.row, a.col"


@query("op_F6_linear_textures", _textures_sql())
def _(spark, sf):
    r = raster(spark, sf)
    names = ["contrast", "dissimilarity", "homogeneity"]
    out = focal.linear_textures(focal.gray_levels(r, "value", 8), [], 1, n_rows(r), N_COLS, names)
    return out.select("row", "col", *(r6(n).alias(n) for n in names))


@query("op_F6_pair_textures")
def _(spark, sf):
    r = raster(spark, sf)
    names = ["entropy", "asm", "energy", "correlation", "variance"]
    out = focal.pair_textures(focal.gray_levels(r, "value", 8), [], 1, n_rows(r), N_COLS, names, 8)
    return out.select("row", "col", *(r6(n).alias(n) for n in names))


_FIELDS = f"{RASTER}, f AS (SELECT row, col, CASE WHEN value < 15 THEN 104 WHEN value < 30 THEN 125 WHEN value < 40 THEN 96 ELSE 75 END AS majority, value * 3 AS size, CAST(floor(price - 800) AS INTEGER) AS around FROM ras)"


def _fields(spark, sf):
    code = F.when(c("value") < 15, 104).when(c("value") < 30, 125).when(c("value") < 40, 96).otherwise(75)
    return raster(spark, sf).select("row", "col", code.alias("majority"), (c("value") * 3).alias("size"), F.floor(c("price") - 800).cast("int").alias("around"))


@query("op_F8_small_fields", f"WITH {_FIELDS} SELECT row, col, CAST(CASE WHEN majority IN (104, 96) AND size <= 20 AND around < 200 THEN 137 WHEN majority BETWEEN 100 AND 147 AND size < 50 AND NOT (majority IN (104, 96) AND around > 200) THEN 137 ELSE majority END AS INTEGER) AS majority FROM f")
def _(spark, sf):
    return focal.small_fields(_fields(spark, sf), list(range(100, 148)), [104, 96], 137).select("row", "col", "majority")


@query("op_F8_refined_area", f"WITH {_FIELDS}, a AS (SELECT row, col, CAST(round_even(CASE WHEN around >= 400 THEN size * 25 / 3e0 WHEN around >= 200 THEN size * 25 / 2e0 ELSE size * 25e0 END / 10, 0) AS INTEGER) AS v FROM f) SELECT a.row, a.col, max(b.v) AS area10 FROM a JOIN a b ON abs(a.row - b.row) <= 2 AND abs(a.col - b.col) <= 2 GROUP BY ALL")
def _(spark, sf):
    rows = _fields(spark, sf).withColumn("area", c("size") * 25)
    return focal.refined_area(rows, [], 2, "area", "around").select("row", "col", "area10")


@query("op_F8_mean_field_size", f"WITH {RASTER}, {_halo(3, 1)}, m AS ({_window('avg({v})', 3, src='halo')}) SELECT row, col, CAST(round_even(round(focal, 9), 0) AS INTEGER) AS around FROM m WHERE (row, col) IN (SELECT (row, col) FROM ras)")
def _(spark, sf):
    r = raster(spark, sf)
    return focal.mean_field_size(r, [], 3, n_rows(r), N_COLS, "value").select("row", "col", "around")


def _context(spark, sf):
    r = raster(spark, sf)
    rows = focal.focal_mean(r.withColumn("size0", c("value")), [], 2, n_rows(r), N_COLS, "size0", "size")
    code = F.when(c("value") < 10, 75).when(c("value") < 30, 137).when(c("value") < 35, 125).when(c("value") < 40, 143).when(c("value") < 45, 96).otherwise(220)
    rows = rows.withColumn("class", code).withColumn("majority", F.when(c("price") > 975, 143).otherwise(0)).withColumn("buffer", F.when(c("price") > 940, 143).when(c("price") > 930, 161).otherwise(0))
    rows = rows.withColumn("excluded", c("col") < 4)
    rows = focal.focal_max(rows.withColumn("high", F.when(c("class") == 220, 1).otherwise(0)), [], 1, "high", "near_high")
    return focal.distance_to(rows, [], c("value") > 47, 6).select("row", "col", "class", "majority", "buffer", "size", "distance", "near_high", "excluded")


@query("op_F9_smallholder_context")
def _(spark, sf):
    return focal.smallholder_context(_context(spark, sf), [], [137, 143, 125], list(range(100, 148)), [143], [125, 137], 86, 96, 143).select("row", "col", "class")


@query("op_F10_forest_edges", f"""WITH {RASTER}, f AS (SELECT row, col, CASE WHEN value > 35 THEN 250 WHEN value > 25 THEN 221 ELSE value END AS class FROM ras)
 SELECT a.row, a.col, CAST(CASE WHEN a.class = 250 AND max(CASE WHEN b.class > 200 THEN 1 ELSE 9 END) = 9 THEN 215 ELSE a.class END AS INTEGER) AS class FROM f a JOIN f b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 GROUP BY a.row, a.col, a.class""")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", F.when(c("value") > 35, 250).when(c("value") > 25, 221).otherwise(c("value")).alias("class"))
    return focal.forest_edges(r, [], rules.CLASSES["dense_for"], rules.FIRST_MATURE, rules.CLASSES["open_for"][0])


_NEAR = lambda dr, dc: f"(SELECT value FROM ras b WHERE b.row = a.row + {dr} AND b.col = a.col + {dc})"


@query("op_F12_slope", f"""WITH {RASTER}, n AS (SELECT a.row, a.col, {', '.join(f"max(CASE WHEN b.row = a.row + {i} AND b.col = a.col + {j} THEN b.value END) AS n{i + 1}{j + 1}" for i in (-1, 0, 1) for j in (-1, 0, 1))} FROM ras a JOIN ras b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 GROUP BY a.row, a.col)
 SELECT row, col, round(atan(sqrt(pow(((n02 + 2 * n12 + n22) - (n00 + 2 * n10 + n20)) / 80e0, 2) + pow(((n20 + 2 * n21 + n22) - (n00 + 2 * n01 + n02)) / 80e0, 2))), 6) AS slope FROM n""")
def _(spark, sf):
    return focal.slope_aspect(raster(spark, sf), [], 10.0, "value").select("row", "col", r6("slope").alias("slope"))


@query("op_F12_self_shadow", f"""WITH {RASTER}, n AS (SELECT a.row, a.col, {', '.join(f"max(CASE WHEN b.row = a.row + {i} AND b.col = a.col + {j} THEN b.value END) AS n{i + 1}{j + 1}" for i in (-1, 0, 1) for j in (-1, 0, 1))} FROM ras a JOIN ras b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 GROUP BY a.row, a.col),
 d AS (SELECT row, col, ((n02 + 2 * n12 + n22) - (n00 + 2 * n10 + n20)) / 8e0 AS dx, ((n20 + 2 * n21 + n22) - (n00 + 2 * n01 + n02)) / 8e0 AS dy FROM n), l AS (SELECT row, col, cos(atan(sqrt(dx * dx + dy * dy))) * cos(radians(60)) + sin(atan(sqrt(dx * dx + dy * dy))) * sin(radians(60)) * cos(radians(135) - atan2(dy, -dx)) AS light FROM d)
 SELECT row, col, round(light, 6) AS light, CAST(CASE WHEN light <= 0 THEN 1 ELSE 0 END AS INTEGER) AS shadow FROM l""")
def _(spark, sf):
    s = focal.slope_aspect(raster(spark, sf), [], 1.0, "value")
    light = focal.illumination(c("slope"), c("aspect"), 60.0, 135.0)
    return s.select("row", "col", r6(light).alias("light"), focal.self_shadow(light).alias("shadow"))


@query("op_F11_cast_shadow", f"WITH {RASTER}, h AS (SELECT row, col, value + row * 10 * tan(radians(40)) AS h FROM ras) SELECT row, col, CAST(CASE WHEN max(h) OVER (PARTITION BY col ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > h THEN 1 ELSE 0 END AS INTEGER) AS shadow FROM h")
def _(spark, sf):
    return focal.cast_shadow(raster(spark, sf), [], 40.0, "north", 10.0, "value").select("row", "col", "shadow")


@query("op_F13_topographic_correction", f"""WITH {RASTER}, l AS (SELECT *, price / 3000 AS light FROM ras), f AS (SELECT zone, regr_intercept(value, light) / nullif(regr_slope(value, light), 0) AS k FROM l GROUP BY zone)
 SELECT row, col, round(coalesce(value * (cos(radians(30)) + k) / nullif(light + k, 0), value), 4) AS corrected FROM l JOIN f USING (zone)""")
def _(spark, sf):
    rows = raster(spark, sf).withColumn("light", c("price") / 3000)
    return focal.topographic_correction(rows, ["zone"], "value", "light", 30.0).select("row", "col", F.round("corrected", 4).alias("corrected"))


@query("op_F14_instances", "SELECT p_partkey, CAST(CASE WHEN 1 + p_size / 5e1 - p_retailprice / 2000 >= 0.9 THEN 1 ELSE 0 END AS INTEGER) AS field FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", segments.instance_mask(c("p_size") / 50.0, c("p_retailprice") / 2000, 0.9).alias("field"))


_SEG = f"""WITH RECURSIVE {RASTER}, m AS (SELECT row, col, row * {N_COLS} + col AS k FROM ras WHERE value > 20), e AS (SELECT a.k AS u, b.k AS v FROM m a JOIN m b ON abs(a.row - b.row) + abs(a.col - b.col) = 1),
 reach(k, root) AS (SELECT k, k FROM m UNION SELECT e.v, reach.root FROM reach JOIN e ON reach.k = e.u WHERE reach.root < e.v)"""


_SEG += ", seg AS (SELECT m.row, m.col, CAST(min(root) AS BIGINT) AS segment FROM m JOIN reach USING (k) GROUP BY m.row, m.col)"


@query("op_F15_connected_components", f"{_SEG} SELECT row, col, segment FROM seg")
def _(spark, sf):
    return segments.connected(raster(spark, sf), [], c("value") > 20, N_COLS)


@query("op_G19_segment_shapes", f"""{_SEG}, n AS (SELECT a.segment, a.row, a.col, 4 - count(b.segment) AS e FROM seg a LEFT JOIN seg b ON a.segment = b.segment AND abs(a.row - b.row) + abs(a.col - b.col) = 1 GROUP BY ALL),
 s AS (SELECT segment, count(*) * 100e0 AS area, CAST(sum(e) AS BIGINT) * 10e0 AS perimeter FROM n GROUP BY segment) SELECT segment, area, perimeter, round(area / perimeter, 6) AS APR, round(100 * perimeter / (4 * sqrt(area)), 6) AS APrEf FROM s WHERE area >= 900""")
def _(spark, sf):
    segs = segments.connected(raster(spark, sf), [], c("value") > 20, N_COLS)
    out = segments.shapes(segs, [], 10.0, 900.0)
    return out.select("segment", "area", "perimeter", r6("APR").alias("APR"), r6("APrEf").alias("APrEf"))


@query("op_F15_cut_fields")
def _(spark, sf):
    return segments.cut_fields(raster(spark, sf).withColumn("m", F.when(c("value") > 8, 1).otherwise(0)), [], "m", N_COLS)


@query("op_F15_watershed")
def _(spark, sf):
    """Basins of the smoothed raster inside fields, in four images."""
    r = raster(spark, sf)
    rows = focal.focal_mean(r, [], 1, n_rows(r), N_COLS, "value", "height").withColumn("cell", F.floor(c("col") / 13))
    rows = rows.withColumn("m", segments.extent_mask(c("height") * 20, c("price"), 0.98, 0.2))
    return segments.watershed(rows, ["cell"], "height", "m", 5)


@query("op_F15_extent_mask", f"WITH {RASTER} SELECT row, col, CAST(CASE WHEN price > 950 THEN 0 WHEN value * 20 > 300 THEN 1 ELSE 0 END AS INTEGER) AS mask FROM ras")
def _(spark, sf):
    return raster(spark, sf).select("row", "col", segments.extent_mask(c("value") * 20, c("price"), 0.95, 0.3).alias("mask"))


@query("op_R3_spatio_temporal", f"""WITH {RASTER}, s AS (SELECT row, col, unnest([1, 2, 3]) AS t, value, price FROM ras WHERE row < 20), v AS (SELECT row, col, t, value * 10e0 + t * 40 + price % 7 AS v FROM s),
 w AS (SELECT a.row, a.col, a.t, b.v, exp(-0.5e0 * (pow(b.t - a.t, 2) + pow(b.row - a.row, 2) + pow(b.col - a.col, 2) + pow((b.v - a.v) / 100, 2))) AS w FROM v a JOIN v b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 AND abs(a.t - b.t) <= 1) SELECT row, col, t, round(sum(w * v) / sum(w), 5) AS value FROM w GROUP BY row, col, t""")
def _(spark, sf):
    from ..operators.series import spatio_temporal

    rows = raster(spark, sf).filter("row < 20").withColumn("t", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    rows = rows.select("row", "col", "t", (c("value") * 10.0 + c("t") * 40 + c("price") % 7).alias("value"))
    return spatio_temporal(rows, [], day="t", colour=100.0).select("row", "col", "t", F.round("value", 5).alias("value"))


@query("op_F17_saliency", f"""WITH {RASTER}, s AS (SELECT row, col, value * 200 * 0.0255e0 AS value FROM ras), mean AS (SELECT avg(CASE WHEN value <> 0 THEN value END) AS m FROM s), {_halo(2, 0, src='s')},
 g AS (SELECT a.row, a.col, sum(b.value * [1, 4, 6, 4, 1][b.row - a.row + 3] * [1, 4, 6, 4, 1][b.col - a.col + 3]) / 256e0 AS v FROM s a JOIN halo b ON abs(a.row - b.row) <= 2 AND abs(a.col - b.col) <= 2 GROUP BY a.row, a.col) SELECT row, col, round(abs(v - m), 6) AS saliency FROM g, mean""")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", (c("value") * 200).alias("value"))
    return focal.saliency(r, [], n_rows(r), N_COLS).select("row", "col", r6("saliency").alias("saliency"))


@query("op_F18_padded", f"WITH {RASTER}, {_halo(4, 1)} SELECT row, col, value * 0.5e0 AS value FROM halo WHERE row BETWEEN -4 AND (SELECT max(row) + 4 FROM ras) AND col BETWEEN -4 AND 53")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", "value")
    return focal.padded(r, 4, n_rows(r), N_COLS, scale=0.5)


@query("op_F18_cubic", f"""WITH {RASTER}, nr AS (SELECT max(row) + 1 AS n FROM ras), taps AS (SELECT o, n, unnest(range(-1, 3)) AS k, (o + 0.5e0) * n / m - 0.5e0 AS z, axis FROM (SELECT unnest(range(0, 13)) AS o, n, 13 AS m, 'r' AS axis FROM nr UNION ALL SELECT unnest(range(0, 70)), 50, 70, 'c')),
 w AS (SELECT axis, o, least(greatest(CAST(floor(z) AS BIGINT) + k, 0), n - 1) AS src, abs(z - floor(z) - k) AS x FROM taps), q AS (SELECT axis, o, src, CASE WHEN x <= 1 THEN 1.25e0 * x * x * x - 2.25e0 * x * x + 1 ELSE -0.75e0 * x * x * x + 3.75e0 * x * x - 6 * x + 3 END AS w FROM w)
 SELECT CAST(a.o AS INTEGER) AS row, CAST(b.o AS INTEGER) AS col, round(sum(value * a.w * b.w), 5) AS value FROM ras JOIN q a ON a.axis = 'r' AND a.src = row JOIN q b ON b.axis = 'c' AND b.src = col GROUP BY 1, 2""")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", "value")
    return focal.cubic(r, [], (n_rows(r), N_COLS), (13, 70)).select("row", "col", F.round("value", 5).alias("value"))


@query("op_G6_dispatched", f"WITH {RASTER}, a AS (SELECT zone, 'cont' AS how, 'avg' AS name, round(avg(value), 4) AS v FROM ras GROUP BY zone), n AS (SELECT zone, CASE WHEN value <= 10 THEN 'Crop' WHEN value <= 30 THEN 'Grass' END AS name, count(*) AS k FROM ras WHERE value <= 30 GROUP BY 1, 2), z AS (SELECT zone, name FROM (SELECT DISTINCT zone FROM ras), (VALUES ('Crop'), ('Grass')) s(name)) SELECT * FROM a UNION ALL SELECT z.zone, 'cat', z.name, CAST(coalesce(k, 0) AS DOUBLE) FROM z LEFT JOIN n ON z.zone = n.zone AND z.name = n.name")
def _(spark, sf):
    r = raster(spark, sf)
    cont = zonal.summarised(r, ["zone"], "value", setting="continuous", entry={"classes": {"x": 1}}, decimals=4)
    cat = zonal.summarised(r, ["zone"], "value", entry={"classes": {"Crop": list(range(1, 11)), "Grass": list(range(11, 31))}}).filter("kind = 'class'")
    return cont.select("zone", F.lit("cont").alias("how"), F.lit("avg").alias("name"), c("avg").cast("double").alias("v")).unionByName(cat.select("zone", F.lit("cat").alias("how"), "name", c("n").cast("double").alias("v")))


@query("op_F16_segmentation_accuracy", f"""WITH {RASTER}, p AS (SELECT row, col, CASE WHEN value > 5 THEN value // 10 END AS ref, CASE WHEN price < 980 THEN CAST(floor(price / 10) AS BIGINT) END AS pred, col // 25 AS region FROM ras), g AS (SELECT region, count(DISTINCT ref) AS n_ref, count(DISTINCT pred) AS n_pred FROM p GROUP BY region),
 n AS (SELECT ref, pred, count(*) AS k FROM p WHERE ref IS NOT NULL AND pred IS NOT NULL GROUP BY 1, 2), b AS (SELECT ref, max({{'k': k, 'p': -pred}}) AS m FROM n GROUP BY ref), h AS (SELECT ref, count(*) AS nr, min(region) AS region FROM p WHERE ref IS NOT NULL GROUP BY ref), q AS (SELECT pred, count(*) AS np FROM p WHERE pred IS NOT NULL GROUP BY pred),
 i AS (SELECT h.region, m.k / CAST(nr + np - m.k AS DOUBLE) AS iou FROM b JOIN h USING (ref) JOIN q ON q.pred = -m.p), s AS (SELECT region, avg(iou) AS iou, count(*) FILTER (WHERE iou >= 0.5) AS k FROM i GROUP BY region)
 SELECT CAST(g.region AS BIGINT) AS region, n_ref, n_pred, round(iou, 6) AS iou, round(coalesce(k, 0) / CAST(n_ref AS DOUBLE), 6) AS hits, round(CASE WHEN n_pred >= n_ref THEN n_pred / CAST(n_ref AS DOUBLE) - 1 ELSE 1 - n_ref / CAST(n_pred AS DOUBLE) END, 6) AS n_error FROM g LEFT JOIN s ON g.region = s.region""")
def _(spark, sf):
    p = raster(spark, sf).select("row", "col", F.when(c("value") > 5, F.floor(c("value") / 10)).alias("ref"), F.when(c("price") < 980, F.floor(c("price") / 10)).alias("pred"), F.floor(c("col") / 25).alias("region"))
    _, out = scores.segmentation_accuracy(p, "ref", "pred", "region", "col", "row")
    return out.select("region", "n_ref", "n_pred", r6("iou").alias("iou"), r6("hits").alias("hits"), r6("n_error").alias("n_error"))


@query("op_R18_shade_mask", f"""WITH {RASTER}, h AS (SELECT row, col, value, value + row * 10 * tan(radians(30)) AS h FROM ras), d AS (SELECT row, col, CASE WHEN max(h) OVER (PARTITION BY col ORDER BY row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > h THEN 1 ELSE 0 END AS s FROM h),
 n AS (SELECT a.row, a.col, {', '.join(f"max(CASE WHEN b.row = a.row + {i} AND b.col = a.col + {j} THEN b.value END) AS n{i + 1}{j + 1}" for i in (-1, 0, 1) for j in (-1, 0, 1))} FROM ras a JOIN ras b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 GROUP BY a.row, a.col),
 g AS (SELECT row, col, ((n02 + 2 * n12 + n22) - (n00 + 2 * n10 + n20)) / 80e0 AS dx, ((n20 + 2 * n21 + n22) - (n00 + 2 * n01 + n02)) / 80e0 AS dy FROM n),
 m AS (SELECT d.row, d.col, greatest(s, CASE WHEN cos(atan(sqrt(dx * dx + dy * dy))) * cos(radians(60)) + sin(atan(sqrt(dx * dx + dy * dy))) * sin(radians(60)) * cos(0 - atan2(dy, -dx)) <= 0 THEN 1 ELSE 0 END) AS s FROM d JOIN g ON d.row = g.row AND d.col = g.col)
 SELECT 'a' AS scene_id, a.row, a.col, CAST(max(b.s) AS SMALLINT) AS mask FROM m a JOIN m b ON abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1 GROUP BY a.row, a.col""")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", c("value").alias("elev"))
    return masks.shade_mask(r, [("a", 60.0, 0.0), ("b", None, None)], [], 10.0)


@query("op_F17_histogram_matched", """WITH a AS (SELECT p_size AS v, count(*) AS n FROM part GROUP BY 1), b AS (SELECT p_size AS v, count(*) AS n FROM part WHERE p_size > 10 GROUP BY 1),
 x AS (SELECT v, round(sum(n) OVER (ORDER BY v) / CAST(sum(n) OVER () AS DOUBLE), 12) AS s FROM a), y AS (SELECT v, round(sum(n) OVER (ORDER BY v) / CAST(sum(n) OVER () AS DOUBLE), 12) AS s FROM b), l AS (SELECT x.v, min(y.v) AS matched FROM x JOIN y ON y.s >= x.s GROUP BY x.v) SELECT p_partkey, CAST(matched AS INTEGER) AS matched FROM part JOIN l ON p_size = v""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return focal.equalised(p, p.filter("p_size > 10"), "p_size").select("p_partkey", "matched")


@query("op_F18_resampled", f"WITH {RASTER} SELECT CAST(row // 4 AS INTEGER) AS row, CAST(col // 4 AS INTEGER) AS col, round(avg(value), 6) AS value FROM ras GROUP BY 1, 2")
def _(spark, sf):
    return focal.resampled(raster(spark, sf), [], 4).withColumn("value", r6("value"))


@query("op_P6_gray_levels", f"WITH {_GRAY} SELECT row, col, gray FROM g")
def _(spark, sf):
    return focal.gray_levels(raster(spark, sf), "value", 8).select("row", "col", "gray")


@query("op_P11_missed_nodata", "SELECT l_orderkey, l_linenumber, (max(l_quantity) OVER w = min(l_quantity) OVER w AND count(*) OVER w > 1) OR (max(l_quantity) OVER u = min(l_quantity) OVER u AND count(*) OVER u > 1) AS missed FROM lineitem WINDOW w AS (PARTITION BY l_returnflag, l_orderkey), u AS (PARTITION BY l_returnflag, l_partkey)")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return masks.missed_nodata(li, "l_returnflag", "l_orderkey", "l_partkey", ["l_quantity"]).select("l_orderkey", "l_linenumber", "missed")


@query("op_P12_block_means", f"WITH {RASTER} SELECT zone, round(avg(value), 6) AS whole, round(avg(value) FILTER (WHERE row < 20 AND col < 25), 6) AS nw, round(avg(value) FILTER (WHERE row < 20 AND col >= 25), 6) AS ne, round(avg(value) FILTER (WHERE row >= 20 AND col < 25), 6) AS sw, round(avg(value) FILTER (WHERE row >= 20 AND col >= 25), 6) AS se FROM ras GROUP BY zone")
def _(spark, sf):
    out = masks.block_means(raster(spark, sf), "zone", "row", "col", "value", 40, 50)
    return out.select("zone", *(r6(x).alias(x) for x in ("whole", "nw", "ne", "sw", "se")))


@query("op_R16_class_of_probabilities", "SELECT l_orderkey, l_linenumber, CAST(CASE WHEN greatest(l_discount * 10, l_tax * 10, l_quantity / 5e1) < 0.5 THEN 0 WHEN l_discount * 10 = greatest(l_discount * 10, l_tax * 10, l_quantity / 5e1) THEN 1 WHEN l_tax * 10 = greatest(l_discount * 10, l_tax * 10, l_quantity / 5e1) THEN 2 ELSE 3 END AS INTEGER) AS class FROM lineitem")
def _(spark, sf):
    p = [c("l_discount") * 10, c("l_tax") * 10, c("l_quantity") / 50.0]
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", masks.probability_mask(p, [1, 2, 3], 0.5).alias("class"))


# Zones.

_SETS = [("Homogeneous crop", v) for v in (*range(1, 9), 12)] + [("Tree crop", v) for v in (9, 10)] + [("No crop", v) for v in (12, *range(20, 26))] + [("Grass", v) for v in (26, 27)] + [("Forest", v) for v in range(40, 46)] + [("Burn", 46), ("Trees", 47), ("Nothing", 99)]
_SETS_SQL = "sets(name, v) AS (VALUES " + ", ".join(f"('{n}', {v})" for n, v in _SETS) + ")"


def _sets(spark):
    return spark.createDataFrame(_SETS, "name string, value int")


@query("op_G1_class_shares", f"""WITH {RASTER}, {_SETS_SQL}, z AS (SELECT zone, count(*) FILTER (WHERE value = 12) // 2 AS half FROM ras GROUP BY zone), names AS (SELECT DISTINCT name FROM sets),
 n AS (SELECT zone, name, CAST((SELECT count(*) FROM ras JOIN sets s ON value = v WHERE ras.zone = z.zone AND s.name = names.name AND NOT (v = 12 AND s.name IN ('Homogeneous crop', 'No crop'))) + CASE WHEN name IN ('Homogeneous crop', 'No crop') THEN half ELSE 0 END AS BIGINT) AS n FROM z, names),
 t AS (SELECT zone, CAST(sum(n) AS BIGINT) AS numpix FROM n GROUP BY zone),
 u AS (SELECT zone, CASE WHEN name IN ('Homogeneous crop', 'Tree crop') THEN 'crop' WHEN name = 'Burn' THEN 'burned' WHEN name = 'Grass' THEN 'grass' WHEN name IN ('Forest', 'Trees') THEN 'tree' END AS up, CAST(sum(n) AS BIGINT) AS n FROM n GROUP BY 1, 2),
 b AS (SELECT zone, 'class' AS kind, name, n FROM n UNION ALL SELECT zone, 'total', up, n FROM u WHERE up IS NOT NULL AND n > 0)
 SELECT zone, kind, name, n, numpix, round(100 * n / CAST(numpix AS DOUBLE), 1) AS percent FROM b JOIN t USING (zone) WHERE numpix > 0""")
def _(spark, sf):
    return zonal.class_shares(raster(spark, sf), _sets(spark), ["zone"], "value", 12)


@query("op_G1_missing_values", f"WITH {RASTER}, {_SETS_SQL}, n AS (SELECT zone, value, count(*) AS n FROM ras WHERE value <> 0 AND value NOT IN (SELECT v FROM sets) GROUP BY zone, value) SELECT zone, value, n FROM n")
def _(spark, sf):
    return zonal.missing_values(raster(spark, sf), _sets(spark), ["zone"], "value").select("zone", F.explode("missing").alias("value", "n"))


@query("op_G2_mask_percent", f"WITH {RASTER}, m AS (SELECT zone, CASE WHEN value > 45 THEN 255 WHEN value > 20 THEN 1 ELSE 0 END AS m FROM ras) SELECT zone, round(100 * count(*) FILTER (WHERE m > 0 AND m <> 255) / CAST(nullif(count(*) FILTER (WHERE m <> 255), 0) AS DOUBLE), 1) AS masked, round(100 * count(*) FILTER (WHERE m = 0) / CAST(nullif(count(*) FILTER (WHERE m <> 255), 0) AS DOUBLE), 1) AS unmasked FROM m GROUP BY zone")
def _(spark, sf):
    r = raster(spark, sf).withColumn("mask", F.when(c("value") > 45, 255).when(c("value") > 20, 1).otherwise(0))
    return zonal.mask_percent(r, ["zone"])


_Q = {"avg": "avg(v)", "med": "median(v)", "std": "stddev_pop(v)", "q10": "quantile_cont(v, 0.1)", "q25": "quantile_cont(v, 0.25)", "q75": "quantile_cont(v, 0.75)", "q90": "quantile_cont(v, 0.9)"}


@query("op_G3_summary", f"WITH {RASTER}, n AS (SELECT zone, CASE WHEN value <> 50 THEN price END AS v FROM ras) SELECT zone, {', '.join(f'coalesce(round({s}, 5), 0) AS {n}' for n, s in _Q.items())} FROM n GROUP BY zone")
def _(spark, sf):
    r = raster(spark, sf).withColumn("v", F.when(c("value") != 50, c("price")))
    return zonal.summary(r, ["zone"], "v", decimals=5)


@query("op_G4_zone_summary", f"WITH n AS (SELECT n_name AS zone, c_mktsegment, c_acctbal AS v FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT zone, c_mktsegment, {', '.join(f'coalesce(round({s}, 5), 0) AS {n}' for n, s in _Q.items())} FROM n GROUP BY zone, c_mktsegment")
def _(spark, sf):
    both = table(spark, sf, "customer").join(checked_broadcast(table(spark, sf, "nation")), c("c_nationkey") == c("n_nationkey")).select(c("n_name").alias("zone"), "c_mktsegment", "c_acctbal")
    return zonal.summary(both, ["zone", "c_mktsegment"], "c_acctbal", decimals=5)


@query("op_G5_polygon_summary", f"WITH {RASTER} SELECT zone, round(avg(value), 6) AS avg_value, round(avg(price), 6) AS avg_price FROM ras GROUP BY zone")
def _(spark, sf):
    out = zonal.polygon_summary(raster(spark, sf), "zone", ["value", "price"])
    return out.select("zone", *(r6(x).alias(x) for x in out.columns[1:]))


@query("op_G7_majority", f"WITH {RASTER}, n AS (SELECT zone, value, count(*) AS n FROM ras GROUP BY zone, value), m AS (SELECT zone, CAST(-max({{'n': n, 'v': -value}}).v AS INTEGER) AS majority FROM n GROUP BY zone) SELECT row, col, majority FROM ras JOIN m USING (zone)")
def _(spark, sf):
    r = raster(spark, sf)
    return zonal.burned_in(r, zonal.majority(r, ["zone"], "value"), ["zone"]).select("row", "col", "majority")


@query("op_G8_number_of_classes", "SELECT count(DISTINCT p_size) AS n_classes FROM part WHERE p_size <> 0")
def _(spark, sf):
    return zonal.number_of_classes(raster(spark, sf), "value")


@query("op_G17_chip_accuracy", """WITH n AS (SELECT o_orderpriority AS region, o_orderstatus AS s, count(*) AS n, avg(o_totalprice) AS mean, sum(o_totalprice) AS area FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2),
 j AS (SELECT p.region, CAST(p.n AS DOUBLE) AS pn, CAST(r.n AS DOUBLE) AS rn, p.mean AS pm, r.mean AS rm, p.area AS pa, r.area AS ra FROM n p JOIN n r ON p.region = r.region AND p.s = 'F' AND r.s = 'O')
 SELECT region, round(CASE WHEN pn >= rn THEN pn / rn - 1 ELSE 1 - rn / pn END, 6) AS n_error, round(CASE WHEN pm >= rm THEN pm / rm - 1 ELSE 1 - rm / pm END, 6) AS mean_error, round(CASE WHEN pa >= ra THEN pa / ra - 1 ELSE 1 - ra / pa END, 6) AS area_error FROM j""")
def _(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus in ('F', 'O')")
    return scores.chip_accuracy(o.withColumn("kind", F.when(c("o_orderstatus") == "F", "pred").otherwise("ref")).withColumnRenamed("o_orderpriority", "region"), "region", "kind", "o_totalprice")


@query("op_G18_overlap_scores", f"""WITH {RASTER}, p AS (SELECT row, col, value // 10 AS ref, CAST(floor(price / 10) AS BIGINT) AS pred FROM ras), n AS (SELECT ref, pred, count(*) AS shared FROM p GROUP BY 1, 2), b AS (SELECT ref, max({{'s': shared, 'p': -pred}}) AS m FROM n GROUP BY ref),
 r AS (SELECT ref, count(*) AS nr, avg(col) AS xr, avg(row) AS yr FROM p GROUP BY ref), q AS (SELECT pred, count(*) AS np, avg(col) AS xp, avg(row) AS yp FROM p GROUP BY pred)
 SELECT CAST(b.ref AS INTEGER) AS ref, -m.p AS pred, round(m.s / CAST(nr + np - m.s AS DOUBLE), 6) AS iou, round(1 - m.s / CAST(nr AS DOUBLE), 6) AS over, round(1 - m.s / CAST(np AS DOUBLE), 6) AS under, round(sqrt(pow(xr - xp, 2) + pow(yr - yp, 2)), 6) AS shift FROM b JOIN r ON b.ref = r.ref JOIN q ON q.pred = -m.p""")
def _(spark, sf):
    p = raster(spark, sf).select("row", "col", F.floor(c("value") / 10).cast("int").alias("ref"), F.floor(c("price") / 10).alias("pred"))
    out = scores.overlap_scores(p, "ref", "pred", "col", "row")
    return out.select("ref", "pred", *(r6(x).alias(x) for x in ("iou", "over", "under", "shift")))


_A27 = {"avg": "avg(l_quantity)", "var": "var_pop(l_quantity)", "cv": "100 * stddev_pop(l_quantity) / avg(l_quantity)", "per90": "quantile_cont(l_quantity, 0.9)"}
for _stat, _sql in _A27.items():

    @query(f"op_A27_polygon_{_stat}", f"SELECT l_suppkey AS poly, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, round({_sql}, 4) AS {_stat} FROM lineitem GROUP BY 1, 2")
    def _stat_of(spark, sf, stat=_stat):
        rows = table(spark, sf, "lineitem").select(c("l_suppkey").alias("poly"), F.trunc("l_shipdate", "month").alias("date"), "l_quantity")
        return zonal.temporal_statistic(rows, "poly", "date", "l_quantity", stat).select("poly", "date", F.round(stat, 4).alias(stat))


# Mosaics and samples.


@query("op_S22_mosaic", f"WITH {RASTER} SELECT row, col, CASE WHEN value > 25 THEN value ELSE -value END AS value FROM ras")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", "value")
    return catalog.mosaic([r.filter("value > 25"), r.withColumn("value", -c("value"))], ["row", "col"])


@query("op_S22_interior", f"WITH {RASTER} SELECT row, col, value FROM ras WHERE row BETWEEN 2 AND (SELECT max(row) FROM ras) - 2 AND col BETWEEN 2 AND 47")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", "value")
    return catalog.interior(r, "row", "col", n_rows(r), N_COLS, 2)


@query("op_S25_thumbnail", f"WITH {RASTER}, s AS (SELECT row, col, value, price FROM ras WHERE row % 4 = 0 AND col % 4 = 0), m AS (SELECT min(value) AS a, max(value) AS b, min(price) AS c, max(price) AS d FROM s) SELECT row, col, round(pow((value - a) / CAST(b - a AS DOUBLE), 0.5), 6) AS value, round(pow((price - c) / (d - c), 0.5), 6) AS price FROM s, m")
def _(spark, sf):
    out = catalog.thumbnail(raster(spark, sf), 4, ["value", "price"], 2.0)
    return out.select("row", "col", r6("value").alias("value"), r6("price").alias("price"))


@query("op_S14_points_at_pixels", f"WITH {RASTER} SELECT c_custkey, value, price FROM customer JOIN ras ON row = CAST(floor((400 - c_nationkey * 10) / 10e0) AS INTEGER) AND col = CAST(floor((c_custkey % 500) / 10e0) AS INTEGER)")
def _(spark, sf):
    from ..operators.sampling import at_pixels

    pts = table(spark, sf, "customer").select("c_custkey", (c("c_custkey") % 500).alias("x"), (c("c_nationkey") * 10).alias("y"))
    return at_pixels(pts, raster(spark, sf), "x", "y", 0.0, 400.0, 10.0).select("c_custkey", "value", "price")


@query("op_R12_blended")
def _(spark, sf):
    r = raster(spark, sf).select("row", "col", c("value").cast("double").alias("value"))
    coarse = focal.resampled(r, [], 5).select(c("row").alias("gr"), c("col").alias("gc"), c("value").alias("then"), (c("value") + 5).alias("now"))
    both = r.join(coarse, (F.floor(r["row"] / 5) == c("gr")) & (F.floor(r["col"] / 5) == c("gc"))).select("row", "col", "then", "now")
    return fusion.blended(r, both, [], 1).select("row", "col", r6("blended").alias("blended"))
