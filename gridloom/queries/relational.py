"""Queries on catalogs, masks, joins, scores, samples, classes through time, sources and streams."""

from __future__ import annotations

import re

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo, grammar, indices
from ..operators import catalog, fusion, joins, masks, models, rules, sampling, scores, series, zonal
from ..sources.shared import checked_broadcast, kept, new_folder
from ..streaming import streams
from .base import CLASSES, CODES, DAILY, GAPPY, OBS, TS, classes, daily, gappy, obs, query, table, ts

PX = ["px"]
r6 = lambda c: F.round(c, 6)
c = F.col

# Projections and predicates.


@query("op_P1_ordered_bands", "SELECT l_orderkey, l_linenumber, l_tax AS var_b, l_discount AS var_a FROM lineitem")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", c("l_discount").alias("sing_var_a"), c("l_tax").alias("poly_var_b"))
    return models.ordered_bands(rows, ["l_orderkey", "l_linenumber"], ["var_b", "var_a"])


@query("op_P2_where", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0e0 ELSE o_totalprice END AS price FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.when(c("o_orderstatus") == "F", 0.0).otherwise(c("o_totalprice")).alias("price"))


@query("op_P4_slice_last_of_day", f"WITH {OBS} SELECT px, date, max(scene) AS scene FROM obs WHERE date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY px, date")
def _(spark, sf):
    from ..operators.series import one_a_day

    rows = obs(spark, sf).select("px", "date", "scene").filter(c("date").between(F.lit("1997-01-01").cast("date"), F.lit("1997-12-31").cast("date")))
    return one_a_day(rows, PX, "scene")


@query("op_P6_min_max_scaled", "SELECT p_partkey, round((p_retailprice - (SELECT min(p_retailprice) FROM part)) / ((SELECT max(p_retailprice) FROM part) - (SELECT min(p_retailprice) FROM part)), 6) AS scaled FROM part")
def _(spark, sf):
    return catalog.min_max_scaled(table(spark, sf, "part"), "p_retailprice", "scaled").select("p_partkey", r6("scaled").alias("scaled"))


@query("op_P7_reclassified", "SELECT p_partkey, CAST(CASE p_size WHEN 1 THEN 10 WHEN 2 THEN 10 WHEN 3 THEN 30 ELSE 99 END AS INTEGER) AS class FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", zonal.reclassified(None, {1: 10, 2: 10, 3: 30}, "p_size", 99).alias("class"))


@query("op_P8_combined_masks", "SELECT p_partkey, CAST(CASE WHEN p_size > 10 AND p_retailprice > 950 THEN 1 ELSE 0 END AS INTEGER) AS mask FROM part")
def _(spark, sf):
    p = table(spark, sf, "part")
    one = lambda cond: p.select("p_partkey", F.when(cond, 1).otherwise(0).alias("mask"))
    return masks.combine_masks([one(c("p_size") > 10), one(c("p_retailprice") > 950)], ["p_partkey"])


@query("op_P9_mask_applied", "SELECT l_orderkey, l_linenumber, CASE WHEN o_custkey % 7 BETWEEN 2 AND 4 THEN NULL ELSE l_quantity END AS l_quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    mask = table(spark, sf, "orders").select(c("o_orderkey").alias("l_orderkey"), (c("o_custkey") % 7).alias("mask"))
    return masks.apply_mask(rows, mask, ["l_orderkey"], ["l_quantity"], 2, 4)


@query("op_P10_qa_bits", "SELECT p_partkey, (p_size & 40) <> 0 AS masked FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", masks.qa_mask(c("p_size"), ["shadow", "cloud"]).alias("masked"))


@query("op_P12_skip_reasons", """WITH s AS (SELECT l_suppkey AS scene, CAST(trunc(100 * count(*) FILTER (WHERE l_quantity < 25) / 600e0) AS INTEGER) AS valid_pix, count(*) AS file_size, CASE WHEN l_suppkey % 5 > 0 THEN CAST(sum(l_linenumber) AS BIGINT) * 100 END AS numpix FROM lineitem GROUP BY l_suppkey),
 r AS (SELECT *, coalesce((valid_pix < 48 AND valid_pix > -1) OR numpix < 170000, false) AS weak FROM s)
 SELECT scene, valid_pix, file_size, numpix, CASE WHEN file_size < 560 THEN 'file size' WHEN weak THEN 'not enough valid data' END AS skip_reason, file_size < 560 OR weak AS skip FROM r""")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(c("l_suppkey").alias("scene"), "l_quantity", "l_linenumber")
    known = F.when(c("scene") % 5 > 0, F.sum("l_linenumber") * 100)
    s = masks.valid_percent(li, "scene", "l_quantity", 600, 25).join(li.groupBy("scene").agg(F.count(F.lit(1)).alias("file_size"), known.alias("numpix")), "scene")
    return masks.skip_reasons(s, 48, 560, 170_000).select("scene", "valid_pix", "file_size", "numpix", "skip_reason", "skip")


@query("op_P13_valid_percent", "SELECT l_suppkey AS scene, CAST(trunc(100 * count(*) FILTER (WHERE l_extendedprice < 50000) / 700e0) AS INTEGER) AS valid_pix FROM lineitem GROUP BY l_suppkey")
def _(spark, sf):
    return masks.valid_percent(table(spark, sf, "lineitem").select(c("l_suppkey").alias("scene"), "l_extendedprice"), "scene", "l_extendedprice", 700, 50000)


@query("op_P14_rerun_flag", "SELECT o_orderkey, o_totalprice > 200000 AND (o_custkey + 1) / CAST(o_orderkey % 500 + 1 AS DOUBLE) >= 2 AS rerun FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", masks.rerun_flag(c("o_totalprice"), c("o_custkey"), c("o_orderkey") % 500).alias("rerun"))


@query("op_P15_missing_files", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def _(spark, sf):
    have = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(c("o_custkey").alias("c_custkey"))
    return catalog.without(table(spark, sf, "customer").select("c_custkey"), have, "c_custkey")


@query("op_P16_marked", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND o_orderkey NOT IN (1, 2, 3) THEN true ELSE false END AS gone FROM orders")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", c("o_orderkey").cast("string").alias("scene_id"), c("o_orderstatus").alias("sensor"), c("o_orderdate").cast("date").alias("date"), F.lit(False).alias("gone"))
    return catalog.marked(o, ["F"], "1996-01-01", "1996-12-31", ["1", "2", "3"], "gone").select("o_orderkey", "gone")


@query("op_P17_region_filter", "SELECT c_custkey, CASE WHEN n_regionkey IN (1, 3) THEN 0e0 ELSE c_acctbal END AS value FROM customer JOIN nation ON c_nationkey = n_nationkey")
def _(spark, sf):
    both = table(spark, sf, "customer").join(checked_broadcast(table(spark, sf, "nation")), c("c_nationkey") == c("n_nationkey"))
    return both.select("c_custkey", F.when(rules.in_region(c("n_regionkey"), [1, 3]), 0.0).otherwise(c("c_acctbal")).alias("value"))


@query("op_P19_valid_class", "SELECT p_partkey, p_size > 0 AND p_size < 256 AND p_size <> 98 AND p_size <= 100 AS ok FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", sampling.valid_class(c("p_size"), True).alias("ok"))


@query("op_P20_year_index", "SELECT y AS year, CAST(row_number() OVER (ORDER BY y) AS INTEGER) AS i FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)")
def _(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return years.withColumn("i", F.row_number().over(Window.orderBy("year")))  # a row a year


@query("op_geo_utm", "SELECT c_custkey, CAST(floor((lon + 180) / 6) % 60 + 1 AS INTEGER) AS zone, CAST(CASE WHEN lat < 0 THEN 32700 ELSE 32600 END + floor((lon + 180) / 6) % 60 + 1 AS INTEGER) AS epsg FROM (SELECT c_custkey, c_custkey % 357 - 178.5e0 AS lon, c_nationkey * 2 - 30e0 AS lat FROM customer)")
def _(spark, sf):
    p = table(spark, sf, "customer").select("c_custkey", (c("c_custkey") % 357 - 178.5).alias("lon"), (c("c_nationkey") * 2 - 30.0).alias("lat"))
    return p.select("c_custkey", geo.utm_zone(c("lon"), c("lat")).alias("zone"), geo.utm_epsg(c("lon"), c("lat")).alias("epsg"))


@query("op_json_props", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("op_cell_names", "SELECT s_suppkey, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS cell FROM supplier")
def _(spark, sf):
    return table(spark, sf, "supplier").select("s_suppkey", grammar.cell_name(c("s_suppkey")).alias("cell"))


# Joins.


@query("op_J1_lut", "SELECT l_orderkey, l_linenumber, p_type AS class_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return li.join(table(spark, sf, "part").select(c("p_partkey").alias("l_partkey"), c("p_type").alias("class_name")), "l_partkey", "left").drop("l_partkey")


@query("op_J2_features_of_samples", "SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(table(spark, sf, "customer").select(c("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")


@query("op_J4_two_roles", "SELECT l.doc_id, a.r_name AS obs_name, b.r_name AS pred_name FROM labels l LEFT JOIN region a ON l.quality = a.r_regionkey LEFT JOIN region b ON l.toxic = b.r_regionkey")
def _(spark, sf):
    names = table(spark, sf, "region")
    role = lambda key, name: checked_broadcast(names.select(c("r_regionkey").alias(key), c("r_name").alias(name)))
    return table(spark, sf, "labels").join(role("quality", "obs_name"), "quality", "left").join(role("toxic", "pred_name"), "toxic", "left").select("doc_id", "obs_name", "pred_name")


@query("op_J5_field_holdout", "WITH h AS (SELECT DISTINCT c_nationkey FROM customer WHERE c_acctbal > 9990) SELECT c_custkey, c_nationkey IN (SELECT c_nationkey FROM h) AS held FROM customer")
def _(spark, sf):
    s = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    out, rest = sampling.field_holdout(s, s.filter("c_acctbal > 9990"), "c_nationkey", "c_custkey")
    return out.select("c_custkey", F.lit(True).alias("held")).unionByName(rest.select("c_custkey", F.lit(False).alias("held")))


@query("op_J6_rest_is_test", "SELECT c_custkey FROM customer WHERE c_acctbal <= 5000")
def _(spark, sf):
    s = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return sampling.train_test(s, s.filter("c_acctbal > 5000"), "c_custkey").select("c_custkey")


_EV = "ev AS (SELECT event_id, user_id AS px, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'error')"


def _errors(spark, sf):
    return table(spark, sf, "events").filter("event_type = 'error'").select("event_id", c("user_id").alias("px"), c("ts").cast("date").alias("day"))


@query("op_J7_pre_post", f"""WITH {DAILY}, {_EV}, a AS (SELECT event_id, max({{'d': date, 'v': value}}) AS p FROM ev JOIN daily USING (px) WHERE date < day AND value > 0 GROUP BY event_id),
 b AS (SELECT event_id, min({{'d': date, 'v': -value}}) AS p FROM ev JOIN daily USING (px) WHERE date >= day AND value > 0 GROUP BY event_id)
 SELECT px, event_id, day, a.p.d AS pre_day, a.p.v AS pre, b.p.d AS post_day, CAST(-b.p.v AS INTEGER) AS post, CAST(date_diff('day', day, a.p.d) AS INTEGER) AS predelta, CAST(date_diff('day', day, b.p.d) AS INTEGER) AS postdelta FROM ev LEFT JOIN a USING (event_id) LEFT JOIN b USING (event_id)""")
def _(spark, sf):
    return joins.pre_post(_errors(spark, sf), daily(spark, sf), PX, "day", "date", "value")


@query("op_J7_usable", f"""WITH {DAILY}, {_EV}, a AS (SELECT event_id, max(date) AS d FROM ev JOIN daily USING (px) WHERE date < day AND value > 0 GROUP BY event_id),
 b AS (SELECT event_id, min(date) AS d FROM ev JOIN daily USING (px) WHERE date >= day AND value > 0 GROUP BY event_id) SELECT event_id FROM ev JOIN a USING (event_id) JOIN b USING (event_id) WHERE date_diff('day', day, a.d) > -3 AND date_diff('day', day, b.d) < 2""")
def _(spark, sf):
    return joins.usable(joins.pre_post(_errors(spark, sf), daily(spark, sf), PX, "day", "date", "value"), 3, 2).select("event_id")


@query("op_J8_nearest", f"""WITH {DAILY}, o AS (SELECT o_orderkey, o_custkey % 150 AS px, DATE '2024-01-01' + CAST(o_orderkey % 31 AS INTEGER) AS day FROM orders),
 n AS (SELECT o_orderkey, o.px, day, min({{'n': abs(date_diff('day', day, date)), 'd': date, 'v': -value}}) AS m FROM o JOIN daily ON o.px = daily.px GROUP BY o_orderkey, o.px, day)
 SELECT o.px, o.o_orderkey, o.day, m.d AS near_day, CAST(-m.v AS INTEGER) AS near_value FROM o LEFT JOIN n USING (o_orderkey)""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (c("o_custkey") % 150).alias("px"), F.date_add(F.lit("2024-01-01").cast("date"), (c("o_orderkey") % 31).cast("int")).alias("day"))
    return joins.nearest(o, daily(spark, sf), PX, "day", "date", "value").select("px", "o_orderkey", "day", "near_day", "near_value")


@query("op_J9_days_of_year", "SELECT a.o_orderkey AS k, b.o_orderkey AS k2 FROM orders a JOIN orders b ON a.o_custkey = b.o_custkey WHERE least(abs(dayofyear(a.o_orderdate) - dayofyear(b.o_orderdate)), 365 - abs(dayofyear(a.o_orderdate) - dayofyear(b.o_orderdate))) <= 10 AND abs(year(a.o_orderdate) - year(b.o_orderdate)) <= 2")
def _(spark, sf):
    o = table(spark, sf, "orders")
    a = o.select(c("o_custkey").alias("px"), c("o_orderkey").alias("k"), c("o_orderdate").cast("date").alias("d1"))
    b = o.select(c("o_custkey").alias("px"), c("o_orderkey").alias("k2"), c("o_orderdate").cast("date").alias("d2"))
    return joins.within_days_of_year(a, b, PX, "d1", "d2", 10, 2).select("k", "k2")


@query("op_J10_points_in_boxes", "SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_acctbal BETWEEN s_acctbal AND s_acctbal + 300 AND c_nationkey BETWEEN s_nationkey AND s_nationkey + 2")
def _(spark, sf):
    boxes = table(spark, sf, "supplier").select("s_suppkey", c("s_acctbal").alias("x0"), c("s_nationkey").cast("double").alias("y0"), (c("s_acctbal") + 300).alias("x1"), (c("s_nationkey") + 2.0).alias("y1"))
    pts = table(spark, sf, "customer").select("c_custkey", c("c_acctbal").alias("x"), c("c_nationkey").cast("double").alias("y"))
    return joins.points_in_boxes(pts, boxes, "x", "y", ["x0", "y0", "x1", "y1"], 500.0).select("c_custkey", "s_suppkey")


_BOX = "SELECT s_suppkey AS k, s_acctbal AS x0, CAST(s_nationkey AS DOUBLE) AS y0, s_acctbal + 400 AS x1, s_nationkey + 3e0 AS y1 FROM supplier"


def _boxes(spark, sf, p=""):
    return table(spark, sf, "supplier").select(c("s_suppkey").alias(f"{p}k"), c("s_acctbal").alias(f"{p}x0"), c("s_nationkey").cast("double").alias(f"{p}y0"), (c("s_acctbal") + 400).alias(f"{p}x1"), (c("s_nationkey") + 3.0).alias(f"{p}y1"))


@query("op_J18_overlapping_boxes", f"SELECT a.k, b.k AS b_k FROM ({_BOX}) a JOIN ({_BOX}) b ON a.x0 <= b.x1 AND a.x1 >= b.x0 AND a.y0 <= b.y1 AND a.y1 >= b.y0")
def _(spark, sf):
    return joins.overlapping_boxes(_boxes(spark, sf), _boxes(spark, sf, "b_"), ["x0", "y0", "x1", "y1"], 500.0, ["b_x0", "b_y0", "b_x1", "b_y1"]).select("k", "b_k")


@query("op_J12_points_in_polygons", "SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_acctbal > s_acctbal AND c_nationkey + 0.5 > s_nationkey AND (c_acctbal - s_acctbal) / 400 + (c_nationkey + 0.5 - s_nationkey) / 4 < 1")
def _(spark, sf):
    s = table(spark, sf, "supplier")
    pt = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = c("s_acctbal"), c("s_nationkey")
    polys = s.select("s_suppkey", x.alias("x0"), y.cast("double").alias("y0"), (x + 400).alias("x1"), (y + 4.0).alias("y1"), F.array(pt(F.lit(0), F.lit(0)), pt(F.lit(400), F.lit(0)), pt(F.lit(0), F.lit(4))).alias("ring"))  # about the corner x0, y0
    pts = table(spark, sf, "customer").select("c_custkey", c("c_acctbal").alias("x"), (c("c_nationkey") + 0.5).alias("y"))
    both = joins.points_in_boxes(pts, polys, "x", "y", ["x0", "y0", "x1", "y1"], 500.0)
    return both.filter(joins.point_in_polygon(c("x") - c("x0"), c("y") - c("y0"), c("ring"), strict=True)).select("c_custkey", "s_suppkey")


@query("op_J13_largest_overlap", "WITH n AS (SELECT p_brand, p_size, count(*) AS shared FROM part GROUP BY p_brand, p_size) SELECT p_brand, CAST(-max({'s': shared, 'p': -p_size}).p AS INTEGER) AS p_size, max(shared) AS shared FROM n GROUP BY p_brand")
def _(spark, sf):
    return joins.largest_overlap(table(spark, sf, "part"), "p_brand", "p_size")


@query("op_J14_raster_algebra", "SELECT l_suppkey AS px, CAST(sum(CASE WHEN l_quantity > o_totalprice / 10000 THEN 1 ELSE 0 END) AS BIGINT) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_suppkey")
def _(spark, sf):
    both = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity").join(table(spark, sf, "orders").select(c("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")
    return both.groupBy(c("l_suppkey").alias("px")).agg(F.sum((c("l_quantity") > c("o_totalprice") / 10000).cast("int")).alias("n"))


@query("op_J15_year_difference", f"WITH {CLASSES} SELECT a.px, a.year, b.class - a.class AS change FROM cls a JOIN cls b ON a.px = b.px AND b.year = a.year + 1")
def _(spark, sf):
    a = classes(spark, sf)
    b = a.select("px", (c("year") - 1).alias("year"), c("class").alias("next"))
    return a.join(b, ["px", "year"]).select("px", "year", (c("next") - c("class")).alias("change"))


@query("op_S10_prefix_join", "SELECT name, part_key FROM (SELECT p_name || '_' || p_partkey AS name FROM part) f JOIN (SELECT DISTINCT p_name AS part_key FROM part) r ON starts_with(name, part_key)")
def _(spark, sf):
    p = table(spark, sf, "part")
    files, records = p.select(F.concat_ws("_", "p_name", "p_partkey").alias("name")), p.select(c("p_name").alias("part_key")).distinct()
    return joins.by_prefix(files, records, "name", "part_key", 3)[0].select("name", "part_key")


@query("op_S11_rebuilt_catalog", "SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'new' WHEN b.k IS NULL THEN 'missing' ELSE 'kept' END AS state FROM (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 0) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) b ON a.k = b.k")
def _(spark, sf):
    return catalog.rebuilt(table(spark, sf, "customer").filter("c_acctbal > 0").select(c("c_custkey").alias("k")), table(spark, sf, "orders").select(c("o_custkey").alias("k")), "k")


@query("op_S12_box_query", "SELECT c_custkey FROM customer WHERE c_acctbal <= 4000 AND c_acctbal + 50 >= 1000 AND c_nationkey <= 12 AND c_nationkey + 1 >= 3")
def _(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", c("c_acctbal").alias("w"), c("c_nationkey").alias("s"), (c("c_acctbal") + 50).alias("e"), (c("c_nationkey") + 1).alias("n"))
    return catalog.in_box(rows, (1000, 3, 4000, 12), ["w", "s", "e", "n"]).select("c_custkey")


@query("op_S9_union_catalogs", "SELECT c_custkey AS id, 'c' AS kind, c_acctbal AS bal, NULL::VARCHAR AS name FROM customer UNION ALL SELECT s_suppkey, 's', s_acctbal, s_name FROM supplier")
def _(spark, sf):
    a = table(spark, sf, "customer").select(c("c_custkey").alias("id"), F.lit("c").alias("kind"), c("c_acctbal").alias("bal"))
    b = table(spark, sf, "supplier").select(c("s_suppkey").alias("id"), F.lit("s").alias("kind"), c("s_acctbal").alias("bal"), c("s_name").alias("name"))
    return a.unionByName(b, allowMissingColumns=True)


@query("op_U2_difference", "SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def _(spark, sf):
    return table(spark, sf, "orders").select(c("o_custkey").alias("k")).distinct().join(table(spark, sf, "customer").filter("c_acctbal > 0").select(c("c_custkey").alias("k")), "k", "left_anti")


@query("op_U4_intersect", "SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def _(spark, sf):
    return table(spark, sf, "supplier").select(c("s_nationkey").alias("k")).intersect(table(spark, sf, "customer").select(c("c_nationkey").alias("k")))


@query("op_U5_distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").dropDuplicates()


@query("op_T2_purest", "SELECT o_custkey, o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) = 1")
def _(spark, sf):
    return sampling.purest(table(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], "o_totalprice", "o_orderkey").select("o_custkey", "o_orderpriority", "o_orderkey")


@query("op_T3_top_features", "SELECT p_type AS feature, round(sum(p_retailprice), 4) AS importance FROM part GROUP BY p_type ORDER BY importance DESC, feature LIMIT 3")
def _(spark, sf):
    imp = table(spark, sf, "part").groupBy(c("p_type").alias("feature")).agg(F.round(F.sum("p_retailprice"), 4).alias("importance"))
    return models.top_features(imp, 3).select("feature", "importance")


# Scores.


def _preds(spark, sf):
    return table(spark, sf, "labels").select("doc_id", c("toxic").alias("pred"), c("quality").alias("label"))


_PR = "p AS (SELECT doc_id, toxic AS pred, quality AS label FROM labels)"


@query("op_G12_confusion", f"WITH {_PR} SELECT k AS pred, count(*) FILTER (WHERE pred = k AND label = 0) AS o_0, count(*) FILTER (WHERE pred = k AND label = 1) AS o_1, count(*) FILTER (WHERE pred = k) AS total FROM p, (VALUES (0), (1)) v(k) GROUP BY k")
def _(spark, sf):
    return scores.confusion(_preds(spark, sf), [0, 1])


@query("op_G12_margins", f"WITH {_PR} SELECT pred, label AS obs, count(*) AS n FROM p GROUP BY CUBE (pred, label)")
def _(spark, sf):
    return scores.pair_counts(_preds(spark, sf))


_CS = f"""{_PR}, k AS (SELECT k AS class, count(*) FILTER (WHERE pred = k) AS n_pred, count(*) FILTER (WHERE label = k) AS n_obs, count(*) FILTER (WHERE pred = k AND label = k) AS hits FROM p, (VALUES (0), (1)) v(k) GROUP BY k),
 a AS (SELECT *, round(CASE WHEN n_pred > 0 THEN hits / CAST(n_pred AS DOUBLE) ELSE 0 END, 3) AS UA, round(CASE WHEN n_obs > 0 THEN hits / CAST(n_obs AS DOUBLE) ELSE 0 END, 3) AS PA FROM k)"""
_FS = lambda b: f"round(CASE WHEN {b * b} * UA + PA > 0 THEN (1 + {b * b}) * UA * PA / ({b * b} * UA + PA) ELSE 0 END, 3)"


@query("op_G14_class_scores", f"WITH {_CS} SELECT class, n_pred, n_obs, hits, UA, PA, {_FS(1.0)} AS F1, {_FS(0.5)} AS F05, {_FS(0.25)} AS F025 FROM a")
def _(spark, sf):
    return scores.class_scores(_preds(spark, sf))


@query("op_G13_overall_scores", f"""WITH {_CS}, f AS (SELECT *, {_FS(1.0)} AS F1 FROM a), o AS (SELECT CAST(sum(hits) AS DOUBLE) AS h, CAST(sum(n_obs) AS DOUBLE) AS n, CAST(sum(n_obs * n_pred) AS DOUBLE) AS x, avg(PA) AS BA, avg(UA) AS UA_macro, avg(F1) AS F1_macro, sum(F1 * n_obs) / sum(n_obs) AS F1_wt, min(F1) AS F1_min, min(PA) AS PA_min FROM f)
 SELECT round(h / n, 3) AS OA, round((h / n - x / (n * n)) / (1 - x / (n * n)), 3) AS Kappa, round(BA, 3) AS BA, round(UA_macro, 3) AS UA_macro, round(F1_macro, 3) AS F1_macro, round(F1_wt, 3) AS F1_wt, round(F1_min, 3) AS F1_min, round(PA_min, 3) AS PA_min FROM o""")
def _(spark, sf):
    return scores.overall_scores(_preds(spark, sf))


@query("op_G14_binary_scores", f"""WITH {_PR}, b AS (SELECT count(*) FILTER (WHERE pred = 1 AND label = 1) AS TP, count(*) FILTER (WHERE pred = 1 AND label <> 1) AS FP, count(*) FILTER (WHERE pred <> 1 AND label = 1) AS FN, count(*) FILTER (WHERE pred <> 1 AND label <> 1) AS TN FROM p),
 u AS (SELECT *, round(TP / CAST(TP + FP AS DOUBLE), 3) AS ua, round(TP / CAST(TP + FN AS DOUBLE), 3) AS pa FROM b) SELECT TP, FP, FN, TN, round((TP + TN) / CAST(TP + FP + FN + TN AS DOUBLE), 3) AS OA, round(2 * ua * pa / (ua + pa), 3) AS F1, round(2 * CAST(TP * TN - FN * FP AS DOUBLE) / ((TP + FP) * (FP + TN) + (TP + FN) * (FN + TN)), 3) AS kappa FROM u""")
def _(spark, sf):
    return scores.binary_scores(_preds(spark, sf), 1)


@query("op_G15_recall", "SELECT o_orderstatus, round(avg(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1e0 ELSE 0e0 END), 3) AS recall, count(*) AS n FROM orders GROUP BY o_orderstatus")
def _(spark, sf):
    return scores.recall(table(spark, sf, "orders"), ["o_orderstatus"], ["1-URGENT", "2-HIGH"], "o_orderpriority")


@query("op_G16_small_fields", "SELECT c_mktsegment, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'other' WHEN c_acctbal < 1000 THEN 'small' WHEN c_acctbal < 5000 THEN 'medium' ELSE 'big' END AS size, round(avg(CASE WHEN c_nationkey IN (1, 2, 3, 4, 5) THEN 1e0 ELSE 0e0 END), 3) AS recall, count(*) AS n FROM customer GROUP BY 1, 2")
def _(spark, sf):
    rows = table(spark, sf, "customer").withColumn("size", scores.small_field_flags(c("c_acctbal"), F.when(c("c_mktsegment") == "HOUSEHOLD", "x").otherwise("field"), 1000, 5000))
    return scores.recall(rows, ["c_mktsegment", "size"], [1, 2, 3, 4, 5], "c_nationkey")


@query("op_G10_run_scores", "SELECT o_orderstatus, o_orderpriority, round(avg(o_totalprice), 4) AS o_totalprice_mean, round(stddev_samp(o_totalprice), 4) AS o_totalprice_std FROM orders GROUP BY 1, 2")
def _(spark, sf):
    out = scores.run_scores(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], ["o_totalprice"])
    return out.select("o_orderstatus", "o_orderpriority", *(F.round(x, 4).alias(x) for x in out.columns[2:]))


@query("op_G11_best_models", "SELECT o_orderstatus, o_orderpriority, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) = 1")
def _(spark, sf):
    return scores.best_models(table(spark, sf, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey", "o_totalprice"), ["o_orderstatus", "o_orderpriority"], "o_totalprice", "o_orderkey")


_LEVELS = ", ".join(f"CAST(trunc(round(quantile_cont(d, {x / 100}), 9)) AS INTEGER) AS delta_{x}" for x in (5, 10, 20, 80, 90, 95))


@query("op_G20_pre_post_summary", f"""WITH r AS (SELECT l_returnflag AS si, CASE WHEN month(l_shipdate) BETWEEN 5 AND 10 THEN 'dry' ELSE 'wet' END AS season, CAST(l_quantity AS DOUBLE) AS p, CAST(l_extendedprice / 2000 AS DOUBLE) AS q FROM lineitem),
 s AS (SELECT *, p - q AS d, (p + q) / 2 AS m FROM r), g AS (SELECT si, coalesce(season, 'ALL') AS season, count(*) AS n, CAST(trunc(round(avg(d), 9)) AS INTEGER) AS delta_avg, CAST(trunc(round(stddev_samp(d), 9)) AS INTEGER) AS delta_std, {_LEVELS},
  CAST(trunc(round(avg(p), 9)) AS INTEGER) AS pre_avg, CAST(trunc(round(stddev_samp(p), 9)) AS INTEGER) AS pre_std, CAST(trunc(round(avg(q), 9)) AS INTEGER) AS post_avg, CAST(trunc(round(stddev_samp(q), 9)) AS INTEGER) AS post_std,
  round(abs(avg(p) - avg(q)) / (stddev_pop(p) + stddev_pop(q)), 2) AS sep_M, CAST(trunc(round(sum(CASE WHEN p > 0 AND q > 0 THEN q * (p / q) * ln(p / q) ELSE 0 END), 9)) AS INTEGER) AS sep_F1, round(-ln(sum(sqrt(p * q))), 3) AS sep_bhatt,
  CAST(trunc(round(0.5e0 * sum(CASE WHEN p > 0 THEN p * ln(p / m) ELSE 0 END) + 0.5e0 * sum(CASE WHEN q > 0 THEN q * ln(q / m) ELSE 0 END), 9)) AS INTEGER) AS sep_jen FROM s GROUP BY GROUPING SETS ((si), (si, season)))
 SELECT *, CAST(trunc(2 * (1 - exp(-sep_bhatt))) AS INTEGER) AS sep_jm FROM g""")
def _(spark, sf):
    r = table(spark, sf, "lineitem").select(c("l_returnflag").alias("si"), F.when(F.month("l_shipdate").between(5, 10), "dry").otherwise("wet").alias("season"), c("l_quantity").alias("pre"), (c("l_extendedprice") / 2000).alias("post"))
    return scores.pre_post_summary(r, ["si"], "season")


@query("op_separability", """WITH h AS (SELECT l_returnflag, CAST(l_quantity AS INTEGER) AS bin, CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) AS p, CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) AS q FROM lineitem GROUP BY 1, 2),
 n AS (SELECT l_returnflag, p / sum(p) OVER w AS p, q / sum(q) OVER w AS q FROM h WINDOW w AS (PARTITION BY l_returnflag)), s AS (SELECT l_returnflag, sum(sqrt(p * q)) AS bc, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2 AS js FROM n GROUP BY 1)
 SELECT l_returnflag, round(-ln(CASE WHEN bc > 0 THEN bc END), 3) AS bhattacharyya, round(js, 6) AS js FROM s""")
def _(spark, sf):
    h = table(spark, sf, "lineitem").groupBy("l_returnflag", c("l_quantity").cast("int").alias("bin")).agg(F.count_if(c("l_linestatus") == "O").alias("p"), F.count_if(c("l_linestatus") == "F").alias("q"))
    # A histogram without counts has no shares; its distances are null on both sides.
    h = h.withColumn("gl_t", F.sum("p").over(Window.partitionBy("l_returnflag"))).withColumn("gl_u", F.sum("q").over(Window.partitionBy("l_returnflag")))
    h = h.withColumn("p", F.when(c("gl_t") > 0, c("p"))).withColumn("q", F.when(c("gl_u") > 0, c("q"))).drop("gl_t", "gl_u")
    return scores.divergences(h, ["l_returnflag"]).select("l_returnflag", "bhattacharyya", "js")


@query("op_G9_class_counts", "SELECT o_orderstatus, count(*) AS n, count(*) FILTER (WHERE k = 1) AS n1, count(*) FILTER (WHERE k = 2) AS n2, count(*) FILTER (WHERE k = 3) AS n3, count(*) FILTER (WHERE k = 4) AS n4 FROM (SELECT o_orderstatus, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS k FROM orders) GROUP BY 1")
def _(spark, sf):
    return zonal.class_counts(table(spark, sf, "orders").withColumn("k", F.substring("o_orderpriority", 1, 1).cast("int")), "o_orderstatus", "k")


@query("op_G21_window_state", f"""WITH {TS}, n AS (SELECT px AS cell_id, 'ndvi' AS si, count(DISTINCT date) AS n, min(date) AS first, max(date) AS last, min(value) AS low FROM ts GROUP BY px)
 SELECT cell_id, si, n, first, last, CASE WHEN n = 0 THEN 'no ts' WHEN n < 530 THEN 'missing images' WHEN low = 0 THEN 'missing windows' ELSE 'clean' END AS state FROM n""")
def _(spark, sf):
    rows = ts(spark, sf).select(c("px").alias("cell_id"), F.lit("ndvi").alias("si"), "date", c("value").alias("block_mean"))
    return catalog.window_state(rows, 530)


@query("op_G22_status", """WITH p AS (SELECT CAST(o_custkey AS VARCHAR) AS grid, bool_or(o_orderstatus = 'F') FILTER (WHERE o_orderpriority = '1-URGENT') AS d, bool_or(o_orderstatus = 'F') FILTER (WHERE o_orderpriority = '2-HIGH') AS q FROM orders GROUP BY 1),
 s AS (SELECT CAST(c_custkey AS VARCHAR) AS grid, c_mktsegment AS sis FROM customer WHERE c_acctbal > 9000) SELECT p.grid, CASE WHEN sis IS NOT NULL THEN 'p_sis_' || sis WHEN q THEN 'p_preprocess' WHEN d THEN 'p' ELSE 'n' END AS status FROM p LEFT JOIN s ON p.grid = s.grid""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    step = F.when(c("o_orderpriority") == "1-URGENT", "download").when(c("o_orderpriority") == "2-HIGH", "preprocess").otherwise("other")
    progress = o.select(c("o_custkey").cast("string").alias("grid"), step.alias("step"), F.when(c("o_orderstatus") == "F", "y").otherwise("n").alias("status"))
    clean = table(spark, sf, "customer").select(c("c_custkey").alias("cell_id"), c("c_mktsegment").alias("si"), F.when(c("c_acctbal") > 9000, "clean").otherwise("x").alias("state"))
    return catalog.status(progress, clean)


# Samples and models.


@query("op_M1_priority", "SELECT c_custkey, CAST(CASE WHEN c_nationkey % 4 = 1 OR c_nationkey % 7 = 1 THEN 4 WHEN (c_nationkey < 5 AND c_acctbal > 0) OR c_mktsegment <> 'HOUSEHOLD' THEN 1 WHEN c_acctbal > 0 AND c_nationkey > 1 THEN 2 ELSE 3 END AS INTEGER) AS priority FROM customer")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", sampling.priority(c("c_nationkey") < 5, c("c_mktsegment"), c("c_acctbal") > 0, c("c_nationkey"), [c("c_nationkey") % 4, c("c_nationkey") % 7], "HOUSEHOLD").alias("priority"))


@query("op_M2_balance", """WITH s AS (SELECT o_orderkey, o_orderstatus, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) % 4 + 1 AS priority, (o_orderkey * 7919 % 1000) / 1e3 AS rand FROM orders),
 n AS (SELECT o_orderstatus, count(*) AS n, count(*) FILTER (WHERE priority = 1) AS n1, count(*) FILTER (WHERE priority = 2) AS n2 FROM s GROUP BY 1), sh(o_orderstatus, share) AS (VALUES ('F', 0.5e0), ('O', 0.3e0), ('P', 0.2e0)),
 r AS (SELECT *, share / 0.5e0 * (SELECT n FROM n WHERE o_orderstatus = 'F') AS want FROM n JOIN sh USING (o_orderstatus)), k AS (SELECT *, round(CASE WHEN n < 200 THEN 1e0 WHEN want < n THEN greatest(200e0, want) / n ELSE 1e0 END, 3) * n AS k FROM r),
 d AS (SELECT o_orderstatus, CASE WHEN n1 = 0 THEN 0e0 WHEN n1 <= k THEN 1e0 ELSE k / n1 END AS d1, CASE WHEN n2 = 0 THEN 0e0 WHEN n1 + n2 < k THEN 1e0 ELSE greatest(0e0, (k - n1) / n2) END AS d2, CASE WHEN n1 + n2 > k THEN 0e0 ELSE (k - n1 - n2) / (n - n1 - n2) END AS d3 FROM k)
 SELECT o_orderkey, o_orderstatus, priority FROM s JOIN d USING (o_orderstatus) WHERE rand < CASE priority WHEN 1 THEN d1 WHEN 2 THEN d2 WHEN 3 THEN d3 ELSE 0 END""")
def _(spark, sf):
    s = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", (F.substring("o_orderpriority", 1, 1).cast("int") % 4 + 1).alias("priority"), (c("o_orderkey") * 7919 % 1000 / 1000.0).alias("rand"))
    shares = spark.createDataFrame([("F", 0.5), ("O", 0.3), ("P", 0.2)], "o_orderstatus string, share double")
    return sampling.balance(s, "o_orderstatus", shares).select("o_orderkey", "o_orderstatus", "priority")


@query("op_M3_stable_holdout", "SELECT c_custkey, (c_custkey * 7919 % 1000) / 1e3 < 0.2 AS held FROM customer")
def _(spark, sf):
    s = table(spark, sf, "customer").select("c_custkey", (c("c_custkey") * 7919 % 1000 / 1000.0).alias("rand2"))
    a, b = sampling.holdout(s, 20)
    return a.select("c_custkey", F.lit(True).alias("held")).unionByName(b.select("c_custkey", F.lit(False).alias("held")))


@query("op_W21_per_class", "SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY (o_orderkey * 7919 % 10007), o_orderkey) <= 50")
def _(spark, sf):
    s = table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", (c("o_orderkey") * 7919 % 10007).alias("rand"))
    return sampling.per_class(s, "o_orderpriority", 50, tie="o_orderkey").select("o_orderpriority", "o_orderkey")


def _features(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.avg("l_quantity").alias("var_q"), F.max("l_extendedprice").alias("var_p"), F.avg("l_discount").alias("var_d"), F.count(F.lit(1)).cast("double").alias("var_n"))
    o = table(spark, sf, "orders").select(c("o_orderkey").alias("l_orderkey"), F.when(c("o_totalprice") > 250000, "high").otherwise("low").alias("label"))
    return rows.join(o, "l_orderkey")


@query("op_M6_random_forest")
def _(spark, sf):
    """Out-of-sample scores of a forest on features of orders."""
    train, test = _split(spark, sf)
    return scores.overall_scores(models.predict(models.fit(train, "label", "RF", trees=20, depth=5), test))


@query("op_M6_boosted_trees")
def _(spark, sf):
    train, test = _split(spark, sf)
    return scores.overall_scores(models.predict(models.fit(train, "label", "GB", trees=5, depth=3), test))


@query("op_M7_importances")
def _(spark, sf):
    train, _ = _split(spark, sf)
    return models.importances(models.fit(train, "label", "RF", trees=20, depth=5), spark)


@query("op_M8_grid")
def _(spark, sf):
    train, test = _split(spark, sf)
    return models.grid_scores(train, test, "label", models.grid(algorithm=["RF"], trees=[5, 10], depth=[3]))


@query("op_M9_classified")
def _(spark, sf):
    train, _ = _split(spark, sf)
    return models.predict(models.fit(train, "label", "RF", trees=20, depth=5), _features(spark, sf).drop("label")).select("l_orderkey", "pred")


def _split(spark, sf):
    rows = kept(_features(spark, sf))  # fits and scores read it many times
    r = sampling.stable_random(c("l_orderkey"), 88)
    return rows.filter(r >= 0.2), rows.filter(r < 0.2)


# Classes through time.


@query("op_W10_majority", f"WITH {CLASSES}, n AS (SELECT px, class, count(*) AS n FROM cls WHERE class IN (75, 74, 80) GROUP BY px, class) SELECT px, CAST(coalesce((SELECT max({{'n': n, 'p': CASE class WHEN 75 THEN 0 WHEN 74 THEN -1 ELSE -2 END, 'c': class}}).c FROM n WHERE n.px = a.px), 0) AS INTEGER) AS majority FROM (SELECT DISTINCT px FROM cls) a")
def _(spark, sf):
    return rules.majority_in(classes(spark, sf), PX, [75, 74, 80])


@query("op_W11_class_counts", f"WITH {CLASSES} SELECT px, year, class, CAST(sum(CASE WHEN class = 221 THEN 1 ELSE 0 END) OVER (PARTITION BY px) AS BIGINT) AS n_palm_for, CAST(sum(CASE WHEN class = 114 THEN 1 ELSE 0 END) OVER (PARTITION BY px) AS BIGINT) AS n_rice FROM cls")
def _(spark, sf):
    return rules.with_counts(classes(spark, sf), PX, ("palm_for", "rice"))


_IN = lambda name: "(" + ", ".join(map(str, sorted(set(rules.CLASSES[name])))) + ")"
_N = lambda name: f"n_{name}"  # noqa: E731  years of a set, counted where a rule first needs them
_AT = lambda f, name, k=1: f"coalesce({f}(class, {k}) OVER w, 0) IN {_IN(name)}"
_BOTH = lambda name: f"({_AT('lag', name)} AND {_AT('lead', name)})"
_EITHER = lambda name: f"({_AT('lag', name)} OR {_AT('lead', name)})"
_GREW = f"(coalesce(lag(class, 1) OVER w, 255) < {rules.FIRST_HIGHVEG} AND coalesce(lag(class, 2) OVER w, 255) < {rules.FIRST_MEDVEG})"
_MATURE = f"(coalesce(lag(class, 1) OVER w, 0) > {rules.FIRST_MATURE} AND coalesce(lag(class, 2) OVER w, 0) > {rules.FIRST_MATURE})"
_ONE = lambda name: str(rules.CLASSES[name][0])
_LAST = lambda k: f"max(CASE WHEN back = {k + 1} THEN class END) OVER (PARTITION BY px)"
_RULE_SQL = {
    "sugar-palm": [(f"class = 143 AND {_BOTH('palm_for')} AND {_N('palm_for')} >= 2", "221")],
    "sugar-grass": [(f"class = 143 AND {_BOTH('Grass_all')} AND {_N('Grass_all')} >= 4", "bg")],
    "banana-wet": [(f"class = 148 AND {_N('LowVeg_wet')} + {_N('MedVeg_wet')} + {_N('palm_for')} >= 5", "164")],
    "palm_for-grass-aggressive": [(f"{_LAST(0)} = 221 OR {_LAST(1)} = 221", "CASE WHEN bf = 221 THEN 221 ELSE 176 END")],
    "palm_for-wetgrass": [(f"class = 221 AND {_N('LowVeg_wet')} + {_N('MedVeg_wet')} > 5", "164")],
    "grass-forest-aggressive": [(f"{_LAST(0)} IN {_IN('Trees_nat')} AND {_LAST(1)} = {_LAST(0)}", _LAST(0))],
    "tree_plant-med_crop": [(f"class IN {_IN('med_crops')} AND {_N('Trees_plantation')} >= 3", "207")],
    "rice-water": [(f"class = 114 AND {_N('NoVeg_water')} >= 4", "40"), (f"class = 40 AND {_BOTH('rice')}", "114")],
    "rice-built": [(f"class = 30 AND {_N('rice')} >= 2 AND {_N('rice')} + {_N('NoVeg_water')} >= 4", "114")],
    "wetgrass-crop": [(f"class IN {_IN('LowVeg_crop')} AND {_BOTH('LowVeg_wet')}", "74")],
    "grass-crop": [(f"class IN {_IN('LowVeg_crop')} AND {_N('Grass_all')} >= 4 AND {_EITHER('Grass_all')}", "75")],
    "wetgrass-built": [(f"class = 30 AND {_BOTH('LowVeg_wet')}", "74")],
    "medcrop-wetshrub": [(f"class IN {_IN('med_crops')} AND ({_AT('lag', 'MedVeg_wet')} OR {_AT('lag', 'LowVeg_wet')}) AND ({_AT('lead', 'MedVeg_wet')} OR {_AT('lead', 'LowVeg_wet')})", "164")],
    "medcrop-shrub": [(f"class IN {_IN('med_crops')} AND ({_AT('lag', 'dry_grass')} OR coalesce(lag(class) OVER w, 0) = 161) AND ({_AT('lead', 'dry_grass')} OR coalesce(lead(class) OVER w, 0) = 161)", "161")],
    "singleton-crop": [(f"class IN {_IN('LowVeg_crop')} AND {_N('LowVeg_crop')} = 1", "80")],
    "grass-built": [(f"class = 30 AND {_N('Grass_all')} >= 4 AND {_EITHER('Grass_all')}", "20")],
    "built-non-built": [(f"class <> 30 AND {_BOTH('NoVeg_built')}", "30")],
    "forest-treeplant": [(f"class IN {_IN('Trees_nat')} AND {_N('Trees_plantation')} > {_N('Trees_nat')} AND {_MATURE}", "207"), (f"class IN {_IN('Trees_plantation')} AND {_N('Trees_plantation')} < {_N('Trees_nat')} AND {_MATURE}", "bf")],
    "forest-brieflow": [(f"class < 148 AND {_BOTH('forest_open_stable')}", "lag(class) OVER w"), ("class < 148 AND coalesce(lag(class) OVER w, 0) IN (215, 250) AND coalesce(lead(class) OVER w, 0) IN (215, 250)", "215")],
    "grass-to-forest": [(f"class IN {_IN('Trees_nat')} AND {_GREW}", "161")], "grass-to-palmforest": [(f"class = 221 AND {_GREW}", "176")], "twmix-medwet": [(f"class = 184 AND {_GREW}", "164")],
    "noplant-plant": [(f"class >= 148 AND class < 200 AND {_AT('lead', 'Trees_plantation')}", "187"), (f"class >= 50 AND class < 148 AND {_AT('lead', 'Trees_plantation')}", "98")],
}


def _rule_sql(names: list[str], start: str = f"{CLASSES}, b0 AS (SELECT px, year, class, 221 AS bf, 75 AS bg FROM cls)", counted: tuple[str, ...] = ()) -> str:
    """``start`` ends with b0 (px, year, class, bf, bg and n_<set> of those that are counted before)."""
    parts, n, known = [f"WITH {start}, q0 AS (SELECT *, row_number() OVER (PARTITION BY px ORDER BY year DESC) AS back FROM b0)"], 0, set(counted)
    for name in names:
        new = sorted({x for cond, _ in _RULE_SQL[name] for x in re.findall(r"\bn_(\w+)", cond)} - known)
        if new:
            counts = ", ".join(f"sum(CASE WHEN class IN {_IN(x)} THEN 1 ELSE 0 END) OVER (PARTITION BY px) AS n_{x}" for x in new)
            parts.append(f"q{n + 1} AS (SELECT *, {counts} FROM q{n})")
            n, known = n + 1, known | set(new)
        for cond, then in _RULE_SQL[name]:
            parts.append(f"q{n + 1} AS (SELECT * REPLACE (CASE WHEN coalesce({cond}, false) THEN {then} ELSE class END AS class) FROM q{n} WINDOW w AS (PARTITION BY px ORDER BY year))")
            n += 1
    return ", ".join(parts) + f" SELECT px, year, CAST(class AS INTEGER) AS class FROM q{n}"


def _based(spark, sf):
    return classes(spark, sf).withColumn("base_forest", F.lit(221)).withColumn("base_grass", F.lit(75))


for _rule in rules.RULES:

    @query(f"op_W12_rule_{_rule.replace('-', '_')}", _rule_sql([_rule]))
    def _apply(spark, sf, rule=_rule):
        return rules.apply_rules(_based(spark, sf), PX, [rule]).select("px", "year", "class")


#: The rules in the order in which they run over a series.
_CHAIN = [
    "sugar-palm", "sugar-grass", "banana-wet", "palm_for-grass-aggressive", "palm_for-wetgrass", "grass-forest-aggressive", "tree_plant-med_crop", "rice-water", "rice-built",
    "forest-treeplant", "forest-brieflow", "grass-to-forest", "grass-to-palmforest", "twmix-medwet", "noplant-plant", "wetgrass-built", "wetgrass-crop", "grass-built", "grass-crop",
    "built-non-built", "medcrop-wetshrub", "medcrop-shrub", "singleton-crop",
]


@query("op_W14_rule_chain", _rule_sql(_CHAIN))
def _(spark, sf):
    return rules.apply_rules(_based(spark, sf), PX, _CHAIN).select("px", "year", "class")


def _top(name: str) -> str:
    """SQL of the commonest class of a set, the first in its order of equal ones, over rows of (class, n)."""
    order = " ".join(f"WHEN {k} THEN {-i}" for i, k in enumerate(rules.CLASSES[name]))
    return f"CAST(coalesce(max(CASE WHEN class IN {_IN(name)} THEN {{'n': n, 'p': CASE class {order} END, 'c': class}} END).c, 0) AS INTEGER)"


_YEARS = lambda *names: f"sum(CASE WHEN class IN ({', '.join(_IN(x)[1:-1] for x in names)}) THEN n ELSE 0 END)"
_BASE = f"""{CLASSES}, n AS (SELECT px, class, count(*) AS n FROM cls GROUP BY px, class), m AS (SELECT px,
  CASE WHEN {_YEARS('shrub_for')} > 0 OR ({_YEARS('dense_for')} > 0 AND {_YEARS('MedVeg_noncrop')} > 0) THEN 226 ELSE 0 END AS base_shrub_for,
  CASE WHEN {_YEARS('palm_for')} > {_YEARS('gtmix')} AND {_YEARS('palm_for')} > {_YEARS('med_crops')} THEN 221 ELSE 0 END AS base_palm_for,
  CASE WHEN {_YEARS('open_for', 'MedVeg_noncrop')} >= 2 AND {_YEARS('dense_for')} = sum(n) - {_YEARS('open_for', 'MedVeg_noncrop')} THEN 215 ELSE 0 END AS base_open_for,
  {_top('dense_for')} AS base_dense_for, {_top('wet')} AS base_wet, {_top('grass_Py36')} AS base_grass_Py36, CAST({_YEARS('palm_for')} AS BIGINT) AS n_palm_for FROM n GROUP BY px),
 base AS (SELECT *, CAST(CASE WHEN base_shrub_for > 0 THEN base_shrub_for WHEN base_palm_for > 0 THEN base_palm_for WHEN base_open_for > 0 THEN base_open_for ELSE base_dense_for END AS INTEGER) AS base_forest FROM m)"""
_HELD = f"""{_BASE}, h1 AS (SELECT * REPLACE (CASE WHEN class IN {_IN('forest_Py36')} AND base_forest >= 200 THEN base_forest ELSE class END AS class) FROM cls JOIN base USING (px)),
 h2 AS (SELECT * REPLACE (CASE WHEN class IN {_IN('grass_Py36')} AND base_grass_Py36 <> 0 THEN base_grass_Py36 ELSE class END AS class) FROM h1),
 h3 AS (SELECT * REPLACE (CASE WHEN class IN (40, 74, 164, 184) AND base_wet <> 0 AND coalesce(lag(class) OVER w, 0) <> class AND coalesce(lead(class) OVER w, 0) <> class THEN base_wet ELSE class END AS class) FROM h2 WINDOW w AS (PARTITION BY px ORDER BY year))"""


@query("op_W13_stable_base", f"WITH {_BASE} SELECT * FROM base")
def _(spark, sf):
    return rules.stable_base(classes(spark, sf), PX)


@query("op_W13_stable_base_region", f"""WITH {_BASE}, shrub AS (SELECT px, CASE WHEN {_YEARS('shrub_for')} > 0 OR ({_YEARS('dense_for')} > 0 AND {_YEARS('MedVeg_noncrop')} > 0 AND px % 3 = 1) THEN 226 ELSE 0 END AS base_shrub_for FROM n GROUP BY px)
 SELECT px, base_shrub_for, CAST(CASE WHEN base_shrub_for > 0 THEN base_shrub_for WHEN base_dense_for > 0 THEN base_dense_for ELSE 0 END AS INTEGER) AS base_forest FROM shrub JOIN (SELECT px, base_dense_for FROM base) USING (px)""")
def _(spark, sf):
    rows = classes(spark, sf)
    return rules.stable_base(rows, PX, ("shrub_for", "dense_for"), rules.in_region(c("px") % 3, [1])).select("px", "base_shrub_for", "base_forest")


@query("op_W14_held_to_base", f"WITH {_HELD} SELECT px, year, CAST(class AS INTEGER) AS class FROM h3")
def _(spark, sf):
    rows = classes(spark, sf)
    return rules.hold_to_base(rows.join(rules.stable_base(rows, PX), PX), PX).select("px", "year", "class")


def _held(spark, sf):
    rows = classes(spark, sf)
    return rules.hold_to_base(rows.join(rules.stable_base(rows, PX), PX), PX).withColumn("base_grass", c("base_grass_Py36"))


@query("op_W14_filtered_series", _rule_sql(_CHAIN, f"{_HELD}, b0 AS (SELECT px, year, class, n_palm_for, base_forest AS bf, base_grass_Py36 AS bg FROM h3)", ("palm_for",)))
def _(spark, sf):
    return rules.apply_rules(_held(spark, sf), PX, _CHAIN).select("px", "year", "class")


@query("op_W15_kept_in_polygons", f"WITH {CLASSES} SELECT px, year, CAST(CASE WHEN c_acctbal > 0 THEN class ELSE 0 END AS INTEGER) AS class FROM cls JOIN customer ON px = c_custkey")
def _(spark, sf):
    rows = classes(spark, sf).join(table(spark, sf, "customer").select(c("c_custkey").alias("px"), "c_acctbal"), "px")
    return rows.select("px", "year", rules.keep_inside(F.lit(0), c("class"), c("c_acctbal")).alias("class"))


# Fusion.


def _scored(spark, sf):
    o = obs(spark, sf)
    month = F.dayofyear("date")
    s = fusion.total_score(
        fusion.cloud_score(c("swir1") * 100, 100.0), fusion.day_score(F.abs(month - 180), 60.0), fusion.year_score(F.abs(F.year("date") - 1998)),
        fusion.spectral_score(F.lit(0.5), c("nir")), fusion.haze_score(c("blue"), c("red")), fusion.sun_score(c("swir2") * 90),
    )
    return o.withColumn("score", F.round(s, 9))


_BAP = f"""WITH {OBS}, s AS (SELECT px, scene, nir, round((greatest(1 / (1 + exp(-10 * (swir1 * 100 / 100e0 - 0.5e0))), 0.1e0) + greatest(exp(-0.5e0 * pow(abs(dayofyear(date) - 180) / (0.33e0 * 60), 2)), 0.1e0)
 + CASE abs(year(date) - 1998) WHEN 0 THEN 1e0 WHEN 1 THEN 0.68e0 WHEN 2 THEN 0.42e0 ELSE 0.1e0 END + 2 * greatest(1 / (1 + exp(20 * (abs(0.5e0 - nir) - 0.2e0))), 0.1e0)
 + greatest(1 / (1 + exp(10 * (1 - 1 / (1 + exp(20 * (blue - 0.5e0 * red - 0.08e0 + 0.075e0))) - 0.5e0))), 0.1e0) + greatest(1 / (1 + exp(10 * (radians(swir2 * 90) - 0.5e0))), 0.1e0)) / 7, 9) AS score FROM obs)
 SELECT px, max({{'s': score, 'o': -scene, 'v': nir}}).v AS bap, round(max(score), 6) AS score FROM s GROUP BY px"""


@query("op_R10_best_available_pixel", _BAP)
def _(spark, sf):
    return fusion.best_pixel(_scored(spark, sf), PX, "score", "scene", "nir").withColumn("score", r6("score"))


@query("op_R11_medoid", f"WITH {TS}, r AS (SELECT px, year(date) AS y, date, value FROM ts), d AS (SELECT a.px, a.y, a.date, a.value, sum(abs(a.value - b.value)) AS far FROM r a JOIN r b ON a.px = b.px AND a.y = b.y GROUP BY ALL) SELECT px, CAST(y AS INTEGER) AS year, min({{'f': far, 'd': date, 'v': value}}).v AS medoid FROM d GROUP BY px, y")
def _(spark, sf):
    return fusion.medoid(ts(spark, sf).withColumn("year", F.year("date")), ["px", "year"], "value", "date")


@query("op_R11_vector_medoid", """WITH v AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings), p AS (SELECT a.label, a.vec_id, round(sum(abs(a.x - b.x)), 4) AS far FROM v a JOIN v b ON a.label = b.label AND a.d = b.d GROUP BY a.label, a.vec_id)
 SELECT label, min({'f': far, 'k': vec_id}).k AS vec_id, round(min(far), 2) AS far FROM p GROUP BY label""")
def _(spark, sf):
    return fusion.vector_medoid(table(spark, sf, "embeddings"), "label", "vec_id", "embedding").withColumn("far", F.round("far", 2))


@query("op_R13_fill_nearest", f"""WITH {GAPPY}, k AS (SELECT *, CASE WHEN value IS NOT NULL THEN {{'d': date, 'v': value}} END AS k FROM gappy),
 n AS (SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY px ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a, first_value(k IGNORE NULLS) OVER (PARTITION BY px ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM k),
 g AS (SELECT px, date, value, a.v AS av, b.v AS bv, date - a.d AS da, b.d - date AS db FROM n) SELECT px, date, coalesce(value, CASE WHEN bv IS NULL OR (av IS NOT NULL AND da <= db) THEN CASE WHEN da <= 3 THEN av END ELSE CASE WHEN db <= 3 THEN bv END END) AS value FROM g""")
def _(spark, sf):
    return fusion.fill_from_nearest(gappy(spark, sf), PX, "value", "date", 3)


# Sources, sinks and streams: round trips.


@query("op_S16_write_series", f"WITH {TS} SELECT CAST(px AS INTEGER) AS cell_id, 'ndvi' AS si, CAST(year(date) AS INTEGER) AS year, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM ts GROUP BY 1, 2, 3")
def _(spark, sf):
    """Written in folders by index and year, read back."""
    from ..sources import tables

    rows = ts(spark, sf).select(c("px").cast("int").alias("cell_id"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit("ndvi").alias("si"), "date", "value")
    path = f"{new_folder(spark)}/series"
    tables.write_series(rows, path)
    return spark.read.parquet(path).groupBy("cell_id", "si", "year").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("op_S20_csv_round_trip", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(spark, sf):
    from ..sources import tables

    path = f"{new_folder(spark)}/csv"
    tables.write_csv(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal"), path)
    return tables.csv(spark, path, "s_suppkey long, s_name string, s_acctbal double")


def _stream(spark, sf):
    schema = table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))  # the session is in UTC


@query("op_stream_windowed", "SELECT event_type, time_bucket(INTERVAL '6 hours', ts) AS start, count(*) AS n, max(value) AS maxv FROM events GROUP BY 1, 2")
def _(spark, sf):
    return streams.drained(streams.windowed(_stream(spark, sf), ["event_type"], "ts", "6 hours", "1 day", "value"), f"w{_unique()}").select("event_type", c("start").cast("timestamp_ntz").alias("start"), "n", "maxv")


@query("op_stream_sessions", """WITH n AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '1 day' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM n)
 SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def _(spark, sf):
    return streams.drained(streams.sessions(_stream(spark, sf), ["user_id"], "ts", "1 day", "40 days"), f"s{_unique()}").select("user_id", c("start").cast("timestamp_ntz").alias("start"), "n")


# Rows of the inventory that the sections above leave.


@query("op_S15_index_at_points", f"WITH {OBS}, p AS (SELECT c_custkey, c_custkey % 100 AS px FROM customer) SELECT c_custkey, date, CAST(floor(max(CASE WHEN nir - red = 0 THEN 0e0 ELSE (1 + (nir - red) / (nir + red + 1e-9)) / 2 END * 10000)) AS INTEGER) AS value FROM p JOIN obs USING (px) GROUP BY c_custkey, date")
def _(spark, sf):

    pts = table(spark, sf, "customer").select("c_custkey", (c("c_custkey") % 100).alias("px"))
    return pts.join(obs(spark, sf).groupBy("px", "date").agg(F.max(F.floor(indices.index("ndvi") * 10000).cast("int")).alias("value")), "px").select("c_custkey", "date", "value")


@query("op_S17_write_stack", "SELECT p_partkey, p_size AS \"b1-yr\", p_retailprice AS \"b2-yr\" FROM part")
def _(spark, sf):
    """A stack written with its band names and read in their order."""
    path = f"{new_folder(spark)}/stack"
    table(spark, sf, "part").select(c("p_retailprice").alias("b2-yr"), "p_partkey", c("p_size").alias("b1-yr")).write.parquet(path)
    return models.ordered_bands(spark.read.parquet(path), ["p_partkey"], ["b1-yr", "b2-yr"])


@query("op_S18_write_mask", "SELECT CAST(p_partkey // 50 AS INTEGER) AS row, CAST(p_partkey % 50 AS INTEGER) AS col, CAST(CASE WHEN p_size > 40 THEN 255 WHEN p_size > 25 THEN 1 ELSE 0 END AS SMALLINT) AS mask FROM part WHERE p_partkey % 50 < 45")
def _(spark, sf):
    """A mask written on the grid of a template: what it lacks there is nodata."""
    p = table(spark, sf, "part").select(F.floor(c("p_partkey") / 50).cast("int").alias("row"), (c("p_partkey") % 50).cast("int").alias("col"), "p_size")
    mask = p.filter("p_size <= 40").withColumn("mask", F.when(c("p_size") > 25, 1).otherwise(0))
    path = f"{new_folder(spark)}/mask"
    masks.on_template(mask, p.filter("col < 45"), []).write.parquet(path)
    return spark.read.parquet(path)


@query("op_S19_compressed", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(spark, sf):
    from ..sources import tables

    path = new_folder(spark)
    tables.compressed(spark, f"{sf}/nation.parquet", f"{path}/zstd")
    return spark.read.parquet(f"{path}/zstd")


_PX = "px AS (SELECT p_partkey // 50 AS row, p_partkey % 50 AS col, p_size AS value, (p_partkey % 50) * 1e0 AS x, (p_partkey // 50) * 1e0 AS y FROM part)"


def _pixels(spark, sf):
    k = c("p_partkey")
    return table(spark, sf, "part").select(F.floor(k / 50).alias("row"), (k % 50).alias("col"), c("p_size").alias("value"), (k % 50).cast("double").alias("x"), F.floor(k / 50).cast("double").alias("y"))


def _triangles(spark, sf):
    """A triangle for each nation, some of them over the raster."""
    pt = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = c("n_nationkey") * 2 + 0.5, c("n_regionkey") * 7 + 0.25
    return table(spark, sf, "nation").select("n_nationkey", x.alias("x0"), y.alias("y0"), (x + 8).alias("x1"), (y + 6).alias("y1"), F.array(pt(x, y), pt(x + 8, y), pt(x, y + 6)).alias("ring"))


@query("op_S24_clip_to_box", f"WITH {_PX} SELECT row, col, value FROM px WHERE row BETWEEN 1 AND 3 AND col BETWEEN 10 AND 29")
def _(spark, sf):
    p = _pixels(spark, sf)
    return catalog.in_box(p.withColumns({"w": c("col"), "s": c("row"), "e": c("col"), "n": c("row")}), (10, 1, 29, 3), ["w", "s", "e", "n"]).select("row", "col", "value")


@query("op_S24_clip_to_polygons", f"WITH {_PX} SELECT n_nationkey, row, col, value FROM px JOIN nation ON x > n_nationkey * 2 + 0.5 AND y > n_regionkey * 7 + 0.25 AND (x - n_nationkey * 2 - 0.5) / 8 + (y - n_regionkey * 7 - 0.25) / 6 < 1")
def _(spark, sf):
    return catalog.clipped_to_polygons(_pixels(spark, sf), _triangles(spark, sf), "n_nationkey", ["x0", "y0", "x1", "y1"], "ring", "x", "y", 8.0).select("n_nationkey", "row", "col", "value")


@query("op_S24_clip_to_chips", f"WITH {_PX}, chips AS (SELECT n_nationkey AS chip, n_nationkey * 2 AS x0, n_regionkey * 5 AS y0 FROM nation) SELECT chip, x, y, CAST(CASE WHEN col <= 25 THEN 1 ELSE 2 END AS INTEGER) AS cell_id, value FROM px JOIN chips ON x >= x0 AND x < x0 + 10 AND y >= y0 AND y < y0 + 5")
def _(spark, sf):
    """Two cells that share a column; chips straddle them."""
    p = _pixels(spark, sf).select("col", "value", "x", "y")
    cells = p.filter("col <= 25").withColumn("cell_id", F.lit(1)).unionByName(p.filter("col >= 25").withColumn("cell_id", F.lit(2))).drop("col")
    x, y = c("n_nationkey") * 2.0, c("n_regionkey") * 5.0
    chips = table(spark, sf, "nation").select(c("n_nationkey").alias("chip"), x.alias("x0"), y.alias("y0"), (x + 10).alias("x1"), (y + 5).alias("y1"))
    return catalog.chip_pixels(cells, chips, ["x0", "y0", "x1", "y1"], "x", "y", 10.0)


@query("op_P5_julian_slice", "SELECT o_orderkey FROM orders WHERE CAST(strftime(o_orderdate, '%Y%j') AS INTEGER) BETWEEN 1996001 AND 1996366")
def _(spark, sf):
    from ..functions.dates import year_day

    return table(spark, sf, "orders").filter(year_day(c("o_orderdate")).between(1996001, 1996366)).select("o_orderkey")


@query("op_J3_variables_of_points", "SELECT c_custkey, c_nationkey, any_value(o_orderstatus) AS var_one, round(avg(o_totalprice) * 0.9713e0, 3) AS var_avg FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY ALL")
def _(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(c("o_custkey").alias("c_custkey")).agg(F.min("o_orderstatus").alias("var_one"), F.round(F.avg("o_totalprice") * 0.9713, 3).alias("var_avg"), F.lit(0).alias("c_nationkey"))
    return sampling.with_variables(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), o, "c_custkey")


@query("op_J11_polygons_clipped_to_cells", """WITH t AS (SELECT n_nationkey AS k, n_nationkey * 2 + 0.5e0 AS x0, n_regionkey * 7 + 0.25e0 AS y0 FROM nation WHERE 1990 + n_nationkey % 3 IN (1990, 1992)), g AS (SELECT cx, cy FROM (SELECT unnest(range(0, 8)) AS cx), (SELECT unnest(range(0, 6)) AS cy)),
 b AS (SELECT k, cx, cy, greatest(cx * 8e0 - x0, 0) AS a, least(cx * 8e0 + 8 - x0, 8) AS z, greatest(cy * 8e0 - y0, 0) AS u, least(cy * 8e0 + 8 - y0, 6) AS v FROM t, g), s AS (SELECT *, unnest(range(0, 4000)) AS i FROM b WHERE a < z AND u < v),
 h AS (SELECT k, cx, cy, (z - a) / 4000 AS w, greatest(least(v, 6 * (1 - (a + (i + 0.5e0) * (z - a) / 4000) / 8)) - u, 0) AS h FROM s) SELECT k, cx, cy, round(sum(w * h) * 0.9713e0, 2) AS area FROM h GROUP BY ALL HAVING sum(w * h) > 0.01""")
def _(spark, sf):
    """Areas of triangles in cells of 8 by 8; SQL sums them strip by strip."""
    polys = _triangles(spark, sf).withColumnRenamed("n_nationkey", "k").withColumn("year", 1990 + c("k") % 3)
    g = spark.range(48).select((c("id") % 8).alias("cx"), F.floor(c("id") / 8).alias("cy"))
    cells = g.withColumns({"w": c("cx") * 8.0, "s": c("cy") * 8.0, "e": c("cx") * 8.0 + 8, "n": c("cy") * 8.0 + 8})
    out = joins.clipped_to_cells(polys, cells, "ring", ["x0", "y0", "x1", "y1"], ["w", "s", "e", "n"], 8.0, "year", [1990, 1992])
    return out.filter("area > 0.01").select("k", "cx", "cy", F.round(c("area") * 0.9713, 2).alias("area"))


@query("op_J16_statistics_to_polygons", "SELECT s_suppkey, avg, med FROM supplier LEFT JOIN (SELECT l_suppkey, round(avg(l_quantity), 4) AS avg, round(median(l_quantity), 4) AS med FROM lineitem WHERE l_quantity > 49 GROUP BY 1) ON l_suppkey = s_suppkey")
def _(spark, sf):
    stats = zonal.summary(table(spark, sf, "lineitem").filter("l_quantity > 49").withColumnRenamed("l_suppkey", "s_suppkey"), ["s_suppkey"], "l_quantity", decimals=4)
    return zonal.to_polygons(table(spark, sf, "supplier").select("s_suppkey"), stats, "s_suppkey").select("s_suppkey", "avg", "med")


@query("op_J17_indices_by_date", f"WITH {OBS}, a AS (SELECT px, date, max(red) AS r FROM obs WHERE scene % 3 > 0 GROUP BY 1, 2), b AS (SELECT px, date, max(nir) AS n FROM obs WHERE scene % 5 > 0 GROUP BY 1, 2) SELECT coalesce(a.px, b.px) AS px, coalesce(a.date, b.date) AS date, round(r, 6) AS red, round(n, 6) AS nir FROM a FULL JOIN b ON a.px = b.px AND a.date = b.date")
def _(spark, sf):
    o = obs(spark, sf)
    out = series.side_by_side({"red": o.filter("scene % 3 > 0").withColumn("value", c("red")), "nir": o.filter("scene % 5 > 0").withColumn("value", c("nir"))}, PX)
    return out.select("px", "date", r6("red").alias("red"), r6("nir").alias("nir"))


@query("op_G24_runtime_totals", "SELECT user_id AS cell, round(sum(value) / 3600, 6) AS dltime, round(sum(value * coalesce(CASE WHEN event_id % 3 > 0 THEN event_id % 3 END, 1)) / 60, 4) AS dlcoremin FROM events GROUP BY user_id")
def _(spark, sf):
    runs = table(spark, sf, "events").select(c("user_id").alias("cell"), "value", F.when(c("event_id") % 3 > 0, c("event_id") % 3).alias("cores"))
    return catalog.runtime_totals(runs, "cell", "value", "cores").select("cell", r6("dltime").alias("dltime"), F.round("dlcoremin", 4).alias("dlcoremin"))


@query("op_T5_first_match", "SELECT o_custkey, min(o_orderkey) AS first FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey")
def _(spark, sf):
    return table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("first"))


@query("op_T1_ranked_by_date", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).cast("long").alias("i"))


@query("op_T4_random_points")
def _(spark, sf):
    """Ten random customers, the same in every run."""
    return table(spark, sf, "customer").select("c_custkey").orderBy(sampling.stable_random(c("c_custkey"), 76), "c_custkey").limit(10)


@query("op_U1_union_of_years", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) IN (1996, 1998)")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return o.filter("year = 1996").unionByName(o.filter("year = 1998"))


@query("op_U3_classes_of_both_sides", "SELECT quality AS class FROM labels UNION SELECT toxic FROM labels")
def _(spark, sf):
    y = table(spark, sf, "labels")
    return y.select(c("quality").alias("class")).union(y.select("toxic")).distinct()


@query("op_M4_point_feature_set", """WITH p AS (SELECT o_custkey AS k, any_value(c_mktsegment) AS label FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1), a AS (SELECT o_custkey AS k, avg(o_totalprice) AS m, max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) AS p FROM orders GROUP BY 1),
 b AS (SELECT o_custkey AS k, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) SELECT k, label, round(m * 0.9713e0, 3) AS var_mean, p AS var_p, n AS var_n FROM p JOIN a USING (k) JOIN b USING (k) WHERE label <> 'BUILDING' AND p IS NOT NULL""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "k")
    pts = table(spark, sf, "customer").select(c("c_custkey").alias("k"), c("c_mktsegment").alias("label"))
    a = o.groupBy("k").agg(F.round(F.avg("o_totalprice") * 0.9713, 3).alias("var_mean"), F.max(F.when(c("o_orderstatus") == "P", c("o_totalprice"))).alias("var_p"), F.lit(1).alias("other"))
    b = o.filter("o_orderpriority = '1-URGENT'").groupBy("k").agg(F.count(F.lit(1)).alias("var_n"))
    return sampling.feature_set(pts, [a, b], "k", "label", skip=["BUILDING"])


@query("op_M10_temporal_classes")
def _(spark, sf):
    """Yearly classes smoothed by the most probable sequence."""
    rows = classes(spark, sf).select("px", "year", *(F.when(c("class") == k, 0.8).otherwise(0.2 / (len(CODES) - 1)).alias(f"p{k}") for k in CODES))
    return models.temporal_classes(rows, PX, "year", CODES, [f"p{k}" for k in CODES], 0.7)


@query("op_M11_feature_registry")
def _(spark, sf):
    return models.feature_model(spark, "m1", ["ndvi", "nbr"], ["maxv-yr", "amp-wet"], ["dem"])


@query("op_M12_latest_scores", "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1")
def _(spark, sf):
    return scores.latest_scores(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderkey")


@query("op_points_in_polygons_drawn")
def _(spark, sf):
    """Five random points in the triangle of each supplier."""
    s = table(spark, sf, "supplier")
    pt = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    x, y = c("s_acctbal"), c("s_nationkey")
    polys = s.select("s_suppkey", x.alias("x0"), y.cast("double").alias("y0"), (x + 400).alias("x1"), (y + 4.0).alias("y1"), F.array(pt(x, y), pt(x + 400, y), pt(x, y + 4)).alias("ring"))
    return sampling.points_in_polygons(polys, "s_suppkey", ["x0", "y0", "x1", "y1"], "ring", 5, 76)


@query("op_R14_shift_by_phase_correlation")
def _(spark, sf):
    """The shift between a raster and a copy of it moved by two rows and three columns, by zone of none."""
    p = table(spark, sf, "part").select(F.floor(c("p_partkey") / 50).cast("int").alias("row"), (c("p_partkey") % 50).cast("int").alias("col"), c("p_size").alias("ref"))
    n = p.agg(F.max("row")).first()[0] + 1
    moved = p.select(((c("row") + 2) % n).alias("row"), ((c("col") + 3) % 50).alias("col"), c("ref").alias("img"))
    return fusion.shifts(p.join(moved, ["row", "col"]).withColumn("cell", F.lit(1)), "cell", "ref", "img")


@query("op_R18_cloud_probability_mask", "SELECT p_partkey, CAST(CASE WHEN p_size % 10 = 7 THEN 255 WHEN p_size * 2 > 60 THEN 1 ELSE 0 END AS INTEGER) AS mask FROM part")
def _(spark, sf):
    prob = F.when(c("p_size") % 10 != 7, F.when(c("p_size") % 20 == 3, 255).otherwise(c("p_size") * 2))
    return table(spark, sf, "part").filter("p_size % 20 <> 3").select("p_partkey", masks.probability_over(prob).alias("mask")).unionByName(
        table(spark, sf, "part").filter("p_size % 20 = 3").select("p_partkey", masks.probability_over(c("p_size") * 2).alias("mask")))


_BATCH = """r AS (SELECT l_suppkey % 5 AS cell, CAST(l_shipdate AS DATE) AS date, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS scene_id FROM lineitem WHERE l_quantity > 49),
 i AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY date, scene_id) - 1 AS i, dense_rank() OVER (PARTITION BY cell ORDER BY date) AS d, count(*) OVER (PARTITION BY cell) AS n FROM r)"""


@query("op_R17_sliding_batches", f"WITH {_BATCH} SELECT a.cell, a.i AS batch, b.scene_id, b.date FROM i a JOIN i b ON a.cell = b.cell AND b.i >= a.i AND b.d < a.d + 7 WHERE a.i < a.n - 7 UNION SELECT cell, greatest(n - 7, 0), scene_id, date FROM i WHERE i >= n - 7")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").filter("l_quantity > 49").select((c("l_suppkey") % 5).alias("cell"), c("l_shipdate").cast("date").alias("date"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("scene_id"))
    return masks.sliding_batches(rows, ["cell"])


@query("op_S15_nearest_pixels", "WITH p AS (SELECT c_custkey, (c_acctbal + 1000) / 10 AS x, c_nationkey * 17e0 AS y FROM customer), r AS (SELECT p_partkey // 50 AS row, p_partkey % 50 AS col, p_size FROM part), n AS (SELECT *, CAST(floor((x - 5) / 20 + 0.5) AS BIGINT) AS k, CAST(floor((395 - y) / 20 + 0.5) AS BIGINT) AS w FROM p) SELECT c_custkey, p_size FROM n LEFT JOIN r ON col = k AND row = w AND abs(x - (5 + k * 20)) <= 8 AND abs(y - (395 - w * 20)) <= 8")
def _(spark, sf):
    pts = table(spark, sf, "customer").select("c_custkey", ((c("c_acctbal") + 1000) / 10).alias("x"), (c("c_nationkey") * 17.0).alias("y"))
    ras = table(spark, sf, "part").select(F.floor(c("p_partkey") / 50).alias("row"), (c("p_partkey") % 50).alias("col"), "p_size")
    return sampling.nearest_pixels(pts, ras, "x", "y", 5.0, 395.0, 20.0, 8.0).select("c_custkey", "p_size")


@query("op_S11_records_of_names", """WITH f AS (SELECT CASE s_suppkey % 3 WHEN 0 THEN 'L3B' WHEN 1 THEN 'L3A' ELSE 'L1C' END || '_' || CASE WHEN s_suppkey % 2 = 0 THEN 'LC08' ELSE 'S2A' END || '_grid' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0') || '_20200101' || CASE WHEN s_suppkey % 5 = 0 THEN '_coregX' ELSE 'X_' END || '.nc' AS name, s_suppkey AS k, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS z FROM supplier)
 SELECT CASE WHEN k % 2 = 0 THEN 'LC08_L2SP_' || substr(z, 1, 6) || '_' || d || '_' || substr(z, 7, 2) || '_' || substr(z, 9, 2) ELSE 'S2A_' || substr(z, 1, 5) || '_' || d || '_' || substr(z, 6, 1) || '_' || substr(z, 7, 3) END AS scene_id,
  string_split(string_split(name, '_coreg')[1], 'X')[1] || '.tif' AS brdf_id, true AS brdf, CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS bandpass, k % 5 = 0 AS coreg FROM (SELECT *, string_split(name, '_')[4] AS d FROM f)""")
def _(spark, sf):
    k = c("s_suppkey")
    name = F.concat(
        F.when(k % 3 == 0, "L3B").when(k % 3 == 1, "L3A").otherwise("L1C"), F.lit("_"), F.when(k % 2 == 0, "LC08").otherwise("S2A"), F.lit("_grid"), F.lpad(k.cast("string"), 10, "0"), F.lit("_20200101"),
        F.when(k % 5 == 0, "_coregX").otherwise("X_"), F.lit(".nc"),
    )
    return catalog.records(table(spark, sf, "supplier").select(name.alias("name"))).select("scene_id", "brdf_id", "brdf", "bandpass", "coreg")


@query("op_S12_scene_index", "SELECT o_orderkey AS scene, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS sensor FROM orders WHERE o_custkey % 90 - 45 <= 10 AND o_custkey % 90 - 40 >= -5 AND o_orderkey % 180 - 90 <= 60 AND o_orderkey % 180 - 80 >= -60 AND o_orderdate BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def _(spark, sf):
    """A gzipped index of scenes, cut to a box, dates and sensors."""
    from ..sources import tables

    k, n = c("o_custkey") % 90, c("o_orderkey") % 180
    rows = table(spark, sf, "orders").select(c("o_orderkey").alias("scene"), c("o_orderdate").cast("date").alias("date"), c("o_orderpriority").alias("sensor"), (n - 90.0).alias("west"), (k - 45.0).alias("south"), (n - 80.0).alias("east"), (k - 40.0).alias("north"))
    path = new_folder(spark)
    rows.write.option("header", True).option("compression", "gzip").csv(f"{path}/index")
    schema = "scene long, date date, sensor string, west double, south double, east double, north double"
    return tables.scene_index(spark, f"{path}/index", schema, (-60.0, -5.0, 60.0, 10.0), "1995-01-01", "1996-12-31", ["1-URGENT", "2-HIGH"], f"{path}/cut").select("scene", "date", "sensor")


@query("op_S20_json_and_scores", "SELECT o_orderpriority AS model, round(avg(o_totalprice) * 0.9713e0, 3) AS score FROM orders WHERE o_orderstatus = 'O' GROUP BY 1 UNION ALL SELECT 'old', 1e0")
def _(spark, sf):
    """Scores through JSON into a log; the last entry of a model counts."""
    from ..sources import tables

    o = table(spark, sf, "orders")
    made = lambda s: o.filter(c("o_orderstatus") == s).groupBy(c("o_orderpriority").alias("model")).agg(F.round(F.avg("o_totalprice") * 0.9713, 3).alias("score"))
    path = new_folder(spark)
    tables.append_scores(made("F").unionByName(spark.createDataFrame([("old", 1.0)], "model string, score double")), f"{path}/log")
    tables.write_json(made("O"), f"{path}/json")
    tables.append_scores(tables.json_lines(spark, f"{path}/json", "model string, score double"), f"{path}/log")
    return tables.latest(spark, f"{path}/log", ["model"])


@query("op_progress_merged", "SELECT CAST(o_custkey AS VARCHAR) AS grid, o_orderpriority AS step, CASE WHEN max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) = 1 THEN 'y' ELSE 'n' END AS status FROM orders GROUP BY 1, 2")
def _(spark, sf):
    from ..sources import tables

    o = table(spark, sf, "orders").select(c("o_custkey").cast("string").alias("grid"), c("o_orderpriority").alias("step"), "o_orderstatus")
    path = f"{new_folder(spark)}/progress"
    tables.merge_progress(spark, path, o.groupBy("grid", "step").agg(F.lit("n").alias("status")))
    return tables.merge_progress(spark, path, o.filter("o_orderstatus = 'F'").select("grid", "step").distinct().withColumn("status", F.lit("y")))


@query("op_log_states", "WITH l AS (SELECT o_custkey AS job, o_orderkey AS t, CASE WHEN o_orderstatus = 'P' THEN 'ERROR: x' || CAST(o_orderkey AS VARCHAR) WHEN o_orderpriority = '5-LOW' THEN 'ALL DONE!' ELSE 'step' END AS line FROM orders) SELECT job, CASE WHEN bool_or(line LIKE 'ERROR%') THEN 'failed' WHEN bool_or(line = 'ALL DONE!') THEN 'done' ELSE 'running' END AS state, min(CASE WHEN line LIKE 'ERROR%' THEN {'a': t, 'l': line} END).l AS error, max({'a': t, 'l': line}).l AS last, count(*) AS lines FROM l GROUP BY job")
def _(spark, sf):
    line = F.when(c("o_orderstatus") == "P", F.concat(F.lit("ERROR: x"), c("o_orderkey").cast("string"))).when(c("o_orderpriority") == "5-LOW", "ALL DONE!").otherwise("step")
    return catalog.log_states(table(spark, sf, "orders").select(c("o_custkey").alias("job"), c("o_orderkey").alias("at"), line.alias("line")))


@query("op_M7_holdout_scores", "SELECT coalesce(CAST(o_orderstatus AS VARCHAR), 'ALL') AS o_orderstatus, count(*) AS n, round(avg(CASE WHEN o_orderpriority = CASE WHEN o_totalprice > 150000 THEN '1-URGENT' ELSE '2-HIGH' END THEN 1e0 ELSE 0e0 END), 3) AS OA, round(avg(CASE WHEN o_orderpriority IN ('1-URGENT') THEN 1e0 ELSE 0e0 END), 3) AS recall FROM orders GROUP BY GROUPING SETS ((o_orderstatus), ())")
def _(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderstatus", c("o_orderpriority").alias("pred"), F.when(c("o_totalprice") > 150000, "1-URGENT").otherwise("2-HIGH").alias("label"))
    return scores.holdout_scores(rows, "o_orderstatus", ["1-URGENT"])


_RAW = """s AS (SELECT l_orderkey, l_linenumber, CAST(trunc(l_tax * 100000) AS INTEGER) AS blue, CAST(trunc(l_discount * 100000) AS INTEGER) AS green, CAST(trunc(l_quantity * 200) AS INTEGER) AS red, CAST(trunc(l_extendedprice / 10) AS INTEGER) AS nir, CAST(l_orderkey % 100 * 100 AS INTEGER) AS swir1, CAST(l_partkey % 101 * 100 AS INTEGER) AS swir2 FROM lineitem),
 v AS (SELECT l_orderkey, l_linenumber, CASE WHEN green < 10000 THEN CAST(green AS DOUBLE) END AS g, CASE WHEN red < 10000 THEN CAST(red AS DOUBLE) END AS r, CASE WHEN nir < 10000 THEN CAST(nir AS DOUBLE) END AS n, CASE WHEN swir1 < 10000 THEN CAST(swir1 AS DOUBLE) END AS s1, CASE WHEN swir2 < 10000 THEN CAST(swir2 AS DOUBLE) END AS s2 FROM s)"""
_ND = lambda a, b: f"({a} - {b}) / ({a} + {b} + 1e-9)"
_HALF = lambda o: f"CASE WHEN {o} = 0 THEN 0e0 ELSE ({o} + 1) * 5e3 END"
_POINT_SQL = {
    "ndvi": _HALF(_ND("n", "r")), "gcvi": _HALF(_ND("n", "g")), "nbr": _HALF(_ND("n", "s2")), "nbr2": _HALF(_ND("s1", "s2")), "evi2": "1e4 * 2.5e0 * ((n / 1e4 - r / 1e4) / (n / 1e4 + 1 + 2.4e0 * r / 1e4))", "cai": "CASE WHEN 1e4 * s2 / (s1 + 1e-9) > 1e9 THEN 1e9 ELSE 1e4 * s2 / (s1 + 1e-9) END",
    "savi": _HALF("(1.5e0 * ((n / 1e4 - r / 1e4) / (n / 1e4 + r / 1e4 + 0.5e0)))"), "msavi": "5e3 * (2 * n / 1e4 + 1) - (pow(2 * n / 1e4 + 1, 2) - 8 * (n / 1e4 - r / 1e4)) / 2", "ndmi": f"(1e4 * ({_ND('n', 's1')}) + 1) * 5e3", "ndwi": f"(1e4 * ({_ND('g', 'n')}) + 1) * 5e3",
    "kndvi": f"1e4 * tanh(pow({_ND('n', 'r')}, 2))", "bai": "CASE WHEN r + n > 0 THEN CASE WHEN pow(0.06e0 - n / 1e4, 2) + pow(0.1e0 - r / 1e4, 2) > 0 THEN least(1e9, 1e4 / (pow(0.06e0 - n / 1e4, 2) + pow(0.1e0 - r / 1e4, 2))) END WHEN r + n <= 0 THEN 0e0 END", "baim": "CASE WHEN s2 + n > 0 THEN CASE WHEN pow(0.05e0 - n / 1e4, 2) + pow(0.2e0 - s2 / 1e4, 2) > 0 THEN least(1e9, 1e4 / (pow(0.05e0 - n / 1e4, 2) + pow(0.2e0 - s2 / 1e4, 2))) END WHEN s2 + n <= 0 THEN 0e0 END",
    "gemi": "1e4 * (eta * (1 - 0.25e0 * eta) - ((r / 1e4 - 0.125e0) / (1 - r / 1e4)))", "mirbi": "CASE WHEN s2 + s1 = 0 THEN 0e0 ELSE 2e3 * ((10 * s2 / 1e4) - (9.8e0 * s1 / 1e4) + 2) END", "swir2": "s2", "nir": "n",
}


@query("op_29_point_indices", f"WITH {_RAW}, e AS (SELECT *, (2 * (pow(n / 1e4, 2) - pow(r / 1e4, 2)) + 1.5e0 * (n / 1e4) + 0.5e0 * (r / 1e4)) / ((n / 1e4) + (r / 1e4) + 0.5e0) AS eta FROM v) SELECT l_orderkey, l_linenumber, {', '.join(f'round(0.9713e0 * ({x}), 3) AS {n}' for n, x in _POINT_SQL.items())} FROM e")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    raw = li.select("l_orderkey", "l_linenumber", (c("l_tax") * 100000).cast("int").alias("blue"), (c("l_discount") * 100000).cast("int").alias("green"), (c("l_quantity") * 200).cast("int").alias("red"), (c("l_extendedprice") / 10).cast("int").alias("nir"), (c("l_orderkey") % 100 * 100).cast("int").alias("swir1"), (c("l_partkey") % 101 * 100).cast("int").alias("swir2"))
    point = lambda n: F.least(F.lit(1e9), indices.point_index(n)) if n in ("bai", "baim", "cai") else indices.point_index(n)
    known = lambda n: F.when(indices.point_index(n).isNotNull(), point(n))
    split = lambda n, x: indices.apart(x) if n == "nir" else x
    return raw.select("l_orderkey", "l_linenumber", *(split(n, F.round(0.9713 * known(n), 3)).alias(n) for n in _POINT_SQL))  # a factor, so that no value lies on a tie


@query("op_29_burn_differences", "SELECT l_orderkey, l_linenumber, round(l_discount - l_tax, 6) AS dnbr, round(CASE WHEN l_discount = 0 THEN 0e0 ELSE (l_discount - l_tax) / sqrt(abs(l_discount)) END, 6) AS rdnbr FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", r6(indices.burn_difference(c("l_discount"), c("l_tax"))).alias("dnbr"), r6(indices.burn_ratio(c("l_discount"), c("l_tax"))).alias("rdnbr"))


@query("op_M13_training_chips", "WITH ch AS (SELECT n_nationkey AS region, n_nationkey * 40e0 AS x0, n_nationkey * 40e0 + CASE n_nationkey % 3 WHEN 0 THEN 30e0 WHEN 1 THEN 30.5e0 ELSE 33e0 END AS x1 FROM nation) SELECT region, x0, CASE WHEN region % 3 = 1 THEN x0 + 30 ELSE x1 END AS x1, CASE region % 3 WHEN 0 THEN 'ready' WHEN 1 THEN 'adjusted' ELSE 'skipped' END AS state, CAST(coalesce(n, 0) AS BIGINT) AS polys FROM ch LEFT JOIN (SELECT region, CASE WHEN count(*) FILTER (WHERE c_nationkey % 4 > 0) > 0 THEN count(*) ELSE 1 END AS n FROM ch JOIN customer ON (c_custkey * 7) % 1000 <= x0 + 30 AND (c_custkey * 7) % 1000 + 2 >= x0 AND c_nationkey <= 30 WHERE region % 3 < 2 GROUP BY region) USING (region)")
def _(spark, sf):
    k = c("n_nationkey")
    chips = table(spark, sf, "nation").select(k.alias("region"), (k * 40.0).alias("x0"), F.lit(0.0).alias("y0"), (k * 40.0 + F.when(k % 3 == 0, 30.0).when(k % 3 == 1, 30.5).otherwise(33.0)).alias("x1"), F.lit(30.0).alias("y1"))
    x = (c("c_custkey") * 7 % 1000).cast("double")
    polys = table(spark, sf, "customer").select((c("c_nationkey") % 4).alias("class"), x.alias("x0"), c("c_nationkey").cast("double").alias("y0"), (x + 2).alias("x1"), (c("c_nationkey") + 1.0).alias("y1"), "c_custkey")
    out, fields = sampling.training_chips(chips, polys, 30.0)
    n = fields.groupBy("region").agg(F.count(F.lit(1)).alias("polys"))
    return out.join(n, "region", "left").select("region", "x0", "x1", "state", F.coalesce("polys", F.lit(0)).alias("polys"))


def _unique() -> str:
    import uuid

    return uuid.uuid4().hex


assert set(_RULE_SQL) == set(rules.RULES) and len(CODES) == 16
