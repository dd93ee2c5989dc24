"""Class sequences, phenology, context and zones against plain Python."""

import math
import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import numpy as np
import pytest

from gridloom.operators import focal, masks, pheno, rules, sampling, scores, zonal
from gridloom.queries import relational
from gridloom.sources import tables

C = {k: set(v) for k, v in rules.CLASSES.items()}
FIRST = {k: v[0] for k, v in rules.CLASSES.items()}
CODES = [143, 221, 75, 114, 40, 30, 150, 74, 164, 207, 250, 215, 148, 98, 161, 184, 226, 20, 187, 176, 80, 104]


def rule(name, ts, count, base_forest, base_grass):
    """One rule over a list of classes; ``count`` gives the years of a set as first counted."""
    n = len(ts)
    back = lambda t, i, fill=0: t[i - 1] if i >= 1 else fill
    back2 = lambda t, i, fill=0: t[i - 2] if i >= 2 else fill
    ahead = lambda t, i, fill=0: t[i + 1] if i + 1 < n else fill

    def each(ts, cond, fill):
        return [(fill(ts, i) if callable(fill) else fill) if cond(ts, i) else ts[i] for i in range(n)]

    beside = lambda t, i, *sets: (any(back(t, i) in C[s] for s in sets), any(ahead(t, i) in C[s] for s in sets))
    grew = lambda t, i: back(t, i, 255) < 180 and back2(t, i, 255) < 148
    grown = lambda t, i: back(t, i) > 200 and back2(t, i) > 200
    if name == "sugar-palm":
        k = count("palm_for", ts)
        return each(ts, lambda t, i: t[i] == 143 and all(beside(t, i, "palm_for")) and k >= 2, 221)
    if name == "sugar-grass":
        k = count("Grass_all", ts)
        return each(ts, lambda t, i: t[i] == 143 and all(beside(t, i, "Grass_all")) and k >= 4, base_grass)
    if name == "banana-wet":
        k = count("palm_for", ts) + count("LowVeg_wet", ts) + count("MedVeg_wet", ts)
        return each(ts, lambda t, i: t[i] == 148 and k >= 5, 164)
    if name == "palm_for-grass-aggressive":
        if ts[-1] == 221 or (n > 1 and ts[-2] == 221):
            return [221 if base_forest == 221 else 176] * n
        return ts
    if name == "palm_for-wetgrass":
        k = count("LowVeg_wet", ts) + count("MedVeg_wet", ts)
        return each(ts, lambda t, i: t[i] == 221 and k > 5, 164)
    if name == "grass-forest-aggressive":
        return [ts[-1]] * n if n > 1 and ts[-1] in C["Trees_nat"] and ts[-2] == ts[-1] else ts
    if name == "tree_plant-med_crop":
        k = count("Trees_plantation", ts)
        return each(ts, lambda t, i: t[i] in C["med_crops"] and k >= 3, 207)
    if name == "rice-water":
        k = count("NoVeg_water", ts)
        ts = each(ts, lambda t, i: t[i] == 114 and k >= 4, 40)
        return each(ts, lambda t, i: t[i] == 40 and back(t, i) == 114 and ahead(t, i) == 114, 114)
    if name == "rice-built":
        r, w = count("rice", ts), count("NoVeg_water", ts)
        return each(ts, lambda t, i: t[i] == 30 and r >= 2 and r + w >= 4, 114)
    if name == "wetgrass-crop":
        return each(ts, lambda t, i: t[i] in C["LowVeg_crop"] and all(beside(t, i, "LowVeg_wet")), 74)
    if name == "grass-crop":
        k = count("Grass_all", ts)
        return each(ts, lambda t, i: t[i] in C["LowVeg_crop"] and k >= 4 and any(beside(t, i, "Grass_all")), 75)
    if name == "wetgrass-built":
        return each(ts, lambda t, i: t[i] == 30 and all(beside(t, i, "LowVeg_wet")), 74)
    if name == "medcrop-wetshrub":
        return each(ts, lambda t, i: t[i] in C["med_crops"] and all(beside(t, i, "MedVeg_wet", "LowVeg_wet")), 164)
    if name == "medcrop-shrub":
        dry = C["dry_grass"] | {161}
        return each(ts, lambda t, i: t[i] in C["med_crops"] and back(t, i) in dry and ahead(t, i) in dry, 161)
    if name == "singleton-crop":
        k = count("LowVeg_crop", ts)
        return each(ts, lambda t, i: t[i] in C["LowVeg_crop"] and k == 1, 80)
    if name == "grass-built":
        k = count("Grass_all", ts)
        return each(ts, lambda t, i: t[i] == 30 and k >= 4 and any(beside(t, i, "Grass_all")), 20)
    if name == "built-non-built":
        return each(ts, lambda t, i: t[i] != 30 and back(t, i) == 30 and ahead(t, i) == 30, 30)
    if name == "forest-treeplant":
        p, f = count("Trees_plantation", ts), count("Trees_nat", ts)
        ts = each(ts, lambda t, i: t[i] in C["Trees_nat"] and p > f and grown(t, i), 207)
        return each(ts, lambda t, i: t[i] in C["Trees_plantation"] and p < f and grown(t, i), base_forest)
    if name == "forest-brieflow":
        ts = each(ts, lambda t, i: t[i] < 148 and back(t, i) in {226, 221} and ahead(t, i) in {226, 221}, back)
        return each(ts, lambda t, i: t[i] < 148 and back(t, i) in {250, 215} and ahead(t, i) in {250, 215}, 215)
    if name == "grass-to-forest":
        return each(ts, lambda t, i: t[i] in C["Trees_nat"] and grew(t, i), 161)
    if name == "grass-to-palmforest":
        return each(ts, lambda t, i: t[i] == 221 and grew(t, i), 176)
    if name == "twmix-medwet":
        return each(ts, lambda t, i: t[i] == 184 and grew(t, i), 164)
    assert name == "noplant-plant"
    ts = each(ts, lambda t, i: 148 <= t[i] < 200 and ahead(t, i) in C["Trees_plantation"], 187)
    return each(ts, lambda t, i: 50 <= t[i] < 148 and ahead(t, i) in C["Trees_plantation"], 98)


def chain(ts, names, base_forest, base_grass, known=None):
    counts = dict(known or {})

    def count(name, now):
        if name not in counts:
            counts[name] = sum(x in C[name] for x in now)
        return counts[name]

    for name in names:
        ts = rule(name, ts, count, base_forest, base_grass)
    return ts


def most(ts, group):
    n = Counter(x for x in ts if x in C[group])
    return max(rules.CLASSES[group], key=lambda c: (n[c], -rules.CLASSES[group].index(c))) if n else 0


def base(ts):
    n = lambda *names: sum(any(x in C[s] for s in names) for x in ts)
    out = {
        "shrub_for": 226 if n("shrub_for") or (n("dense_for") and n("MedVeg_noncrop")) else 0,
        "palm_for": 221 if n("palm_for") > n("gtmix") and n("palm_for") > n("med_crops") else 0,
        "open_for": 215 if n("open_for", "MedVeg_noncrop") >= 2 and n("dense_for") == len(ts) - n("open_for", "MedVeg_noncrop") else 0,
        **{g: most(ts, g) for g in ("dense_for", "wet", "grass_Py36")},
    }
    out["forest"] = next((out[g] for g in ("shrub_for", "palm_for", "open_for", "dense_for") if out[g]), 0)
    return out


def held(ts, b):
    ts = [b["forest"] if x in C["forest_Py36"] and b["forest"] >= 200 else x for x in ts]
    ts = [b["grass_Py36"] if x in C["grass_Py36"] and b["grass_Py36"] else x for x in ts]
    near = lambda i: {ts[i - 1] if i else 0, ts[i + 1] if i + 1 < len(ts) else 0}
    return [b["wet"] if x in C["wet"] and b["wet"] and x not in near(i) else x for i, x in enumerate(ts)]


@pytest.fixture(scope="module")
def sequences():
    r = random.Random(4)
    kinds = [r.sample(CODES, 4) for _ in range(300)]
    return {px: [r.choice(kinds[px]) for _ in range(r.choice([1, 2, 8, 8, 8, 9]))] for px in range(300)}


@pytest.fixture(scope="module")
def series(spark, sequences):
    return spark.createDataFrame([(px, 2000 + i, x) for px, ts in sequences.items() for i, x in enumerate(ts)], "px long, year int, class int").cache()


def by_pixel(df, column="class"):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["px"], r["year"])):
        out[r["px"]].append(r[column])
    return out


def test_all_rules_in_one_chain(series, sequences):
    from pyspark.sql import functions as F

    assert sorted(relational._CHAIN) == sorted(rules.RULES)
    got = by_pixel(rules.apply_rules(series.withColumn("base_forest", F.lit(221)).withColumn("base_grass", F.lit(75)), ["px"], relational._CHAIN))
    assert got == {px: chain(ts, relational._CHAIN, 221, 75) for px, ts in sequences.items()}


def test_counts_at_first_use(spark):
    """A count sees what the rules before it changed, and no rule after it changes the count."""
    from pyspark.sql import functions as F

    ts = [74, 110, 74, 110, 74, 30]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(ts)], "px int, year int, class int").withColumn("base_forest", F.lit(0)).withColumn("base_grass", F.lit(75))
    assert by_pixel(rules.apply_rules(df, ["px"], ["wetgrass-crop", "grass-built"]))[1] == [74, 74, 74, 74, 74, 20]
    assert by_pixel(rules.apply_rules(rules.with_counts(df, ["px"], ["Grass_all"]), ["px"], ["wetgrass-crop", "grass-built"]))[1] == [74, 74, 74, 74, 74, 30]


def test_bases_holds_and_chain(series, sequences):
    bases = {px: base(ts) for px, ts in sequences.items()}
    found = rules.stable_base(series, ["px"])
    for r in found.collect():
        assert {k: r[f"base_{k}"] for k in bases[r["px"]]} == bases[r["px"]]
    rows = rules.hold_to_base(series.join(found, "px"), ["px"])
    want = {px: held(ts, bases[px]) for px, ts in sequences.items()}
    assert by_pixel(rows) == want
    got = by_pixel(rules.apply_rules(rows.withColumn("base_grass", rows["base_grass_Py36"]), ["px"], relational._CHAIN))
    known = {px: {"palm_for": sum(x == 221 for x in ts)} for px, ts in sequences.items()}
    assert got == {px: chain(ts, relational._CHAIN, bases[px]["forest"], bases[px]["grass_Py36"], known[px]) for px, ts in want.items()}


def test_regions(series, sequences):
    """A rule on its own region only."""
    from pyspark.sql import functions as F

    df = series.withColumn("base_forest", F.lit(221)).withColumn("base_grass", F.lit(75)).withColumn("region", F.col("px") % 3)
    got = by_pixel(rules.apply_rules(df, ["px"], ["built-non-built", "grass-to-forest"], where={"built-non-built": rules.in_region(F.col("region"), [1])}))
    want = {px: chain(ts, ["built-non-built", "grass-to-forest"] if px % 3 == 1 else ["grass-to-forest"], 221, 75) for px, ts in sequences.items()}
    assert got == want


def slope_peaks(x, v, least=3000, low=1000):
    n = len(v)
    if n < 2:
        g = [0.0] * n
    else:
        g = list(np.gradient(np.array(v, float), np.array(x, float)))
    top = [i > 0 and g[i] < 0 < g[i - 1] and v[i] >= least for i in range(n)]
    turn = [v[i] if top[i] or (i > 0 and g[i] > 0 > g[i - 1] and v[i] <= low) else None for i in range(n)]
    line, last = [], None
    for t in turn:
        last = t if t is not None else last
        line.append(last)
    first = next((t for t in turn if t is not None), None)
    line = [first if t is None else t for t in line]
    hits = [i for i in range(1, n) if top[i] and line[i] is not None and (abs(line[i] - line[i - 1]) >= least - low or line[i] == line[i - 1])]
    alt = max(range(n), key=lambda i: (v[i], -i))
    alt = alt if v[alt] >= 3000 else None
    count = 0 if max(v) < low else len(hits) or (1 if alt is not None else 0)
    return count, x[hits[0]] if hits else (x[alt] if alt is not None else None)


def test_derivative_peaks(spark):
    r = random.Random(6)
    data = {}
    for px in range(150):
        x = sorted(r.sample(range(400), r.randint(1, 40)))
        top = r.choice([900, 4000, 9000])
        data[px] = (x, [int(abs(math.sin(i / r.choice([3, 5, 9]))) * top) + r.randint(0, 50) for i in range(len(x))])
    d0 = date(2020, 1, 1)
    df = spark.createDataFrame([(px, d0 + timedelta(a), b) for px, (x, v) in data.items() for a, b in zip(x, v, strict=True)], "px int, date date, value int")
    for row in pheno.peaks_by_derivative(df, ["px"]).collect():
        n, first = slope_peaks(*data[row["px"]])
        assert (row["n"], row["first_date"]) == (n, None if first is None else d0 + timedelta(first)), row["px"]


def test_change_with_user_columns(spark):
    """Columns of the caller with short names are not touched."""
    d0 = date(2020, 1, 1)
    rows = [(1, 7, d0 + timedelta(i), x) for i, x in enumerate([5000, 5000, 5000, 5000, 3000, 3000, 3000, 3000, 5000])]
    df = spark.createDataFrame(rows, "v int, f int, date date, value int")
    got = pheno.significant_change(df, ["v", "f"], -800).first()
    assert (got["v"], got["f"], got["events"], got["first_doy"]) == (1, 7, 1, 5)
    assert pheno.significant_change(df, ["v", "f"], -800, season=(6, 20)).first()["first_doy"] == 0
    assert pheno.significant_change(df, ["v", "f"], -800, season=(350, 5)).first()["first_doy"] == 5
    assert pheno.peaks(df.withColumnsRenamed({"v": "c", "f": "base0"}), ["c", "base0"]).first()["c"] == 1


def test_smallholder_context(spark):
    r = random.Random(8)
    crops, low, big, small = [137, 143, 125], list(range(100, 148)), [143], [125, 137]
    px = {}
    for cell in (1, 2):
        for i in range(12):
            for j in range(12):
                px[cell, i, j] = dict(
                    cls=r.choice([75, 137, 125, 143, 96, 86, 220]), majority=r.choice([0, 0, 143, 161]), buffer=r.choice([0, 143, 161]), size=r.choice([10, 40, 60]), distance=r.choice([0.0, 1.0, 2.0, 5.0]), near=r.choice([0, 1]), excluded=r.random() < 0.1,
                )
    rows = [(k[0], k[1], k[2], *p.values()) for k, p in px.items()]
    df = spark.createDataFrame(rows, "cell int, row int, col int, class int, majority int, buffer int, size int, distance double, near_high int, excluded boolean")

    def first(p):
        o, low_small = p["cls"], p["size"] <= 50 and p["cls"] in low and not p["excluded"]
        inside = p["majority"] if p["majority"] in crops and o in crops else o
        buf = small[0] if low_small and p["buffer"] in low else o
        buf = 143 if p["size"] > 30 and p["buffer"] == 143 and o in crops else buf
        x = (small[0] if low_small else o) if p["buffer"] == 0 else (buf if p["majority"] == 0 else inside)
        was_small = x in small
        if p["distance"] > 1 and p["near"] and was_small:
            x = 86
        if p["distance"] > 1 and was_small and p["majority"] == 0 and p["buffer"] in big:
            x = 86
        if p["distance"] > 3 and was_small and p["buffer"] == 0 and o not in low:
            x = 86
        return 86 if x == 96 else x

    made = {k: first(p) for k, p in px.items()}
    want = {
        (c, i, j): 96 if x == 86 and any(made.get((c, i + a, j + b)) in crops for a in (-1, 0, 1) for b in (-1, 0, 1)) else x for (c, i, j), x in made.items()
    }
    got = focal.smallholder_context(df, ["cell"], crops, low, big, small, 86, 96, 143)
    assert {(r["cell"], r["row"], r["col"]): r["class"] for r in got.collect()} == want


@pytest.mark.parametrize("azimuth", [0, 30, 45, 77, 90, 135, 180, 200, 250, 270, 315, 359])
def test_cast_shadow_of_a_tower(spark, azimuth):
    """A tower darkens the pixels behind it, as far as its height allows, and none before it."""
    size, height, res, angle = 31, 60.0, 10.0, 40.0
    df = spark.createDataFrame([(i, j, height if (i, j) == (15, 15) else 0.0) for i in range(size) for j in range(size)], "row int, col int, elev double")
    dark = {(r["row"], r["col"]) for r in focal.cast_shadow(df, [], angle, azimuth, res).collect() if r["shadow"]}
    reach = height / math.tan(math.radians(angle)) / res
    away = (math.cos(math.radians(azimuth)), -math.sin(math.radians(azimuth)))  # rows grow southwards
    assert dark
    for i, j in dark:
        along = (i - 15) * away[0] + (j - 15) * away[1]
        across = abs((i - 15) * away[1] - (j - 15) * away[0])
        assert 0 < along <= reach + 1 and across <= 1
    assert max((i - 15) * away[0] + (j - 15) * away[1] for i, j in dark) >= reach - 1.5


def test_kinds_of_maps():
    assert zonal.map_kind("class", "cont", None, False) == "cat" and zonal.map_kind(None, "Continuous", {"type": "cat"}, True) == "cont"
    assert zonal.map_kind("", "None", {"type": "cat"}, False) == "cat" and zonal.map_kind(None, None, {"classes": {}}, False) == "cont"
    assert zonal.map_kind(None, None, {"classes": {"a": 1}}, False) == "cat" and zonal.map_kind(None, None, None, True) == "cat"
    with pytest.raises(ValueError, match="kind"):
        zonal.map_kind("x", None, None, False)


def test_points_in_a_thin_polygon(spark):
    """A polygon that fills little of its box still gets all its points."""
    ring = [(0.0, 0.0), (100.0, 99.9), (100.0, 100.0)]
    df = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 100.0, [{"x": x, "y": y} for x, y in ring])], "k int, x0 double, y0 double, x1 double, y1 double, ring array<struct<x:double,y:double>>")
    got = sampling.points_in_polygons(df, "k", ["x0", "y0", "x1", "y1"], "ring", 6, 3).collect()
    assert sorted(r["point"] for r in got) == [1, 2, 3, 4, 5, 6] and all(0.999 * r["x"] <= r["y"] <= r["x"] for r in got)
    with pytest.raises(ValueError, match="area"):
        sampling.points_in_polygons(df.selectExpr("k", "x0", "y0", "x1", "y1", "array(ring[0], ring[1], ring[0]) AS ring"), "k", ["x0", "y0", "x1", "y1"], "ring", 6, 3)


def test_progress_log(spark, tmp_path):
    path = str(tmp_path / "p")
    one = lambda *rows: spark.createDataFrame(rows, "grid string, step string, status string")
    tables.merge_progress(spark, path, one(("a", "s", "n"), ("b", "s", "n")))
    got = tables.merge_progress(spark, path, one(("a", "s", "y"), ("c", "s", "n")))
    assert sorted(tuple(r) for r in got.collect()) == [("a", "s", "y"), ("b", "s", "n"), ("c", "s", "n")]


def test_separability_edges(spark):
    """Zero and negative values leave their terms out; one row has no deviation."""
    df = spark.createDataFrame([("a", "dry", 0.0, 5.0), ("a", "dry", 4.0, 2.0), ("a", "wet", -1.0, 3.0), ("a", "wet", None, 3.0)], "si string, season string, pre double, post double")
    got = {r["season"]: r for r in scores.pre_post_summary(df, ["si"], "season").collect()}
    assert got["ALL"]["n"] == 3 and got["wet"]["n"] == 1 and got["wet"]["delta_std"] is None and got["wet"]["delta_95"] == -4
    assert got["dry"]["sep_F1"] == int(4 * math.log(2)) and got["dry"]["sep_bhatt"] == round(-math.log(math.sqrt(8)), 3)
    assert got["dry"]["sep_jen"] == int((4 * math.log(4 / 3) + 2 * math.log(2 / 3) + 5 * math.log(2)) / 2)


def test_batches_of_few_scenes(spark):
    d0 = date(2020, 1, 1)
    df = spark.createDataFrame([(1, d0 + timedelta(i // 2), f"s{i}") for i in range(5)], "cell int, date date, scene_id string")
    got = defaultdict(list)
    for r in masks.sliding_batches(df, ["cell"], 2).collect():
        got[r["batch"]].append(r["scene_id"])
    assert {k: sorted(v) for k, v in got.items()} == {0: ["s0", "s1", "s2", "s3"], 1: ["s1", "s2", "s3"], 2: ["s2", "s3", "s4"], 3: ["s3", "s4"]}
