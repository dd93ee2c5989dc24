"""Operators against plain Python on small tables: what SQL cannot express, and edges."""

import math
from datetime import date, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridloom.functions import grammar, indices
from gridloom.operators import catalog, focal, intervals, joins, masks, pheno, rules, segments, series
from gridloom.plans.calendar import Calendar

D0 = date(2020, 1, 1)


def days(spark, values, px=1):
    return spark.createDataFrame([(px, D0 + timedelta(i), v) for i, v in enumerate(values)], "px int, date date, value int")


def test_seasons():
    c = Calendar()
    assert c.season("yr", 2020) == (date(2020, 6, 1), date(2021, 5, 31))
    assert c.season("wet", 2020) == (date(2020, 11, 1), date(2021, 3, 2))
    assert c.season("Jan", 2020) == (date(2021, 1, 1), date(2021, 1, 31))
    assert c.season("Q1", 2020)[1] == c.season("Q2", 2020)[0]
    assert c.season("dry", 2020, (30, 0))[0] == c.season("dry", 2020)[0] - timedelta(30)


def test_names():
    assert grammar.parse_index("savi.n25-smnorm") == {"index": "savi", "param": -0.25, "series": "sm", "norm": True}
    f = grammar.parse_feature("sigdelta.n500.doy.glcm.homog.w3.c8.th0-yr")
    assert (f["threshold"], f["freq"], f["texture"]["window"]) == (-500, "doy", 3)
    assert grammar.train_years("17to19") == [2017, 2018, 2019]
    assert grammar.parse_model("a_b_24-geo_lc5_RF100_ss2-run3")["subsample"] == 2
    with pytest.raises(ValueError):
        grammar.parse_feature("nothing")


def test_index_edges(spark):
    rows = spark.createDataFrame([(0.0, 0.0, 0.0, 0.0, 0.0, 0.0), (1.0, 1.0, 1.0, 1.0, 1.0, 1.0), (None, 0.1, 0.2, 0.3, 0.4, 0.5)], ", ".join(f"{b} double" for b in indices.BANDS))
    got = rows.select(*(indices.index(n).alias(n) for n in indices.INDICES)).collect()
    for r in got:
        assert all(v is not None and math.isfinite(v) for v in r)
    assert got[0]["ndvi"] == 0 and got[0]["bai"] == 0 and got[1]["char"] == 0


def suppress(values, base, inverted, rounds=9):
    mark, lost = (10000, 32767) if inverted else (1, 0)
    c = [v if (v > base if not inverted else 0 < v < base) else mark for v in values]
    for t in range(1, rounds + 1):
        for sign in (1, -1):
            at = lambda i: c[i] if 0 <= i < len(c) else None  # noqa: E731, B023
            new = []
            for i, x in enumerate(c):
                o = at(i + sign * t)
                far = x - (lost if o is None else o)
                flat = t >= 2 and at(i + sign * (t - 1)) == mark
                new.append(x if (far <= 0 if inverted else far >= 0) or x == mark or flat else lost)
            c = new
    return c


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(1, 9000), min_size=3, max_size=30), st.booleans())
def test_peaks(spark, values, inverted):
    base = float(np.median(values))
    c = suppress(values, base, inverted)
    hits = [i for i, x in enumerate(c) if (x <= base - 500 if inverted else x >= base + 500)]
    got = pheno.peaks(days(spark, values), ["px"], 500, inverted).first()
    assert got["n"] == len(hits)
    assert got["first_date"] == (D0 + timedelta(hits[0]) if hits else None)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(1, 9000)), min_size=1, max_size=20), st.integers(0, 3))
def test_fills(spark, values, limit):
    got = [r[0] for r in days(spark, values).select(series.forward_fill("value", ["px"], limit).alias("f"), "date").orderBy("date").collect()]
    want = [next((values[j] for j in range(i, max(-1, i - limit - 1), -1) if values[j] is not None), None) for i in range(len(values))]
    assert got == want


@pytest.mark.parametrize("method", [m for m in series.SMOOTHERS if m != "dbl"])
def test_smoothers_keep_a_constant(spark, method):
    out = [D0 + timedelta(i) for i in (0, 5, 11, 19)]
    got = series.smoothed(days(spark, [700] * 20), ["px"], out, method).collect()
    assert [round(r["value"], 1) for r in got] == [700.0] * 4


def test_whittaker_is_least_squares():
    x, y = np.array([3, 4, 9, 12, 20]), np.array([1.0, 5.0, 2.0, 8.0, 3.0])
    n = 21 - 3
    w = np.zeros(n)
    w[x - 3] = 1
    z = np.zeros(n)
    z[x - 3] = y
    d = np.diff(np.eye(n), 2, axis=0)
    want = np.linalg.solve(np.diag(w + 1e-9) + 100 * d.T @ d, z)
    assert np.allclose(series.whittaker(x, y, np.arange(3, 21)), want, atol=1e-6)


def test_as_of_ties_and_strictness(spark):
    e = spark.createDataFrame([(1, 10, D0)], "px int, id int, day date")
    o = spark.createDataFrame([(1, D0, 5), (1, D0, 7), (1, D0 - timedelta(2), 3), (1, D0 + timedelta(1), None)], "px int, date date, value int")
    one = lambda d, s: tuple(joins.as_of(e, o, ["px"], "day", "date", "value", d, s).first()[-2:])
    assert one("backward", False) == (D0, 7) and one("forward", False) == (D0, 7)
    assert one("backward", True) == (D0 - timedelta(2), 3) and one("forward", True) == (None, None)


def test_gaps(spark):
    i = spark.createDataFrame([(1, date(2020, 1, 1), date(2020, 12, 31)), (1, date(2021, 1, 1), date(2021, 2, 1)), (1, date(2020, 3, 1), date(2020, 4, 1)), (1, date(2021, 3, 1), date(2021, 3, 9)), (2, D0, D0)], "c int, s date, e date")
    assert [tuple(r) for r in intervals.gaps(i, ["c"], "s", "e").collect()] == [(1, date(2021, 2, 1), date(2021, 3, 1))]


def grid(spark, img):
    return spark.createDataFrame([(r, k, int(v)) for r, row in enumerate(img) for k, v in enumerate(row)], "row int, col int, value int")


def flood(img):
    out, seen = {}, set()
    for r, k in zip(*np.nonzero(img), strict=True):
        if (r, k) in seen:
            continue
        todo, part = [(r, k)], []
        seen.add((r, k))
        while todo:
            a, b = todo.pop()
            part.append((a, b))
            for n in ((a + 1, b), (a - 1, b), (a, b + 1), (a, b - 1)):
                if 0 <= n[0] < img.shape[0] and 0 <= n[1] < img.shape[1] and img[n] and n not in seen:
                    seen.add(n)
                    todo.append(n)
        for p in part:
            out[p] = min(part)
    return out


def test_connected_components(spark):
    img = (np.random.default_rng(5).random((17, 23)) < 0.55).astype(int)
    want = flood(img)
    got = segments.connected(grid(spark, img), [], F.col("value") == 1, 23).collect()
    assert {(r["row"], r["col"]): len(want) and r["segment"] for r in got} == {p: q[0] * 23 + min(k for (a, k), root in want.items() if root == q and a == q[0]) for p, q in want.items()}


def test_focal_and_textures(spark):
    img = np.random.default_rng(3).integers(0, 9, (9, 11))
    pad = np.pad(img, 2, mode="symmetric")
    mean = {(r["row"], r["col"]): r["focal"] for r in focal.focal_mean(grid(spark, img), [], 2, 9, 11).collect()}
    assert all(abs(mean[r, k] - pad[r : r + 5, k : k + 5].mean()) < 1e-9 for r in range(9) for k in range(11))
    pad = np.pad(img, 1, mode="reflect")
    g = grid(spark, img).withColumnRenamed("value", "gray")
    got = focal.pair_textures(g, [], 1, 9, 11, ["entropy", "contrast", "correlation"], 8, block=4).collect()
    assert len(got) == 99
    for r in got:
        win = pad[r["row"] : r["row"] + 3, r["col"] : r["col"] + 3]
        m = np.zeros((9, 9))
        for a, b in zip(win[:, :-1].ravel(), win[:, 1:].ravel(), strict=True):
            m[a, b] += 1
            m[b, a] += 1
        m /= m.sum()
        i, j = np.indices(m.shape)
        assert abs(r["entropy"] + (m * np.log2(m + 1e-10)).sum()) < 1e-9 and abs(r["contrast"] - ((i - j) ** 2 * m).sum()) < 1e-9


def test_rules_in_order(spark):
    rows = spark.createDataFrame([(1, y, k) for y, k in enumerate([74, 110, 74, 30, 74])], "px int, year int, class int").withColumn("base_forest", F.lit(221)).withColumn("base_grass", F.lit(75))
    got = rules.apply_rules(rows, ["px"], ["wetgrass-crop", "wetgrass-built"]).orderBy("year")
    assert [r["class"] for r in got.collect()] == [74] * 5
    assert len(rules.RULES) == 23


def test_masks_fail_when_missing(spark):
    df = spark.createDataFrame([("a", 1, 5), ("b", 1, 6)], "scene string, row int, v int")
    mask = spark.createDataFrame([("a", 1, 2)], "scene string, row int, mask int")
    got = masks.apply_mask(df, mask, ["scene", "row"], ["v"], 2, 3)
    assert {r["scene"]: r["v"] for r in got.collect()} == {"a": None, "b": 6}
    with pytest.raises(masks.MaskError):
        masks.apply_mask(df, mask, ["scene", "row"], ["v"], 2, 3, missing="fail")


def test_upsert(spark):
    old = spark.createDataFrame([("1", "a", "n"), ("1", "b", "y")], "grid string, step string, status string")
    new = spark.createDataFrame([("1", "a", "y")], old.schema)
    assert sorted(tuple(r) for r in catalog.merged(old, new, ["grid", "step"]).collect()) == [("1", "a", "y"), ("1", "b", "y")]


def test_row_order_does_not_matter(spark):
    v = [500, 4000, 900, 7000, 300, 8000, 200]
    a = pheno.significant_change(days(spark, v), ["px"], -800).collect()
    b = pheno.significant_change(days(spark, v).repartition(3).orderBy(F.rand(1)), ["px"], -800).collect()
    assert a == b


def test_season_features(spark):
    """All features against plain Python."""
    import random

    r = random.Random(12)
    data = {px: [r.choice([int(3000 + 2500 * math.sin(i / r.choice([2, 3])) + r.randint(0, 900)), r.randint(1, 6000)]) for i in range(r.randint(3, 40))] for px in range(60)}
    df = spark.createDataFrame([(px, D0 + timedelta(5 * i), v) for px, s in data.items() for i, v in enumerate(s)], "px int, date date, value int")
    day = lambda i: (D0 + timedelta(5 * i)).timetuple().tm_yday
    for row in pheno.season_features(df, ["px"], 1).collect():
        v = data[row["px"]]
        base = float(np.median([x for x in v if x > 0]))
        up = [i for i, x in enumerate(suppress(v, base, False)) if x >= base + 500]
        down = [i for i, x in enumerate(suppress(v, base, True)) if x <= base - 500]
        mid = int(base)
        posd, posv = (day(up[0]), v[up[0]]) if up else (0, mid)
        tosd, tosv = (day(down[-1]), v[down[-1]]) if down else (0, mid)
        amp = posv - tosv if up and down else mid - tosv if down else posv - mid if up else 0
        sos = eos = None
        if up:
            b, a = range(up[0]), range(up[0] + 1, len(v))
            sos = max((i for i in b if v[i] < 2000), default=min(b, default=None))
            eos = min((i for i in a if v[i] < 2000), default=max(a, default=None))
        sosd, eosd = (day(i) if i is not None else 0 for i in (sos, eos))
        rate = lambda i, d: 0 if d == 0 or posd == d else int((posv - v[i]) / (posd - d))  # noqa: B023, E731
        want = (len(up), posd, posv, len(down), tosd, tosv, max(amp, 0), sosd, eosd, rate(sos, sosd), rate(eos, eosd), 0 if 0 in (sosd, eosd) else eosd - sosd)
        got = tuple(row[c] for c in ("numrot", "posd", "posv", "numlow", "tosd", "tosv", "p1amp", "sosd", "eosd", "rog", "ros", "los"))
        assert got == want, row["px"]


def test_nearest_and_sides(spark):
    """Ties of days and values, and both sides at once, against plain Python."""
    import random

    r = random.Random(13)
    obs = [(r.randint(0, 3), D0 + timedelta(r.randint(0, 30)), r.choice([None, -5, 7, 9, 11])) for _ in range(60)]
    ev = [(r.randint(0, 4), i, D0 + timedelta(r.randint(0, 30))) for i in range(80)]
    o, e = spark.createDataFrame(obs, "px int, date date, value int"), spark.createDataFrame(ev, "px int, id int, day date")
    near = {x["id"]: (x["near_day"], x["near_value"]) for x in joins.nearest(e, o, ["px"], "day", "date", "value").collect()}
    sides = {x["id"]: (x["pre_day"], x["pre"], x["post_day"], x["post"]) for x in joins.pre_post(e, o, ["px"], "day", "date", "value").collect()}
    for px, i, day in ev:
        mine = [(d, v) for p, d, v in obs if p == px and v is not None]
        best = min(mine, key=lambda x: (abs((x[0] - day).days), x[0], -x[1]), default=(None, None))  # noqa: B023
        assert near[i] == best
        good = [x for x in mine if x[1] > 0]
        a = max((x for x in good if x[0] < day), default=(None, None))
        b = min((x for x in good if x[0] >= day), key=lambda x: (x[0], -x[1]), default=(None, None))
        assert sides[i] == (*a, *b)
