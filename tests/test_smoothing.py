"""Smoothers, preparation, reconstruction, basins and blending against plain NumPy."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest

from gridloom.operators import focal, fusion, models, pheno, segments, series

R = np.random.default_rng(3)
X = np.sort(R.choice(np.arange(1, 700), 60, replace=False)).astype(np.int64)
Y = 3000 + 1500 * np.sin(2 * np.pi * X / 365.25) + R.normal(0, 120, 60)
OUT = np.arange(20, 680, 13)


def test_savitzky_golay_and_lowess():
    for half, degree, tricube, f in ((15.5, 2, False, series.savitzky_golay), (15.5, 1, True, series.lowess)):
        z = f(X, Y, OUT)
        for t, got in zip(OUT, z, strict=True):
            d = np.abs(X - t)
            near = np.flatnonzero(d <= half)
            if len(near) > degree:
                w = np.maximum((1 - np.minimum(d[near] / half, 1) ** 3) ** 3, 1e-6) if tricube else np.ones(len(near))
                fit = np.polynomial.polynomial.polyfit(X[near] - t, Y[near], degree, w=np.sqrt(w))
                assert got == pytest.approx(fit[0], rel=1e-6)


def test_harmonics():
    k = 3
    a = lambda t: np.column_stack([np.ones(len(t)), t, *(f(2 * np.pi * i * t / 365.25) for i in range(1, k + 1) for f in (np.cos, np.sin))])
    coef = np.linalg.pinv(a(X.astype(float))) @ Y
    assert series.harmonic(X, Y, OUT) == pytest.approx(a(OUT.astype(float)) @ coef, rel=1e-6)


def test_cubic_spline():
    """Through all values, smooth at them, straight at the ends."""
    assert series.cubic_spline(X, Y, X) == pytest.approx(Y)
    fine = np.linspace(X[0], X[-1], 40001)
    z = series.cubic_spline(X, Y, fine)
    h = fine[1] - fine[0]
    second = np.diff(z, 2) / h**2
    assert np.abs(np.diff(second)).max() < 0.02 * np.abs(second).max()
    assert abs(second[0]) < 0.01 * np.abs(second).max() and abs(second[-1]) < 0.01 * np.abs(second).max()


def test_gaussian_process():
    k = lambda a, b: math.exp(-((a - b) ** 2) / (2 * 30.0**2))
    big = np.array([[k(a, b) + 0.1 * (i == j) for j, b in enumerate(X)] for i, a in enumerate(X)])
    weights = np.linalg.inv(big) @ (Y - Y.mean())
    want = [Y.mean() + sum(k(t, a) * w for a, w in zip(X, weights, strict=True)) for t in OUT]
    assert series.gaussian_process(X, Y, OUT) == pytest.approx(want, rel=1e-6)


def test_double_logistic():
    """A curve of its own kind is found again."""
    x = np.arange(0, 365, 9)
    u = x / 360
    y = 1500 + 4000 * (1 / (1 + np.exp(-14 * (u - 0.3))) - 1 / (1 + np.exp(-16 * (u - 0.72))))
    assert np.abs(series.double_logistic(x, y, x) - y).max() < 40
    assert (series.double_logistic(x[:5], y[:5], x[:5]) == y[:5]).all()


def test_envelope_and_dynamic():
    y = Y.copy()
    y[10::7] -= 1200
    upper, plain = series.envelope(X, y, X), series.savitzky_golay(X, y, X, 61)
    assert (upper >= plain - 1e-6).mean() > 0.9 and upper[10::7].mean() > y[10::7].mean() + 400
    z = series.dynamic_temporal(X, y, OUT)
    for t, got in zip(OUT, z, strict=True):
        d = np.abs(X - t)
        half = max(15.5, np.sort(d)[6] + 1)
        near = d < half
        w = (1 - (d[near] / half) ** 3) ** 3 * np.where(y[near] < np.median(y[near]) * 0.8, 0.05, 1.0)
        fit = np.polynomial.polynomial.polyfit(X[near] - t, y[near], 1, w=np.sqrt(w))
        assert got == pytest.approx(fit[0], rel=1e-6)


def slow_spikes(x, y, days, limit):
    return [0 < i < len(x) - 1 and x[i] - x[i - 1] <= days and x[i + 1] - x[i] <= days and abs(y[i] - (line := y[i - 1] + (y[i + 1] - y[i - 1]) * (x[i] - x[i - 1]) / (x[i + 1] - x[i - 1]))) > limit * abs(line) for i in range(len(x))]


def slow_prepared(x, y, low=50.0, extreme=0.0, limits=(0.1, 0.2)):
    v = {a: b for a, b in zip(x, y, strict=True) if b > low}
    missing = [a for a in x if a not in v]
    keys = sorted(v)
    spikes = [k for k, s in zip(keys, slow_spikes(keys, [v[k] for k in keys], 120, limits[0]), strict=True) if s]
    for k in spikes:
        del v[k]
    filled = {}
    for t in missing + spikes:
        near = []
        for a, b in v.items():
            turns = round((a - t) / 365.25)
            if 1 <= abs(turns) <= 2 and abs(a - t - 365.25 * turns) <= 30:
                near.append(b)
        if len(near) >= 2:
            filled[t] = float(np.mean(near))
    v |= filled
    if extreme:
        m = float(np.median(list(v.values())))
        v = {a: b for a, b in v.items() if (b - m) / m <= extreme}
    keys = sorted(v)
    bad = slow_spikes(keys, [v[k] for k in keys], 120, limits[1])
    return [(k, v[k]) for k, s in zip(keys, bad, strict=True) if not s]


@pytest.mark.parametrize("extreme", [0.0, 0.4])
def test_prepared(extreme):
    r = random.Random(2)
    for _ in range(40):
        x = sorted(r.sample(range(1500), r.randint(1, 90)))
        y = [r.choice([0, 10, 2000 + 500 * math.sin(a / 58), r.randint(100, 9000), 2000 + 500 * math.sin(a / 58)]) for a in x]
        got = series.prepared(np.array(x), np.array(y, float), extreme=extreme)
        want = slow_prepared(x, y, extreme=extreme)
        assert got[0].tolist() == [a for a, _ in want] and got[1] == pytest.approx([b for _, b in want])


def test_reconstructed_by_year(spark):
    """Each year from its padded slice alone, on its own days; what is done is left out."""
    r = random.Random(5)
    d0 = date(2000, 1, 1)
    data = {px: {d0 + timedelta(i): r.randint(100, 9000) for i in r.sample(range(900), 60)} for px in range(4)}
    df = spark.createDataFrame([(px, d, v) for px, s in data.items() for d, v in s.items()], "px int, date date, value int")
    days = {2000: [date(2000, 3, 1), date(2000, 9, 14)], 2001: [date(2001, 3, 1), date(2001, 12, 1)]}
    slices = {y: (date(y, 1, 1) - timedelta(30), date(y, 12, 31) + timedelta(30), days[y]) for y in days}
    done = spark.createDataFrame([(2, 2000)], "px int, year int")
    got = {(x["px"], x["year"], x["date"]): x["value"] for x in series.reconstructed(df, ["px"], slices, "wh", done=done).collect()}
    want = {}
    for px, s in data.items():
        for y, (a, b, out) in slices.items():
            if (px, y) != (2, 2000):
                x = sorted(d for d in s if a <= d <= b)
                x, v = series.prepared(np.array([d.toordinal() for d in x]), np.array([s[d] for d in x], float))
                want |= {(px, y, d): z for d, z in zip(out, series.whittaker(x, v, np.array([d.toordinal() for d in out])), strict=True)}
    assert got.keys() == want.keys()
    assert {k: pytest.approx(v, rel=1e-4) for k, v in want.items()} == got


def test_basins():
    """One marker a basin, all of the mask that a marker reaches, and a ridge between two hills parts them."""
    i, j = np.mgrid[0:20, 0:30]
    h = np.maximum(10 - np.hypot(i - 10, j - 7), 10 - np.hypot(i - 10, j - 22))
    got = segments.flooded(h, np.ones((20, 30), np.int64), 7)
    near = np.hypot(i - 10, j - 7) < np.hypot(i - 10, j - 22) - 1.5
    assert set(np.unique(got)) == {1, 2} and len(np.unique(got[near])) == 1 and (got[near][0] != got[10, 22])
    mask = (R.random((20, 30)) > 0.4).astype(np.int64)
    got = segments.flooded(h, mask, 5)
    assert ((got > 0) <= (mask > 0)).all()
    for k in np.unique(got[got > 0]):  # every basin hangs together
        todo, seen = [tuple(np.argwhere(got == k)[0])], set()
        while todo:
            a, b = todo.pop()
            if (a, b) in seen or not (0 <= a < 20 and 0 <= b < 30) or got[a, b] != k:
                continue
            seen.add((a, b))
            todo += [(a - 1, b), (a + 1, b), (a, b - 1), (a, b + 1)]
        assert len(seen) == (got == k).sum()


def test_blended(spark):
    n, half = 9, 2
    fine, then, now = (R.integers(0, 5000, (n, n)).astype(float) for _ in range(3))
    f = spark.createDataFrame([(i, j, float(fine[i, j])) for i in range(n) for j in range(n)], "row int, col int, value double")
    c = spark.createDataFrame([(i, j, float(then[i, j]), float(now[i, j])) for i in range(n) for j in range(n)], "row int, col int, then double, now double")
    got = {(r["row"], r["col"]): r["blended"] for r in fusion.blended(f, c, [], half).collect()}
    for i in range(n):
        for j in range(n):
            up = down = 0.0
            for a in range(max(0, i - half), min(n, i + half + 1)):
                for b in range(max(0, j - half), min(n, j + half + 1)):
                    w = 1 / ((abs(fine[a, b] - then[a, b]) + 1e-4) * (abs(now[a, b] - then[a, b]) + 1e-4) * (1 + math.hypot(a - i, b - j) / half))
                    up, down = up + w * (fine[a, b] + now[a, b] - then[a, b]), down + w
            assert got[i, j] == pytest.approx(up / down)


def test_most_probable_sequence(spark):
    """Against all sequences."""
    import itertools

    r = random.Random(9)
    classes, stay = [1, 2, 3], 0.7
    data = {px: [[r.random() for _ in classes] for _ in range(5)] for px in range(12)}
    df = spark.createDataFrame([(px, y, *p) for px, ps in data.items() for y, p in enumerate(ps)], "px int, year int, p1 double, p2 double, p3 double")
    got = {}
    for row in models.temporal_classes(df, ["px"], "year", classes, ["p1", "p2", "p3"], stay).collect():
        got.setdefault(row["px"], {})[row["year"]] = row["class"]
    move = (1 - stay) / (len(classes) - 1)
    for px, ps in data.items():
        score = lambda s: sum(math.log(max(ps[y][k], 1e-12)) for y, k in enumerate(s)) + sum(math.log(stay if a == b else move) for a, b in zip(s, s[1:], strict=False))  # noqa: B023, E731
        best = max(itertools.product(range(3), repeat=5), key=score)
        assert [got[px][y] for y in range(5)] == [classes[k] for k in best]


def test_glcm_pair_textures():
    """Properties of a matrix against sums over its cells."""
    p = R.random((4, 4))
    p = (p + p.T) / (p + p.T).sum()
    got = focal.glcm_properties(p, ["entropy", "asm", "energy", "variance", "std", "correlation", "contrast", "dissimilarity", "homogeneity"])
    cells = [(i, j, p[i, j]) for i in range(4) for j in range(4)]
    mean = sum(i * v for i, _, v in cells)
    var = sum((i - mean) ** 2 * v for i, _, v in cells)
    want = {
        "entropy": -sum(v * math.log2(v + 1e-10) for *_, v in cells), "asm": sum(v * v for *_, v in cells), "energy": math.sqrt(sum(v * v for *_, v in cells)), "variance": var, "std": math.sqrt(var),
        "correlation": sum((i - mean) * (j - mean) * v for i, j, v in cells) / var, "contrast": sum((i - j) ** 2 * v for i, j, v in cells), "dissimilarity": sum(abs(i - j) * v for i, j, v in cells),
        "homogeneity": sum(v / (1 + (i - j) ** 2) for i, j, v in cells),
    }
    assert {k: float(v) for k, v in got.items()} == pytest.approx(want)


def test_derivative_greenup_and_senescence(spark):
    d0 = date(2020, 1, 1)
    r = random.Random(7)
    data = {px: [int(3000 + 2500 * math.sin(i / 8) + r.randint(-300, 300)) for i in range(40)] for px in range(10)}
    df = spark.createDataFrame([(px, d0 + timedelta(3 * i), v) for px, s in data.items() for i, v in enumerate(s)], "px int, date date, value int")
    peak = spark.createDataFrame([(px, d0 + timedelta(3 * (s.index(max(s[8:20]))))) for px, s in data.items()], "px int, first_date date")
    for before, f, day in ((True, pheno.greenup, "sos"), (False, pheno.senescence, "eos")):
        for row in f(df, peak, ["px"], "deriv").collect():
            s = data[row["px"]]
            top = s.index(max(s[8:20]))
            part = list(enumerate(s))[:top] if before else list(enumerate(s))[top + 1 :]
            v = np.array([x for _, x in part], float)
            g = np.gradient(v, 3.0) if len(v) > 1 else np.zeros(len(v))
            hit = [k for k in range(len(v)) if (g[k] > 0 if before else g[k] < 0)]
            mid = float(np.median(v[hit]))
            best = min(hit, key=lambda k: (abs(v[k] - mid), k))  # noqa: B023
            assert row[day] == d0 + timedelta(3 * part[best][0])
