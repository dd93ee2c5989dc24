"""Pixel series: same-day scenes, fills, regular dates, smoothing.

A series is a table with key columns, a date and a value.  Windows partition by
the key, so one exchange serves a whole chain of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by(keys: list[str], day: str = "date"):
    return Window.partitionBy(*keys).orderBy(day)


def by_falling(keys: list[str], day: str = "date"):
    """From each image on to the last: what comes after is behind in this order, so that a frame grows row by row."""
    return Window.partitionBy(*keys).orderBy(F.col(day).desc()).rowsBetween(Window.unboundedPreceding, 0)


#: Rows of a task where series are dealt out by their number.
TASK_ROWS = 300_000


def tasks(df: DataFrame) -> int:
    """Tasks for the series of a table: they grow with its rows, so that what one of them holds does not."""
    return max(df.sparkSession.sparkContext.defaultParallelism, df.count() // TASK_ROWS + 1)


def merge_same_day(df: DataFrame, keys: list[str], value: Column, day: str = "date", name: str = "value", parts: int | None = None) -> DataFrame:
    """Scenes of one day merged by the largest value of an index; with ``parts`` in as many tasks by key, which what follows by key goes on in."""
    rows = df.select(*keys, day, value.alias(name))
    return (rows.repartition(parts, *keys) if parts else rows).groupBy(*keys, day).agg(F.max(name).alias(name))


def merge_same_day_bands(df: DataFrame, keys: list[str], bands: list[str], day: str = "date") -> DataFrame:
    """Scenes of one day merged by the largest value of each band, before an index."""
    return df.groupBy(*keys, day).agg(*(F.max(b).alias(b) for b in bands))


def one_a_day(df: DataFrame, keys: list[str], order: str, keep: str = "last", day: str = "date") -> DataFrame:
    """The last (or first) row of each day in the order of a column."""
    c = F.col(order).desc() if keep == "last" else F.col(order).asc()
    return df.withColumn("gl_n", F.row_number().over(Window.partitionBy(*keys, day).orderBy(c))).filter("gl_n = 1").drop("gl_n")


def every_nth(df: DataFrame, keys: list[str], n: int, offset: int = 0, day: str = "date") -> DataFrame:
    """Images 0 + offset, n + offset, ... of each series by date."""
    return df.withColumn("gl_n", F.row_number().over(by(keys, day)) - 1).filter(F.col("gl_n") % n == offset).drop("gl_n")


def drop_every_second(df: DataFrame, keys: list[str], day: str = "date") -> DataFrame:
    """All but the images at positions 1, 3, 5, ..."""
    return every_nth(df, keys, 2, 0, day)


def shift(value: str, keys: list[str], by_n: int, fill: float | int | None = None, day: str = "date") -> Column:
    """The value ``by_n`` images earlier (later if negative)."""
    c = F.lag(value, by_n).over(by(keys, day)) if by_n >= 0 else F.lead(value, -by_n).over(by(keys, day))
    return c if fill is None else F.coalesce(c, F.lit(fill))


def forward_fill(value: str | Column, keys: list[str], limit: int | None = None, day: str = "date") -> Column:
    """The last value that is not null, at most ``limit`` images back."""
    frame = by(keys, day).rowsBetween(Window.unboundedPreceding if limit is None else -limit, 0)
    return F.last(value, ignorenulls=True).over(frame)


def backward_fill(value: str | Column, keys: list[str], limit: int | None = None, day: str = "date") -> Column:
    """The next value that is not null, at most ``limit`` images on."""
    if limit is None:
        return F.last(value, ignorenulls=True).over(by_falling(keys, day))
    return F.first(value, ignorenulls=True).over(by(keys, day).rowsBetween(0, limit))


def nulls_in_last(value: str, keys: list[str], n: int, day: str = "date") -> Column:
    """How many of the last ``n`` images are null; null while there are fewer images."""
    w = by(keys, day)
    count = F.sum(F.col(value).isNull().cast("int")).over(w.rowsBetween(1 - n, 0))
    return F.when(F.row_number().over(w) >= n, count)


def interpolated(value: str, keys: list[str], day: str = "date") -> Column:
    """Nulls by the straight line between their neighbours in time; at the ends the nearest value."""
    w = by(keys, day)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(day).alias("d"), F.col(value).cast("double").alias("v")))
    before = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    after = F.last(known, ignorenulls=True).over(by_falling(keys, day))
    span = F.datediff(after["d"], before["d"])
    part = F.datediff(F.col(day), before["d"]) / F.when(span > 0, span)
    line = before["v"] + (after["v"] - before["v"]) * part
    return F.when(F.col(value).isNotNull(), F.col(value).cast("double")).otherwise(F.coalesce(line, before["v"], after["v"]))


def regridded(df: DataFrame, keys: list[str], dates: DataFrame, value: str = "value", day: str = "date") -> DataFrame:
    """Values on the days of ``dates`` by linear interpolation.  The days of a calendar are few, so they are broadcast."""
    grid = df.select(*keys).distinct().crossJoin(F.broadcast(dates.select(F.col("date").alias(day), F.lit(True).alias("wanted"))))
    rows = df.select(*keys, day, F.col(value).cast("double").alias(value), F.lit(False).alias("wanted")).unionByName(grid.withColumn(value, F.lit(None).cast("double")))
    rows = rows.groupBy(*keys, day).agg(F.max(value).alias(value), F.max("wanted").alias("wanted"))
    return rows.withColumn(value, interpolated(value, keys, day)).filter("wanted").drop("wanted")


def _fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c rounded once: the error of the product and that of the sum are added at the end."""

    def halves(v: Column) -> tuple[Column, Column]:
        high = 134217729.0 * v - (134217729.0 * v - v)
        return high, v - high

    (ah, al), (bh, bl), p = halves(a), halves(b), a * b
    lost = ((ah * bh - p) + ah * bl + al * bh) + al * bl
    s = p + c
    t = s - p
    return s + (((p - (s - t)) + (c - t)) + lost)


def _quantile(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """``value`` as the quantile of its series between the two nearest ranks, to the last digit as DuckDB gives it, since a digit decides where a
    value meets a limit."""
    every = Window.partitionBy(*keys)
    rows = df.withColumns({"gl_i": F.row_number().over(every.orderBy(F.col(value).asc_nulls_last())) - 1, "gl_at": (F.count(value).over(every) - 1) * F.lit(q)})
    rank = lambda r: F.max(F.when(F.col("gl_i") == r, F.col(value).cast("double"))).over(every)
    rows = rows.withColumns({"gl_lo": rank(F.floor("gl_at")), "gl_hi": rank(F.ceil("gl_at"))})
    d = F.col("gl_at") - F.floor("gl_at")
    return rows.withColumn(value, _fused(F.col("gl_lo"), 1.0 - d, F.col("gl_hi") * d)).drop("gl_i", "gl_at", "gl_lo", "gl_hi")


def low_values_to_zero(df: DataFrame, keys: list[str], value: str = "value", gap: float = 0.25) -> DataFrame:
    """Values below the 5th percentile by more than a share of it become 0."""
    return df.withColumn("gl_p", F.col(value)).transform(_quantile, keys, "gl_p", 0.05).withColumn(value, F.when((F.col(value) < F.col("gl_p")) & ((F.col("gl_p") - F.col(value)) > gap * F.col("gl_p")), F.lit(0)).otherwise(F.col(value))).drop("gl_p")


def far_from_median(df: DataFrame, keys: list[str], value: str = "value", limit: float = 0.5) -> DataFrame:
    """``extreme``: whether a value lies further from its series' median than a share of it."""
    m = F.median(value).over(Window.partitionBy(*keys))
    return df.withColumn("gl_m", m).withColumn("extreme", F.abs(F.col(value) - F.col("gl_m")) > limit * F.abs(F.col("gl_m"))).drop("gl_m")


def clamped(value: Column, fitted: Column, limit: float) -> Column:
    """A value no further from the fitted one than ``limit``."""
    return F.least(F.greatest(value, fitted - limit), fitted + limit)


def side_by_side(parts: dict[str, DataFrame], keys: list[str], value: str = "value", day: str = "date") -> DataFrame:
    """keys, day and a column for each index: series from several places, one row a key and day that any of them has; of rows that repeat a day the largest value."""
    every = None
    for name, df in parts.items():
        rows = df.select(*keys, day, F.lit(name).alias("gl_si"), F.col(value).cast("double").alias("gl_v"))
        every = rows if every is None else every.unionByName(rows)
    return every.groupBy(*keys, day).agg(*(F.max(F.when(F.col("gl_si") == name, F.col("gl_v"))).alias(name) for name in parts))


# Smoothers: functions of days and values (no nulls) to values on output days.


def whittaker_rows(xs: list[np.ndarray], ys: list[np.ndarray], out: np.ndarray, penalty: float = 100.0) -> np.ndarray:
    """Penalised least squares (second differences) on a daily grid, for many series at once: [series, out].

    The matrix of each series has five bands, so it is solved by one sweep over
    the days and one back, each step for all series together.
    """
    first = min(int(out[0]), min(int(x[0]) for x in xs))
    n = max(int(out[-1]), max(int(x[-1]) for x in xs)) + 1 - first
    w, z = np.zeros((n, len(xs))), np.zeros((n, len(xs)))
    for i, (x, y) in enumerate(zip(xs, ys, strict=True)):
        np.add.at(z[:, i], x - first, y)
        np.add.at(w[:, i], x - first, 1)
    z = np.divide(z, w, out=np.zeros_like(z), where=w > 0)
    w = (w > 0).astype(float)
    if n < 3:
        return np.repeat((z.sum(axis=0) / w.sum(axis=0))[:, None], len(out), axis=1)
    diag, near, far = np.zeros(n), np.zeros(n), np.full(n, penalty)  # of penalty D'D
    for k, c in ((0, 1.0), (1, -2.0), (2, 1.0)):
        diag[k : n - 2 + k] += penalty * c * c
    near[: n - 2] += -2 * penalty
    near[1 : n - 1] += -2 * penalty
    far[n - 2 :] = 0
    near[n - 1 :] = 0
    d, c, e = np.empty_like(w), np.zeros_like(w), np.zeros_like(w)
    zero = np.zeros(len(xs))
    for t in range(n):
        c1, e1, d1 = (c[t - 1], e[t - 1], d[t - 1]) if t else (zero, zero, zero)
        e2, d2 = (e[t - 2], d[t - 2]) if t > 1 else (zero, zero)
        d[t] = w[t] + 1e-9 + diag[t] - c1 * c1 * d1 - e2 * e2 * d2
        c[t] = (near[t] - d1 * c1 * e1) / d[t]
        e[t] = far[t] / d[t]
        z[t] = w[t] * z[t] - c1 * (z[t - 1] if t else 0) - e2 * (z[t - 2] if t > 1 else 0)
    for t in reversed(range(n)):
        z[t] = z[t] / d[t] - c[t] * (z[t + 1] if t + 1 < n else 0) - e[t] * (z[t + 2] if t + 2 < n else 0)
    return z[out - first].T


def whittaker(x: np.ndarray, y: np.ndarray, out: np.ndarray, penalty: float = 100.0) -> np.ndarray:
    return whittaker_rows([x], [y], out, penalty)[0]


def savitzky_golay(x: np.ndarray, y: np.ndarray, out: np.ndarray, window: int = 31, degree: int = 2) -> np.ndarray:
    """A polynomial through the values within half a window of each day."""
    return _local(x, y, out, window / 2, degree, lambda u: np.ones_like(u))


def lowess(x: np.ndarray, y: np.ndarray, out: np.ndarray, window: int = 31) -> np.ndarray:
    """A line with tricube weights."""
    return _local(x, y, out, window / 2, 1, lambda u: (1 - np.minimum(np.abs(u), 1) ** 3) ** 3)


def _local(x, y, out, half, degree, weight) -> np.ndarray:
    z = np.empty(len(out))
    for i, t in enumerate(out):
        d = x - t
        near = np.abs(d) <= half
        h = half
        if near.sum() <= degree:
            near = np.argsort(np.abs(d), kind="stable")[: degree + 2]
            h = max(np.abs(d[near]).max() * 1.001, 1)
        w = np.sqrt(np.maximum(weight(d[near] / h), 1e-6))
        a = np.vander(d[near] / max(h, 1), degree + 1, increasing=True)
        z[i] = np.linalg.lstsq(a * w[:, None], y[near] * w, rcond=None)[0][0]
    return z


def harmonic(x: np.ndarray, y: np.ndarray, out: np.ndarray, orders: int = 3) -> np.ndarray:
    """A line and waves of a year and its parts, as many as the values allow."""
    k = max(0, min(orders, (len(x) - 2) // 2))

    def waves(t: np.ndarray) -> np.ndarray:
        a = [np.ones(len(t)), (t - x[0]) / 365.25]
        for i in range(1, k + 1):
            a += [np.cos(2 * np.pi * i * t / 365.25), np.sin(2 * np.pi * i * t / 365.25)]
        return np.stack(a, axis=1)

    return waves(out) @ np.linalg.lstsq(waves(x), y, rcond=None)[0]


def linear(x: np.ndarray, y: np.ndarray, out: np.ndarray) -> np.ndarray:
    return np.interp(out, x, y)


def cubic_spline(x: np.ndarray, y: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The natural cubic spline."""
    if len(x) < 3:
        return np.interp(out, x, y)
    h = np.diff(x).astype(float)
    a = np.zeros((len(x), len(x)))
    b = np.zeros(len(x))
    a[0, 0] = a[-1, -1] = 1
    i = np.arange(1, len(x) - 1)
    a[i, i - 1], a[i, i], a[i, i + 1] = h[:-1], 2 * (h[:-1] + h[1:]), h[1:]
    b[1:-1] = 6 * (np.diff(y)[1:] / h[1:] - np.diff(y)[:-1] / h[:-1])
    m = np.linalg.solve(a, b)
    t = np.clip(out, x[0], x[-1])
    j = np.clip(np.searchsorted(x, t, side="right") - 1, 0, len(x) - 2)
    l, r = t - x[j], x[j + 1] - t  # noqa: E741
    return (m[j] * r**3 + m[j + 1] * l**3) / (6 * h[j]) + (y[j] / h[j] - m[j] * h[j] / 6) * r + (y[j + 1] / h[j] - m[j + 1] * h[j] / 6) * l


def gaussian_process(x: np.ndarray, y: np.ndarray, out: np.ndarray, scale: float = 30.0, noise: float = 0.1) -> np.ndarray:
    """The mean of a Gaussian process with a squared-exponential kernel, about the series' mean."""
    k = lambda a, b: np.exp(-0.5 * ((a[:, None] - b[None, :]) / scale) ** 2)
    return y.mean() + k(out, x) @ np.linalg.solve(k(x, x) + noise * np.eye(len(x)), y - y.mean())


#: Derivatives that are held at once where double logistic curves are fitted.
FIT_CELLS = 2_000_000


def double_logistic_rows(xs: list[np.ndarray], ys: list[np.ndarray], out: np.ndarray, steps: int = 40) -> np.ndarray:
    """Rise and fall by two logistic curves, fitted by damped least squares, for many series at once: [series, out]; a line where it does not fit."""
    z, sizes = np.empty((len(xs), len(out))), np.array([len(x) for x in xs])
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)  # series of one length are fitted together
        step = max(1, FIT_CELLS // (6 * max(int(n), len(out))))
        for k in range(0, len(at), step):
            some = at[k : k + step]
            if n < 7:
                z[some] = [np.interp(out, xs[i], ys[i]) for i in some]
            else:
                z[some] = _double_logistic(np.stack([xs[i] for i in some]), np.stack([ys[i] for i in some]), out, steps)
    return z


def _double_logistic(x: np.ndarray, y: np.ndarray, out: np.ndarray, steps: int) -> np.ndarray:
    span = (x[:, -1:] - x[:, :1]).astype(float)
    span[span == 0] = 1.0
    rise = lambda p, k, t: 1 / (1 + np.exp(-np.clip(p[:, k + 1, None] * (t - p[:, k, None]), -50, 50)))
    f = lambda p, t: p[:, 0, None] + p[:, 1, None] * (rise(p, 2, t) - rise(p, 4, t))
    u, v = (x - x[:, :1]) / span, (out - x[:, :1]) / span
    s = len(x)
    p = np.stack([y.min(axis=1), np.ptp(y, axis=1), *(np.full(s, c) for c in (0.3, 12.0, 0.7, 12.0))], axis=1)
    damp, best, moved = np.full(s, 1e-2), ((f(p, u) - y) ** 2).sum(axis=1), np.arange(s)
    g, down, diag = np.empty((s, 6, 6)), np.empty((s, 6)), np.arange(6)
    for _ in range(steps):
        if len(moved):  # elsewhere the derivatives are those of the step before
            q, t, e = p[moved], u[moved], np.maximum(np.abs(p[moved]), 1) * 1e-5
            j = np.empty((*t.shape, 6))
            for k in range(6):
                d = np.where(diag == k, e, 0.0)
                j[:, :, k] = (f(q + d, t) - f(q - d, t)) / (2 * e[:, k, None])
            g[moved] = j.transpose(0, 2, 1) @ j
            down[moved] = (j.transpose(0, 2, 1) @ (y[moved] - f(q, t))[:, :, None])[:, :, 0]
        a = g.copy()
        a[:, diag, diag] += damp[:, None] * (g[:, diag, diag] + 1e-9)
        q = p + np.linalg.solve(a, down[:, :, None])[:, :, 0]
        err = ((f(q, u) - y) ** 2).sum(axis=1)
        better = err < best
        moved = np.flatnonzero(better)
        p[moved], best[moved] = q[moved], err[moved]
        damp = np.where(better, damp / 3, damp * 4)
    return f(p, v)


def double_logistic(x: np.ndarray, y: np.ndarray, out: np.ndarray, steps: int = 40) -> np.ndarray:
    return double_logistic_rows([x], [y], out, steps)[0]


def envelope(x: np.ndarray, y: np.ndarray, out: np.ndarray, passes: int = 3, window: int = 61) -> np.ndarray:
    """Adaptive upper envelope: local fits to values that are lifted to the fit before."""
    z = y.astype(float)
    for _ in range(passes):
        z = np.maximum(z, savitzky_golay(x, z, x, window))
    return savitzky_golay(x, z, out, window)


def dynamic_temporal(x: np.ndarray, y: np.ndarray, out: np.ndarray, window: int = 31, least: int = 7, outlier: float = 0.2) -> np.ndarray:
    """Local lines whose window widens until it holds ``least`` values; values far below the local median weigh little."""
    z = np.empty(len(out))
    for i, t in enumerate(out):
        d = np.abs(x - t)
        half = max(window / 2, np.sort(d)[min(least, len(d)) - 1] + 1)
        near = d < half
        v = y[near]
        w = (1 - (d[near] / half) ** 3) ** 3 * np.where(v < np.median(v) * (1 - outlier), 0.05, 1.0)
        a = np.stack([np.ones(near.sum()), (x[near] - t) / half], axis=1) * np.sqrt(w)[:, None]
        z[i] = np.linalg.lstsq(a, v * np.sqrt(w), rcond=None)[0][0]
    return z


SMOOTHERS: dict[str, Callable] = {
    "dts": dynamic_temporal, "csp": cubic_spline, "lw": lowess, "wh": whittaker, "ac": envelope, "harm": harmonic,
    "gpr": gaussian_process, "sg": savitzky_golay, "dbl": double_logistic, "linear": linear,
}
#: Smoothers that take many series at once.
MANY: dict[str, Callable] = {"wh": whittaker_rows, "dbl": double_logistic_rows}


def spikes(x: np.ndarray, y: np.ndarray, days: int = 120, limit: float = 0.1, rounds: int = 1) -> np.ndarray:
    """Which values lie off the line between their neighbours, both within ``days``, by more than a share ``limit`` of it; a round drops those found before."""
    out = np.zeros(len(x), bool)
    for _ in range(rounds):
        at = np.flatnonzero(~out)
        if len(at) < 3:
            break
        a, b, c = at[:-2], at[1:-1], at[2:]
        line = y[a] + (y[c] - y[a]) * (x[b] - x[a]) / (x[c] - x[a])
        off = (x[b] - x[a] <= days) & (x[c] - x[b] <= days) & (np.abs(y[b] - line) > limit * np.abs(line))
        out[b[off]] = True
    return out


#: Pairs of a missing and a known value that are compared at once.
FILL_CELLS = 250_000


def prefilled(x: np.ndarray, y: np.ndarray, days: int = 30, years: int = 2, least: int = 2) -> np.ndarray:
    """Missing values (nan) as the mean of the values within ``days`` of the same day of the year in at most ``years`` years before
    or after, where there are ``least`` of them; others stay missing."""
    out, known, missing = y.copy(), np.flatnonzero(~np.isnan(y)), np.flatnonzero(np.isnan(y))
    step = max(1, FILL_CELLS // max(len(known), 1))
    for at in range(0, len(missing), step):  # all pairs of a missing and a known value in blocks
        some = missing[at : at + step]
        away = x[known] - x[some, None]
        turns = np.round(away / 365.25)
        near = (np.abs(away - 365.25 * turns) <= days) & (np.abs(turns) >= 1) & (np.abs(turns) <= years)
        n = near.sum(axis=1)
        filled = n >= least
        out[some[filled]] = np.where(near[filled], y[known], 0.0).sum(axis=1) / n[filled]
    return out


def prepared(x: np.ndarray, y: np.ndarray, low: float = 50.0, prefill: bool = True, outliers: bool = True, extreme: float = 0.0, limits: tuple[float, float] = (0.1, 0.2), days: int = 120, fill_days: int = 30, fill_years: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Days and values that a smoother gets, in the order of the steps: values up to ``low`` are missing; spikes beyond the first of
    ``limits`` are, and gaps are filled from other years (prefill); values above the median by more than a share ``extreme`` are
    missing (0: none); spikes beyond the second limit go (outliers); what is missing goes."""
    y = np.where(y <= low, np.nan, y.astype(float))
    some = np.flatnonzero(~np.isnan(y))
    if prefill and len(some):
        y[some[spikes(x[some], y[some], days, limits[0])]] = np.nan
        y = prefilled(x, y, fill_days, fill_years)
        some = np.flatnonzero(~np.isnan(y))
    if extreme and len(some):
        middle = np.median(y[some])
        y[some[(y[some] - middle) / middle > extreme]] = np.nan
        some = np.flatnonzero(~np.isnan(y))
    if outliers and len(some):
        y[some[spikes(x[some], y[some], days, limits[1])]] = np.nan
        some = np.flatnonzero(~np.isnan(y))
    return x[some], y[some]


def _fitted(method: str, xs: list[np.ndarray], ys: list[np.ndarray], days: np.ndarray, least: int, **options) -> list[np.ndarray]:
    """Values of many series on the output days; series with fewer than ``least`` values by straight lines, those without any as nan."""
    fit = SMOOTHERS[method]
    long = [i for i, x in enumerate(xs) if len(x) >= least]
    z = [np.interp(days, x, y) if len(x) else np.full(len(days), np.nan) for x, y in zip(xs, ys, strict=True)]
    if long and method in MANY:
        for i, row in zip(long, MANY[method]([xs[i] for i in long], [ys[i] for i in long], days, **options), strict=True):
            z[i] = row
    else:
        for i in long:
            z[i] = fit(xs[i], ys[i], days, **options)
    return z


def reconstructed(
    df: DataFrame, keys: list[str], slices: dict[int, tuple[date, date, list[date]]], method: str = "wh", value: str = "value", day: str = "date", least: int = 3,
    steps: dict | None = None, done: DataFrame | None = None, **options,
) -> DataFrame:
    """keys, year, date, value: series smoothed year by year.

    ``slices`` gives for each year the first and last day of its padded slice and its output days; a value is in every slice that holds
    its day.  ``steps`` are options of ``prepared``.  Keys and years in ``done`` are left out, so a run goes on where another ended.
    Series without a value left in a slice give none.
    """
    out_days = {year: np.array([d.toordinal() for d in days], np.int64) for year, (_, _, days) in slices.items()}
    epoch, steps = date(1970, 1, 1).toordinal(), steps or {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for year, rows in b.groupby("year", sort=False):
                for at in range(0, len(rows), 500):
                    some = rows.iloc[at : at + 500]
                    made = [prepared(np.asarray(x, np.int64) + epoch, np.asarray(y, float), **steps) for x, y in zip(some["gl_x"], some["gl_y"], strict=True)]
                    z = _fitted(method, [m[0] for m in made], [m[1] for m in made], out_days[year], least, **options)
                    keep = [i for i, m in enumerate(made) if len(m[0])]
                    days = (out_days[year] - epoch).tolist()
                    yield some[[*keys, "year"]].iloc[keep].assign(gl_d=[days] * len(keep), gl_z=[z[i] for i in keep])

    years = [F.struct(F.lit(y).alias("y"), F.lit(a).alias("a"), F.lit(b).alias("b")) for y, (a, b, _) in slices.items()]
    held = F.filter(F.array(*years), lambda s: (F.col(day) >= s["a"]) & (F.col(day) <= s["b"]))
    rows = df.filter(F.col(value).isNotNull()).withColumn("year", F.explode(F.transform(held, lambda s: s["y"])))
    if done is not None:
        rows = rows.join(done.select(*keys, "year").distinct(), [*keys, "year"], "left_anti")
    pairs = F.sort_array(F.collect_list(F.struct(F.unix_date(day).alias("x"), F.col(value).cast("double").alias("y"))))  # of one series and year
    rows = rows.groupBy(*keys, "year").agg(pairs.alias("p")).select(*keys, "year", F.col("p.x").alias("gl_x"), F.col("p.y").alias("gl_y"))
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    out = rows.mapInPandas(run, schema + ", year int, gl_d array<int>, gl_z array<double>")
    each = F.explode(F.arrays_zip(F.col("gl_d").alias("d"), F.col("gl_z").alias("v"))).alias("p")
    return out.select(*keys, "year", each).select(*keys, "year", F.date_from_unix_date("p.d").alias("date"), F.col("p.v").alias("value"))


def spatio_temporal(df: DataFrame, keys: list[str], value: str = "value", day: str = "date", half: int = 1, steps: int = 1, time: float = 1.0, colour: float = 1000.0, space: float = 1.0) -> DataFrame:
    """``value`` as the mean of the pixels around it, ``half`` each way, on the ``steps`` images before and after, weighed by normal curves of
    their distance in images, in value and in pixels; missing neighbours have no weight, missing values stay missing."""
    at = lambda along, k: Window.partitionBy(*keys, day, "col" if along == "row" else "row").orderBy(along).rangeBetween(k, k)
    span, own = range(-half, half + 1), Window.partitionBy(*keys, "row", "col").orderBy(day)
    rows = df.withColumn("gl_line", F.array(*(F.first(F.col(value).cast("double")).over(at("col", k)) for k in span)))
    rows = rows.withColumn("gl_box", F.array(*(F.first("gl_line").over(at("row", k)) for k in span)))
    times = {s: F.lag("gl_box", -s).over(own) if s < 0 else F.lead("gl_box", s).over(own) if s else F.col("gl_box") for s in range(-steps, steps + 1)}
    rows = rows.withColumns({f"gl_t{s + steps}": c for s, c in times.items()})
    total, weights = F.lit(0.0), F.lit(0.0)
    for s in range(-steps, steps + 1):
        for i, r in enumerate(span):
            for j, c in enumerate(span):
                v = F.get(F.get(F.col(f"gl_t{s + steps}"), F.lit(i)), F.lit(j))
                away = float(np.exp(-0.5 * ((s / time) ** 2 + (r * r + c * c) / space**2)))
                w = away * F.exp(-0.5 * F.pow((v - F.col(value)) / colour, F.lit(2)))
                total, weights = total + F.coalesce(w * v, F.lit(0.0)), weights + F.coalesce(w, F.lit(0.0))
    names = ["gl_line", "gl_box", *(f"gl_t{s}" for s in range(2 * steps + 1))]
    return rows.withColumn(value, F.when(F.col(value).isNotNull(), total / weights)).drop(*names)


def smoothed(df: DataFrame, keys: list[str], out_dates: list[date], method: str = "wh", value: str = "value", day: str = "date", least: int = 3, parts: int | None = None, **options) -> DataFrame:
    """Series on regular days: keys, date, value.

    Each series is one row with two arrays, so the Python side gets whole
    batches of series and no group is a call of its own. Series go to
    ``parts`` tasks (None: by the number of rows, which are counted): their
    bytes are few, so Spark by itself would put the fits of all in one task.
    """
    days = np.array([d.toordinal() for d in out_dates], np.int64)
    epoch, step = date(1970, 1, 1).toordinal(), 4000 if method == "dbl" else 500

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), step):
                some = b.iloc[at : at + step]
                xs, ys = [np.asarray(x, np.int64) + epoch for x in some["gl_x"]], [np.asarray(y, float) for y in some["gl_y"]]
                yield some[keys].assign(gl_z=_fitted(method, xs, ys, days, least, **options))

    pairs = F.sort_array(F.collect_list(F.struct(F.unix_date(day).alias("x"), F.col(value).cast("double").alias("y"))))
    rows = df.filter(F.col(value).isNotNull()).repartition(parts or tasks(df), *keys).groupBy(*keys).agg(pairs.alias("p")).select(*keys, F.col("p.x").alias("gl_x"), F.col("p.y").alias("gl_y"))
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    out = rows.mapInPandas(run, schema + ", gl_z array<double>")
    dates = F.array(*(F.lit(d) for d in out_dates))
    return out.select(*keys, F.explode(F.arrays_zip(dates.alias("date"), F.col("gl_z").alias("value"))).alias("p")).select(*keys, "p.date", "p.value")
