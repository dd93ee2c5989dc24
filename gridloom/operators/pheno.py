"""Change events, peaks and the seasons around them, on window functions over one sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import season_day
from .series import by, by_falling, forward_fill
from .stats import trunc, valid

LOW, HIGH = 0, 10000


def significant_change(
    df: DataFrame, keys: list[str], threshold: int, pre: tuple[int, int] = (LOW, HIGH), post: tuple[int, int] = (LOW, HIGH), fill: int = 2,
    normalize: str | None = None, value: str = "value", day: str = "date", season: tuple[int, int] | None = None,
) -> DataFrame:
    """keys, events (number), first_date, first_doy, change (largest value at an event, 0 if none).

    first_doy is 0 without an event, on the day of the year of the last image, and outside ``season``, the first and last
    day of the year without the padding of the series (the first after the last goes over the turn of the year).

    An event is a drop (a rise for a positive threshold) from the image before
    that still holds, at 0.7 of the threshold, two images later, and against the
    second and third image before.  Where the image and the one before it were
    missing, a drop that shows three images later does not count.
    """
    w, every = by(keys, day), Window.partitionBy(*keys)
    rows = df.withColumn("gl_v", valid(value).cast("double"))
    if normalize:
        mean, dev = F.avg("gl_v").over(every), F.stddev_pop("gl_v").over(every)
        rows = rows.withColumn("gl_v", F.col("gl_v") - mean if normalize == "0m" else (F.col("gl_v") - mean) / F.when(dev != 0, dev))
    rows = rows.withColumn("gl_gap", F.col("gl_v").isNull()).withColumn("gl_f", forward_fill("gl_v", keys, fill, day))
    if threshold > 0:
        rows = rows.withColumn("gl_f", LOW + HIGH - F.col("gl_f"))
        pre, post, threshold = (LOW + HIGH - pre[1], LOW + HIGH - pre[0]), (LOW + HIGH - post[1], LOW + HIGH - post[0]), -threshold
    within = lambda limits: F.when((F.col("gl_f") > limits[0]) & (F.col("gl_f") < limits[1]), F.col("gl_f"))
    rows = rows.withColumn("gl_pre", within(pre)).withColumn("gl_post", within(post))
    after = [F.coalesce(F.lead("gl_post", k).over(w) if k else F.col("gl_post"), F.lit(HIGH)) for k in range(4)]
    before = [None, *(F.coalesce(F.lag("gl_pre", k).over(w), F.lit(LOW)) for k in (1, 2, 3))]
    weak = 0.7 * threshold
    kept = (
        (after[0] - before[1] <= threshold) & (after[1] - before[1] <= weak) & (after[2] - before[1] <= weak)
        & (after[0] - before[2] < weak) & (after[0] - before[3] < weak)
    )
    doubt = F.col("gl_gap") & F.coalesce(F.lag("gl_gap").over(w), F.lit(False)) & (after[3] - before[1] <= weak)
    rows = rows.withColumn("gl_hit", F.coalesce(kept & ~doubt & (F.col("gl_f") > LOW), F.lit(False)))
    rows = rows.withColumn("gl_last", F.max(day).over(every))
    first = F.min(F.when(F.col("gl_hit"), F.col(day)))
    out = rows.groupBy(*keys).agg(
        F.count_if("gl_hit").alias("events"), first.alias("first_date"), trunc(F.coalesce(F.max(F.when(F.col("gl_hit"), F.col("gl_f"))), F.lit(0))).alias("change"), F.max("gl_last").alias("gl_last")
    )
    doy = F.coalesce(F.dayofyear("first_date"), F.lit(0))
    inside = F.lit(True)
    if season:
        inside = (doy >= season[0]) & (doy <= season[1]) if season[0] < season[1] else (doy >= season[0]) | (doy <= season[1])
    return out.withColumn("first_doy", F.when((doy == F.dayofyear("gl_last")) | ~inside, F.lit(0)).otherwise(doy)).drop("gl_last")


def as_frequency(events: DataFrame, freq: str) -> Column:
    """A change event as ``bi``, ``count``, ``doy`` or ``mo``; no event is 0."""
    if freq == "bi":
        return F.when(F.col("events") > 0, 1).otherwise(0)
    if freq == "count":
        return F.col("events")
    return F.col("first_doy") if freq == "doy" else F.when(F.col("first_doy") == 0, 0).otherwise(F.month("first_date"))


def suppressed(df: DataFrame, keys: list[str], rounds: int, inverted: bool, day: str, name: str = "gl_c") -> DataFrame:
    """``name`` after ``rounds`` of suppression by the neighbours t steps ahead and behind."""
    w, mark = by(keys, day), 10000 if inverted else 1
    lost = 32767 if inverted else 0
    for t in range(1, rounds + 1):
        for step in (F.lead, F.lag):
            other = step(name, t).over(w)
            against = F.col(name) - F.coalesce(other, F.lit(lost))
            flat = F.coalesce(step(name, t - 1).over(w) == mark, F.lit(False)) if t >= 2 else F.lit(False)
            keep = (against <= 0 if inverted else against >= 0) | (F.col(name) == mark) | flat
            df = df.withColumn(name, F.when(keep, F.col(name)).otherwise(lost))
    return df


def marked_peaks(df: DataFrame, keys: list[str], sigdif: int, inverted: bool, rounds: int, value: str, day: str, name: str) -> DataFrame:
    """``name``: struct(d, v) at peaks (troughs) at least ``sigdif`` past ``gl_base``, which is there; null elsewhere."""
    v = F.col(value)
    if inverted:
        start = F.when((v < F.col("gl_base")) & (v > 0), v.cast("double")).otherwise(F.lit(10000.0))
    else:
        start = F.when(v > F.col("gl_base"), v.cast("double")).otherwise(F.lit(1.0))
    rows = suppressed(df.withColumn(name, start), keys, rounds, inverted, day, name)
    past = F.col(name) <= F.col("gl_base") - sigdif if inverted else F.col(name) >= F.col("gl_base") + sigdif
    return rows.withColumn(name, F.when(past, F.struct(F.col(day).alias("d"), v.alias("v"))))


def with_base(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``gl_base``: the median of a series' positive values."""
    return df.withColumn("gl_base", F.median(F.when(F.col(value) > 0, F.col(value))).over(Window.partitionBy(*keys)))


def peaks(df: DataFrame, keys: list[str], sigdif: int = 500, inverted: bool = False, rounds: int = 9, value: str = "value", day: str = "date") -> DataFrame:
    """keys, n, first_date, first_value, last_date, last_value, base: peaks (troughs) at least ``sigdif`` past the median of positive values."""
    rows = marked_peaks(with_base(df, keys, value), keys, sigdif, inverted, rounds, value, day, "gl_c")
    out = rows.groupBy(*keys).agg(F.count("gl_c").alias("n"), F.min("gl_c").alias("gl_a"), F.max("gl_c").alias("gl_b"), F.max("gl_base").alias("base"))
    return out.select(*keys, "n", F.col("gl_a.d").alias("first_date"), F.col("gl_a.v").alias("first_value"), F.col("gl_b.d").alias("last_date"), F.col("gl_b.v").alias("last_value"), "base")


def derivative(keys: list[str], value: str = "value", day: str = "date") -> Column:
    """Slope a day at each image: second-order where it has both neighbours, else one-sided."""
    w = by(keys, day)
    before, after = F.lag(value).over(w), F.lead(value).over(w)
    a, b = F.datediff(day, F.lag(day).over(w)), F.datediff(F.lead(day).over(w), F.col(day))
    v = F.col(value)
    middle = (a * a * after + (b * b - a * a) * v - b * b * before) / (a * b * (a + b))
    return F.coalesce(middle, (after - v) / b, (v - before) / a)


def peaks_by_derivative(df: DataFrame, keys: list[str], least: int = 3000, base: int = 1000, value: str = "value", day: str = "date", plain: int = 3000) -> DataFrame:
    """keys, n, first_date of peaks.

    A maximum is where the slope turns from rising to falling at ``least`` or more, a minimum where it turns to rising at ``base`` or
    less.  Values at these are carried on to the next one (and back to the beginning); a maximum is a peak where that line steps by
    ``least`` - ``base`` or more from the image before, or not at all.  Without a peak the largest value counts as one if it is
    ``plain`` or more.  Series that stay below ``base`` have none.
    """
    w = by(keys, day)
    rows = df.withColumn("gl_g", derivative(keys, value, day))
    before = F.lag("gl_g").over(w)
    rows = rows.withColumn("gl_top", F.coalesce((F.col("gl_g") < 0) & (before > 0) & (F.col(value) >= least), F.lit(False)))
    rows = rows.withColumn("gl_turn", F.when(F.col("gl_top") | ((F.col("gl_g") > 0) & (before < 0) & (F.col(value) <= base)), F.col(value)))
    last, following = F.last("gl_turn", ignorenulls=True).over(w), F.last("gl_turn", ignorenulls=True).over(by_falling(keys, day))
    rows = rows.withColumn("gl_line", F.coalesce(last, following))
    step = F.abs(F.col("gl_line") - F.lag("gl_line").over(w))
    rows = rows.withColumn("gl_peak", F.coalesce(F.col("gl_top") & ((step >= least - base) | (step == 0)), F.lit(False)))
    best = F.min(F.when(F.col(value) >= plain, F.struct((-F.col(value)).alias("v"), F.col(day).alias("d"))))
    out = rows.groupBy(*keys).agg(F.count_if("gl_peak").alias("gl_n"), F.min(F.when(F.col("gl_peak"), F.col(day))).alias("gl_first"), best.alias("gl_best"), F.max(value).alias("gl_most"))
    n = F.when(F.coalesce(F.col("gl_most") < base, F.lit(True)), 0).when(F.col("gl_n") > 0, F.col("gl_n")).when(F.col("gl_best").isNotNull(), 1).otherwise(0)
    return out.select(*keys, n.cast("long").alias("n"), F.coalesce("gl_first", F.col("gl_best.d")).alias("first_date"))


def greenup(df: DataFrame, peak: DataFrame, keys: list[str], method: str = "thresh", limit: int = 2000, value: str = "value", day: str = "date") -> DataFrame:
    """keys, sos, sosv before the first peak: the last image below ``limit`` (thresh), the first fall (step), or the image whose value is nearest to the median of rising ones (deriv); else the first image."""
    rows = df.join(peak.select(*keys, F.col("first_date").alias("peak")), keys).filter(F.col(day) < F.col("peak"))
    return _side(rows, keys, method, limit, value, day, before=True)


def senescence(df: DataFrame, peak: DataFrame, keys: list[str], method: str = "thresh", limit: int = 2000, value: str = "value", day: str = "date") -> DataFrame:
    """keys, eos, eosv after the first peak: the first image below ``limit`` (thresh), the first rise (step), or as in greenup for falling ones (deriv); else the last image."""
    rows = df.join(peak.select(*keys, F.col("first_date").alias("peak")), keys).filter(F.col(day) > F.col("peak"))
    return _side(rows, keys, method, limit, value, day, before=False)


def _side(rows: DataFrame, keys: list[str], method: str, limit: int, value: str, day: str, before: bool) -> DataFrame:
    at = F.struct(F.col(day).alias("d"), F.col(value).alias("v"))
    step = F.col(value) - F.lag(value).over(by(keys, day))
    if method == "thresh":
        rows = rows.withColumn("hit", F.col(value) < limit)
        pick = F.max if before else F.min
    elif method == "step":
        rows = rows.withColumn("hit", F.coalesce(step < 0 if before else step > 0, F.lit(False)))
        pick = F.min
    else:
        g = derivative(keys, value, day)
        rows = rows.withColumn("g", g).withColumn("hit", F.col("g") > 0 if before else F.col("g") < 0)
        mid = F.median(F.when(F.col("hit"), F.col(value))).over(Window.partitionBy(*keys))
        rows = rows.withColumn("far", F.when(F.col("hit"), F.abs(F.col(value) - mid)))
        out = rows.groupBy(*keys).agg(F.min(F.when(F.col("hit"), F.struct("far", at.alias("at")))).alias("m"))
        return out.select(*keys, F.col("m.at.d").alias("sos" if before else "eos"), F.col("m.at.v").alias("sosv" if before else "eosv"))
    found, none = pick(F.when(F.col("hit"), at)), (F.min if before else F.max)(at)
    out = rows.groupBy(*keys).agg(F.coalesce(found, none).alias("at"))
    return out.select(*keys, F.col("at.d").alias("sos" if before else "eos"), F.col("at.v").alias("sosv" if before else "eosv"))


def season_features(df: DataFrame, keys: list[str], first_day: int, sigdif: int = 500, value: str = "value", day: str = "date", rounds: int = 9, limit: int = 2000) -> DataFrame:
    """numrot, posd, posv, numlow, tosd, tosv, p1amp, sosd, sosv, eosd, eosv, rog, ros, los by key; 0 (values: the median) where there is no peak.

    Peaks and troughs are marked in one order of the series; the first peak then parts its images, and one aggregation
    gives all features.
    """
    rows = with_base(df, keys, value)
    for name, inverted in (("gl_up", False), ("gl_down", True)):
        rows = marked_peaks(rows, keys, sigdif, inverted, rounds, value, day, name)
    rows = rows.withColumn("gl_first", F.min("gl_up").over(Window.partitionBy(*keys)))
    at, peak = F.struct(F.col(day).alias("d"), F.col(value).alias("v")), F.col("gl_first.d")
    before, after, under = F.col(day) < peak, F.col(day) > peak, F.col(value) < limit
    both = rows.groupBy(*keys).agg(
        F.count("gl_up").alias("numrot"), F.max("gl_first").alias("gl_p"), F.max("gl_base").alias("gl_m"), F.count("gl_down").alias("numlow"), F.max("gl_down").alias("gl_t"),
        F.coalesce(F.max(F.when(before & under, at)), F.min(F.when(before, at))).alias("gl_s"), F.coalesce(F.min(F.when(after & under, at)), F.max(F.when(after, at))).alias("gl_e"),
    )
    names = {"pd": "gl_p.d", "pv": "gl_p.v", "td": "gl_t.d", "tv": "gl_t.v", "sos": "gl_s.d", "sosv": "gl_s.v", "eos": "gl_e.d", "eosv": "gl_e.v"}
    both = both.select(*keys, "numrot", "numlow", trunc(F.col("gl_m")).alias("mid"), *(F.col(c).alias(n) for n, c in names.items()))
    has, low = F.col("numrot") > 0, F.col("numlow") > 0
    date_or_0 = lambda c, ok: F.when(ok, F.coalesce(season_day(F.col(c), first_day), F.lit(0))).otherwise(0)
    both = both.withColumn("posd", date_or_0("pd", has)).withColumn("posv", F.when(has, F.col("pv")).otherwise(F.col("mid")))
    both = both.withColumn("tosd", date_or_0("td", low)).withColumn("tosv", F.when(low, F.col("tv")).otherwise(F.col("mid")))
    amp = F.when(low & has, F.col("posv") - F.col("tosv")).when(low, F.col("mid") - F.col("tosv")).otherwise(F.col("posv") - F.col("mid"))
    both = both.withColumn("p1amp", F.when((amp > 0) & (has | low), amp).otherwise(0))
    both = both.withColumn("sosd", date_or_0("sos", has & F.col("sos").isNotNull())).withColumn("eosd", date_or_0("eos", has & F.col("eos").isNotNull()))
    rate = lambda v, d: F.when((F.col(d) == 0) | (F.col("posd") == F.col(d)), 0).otherwise(trunc((F.col("posv") - F.col(v)) / F.when(F.col("posd") != F.col(d), F.col("posd") - F.col(d))))
    both = both.withColumn("rog", rate("sosv", "sosd")).withColumn("ros", rate("eosv", "eosd"))
    both = both.withColumn("los", F.when((F.col("sosd") == 0) | (F.col("eosd") == 0), 0).otherwise(F.col("eosd") - F.col("sosd")))
    return both.select(*keys, "numrot", "posd", "posv", "numlow", "tosd", "tosv", "p1amp", "sosd", "sosv", "eosd", "eosv", "rog", "ros", "los")
