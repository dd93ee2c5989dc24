"""Gaps in intervals and observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def gaps(df: DataFrame, keys: list[str], start: str, end: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """keys, gap_start, gap_end: days between the furthest end so far and the next start.

    31 December to 1 January is no gap, nor is a single interval.  With ``first``
    and ``last`` the head and the tail of that period count too.
    """
    w = Window.partitionBy(*keys).orderBy(start, end)
    furthest = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("gl_e", furthest).withColumn("gl_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).filter("gl_n > 1")
    turn = (F.month("gl_e") == 12) & (F.day("gl_e") == 31) & (F.datediff(start, "gl_e") == 1)
    out = rows.filter((F.col(start) > F.col("gl_e")) & ~turn).select(*keys, F.col("gl_e").alias("gap_start"), F.col(start).alias("gap_end"))
    if first and last:
        ends = rows.groupBy(*keys).agg(F.min(start).alias("a"), F.max(end).alias("b"))
        a, b = F.lit(first).cast("date"), F.lit(last).cast("date")
        out = out.unionByName(ends.filter(F.col("a") > a).select(*keys, a.alias("gap_start"), F.col("a").alias("gap_end")))
        out = out.unionByName(ends.filter(F.col("b") < b).select(*keys, F.col("b").alias("gap_start"), b.alias("gap_end")))
    return out


def sessions(df: DataFrame, keys: list[str], day: str, most: int) -> DataFrame:
    """keys, session, first, last, n: runs of days no further apart than ``most``."""
    w = Window.partitionBy(*keys).orderBy(day)
    rows = df.withColumn("gl_new", F.when(F.datediff(day, F.lag(day).over(w)) > most, 1).otherwise(0))
    rows = rows.withColumn("session", F.sum("gl_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*keys, "session").agg(F.min(day).alias("first"), F.max(day).alias("last"), F.count(F.lit(1)).alias("n"))


def days_since_event(events: DataFrame, obs: DataFrame, key: str, event_day: str, day: str, value: str, before: int, after: int) -> DataFrame:
    """Last value in the ``before`` days up to the day before an event, first value in the ``after`` days from it on: key, event_day, pre, post.

    Observations meet events of their key within bins of days, so a long history is not paired with every event.
    """
    width = max(before, after) + 1
    e = events.select(key, event_day).distinct().withColumn("gl_b", F.floor(F.unix_date(event_day) / width))
    o = obs.filter(F.col(value).isNotNull()).select(key, F.col(day).alias("gl_d"), F.col(value).alias("gl_v"))
    o = o.withColumn("gl_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor(F.unix_date("gl_d") / width) + k)))
    both = e.join(o, [key, "gl_b"], "left").withColumn("gl_n", F.datediff("gl_d", event_day))
    pre = F.col("gl_n").between(-before, -1)
    post = F.col("gl_n").between(0, after)
    return both.groupBy(key, event_day).agg(
        F.max(F.when(pre, F.struct("gl_n", "gl_v")))["gl_v"].alias("pre"), F.min(F.when(post, F.struct("gl_n", "gl_v")))["gl_v"].alias("post")
    )
