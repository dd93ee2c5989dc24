"""Seasons and regular dates."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.grammar import MONTHS, expand_seasons


@dataclass(frozen=True)
class Calendar:
    """The first month of a year and the days of the year on which wet and dry seasons begin and end."""

    first_month: int = 6
    wet: tuple[int, int] = (306, 61)
    dry: tuple[int, int] = (183, 259)

    def year(self, year: int) -> tuple[date, date]:
        start = date(year, self.first_month, 1)
        return start, start + timedelta(364)

    def season(self, name: str, year: int, pad: tuple[int, int] = (0, 0)) -> tuple[date, date]:
        """First and last day.  A quarter ends on the day on which the next begins."""
        start, end = self.year(year)
        if name == "yr":
            first, last = start, end
        elif name[:3] in MONTHS:
            a, b = MONTHS.index(name[:3]) + 1, MONTHS.index(name[-3:]) + 1
            of = lambda m: year if m >= self.first_month else year + 1
            first, last = date(of(a), a, 1), date(of(b), b, calendar.monthrange(of(b), b)[1])
        elif name[0] == "Q":
            q = int(name[1])
            first, last = start + timedelta(91 * (q - 1)), start + timedelta(91 * q)
        elif name in ("wet", "dry"):
            first, last = (self._day(d, year, end) for d in (self.wet if name == "wet" else self.dry))
        else:
            raise ValueError(f"not a season: {name}")
        return first - timedelta(pad[0]), last + timedelta(pad[1])

    @staticmethod
    def _day(day: int, year: int, end: date) -> date:
        late = date(year + 1, 1, 1) + timedelta(day - 1)
        return date(year, 1, 1) + timedelta(day - 1) if late > end else late

    def table(self, spark: SparkSession, names: list[str], years: list[int], pad: tuple[int, int] = (0, 0)) -> DataFrame:
        """season: name, year, start, end, start_pad, end_pad; one row a season and year."""
        every = [n for name in names for n in expand_seasons(name, self.first_month)]
        rows = [(n, y, *self.season(n, y), *self.season(n, y, pad)) for y in years for n in every]
        return spark.createDataFrame(rows, "name string, year int, start date, end date, start_pad date, end_pad date")

    def sql(self, names: list[str], years: list[int], pad: tuple[int, int] = (0, 0)) -> str:
        """The same table as SQL values."""
        every = [n for name in names for n in expand_seasons(name, self.first_month)]
        rows = ", ".join(
            f"('{n}', {y}, " + ", ".join(f"DATE '{d}'" for d in (*self.season(n, y), *self.season(n, y, pad))) + ")" for y in years for n in every
        )
        return f"(VALUES {rows}) season(name, year, \"start\", \"end\", start_pad, end_pad)"


def in_seasons(df: DataFrame, seasons: DataFrame, day: str = "date", padded: bool = False) -> DataFrame:
    """Rows of ``df`` once for every season that holds their day.

    Seasons, a few rows a year, are listed by the months that they touch and
    broadcast, so a row is compared with the seasons of its month only.
    """
    a, b = ("start_pad", "end_pad") if padded else ("start", "end")
    months = F.sequence(F.trunc(a, "month"), F.trunc(b, "month"), F.expr("interval 1 month"))
    listed = seasons.withColumn("gl_month", F.explode(months))
    return df.join(F.broadcast(listed), F.trunc(df[day], "month") == listed["gl_month"]).filter(F.col(day).between(F.col(a), F.col(b))).drop("gl_month")


def regular_dates(spark: SparkSession, start: date, end: date, skip: int) -> DataFrame:
    """Days on which ``day == 1`` or ``day % skip == 0``."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    return days.filter((F.day("date") == 1) | (F.day("date") % skip == 0))
