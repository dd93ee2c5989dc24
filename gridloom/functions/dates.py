"""Day-of-year and year keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_day(date: Column) -> Column:
    """YYYYDDD as an integer."""
    return (F.year(date) * 1000 + F.dayofyear(date)).cast("int")


def from_year_day(key: Column) -> Column:
    return F.date_add(F.make_date(F.floor(key / 1000).cast("int"), F.lit(1), F.lit(1)), (key % 1000 - 1).cast("int"))


def month_of_day(year: Column, doy: Column) -> Column:
    """Month of a day of the year; 0 (no event) stays 0."""
    return F.when(doy == 0, F.lit(0)).otherwise(F.month(F.date_add(F.make_date(year, F.lit(1), F.lit(1)), doy - 1)))


def season_day(date: Column, start_day: int) -> Column:
    """Day of the year, 365 later where the season has gone into the next year."""
    d = F.dayofyear(date)
    return F.when(d < start_day, d + 365).otherwise(d)


def start_day(first_month: int) -> int:
    return int(30.5 * first_month) - 30


def cosine_day(day: Column) -> Column:
    """Truncated 100 (cos(2 pi day / 365) + 1), so that the year has no seam."""
    return (100 * (F.cos(2 * F.pi() * day / 365) + 1)).cast("int")


def day_distance(a: Column, b: Column) -> Column:
    """Days between days of the year, across the turn of the year if that is shorter."""
    d = F.abs(F.dayofyear(a) - F.dayofyear(b))
    return F.least(d, 365 - d)
