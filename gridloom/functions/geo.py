"""Grid and projection arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latitude bands of 8 degrees from 80 south.
BAND_LETTERS = "CDEFGHJKLMNPQRSTUVWXX"


def utm_zone(lon: Column, lat: Column) -> Column:
    """UTM zone with the exceptions of Norway and Svalbard."""
    plain = (F.floor((lon + 180) / 6) % 60 + 1).cast("int")
    north = lat.between(72, 84)
    return (
        F.when(lat.between(56, 63.999999) & lon.between(3, 11.999999), F.lit(32))
        .when(north & (lon >= 0) & (lon < 9), F.lit(31)).when(north & (lon >= 9) & (lon < 21), F.lit(33))
        .when(north & (lon >= 21) & (lon < 33), F.lit(35)).when(north & (lon >= 33) & (lon < 42), F.lit(37))
        .otherwise(plain)
    )


def utm_letter(lat: Column) -> Column:
    return F.when(lat.between(-80, 84), F.substr(F.lit(BAND_LETTERS), (F.floor((lat + 80) / 8) + 1).cast("int"), F.lit(1)))


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat < 0, F.lit(32700)).otherwise(F.lit(32600)) + utm_zone(lon, lat)


def snapped(x: Column, step: float, up: bool = False) -> Column:
    """The edge of the grid at or below (up: at or above) a coordinate."""
    return (F.ceil(x / step) if up else F.floor(x / step)) * step


def cell_of(x: Column, y: Column, size: float) -> list[Column]:
    return [F.floor(x / size).cast("long"), F.floor(y / size).cast("long")]


def pixel_of(x: Column, y: Column, x0: float, y0: float, res: float) -> list[Column]:
    """Row and column of the pixel that holds a point; rows count down from the top."""
    return [F.floor((y0 - y) / res).cast("int"), F.floor((x - x0) / res).cast("int")]
