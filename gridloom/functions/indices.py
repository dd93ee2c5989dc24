"""Spectral indices as column expressions over reflectance bands in 0 to 1.

``half`` maps a normalised difference from -1..1 to 0..1 and keeps an exact
zero, the missing value of the series.  Divisions by zero give 0.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BANDS = ("blue", "green", "red", "nir", "swir1", "swir2")
EPS = 1e-9
Index = Callable[[dict[str, Column], str | None], Column]


def half(ratio: Column) -> Column:
    return F.when(ratio == 0, F.lit(0.0)).otherwise((1 + ratio) / 2)


def over(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def normalised(a: Column, b: Column) -> Column:
    return (a - b) / (a + b + EPS)


def clipped(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def factor(param: str | None, default: float) -> float:
    """``50`` is 0.5 and ``n50`` is -0.5."""
    if not param:
        return default
    return -int(param[1:]) / 100 if param[0] == "n" else int(param) / 100


def evi2(b: dict[str, Column], param: str | None = None) -> Column:
    return over(2.5 * (b["nir"] - b["red"]), b["nir"] + factor(param, 1.0) + 2.4 * b["red"])


def savi(b: dict[str, Column], param: str | None = None) -> Column:
    f = factor(param, 0.5)
    whole = b["nir"] + b["red"] + f
    x = (1 + f) * ((b["nir"] - b["red"]) / F.when(whole == 0, F.lit(1e-10)).otherwise(whole))
    return half(x) if f >= 0 else F.when(x == 0, F.lit(0.0)).otherwise((clipped(x, -5.0, 5.0) + 5) / 10)


def burned(b: dict[str, Column], x: str, y: str, at: tuple[float, float]) -> Column:
    far = (at[0] - b[x]) * (at[0] - b[x]) + (at[1] - b[y]) * (at[1] - b[y])  # products are rounded once, powers of Java are not
    return F.when(b[x] + b[y] == 0, F.lit(0.0)).otherwise(over(F.lit(1.0), far))


def gemi(b: dict[str, Column], param: str | None = None) -> Column:
    n, r = b["nir"], b["red"]
    eta = (2 * (n * n - r * r) + 1.5 * n + 0.5 * r) / (n + r + 0.5)
    return eta * (1 - 0.25 * eta) - over(r - 0.125, 1 - r)


def wi(b: dict[str, Column], param: str | None = None) -> Column:
    s = b["swir1"] + b["red"]
    return F.when(s == 0, F.lit(0.0)).when(s > 0.5, F.lit(0.001)).otherwise(1 - s / 0.5)


def char(b: dict[str, Column], param: str | None = None) -> Column:
    x, y, z = b["blue"], b["green"], b["red"]
    most = F.greatest(F.abs(x - y), F.abs(x - z), F.abs(z - y))
    return F.when(x + y + z == 3, F.lit(0.0)).otherwise((x + y + z + most * 15) / 3)


def mirbi(b: dict[str, Column], param: str | None = None) -> Column:
    none = (F.abs(b["swir1"]) <= 1e-5) & (F.abs(b["swir2"]) <= 1e-5)
    return F.when(none, F.lit(0.0)).otherwise(0.2 * (10 * b["swir2"] - 9.8 * b["swir1"] + 2))


def msavi(b: dict[str, Column], param: str | None = None) -> Column:
    a = 2 * b["nir"] + 1
    return (a - F.sqrt(F.greatest(a * a - 8 * (b["nir"] - b["red"]), F.lit(0.0)))) / 2


def to_unit(x: Column, low: float, high: float) -> Column:
    """low..high as 0..1."""
    return (x - low) / (high - low)


def bare_soil(b: dict[str, Column]) -> Column:
    return (b["swir1"] + b["red"] - b["nir"] - b["blue"]) / (b["swir1"] + b["red"] + b["nir"] + b["blue"] + EPS)


def shadow(b: dict[str, Column], param: str | None = None) -> Column:
    dark = clipped((1 - b["blue"]) * (1 - b["green"]) * (1 - b["red"]), -2.0, 1.0)
    return to_unit(dark - to_unit(normalised(b["nir"], b["green"]), -1, 1) - to_unit(bare_soil(b), -1, 1), -2, 1)


def log_unit(x: Column) -> Column:
    """log of 0.01..1 as 0..1."""
    return clipped(to_unit(F.ln(F.greatest(x, F.lit(1e-9))), math.log(0.01), 0.0), 0.0, 1.0)


def log_product(a: str, b: str) -> Index:
    return lambda bands, param=None: clipped(log_unit(bands[a]) * log_unit(bands[b]), 0.0, 1.0)


#: name: (bands, expression)
INDICES: dict[str, tuple[tuple[str, ...], Index]] = {
    "ndvi": (("red", "nir"), lambda b, p=None: half(normalised(b["nir"], b["red"]))),
    "kndvi": (("red", "nir"), lambda b, p=None: F.tanh(F.pow(normalised(b["nir"], b["red"]), F.lit(2)))),
    "gcvi": (("green", "nir"), lambda b, p=None: clipped((b["nir"] / (b["green"] + EPS) - 1) / 10, 0.0, 1.0)),
    "evi2": (("red", "nir"), evi2),
    "savi": (("red", "nir"), savi),
    "msavi": (("red", "nir"), msavi),
    "msavi_v0": (("red", "nir"), lambda b, p=None: (2 * b["nir"] + 1) / 2 - ((2 * b["nir"] + 1) * (2 * b["nir"] + 1) - 8 * (b["nir"] - b["red"])) / 2),
    "nbr": (("nir", "swir2"), lambda b, p=None: half(normalised(b["nir"], b["swir2"]))),
    "nbr2": (("swir1", "swir2"), lambda b, p=None: half(normalised(b["swir1"], b["swir2"]))),
    "ndmi": (("nir", "swir1"), lambda b, p=None: half(normalised(b["swir1"], b["nir"]))),
    "ndmi_std": (("nir", "swir1"), lambda b, p=None: half(normalised(b["nir"], b["swir1"]))),
    "ndwi": (("green", "nir"), lambda b, p=None: half(normalised(b["nir"], b["green"]))),
    "ndwi_std": (("green", "nir"), lambda b, p=None: half(normalised(b["green"], b["nir"]))),
    "wi": (("red", "swir1"), wi),
    "bai": (("red", "nir"), lambda b, p=None: burned(b, "nir", "red", (0.06, 0.1))),
    "baim": (("nir", "swir2"), lambda b, p=None: burned(b, "nir", "swir2", (0.05, 0.2))),
    "mirbi": (("swir1", "swir2"), mirbi),
    "cai": (("swir1", "swir2"), lambda b, p=None: b["swir2"] / (b["swir1"] + EPS)),
    "gemi": (("red", "nir"), gemi),
    "char": (("blue", "green", "red"), char),
    "ndviV0": (("red", "nir"), lambda b, p=None: F.when(normalised(b["nir"], b["red"]) < 1e-6, F.lit(0.0)).otherwise(normalised(b["nir"], b["red"]))),
    "nbrV0": (("nir", "swir2"), lambda b, p=None: normalised(b["nir"], b["swir2"])),
    "ndmiV0": (("nir", "swir1"), lambda b, p=None: F.when(normalised(b["nir"], b["swir1"]) < 0, F.lit(0.01)).otherwise(normalised(b["nir"], b["swir1"]))),
    "hot": (("blue", "red"), lambda b, p=None: b["blue"] - 0.5 * b["red"] - 0.08),
    "haze": (("blue", "red"), lambda b, p=None: 1 - 1 / (1 + F.exp(20.0 * (b["blue"] - 0.5 * b["red"] - 0.08 + 0.075)))),
    "bsi": (("blue", "red", "nir", "swir1"), lambda b, p=None: to_unit(bare_soil(b), -1, 1)),
    "ndsi": (("green", "swir1"), lambda b, p=None: to_unit(normalised(b["green"], b["swir1"]), -1, 1)),
    "shi": (("blue", "green", "red", "nir", "swir1"), shadow),
    "shi2": (("blue", "green", "nir", "swir1"), lambda b, p=None: to_unit(b["blue"] + b["green"] - b["nir"] - b["swir1"], -2, 2)),
    "log_bg": (("blue", "green"), log_product("blue", "green")),
    "log_br": (("blue", "red"), log_product("blue", "red")),
    "log_bn": (("blue", "nir"), log_product("blue", "nir")),
    "log_bs1": (("blue", "swir1"), log_product("blue", "swir1")),
    "log_bs2": (("blue", "swir2"), log_product("blue", "swir2")),
    **{band: ((band,), lambda b, p=None, band=band: b[band]) for band in BANDS},
}


def index(name: str, bands: dict[str, str] | None = None) -> Column:
    """``name`` or ``name.param`` over columns named after the bands, or as ``bands`` maps them; missing input gives 0."""
    base, _, param = name.partition(".")
    needs, build = INDICES[base]
    cols = {b: F.col((bands or {}).get(b, b)) for b in needs}
    value = build(cols, param or None)
    return F.coalesce(F.when(F.isnan(value), F.lit(0.0)).otherwise(value), F.lit(0.0))


def reflectance(raw: Column, nodata: int = 65535, scale: float = 1e-4) -> Column:
    """Scaled integers as 0 to 1; nodata as 0."""
    return F.when(raw.isNull() | (raw == nodata), F.lit(0.0)).otherwise(clipped(raw * scale, 0.0, 1.0))


#: Bands of the point forms, the first in the place of nir.
POINT_BANDS = {
    "evi2": ("nir", "red"), "gcvi": ("nir", "green"), "ndvi": ("nir", "red"), "nbr": ("nir", "swir2"), "nbr2": ("swir1", "swir2"), "cai": ("swir1", "swir2"), "savi": ("nir", "red"),
    "msavi": ("nir", "red"), "ndmi": ("nir", "swir1"), "kndvi": ("nir", "red"), "bai": ("nir", "red"), "baim": ("nir", "swir2"), "gemi": ("nir", "red"), "ndwi": ("nir", "green"),
    "wi": ("swir1", "red"), "mirbi": ("swir1", "swir2"), "nir": ("nir", "nir"), "red": ("nir", "red"), "green": ("nir", "green"), "swir1": ("nir", "swir1"), "swir2": ("nir", "swir2"),
}


def point_index(name: str, most: int = 10_000, bands: dict[str, str] | None = None) -> Column:
    """``name`` or ``savi.param`` at a point, from bands in whole numbers below ``most`` (others are null, and so is the index).

    These forms are not those of images: gcvi is a normalised difference, ndmi and ndwi are scaled twice, wi takes bands in
    whole numbers as if they were shares, msavi halves its root's argument.
    """
    base, _, param = name.partition(".")
    s = float(most)
    n, b = (F.when(F.col((bands or {}).get(x, x)) < most, F.col((bands or {}).get(x, x)).cast("double")) for x in POINT_BANDS[base])
    diff = (n - b) / (n + b + EPS)
    unit = lambda x: F.when(x == 0, 0.0).otherwise((x + 1) * (s / 2))
    if base in ("gcvi", "ndvi", "nbr", "nbr2"):
        return unit(diff)
    if base == "evi2":
        return 2.5 * s * ((n / s - b / s) / (n / s + 1.0 + 2.4 * b / s))
    if base == "cai":
        return s * b / (n + EPS)
    if base == "savi":
        soil = (-int(param[1:]) if param.startswith("n") else int(param)) / 100 if param else 0.5
        return unit((1 + soil) * ((n / s - b / s) / (n / s + b / s + soil)))
    if base == "msavi":
        level = 2 * n / s + 1
        return s / 2 * level - (level * level - 8 * (n / s - b / s)) / 2
    if base in ("ndmi", "ndwi"):
        return ((s * diff if base == "ndmi" else -s * diff) + 1) * (s / 2)
    if base == "kndvi":
        return s * F.tanh(diff * diff)
    if base in ("bai", "baim"):
        x, y = (0.06, 0.1) if base == "bai" else (0.05, 0.2)
        far = F.pow(x - n / s, F.lit(2)) + F.pow(y - b / s, F.lit(2))
        return F.when(n + b > 0, s / F.when(far > 0, far)).when(n + b <= 0, 0.0)
    if base == "gemi":
        x, y = n / s, b / s
        eta = (2 * (x * x - y * y) + 1.5 * x + 0.5 * y) / (x + y + 0.5)
        return s * (eta * (1 - 0.25 * eta) - (y - 0.125) / (1 - y))
    if base == "wi":
        total = F.when((n > 0) & (n < 1), n + b).when(n.isNotNull(), 0.0)
        return F.when(total > 0.5, 0.001 * s).otherwise(s * (1.0 - total / 0.5))
    if base == "mirbi":
        return F.when(n + b == 0, 0.0).otherwise(s / 5 * (10 * b / s - 9.8 * n / s + 2))
    return b


def apart(x: Column) -> Column:
    """``x`` itself.  A lambda in a projection makes Spark compile its columns as functions of their own and not as one method, which Java would
    only interpret beyond 8,000 bytes: of many indices one is put in this."""
    return F.get(F.transform(F.array(x), lambda v: v), F.lit(0))


def burn_difference(pre: Column, post: Column) -> Column:
    return pre - post


def burn_ratio(pre: Column, post: Column) -> Column:
    return over(pre - post, F.sqrt(F.abs(pre)))
