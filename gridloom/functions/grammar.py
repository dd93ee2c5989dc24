"""Names that carry parameters: scenes, indices, features, models, training years."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def parse_index(name: str) -> dict:
    """``savi.n25-smnorm``: index, param, kind of series and whether it is normalised."""
    m = re.fullmatch(r"([A-Za-z0-9]+?)(?:\.(n?\d+))?(?:-((?:raw|sm)\w*?)(norm)?)?", name)
    if not m:
        raise ValueError(f"not an index: {name}")
    p = m[2]
    return {"index": m[1], "param": None if p is None else -int(p[1:]) / 100 if p[0] == "n" else int(p) / 100, "series": m[3], "norm": bool(m[4])}


def parse_feature(name: str) -> dict:
    """``sigdelta.n500.doy.glcm.homog.w3.c8.th0-yr``: statistic, threshold, frequency, texture and season."""
    head, _, season = name.rpartition("-")
    if not head:
        raise ValueError(f"not a feature: {name}")
    parts = head.split(".")
    out = {"stat": parts[0], "threshold": None, "freq": None, "texture": None, "season": season}
    i = 1
    if i < len(parts) and (m := re.fullmatch(r"([np])(\d+)", parts[i])):
        out["threshold"] = int(m[2]) * (-1 if m[1] == "n" else 1)
        i += 1
    if i < len(parts) and parts[i] in ("bi", "count", "doy", "mo", "v"):
        out["freq"] = parts[i]
        i += 1
    if i < len(parts) and parts[i] == "glcm":
        kind = {"kind": parts[i + 1]}
        for x in parts[i + 2 :]:
            m = re.fullmatch(r"(w|c|th)(\d+)", x)
            kind[{"w": "window", "c": "levels", "th": "angle"}[m[1]]] = int(m[2])
        out["texture"], i = kind, len(parts)
    if i != len(parts):
        raise ValueError(f"not a feature: {name}")
    return out


def parse_model(name: str) -> dict:
    """``feat_samp_yrs[-geo]_class_alg100[_ss2][-run3]``."""
    m = re.fullmatch(r"([^_]+)_([^_]+)_([^_-]+)(-geo)?_([^_]+)_([A-Za-z]+)(\d+)(?:_ss(\d+))?(?:-run(\d+))?", name)
    if not m:
        raise ValueError(f"not a model: {name}")
    num = lambda x: None if x is None else int(x)
    return {"features": m[1], "samples": m[2], "years": train_years(m[3]), "geo": bool(m[4]), "classes": m[5], "algorithm": m[6], "size": int(m[7]), "subsample": num(m[8]), "run": num(m[9])}


def train_years(label: str) -> list[int]:
    """``24`` is 2024, ``17to24`` a range, ``252217`` three years."""
    if "to" in label:
        a, b = label.split("to")
        return list(range(2000 + int(a), 2001 + int(b)))
    return [2000 + int(label[i : i + 2]) for i in range(0, len(label), 2)]


def expand_seasons(season: str, first_month: int = 6) -> list[str]:
    """``Monthly`` and ``Quarterly`` as their parts, months from the first of the year on."""
    if season == "Monthly":
        return MONTHS[first_month - 1 :] + MONTHS[: first_month - 1]
    return [f"Q{i}" for i in range(1, 5)] if season == "Quarterly" else [season]


def scene_date(name: Column) -> Column:
    """Date in the fourth underscore field (``L3A_LC08_xx_20200131_...``) or, for a series layer, ``YYYYDDD.tif``."""
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")
    field = F.substring(F.get(F.split(stem, "_"), F.lit(3)), 1, 8)
    layer = F.date_add(F.make_date(F.substring(stem, 1, 4).try_cast("int"), F.lit(1), F.lit(1)), F.substring(stem, 5, 3).try_cast("int") - 1)
    return F.when(stem.rlike(r"^\d{7}$"), layer).otherwise(F.try_to_date(field, "yyyyMMdd"))


def scene_sensor(name: Column) -> Column:
    return F.get(F.split(name, "_"), F.lit(1))


def cell_name(cell: Column) -> Column:
    return F.lpad(cell.cast("string"), 6, "0")
