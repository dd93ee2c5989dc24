"""Yearly class series: majorities, stable bases, and rules that rewrite illogical sequences.

A rule is a condition on a year's class, its neighbours and counts over the
series, and a replacement.  Rules run in order, each on the result of the ones
before.  The years of a class set are counted when a rule first needs them, on
the series as it is then, and later rules use that count; sets that the stable
base counts are counted before any rule.  All windows partition by the pixel, so
the chain needs one exchange.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Class codes of the land-cover legend that the rules name; the first of a list is the code that is stored.
CLASSES = {
    "sugar": [143], "rice": [114], "banana": [148], "LowVeg_crop": list(range(100, 148)),
    "med_crops": [150, 148, 151, 152, 153, 155, 156, 157, 158, 159, 190, 191, 192, 193, 194, 196, 197, 198, 199, 183],
    "LowVeg_wet": [74, 64, 61, 65, 63, 68], "NoVeg_water": [40], "NoVeg_built": [30], "NoVeg_bare": [20],
    "Grass_all": [75, 51, 55, 58, 71, 72, 73, 74, 76, 77, 79, 80, 81, 82, 83, 84, 85, 86, 87, 88, 89, 91, 108],
    "dry_grass": [80, 75], "gtmix": [176], "MedVeg_noncrop": [161, *range(162, 170)], "MedVeg_wet": [164],
    "Trees_plantation": [207, 187, 217, 202, 203, 205, 206, 208, 209, 216], "TreePlant_young": [187, 182, 185], "TreePlant_start": [98],
    "dense_for": [250], "open_for": [215], "shrub_for": [226], "palm_for": [221], "forest_Py36": [226, 215, 221, 220], "grass_Py36": [74, 75, 80, 91], "wet": [40, 74, 164, 184], "tree_water_mix": [184], "forest_open_stable": [226, 221],
    "Trees_nat": [220, 212, 213, 214, 215, 218, 219, 184, *range(221, 255)],
}
FIRST_VEG, FIRST_MEDVEG, FIRST_HIGHVEG, FIRST_MATURE = 50, 148, 180, 200
HIGHVEG_NONE = 255


#: Groups that should be stable through time; forests in the order in which they win.
STABLE = ("shrub_for", "palm_for", "open_for", "dense_for", "wet", "grass_Py36")


@dataclass
class Series:
    """What a rule sees: this year's class, neighbours, counts and base classes."""

    cls: Column
    near: Callable[[int, int], Column]
    end: Callable[[int], Column]
    counted: set[str] = field(default_factory=set)

    def now(self, name: str) -> Column:
        return self.cls.isin(CLASSES[name])

    def at(self, step: int, *names: str) -> Column:
        """Whether the class ``step`` years on (back if negative) is in one of the sets."""
        return self.near(step, 0).isin(sorted({c for n in names for c in CLASSES[n]}))

    def both(self, *names: str) -> Column:
        return self.at(-1, *names) & self.at(1, *names)

    def either(self, *names: str) -> Column:
        return self.at(-1, *names) | self.at(1, *names)

    def count(self, *names: str) -> Column:
        self.counted.update(names)
        total = F.lit(0)
        for n in names:
            total = total + F.col(f"n_{n}")
        return total

    def grew(self) -> Column:
        """Low vegetation two years ago, no high vegetation last year."""
        return (self.near(-1, 255) < FIRST_HIGHVEG) & (self.near(-2, 255) < FIRST_MEDVEG)

    def mature(self) -> Column:
        return (self.near(-1, 0) > FIRST_MATURE) & (self.near(-2, 0) > FIRST_MATURE)


def stored(name: str) -> Column:
    return F.lit(CLASSES[name][0])


Step = tuple[Callable[[Series], Column], Callable[[Series], Column]]


def _one(when: Callable[[Series], Column], then: str) -> list[Step]:
    return [(when, lambda s: stored(then))]


#: Each rule: steps of (condition, replacement).
RULES: dict[str, list[Step]] = {
    "sugar-palm": _one(lambda s: s.now("sugar") & s.both("palm_for") & (s.count("palm_for") >= 2), "palm_for"),
    "sugar-grass": [(lambda s: s.now("sugar") & s.both("Grass_all") & (s.count("Grass_all") >= 4), lambda s: F.col("base_grass"))],
    "banana-wet": _one(lambda s: s.now("banana") & (s.count("LowVeg_wet", "MedVeg_wet", "palm_for") >= 5), "MedVeg_wet"),
    "palm_for-grass-aggressive": [(
        lambda s: s.end(0).isin(CLASSES["palm_for"]) | s.end(1).isin(CLASSES["palm_for"]),
        lambda s: F.when(F.col("base_forest").isin(CLASSES["palm_for"]), stored("palm_for")).otherwise(stored("gtmix")),
    )],
    "palm_for-wetgrass": _one(lambda s: s.now("palm_for") & (s.count("LowVeg_wet", "MedVeg_wet") > 5), "MedVeg_wet"),
    "grass-forest-aggressive": [(lambda s: s.end(0).isin(CLASSES["Trees_nat"]) & (s.end(1) == s.end(0)), lambda s: s.end(0))],
    "tree_plant-med_crop": _one(lambda s: s.now("med_crops") & (s.count("Trees_plantation") >= 3), "Trees_plantation"),
    "rice-water": [
        (lambda s: s.now("rice") & (s.count("NoVeg_water") >= 4), lambda s: stored("NoVeg_water")),
        (lambda s: s.now("NoVeg_water") & s.both("rice"), lambda s: stored("rice")),
    ],
    "rice-built": _one(lambda s: s.now("NoVeg_built") & (s.count("rice") >= 2) & (s.count("rice", "NoVeg_water") >= 4), "rice"),
    "wetgrass-crop": _one(lambda s: s.now("LowVeg_crop") & s.both("LowVeg_wet"), "LowVeg_wet"),
    "grass-crop": _one(lambda s: s.now("LowVeg_crop") & (s.count("Grass_all") >= 4) & s.either("Grass_all"), "Grass_all"),
    "wetgrass-built": _one(lambda s: s.now("NoVeg_built") & s.both("LowVeg_wet"), "LowVeg_wet"),
    "medcrop-wetshrub": _one(lambda s: s.now("med_crops") & s.both("MedVeg_wet", "LowVeg_wet"), "MedVeg_wet"),
    "medcrop-shrub": _one(
        lambda s: s.now("med_crops") & (s.at(-1, "dry_grass") | (s.near(-1, 0) == stored("MedVeg_noncrop"))) & (s.at(1, "dry_grass") | (s.near(1, 0) == stored("MedVeg_noncrop"))),
        "MedVeg_noncrop",
    ),
    "singleton-crop": _one(lambda s: s.now("LowVeg_crop") & (s.count("LowVeg_crop") == 1), "dry_grass"),
    "grass-built": _one(lambda s: s.now("NoVeg_built") & (s.count("Grass_all") >= 4) & s.either("Grass_all"), "NoVeg_bare"),
    "built-non-built": _one(lambda s: ~s.now("NoVeg_built") & s.both("NoVeg_built"), "NoVeg_built"),
    "forest-treeplant": [
        (lambda s: s.now("Trees_nat") & (s.count("Trees_plantation") > s.count("Trees_nat")) & s.mature(), lambda s: stored("Trees_plantation")),
        (lambda s: s.now("Trees_plantation") & (s.count("Trees_plantation") < s.count("Trees_nat")) & s.mature(), lambda s: F.col("base_forest")),
    ],
    "forest-brieflow": [
        (lambda s: (s.cls < FIRST_MEDVEG) & s.both("forest_open_stable"), lambda s: s.near(-1, 0)),
        (lambda s: (s.cls < FIRST_MEDVEG) & s.both("dense_for", "open_for"), lambda s: stored("open_for")),
    ],
    "grass-to-forest": _one(lambda s: s.now("Trees_nat") & s.grew(), "MedVeg_noncrop"),
    "grass-to-palmforest": _one(lambda s: s.now("palm_for") & s.grew(), "gtmix"),
    "twmix-medwet": _one(lambda s: s.now("tree_water_mix") & s.grew(), "MedVeg_wet"),
    "noplant-plant": [
        (lambda s: (s.cls >= FIRST_MEDVEG) & (s.cls < FIRST_MATURE) & s.at(1, "Trees_plantation"), lambda s: stored("TreePlant_young")),
        (lambda s: (s.cls >= FIRST_VEG) & (s.cls < FIRST_MEDVEG) & s.at(1, "Trees_plantation"), lambda s: stored("TreePlant_start")),
    ],
}


def counted_by(name: str) -> list[str]:
    """The class sets whose years a rule counts."""
    probe = Series(F.lit(0), lambda k, fill: F.lit(fill), lambda k: F.lit(0))
    for when, _ in RULES[name]:
        when(probe)
    return sorted(probe.counted)


def with_counts(df: DataFrame, keys: list[str], sets: tuple[str, ...] | list[str], cls: str = "class") -> DataFrame:
    """``n_<set>``: years of a pixel in each class set."""
    w = Window.partitionBy(*keys)
    return df.withColumns({f"n_{n}": F.sum(F.col(cls).isin(CLASSES[n]).cast("int")).over(w) for n in sets})


def majority_in(df: DataFrame, keys: list[str], order: list[int], cls: str = "class") -> DataFrame:
    """keys, majority: the class of a set that a pixel has in most years, the first in the set's order of equal ones; 0 without any."""
    n = df.groupBy(*keys, cls).agg(F.count(F.lit(1)).alias("gl_n"))
    place = F.create_map(*(F.lit(x) for i, c in enumerate(order) for x in (c, -i)))
    best = F.max(F.when(F.col(cls).isin(order), F.struct("gl_n", F.try_element_at(place, F.col(cls)).alias("gl_p"), F.col(cls).alias("gl_c"))))
    return n.groupBy(*keys).agg(F.coalesce(best["gl_c"], F.lit(0)).alias("majority"))


def stable_base(df: DataFrame, keys: list[str], groups: tuple[str, ...] = STABLE, region: Column | None = None, cls: str = "class") -> DataFrame:
    """keys, base_<group> of each group that should be stable (0 where it has none), and base_forest, the first of the forest groups that is not 0.

    Shrub forest wherever it occurs, or dense forest and shrub both do (inside ``region``, a column of ``df``, if given); palm forest where
    it has more years than grass-tree mix and than tree crops; open forest where it and shrub have two years or more and all others are
    dense forest; of any other group the commonest class, the first in its order of equal ones.  Also n_palm_for, for rules that count it.
    """
    in_set = lambda *names: F.col(cls).isin(sorted({c for n in names for c in CLASSES[n]}))
    years = lambda *names: F.count_if(in_set(*names))
    here = F.lit(True) if region is None else F.coalesce(F.max(region), F.lit(False))

    def common(group: str) -> Column:
        """The commonest class of a group from one count a class."""
        best = [F.struct(F.count_if(F.col(cls) == c).alias("n"), F.lit(-i).alias("p"), F.lit(c).alias("c")) for i, c in enumerate(CLASSES[group])]
        top = F.greatest(*best) if len(best) > 1 else best[0]
        return F.when(top["n"] > 0, top["c"]).otherwise(0)

    made = {
        "shrub_for": lambda: F.when((years("shrub_for") > 0) | ((years("dense_for") > 0) & (years("MedVeg_noncrop") > 0) & here), stored("shrub_for")).otherwise(0),
        "palm_for": lambda: F.when((years("palm_for") > years("gtmix")) & (years("palm_for") > years("med_crops")), stored("palm_for")).otherwise(0),
        "open_for": lambda: F.when((years("open_for", "MedVeg_noncrop") >= 2) & (years("dense_for") == F.count(F.lit(1)) - years("open_for", "MedVeg_noncrop")), stored("open_for")).otherwise(0),
    }
    base = {g: made.get(g, lambda g=g: common(g))().cast("int").alias(f"base_{g}") for g in groups}
    out = df.groupBy(*keys).agg(*base.values(), years("palm_for").cast("long").alias("n_palm_for"))
    forests = [F.when(F.col(f"base_{g}") > 0, F.col(f"base_{g}")) for g in groups if g.endswith(("_for", "_forest"))]
    return out.withColumn("base_forest", F.coalesce(*forests, F.lit(0)))


def apply_rules(df: DataFrame, keys: list[str], names: list[str] | None = None, cls: str = "class", year: str = "year", where: Column | dict[str, Column] | None = None) -> DataFrame:
    """``cls`` after the named rules, in order, on the rows where ``where`` (or that of a rule) holds.

    ``df`` has base_forest and base_grass where rules need them, and may have ``n_<set>``, years that were counted before.
    """
    w = Window.partitionBy(*keys).orderBy(year)
    every = Window.partitionBy(*keys).orderBy(F.col(year).desc())
    columns = df.columns
    rows = df.withColumn("gl_back", F.row_number().over(every))
    near = lambda k, fill: F.coalesce(F.lag(cls, -k).over(w) if k < 0 else F.lead(cls, k).over(w), F.lit(fill))
    end = lambda k: F.max(F.when(F.col("gl_back") == k + 1, F.col(cls))).over(Window.partitionBy(*keys))
    for name in names if names is not None else list(RULES):
        rows = with_counts(rows, keys, [n for n in counted_by(name) if f"n_{n}" not in rows.columns], cls)
        inside = where.get(name) if isinstance(where, dict) else where
        for when, then in RULES[name]:
            s = Series(F.col(cls), near, end)
            hit = F.coalesce(when(s) if inside is None else when(s) & inside, F.lit(False))
            rows = rows.withColumn("gl_new", F.when(hit, then(s)).otherwise(F.col(cls))).drop(cls).withColumnRenamed("gl_new", cls)
    return rows.select(columns)


def hold_to_base(df: DataFrame, keys: list[str], group: str = "Py36", cls: str = "class", year: str = "year") -> DataFrame:
    """Classes set to the pixel's base classes (base_forest, base_grass_<group>, base_wet), one group after the other.

    Forest of the group where the base is mature forest; grass of the group where there is a base; wet classes where there
    is a base, unless the year before or after has the same class.
    """
    w = Window.partitionBy(*keys).orderBy(year)
    now, grass = F.col(cls), F.col(f"base_grass_{group}")
    df = df.withColumn(cls, F.when(now.isin(CLASSES[f"forest_{group}"]) & (F.col("base_forest") >= FIRST_MATURE), F.col("base_forest")).otherwise(now))
    df = df.withColumn(cls, F.when(now.isin(CLASSES[f"grass_{group}"]) & (grass > 0), grass).otherwise(now))
    steady = (F.coalesce(F.lag(cls).over(w), F.lit(0)) == now) | (F.coalesce(F.lead(cls).over(w), F.lit(0)) == now)
    return df.withColumn("gl_new", F.when(now.isin(CLASSES["wet"]) & (F.col("base_wet") > 0) & ~steady, F.col("base_wet")).otherwise(now)).drop(cls).withColumnRenamed("gl_new", cls)


def keep_inside(edited: Column, original: Column, area: Column) -> Column:
    """Inside polygons the original class stays."""
    return F.when(area > 0, original).otherwise(edited)


def in_region(strata: Column, apply_to: list) -> Column:
    """Where a rule applies: everywhere for 0, NA or all."""
    return F.lit(True) if any(x in (0, "NA", "all") for x in apply_to) else strata.isin(apply_to)
