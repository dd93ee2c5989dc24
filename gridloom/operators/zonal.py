"""Zonal statistics of classes and of continuous values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reclassified(df: DataFrame, lut: dict[int, int], column: str, missing: int = 0) -> Column:
    """Old to new codes by a small table; 0 stays 0."""
    pairs = F.create_map(*(F.lit(x) for kv in lut.items() for x in kv))
    return F.when(F.col(column) == 0, F.lit(0)).otherwise(F.coalesce(F.try_element_at(pairs, F.col(column)), F.lit(missing)))


#: Names of sets that share the crop edge.
CROP_SETS = ("crop", "homogeneous crop", "no crop", "nocrop")


def rolled_up(name: Column) -> Column:
    """The total that a class set counts in: crop (but for non-crops), burned, grass or tree (forests too); none for sets that begin with no."""
    low = F.lower(name)
    crop = low.contains("crop")
    return (
        F.when(low.startswith("no"), F.lit(None)).when(crop & ~low.contains("noncrop"), "crop").when(low.contains("burn"), "burned")
        .when(low.contains("grass"), "grass").when((low.contains("tree") & ~crop) | low.contains("forest"), "tree")
    )


def class_shares(df: DataFrame, sets: DataFrame, zone: list[str], value: str = "class", edge: int | None = None) -> DataFrame:
    """zone, kind, name, n, numpix, percent (one decimal): class sets (kind class), and totals of crop, burned, grass and tree sets above 0 (kind total).

    ``numpix`` is the sum of all sets' counts, so pixels of no set are left out.  Pixels of the class ``edge`` count half, truncated,
    in each set of crop and of no crop.  ``sets`` (name, value) is a dimension of a few hundred rows; names without a pixel have n = 0.
    """
    shared = F.lower(F.col("name")).isin(*CROP_SETS) if edge is not None else F.lit(False)
    named = F.broadcast(sets.filter(~(shared & (F.col("value") == F.lit(edge)))).select("name", F.col("value").alias(value)).distinct())
    counts = df.groupBy(*zone, value).agg(F.count(F.lit(1)).alias("gl_n"))
    edges = counts.groupBy(*zone).agg(F.floor(F.coalesce(F.sum(F.when(F.col(value) == F.lit(edge), F.col("gl_n"))), F.lit(0)) / 2).cast("long").alias("gl_e"))
    found = counts.join(named, value).groupBy(*[F.col(z).alias(f"gl_{z}") for z in zone], F.col("name").alias("gl_name")).agg(F.sum("gl_n").alias("gl_n"))
    every = edges.crossJoin(F.broadcast(sets.select("name").distinct()))  # a row a zone and set
    same = F.col("name") == F.col("gl_name")
    for z in zone:
        same = same & F.col(z).eqNullSafe(F.col(f"gl_{z}"))
    n = F.coalesce("gl_n", F.lit(0)) + F.when(shared, F.col("gl_e")).otherwise(0)
    rows = every.join(found, same, "left").select(*zone, F.lit("class").alias("kind"), "name", n.cast("long").alias("n"))
    total = rows.groupBy(*zone).agg(F.sum("n").alias("numpix"))
    up = rows.groupBy(*zone, rolled_up(F.col("name")).alias("name")).agg(F.sum("n").alias("n")).filter("name is not null and n > 0")
    both = rows.unionByName(up.withColumn("kind", F.lit("total")))
    return both.join(total, zone).filter("numpix > 0").withColumn("percent", F.round(100 * F.col("n") / F.col("numpix"), 1))


def missing_values(df: DataFrame, sets: DataFrame, zone: list[str], value: str = "class") -> DataFrame:
    """zone, missing: number of pixels of each class (not 0) that no set has."""
    lost = df.filter(F.col(value) != 0).join(F.broadcast(sets.select(F.col("value").alias(value)).distinct()), value, "left_anti")
    counts = lost.groupBy(*zone, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*zone).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(value, "n")))).alias("missing"))  # one entry a class


def mask_percent(df: DataFrame, zone: list[str], mask: str = "mask", nodata: int = 255) -> DataFrame:
    known = F.count_if(F.col(mask) != nodata)
    share = lambda c: F.round(100 * F.count_if(c & (F.col(mask) != nodata)) / F.when(known > 0, known), 1)
    return df.groupBy(*zone).agg(share(F.col(mask) > 0).alias("masked"), share(F.col(mask) == 0).alias("unmasked"))


def shown(x: Column, decimals: int | None) -> Column:
    """Truncated (None) or rounded."""
    return x.cast("int") if decimals is None else F.round(x, decimals)


def summary(df: DataFrame, zone: list[str], value: str, nodata: int | None = None, decimals: int | None = None) -> DataFrame:
    """avg, med, std (population) and quartiles by zone; zones without a value give 0."""
    v = F.col(value) if nodata is None else F.when(F.col(value) != nodata, F.col(value))
    rows = df.groupBy(*zone).agg(F.avg(v).alias("gl_avg"), F.stddev_pop(v).alias("gl_std"), F.percentile(v, F.array(*(F.lit(x) for x in (0.1, 0.25, 0.5, 0.75, 0.9)))).alias("gl_q"))
    level = lambda i: F.get("gl_q", F.lit(i))
    stats = {"avg": F.col("gl_avg"), "med": level(2), "std": F.col("gl_std"), "q10": level(0), "q25": level(1), "q75": level(3), "q90": level(4)}
    return rows.select(*zone, *(F.coalesce(shown(s, decimals), F.lit(0)).alias(n) for n, s in stats.items()))


def majority(df: DataFrame, zone: list[str], value: str) -> DataFrame:
    """The most frequent value of each zone, the smallest of equal ones."""
    n = df.groupBy(*zone, value).agg(F.count(F.lit(1)).alias("gl_n"))
    return n.groupBy(*zone).agg((-F.max(F.struct("gl_n", (-F.col(value)).alias("gl_v")))["gl_v"]).alias("majority"))


def burned_in(df: DataFrame, stats: DataFrame, zone: list[str]) -> DataFrame:
    """Pixels with the statistics of their zone."""
    return df.join(stats, zone, "left")


def polygon_summary(df: DataFrame, zone: str, bands: list[str], stat: str = "avg") -> DataFrame:
    """One row a polygon, a column a band."""
    made = {"avg": F.avg, "med": F.median, "var": F.var_pop, "max": F.max, "min": F.min}[stat]
    return df.groupBy(zone).agg(*(made(b).alias(f"{stat}_{b}") for b in bands))


def number_of_classes(df: DataFrame, value: str, nodata: int = 0) -> DataFrame:
    return df.filter(F.col(value) != nodata).agg(F.count_distinct(value).alias("n_classes"))


def class_counts(df: DataFrame, value: str, priority: str, most: int = 4) -> DataFrame:
    """Rows of each class, in all and by priority."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(priority) == k).alias(f"n{k}") for k in range(1, most + 1)))


KINDS = {"cat": "cat", "categorical": "cat", "class": "cat", "classes": "cat", "cont": "cont", "continuous": "cont"}


def map_kind(asked: str | None, setting: str | None, entry: dict | None, sets: bool) -> str:
    """cat or cont: as asked, else as set, else by the product's ``type``, else cat where there are classes to sum."""
    for value in (asked, setting, (entry or {}).get("type")):
        if value not in (None, "", "None"):
            if str(value).lower() not in KINDS:
                raise ValueError(f"unknown kind of map: {value}")
            return KINDS[str(value).lower()]
    return "cat" if sets or (entry or {}).get("classes") else "cont"


def summarised(df: DataFrame, zone: list[str], value: str, asked: str | None = None, setting: str | None = None, entry: dict | None = None, sets: DataFrame | None = None, edge: int | None = None, decimals: int | None = None) -> DataFrame:
    """The summary of a map product by zone: class shares or statistics, by its kind.  Classes are ``sets`` or those of the product's entry (name: codes)."""
    if map_kind(asked, setting, entry, sets is not None) == "cont":
        return summary(df, zone, value, decimals=decimals)
    if sets is None and (entry or {}).get("classes"):
        codes = [(name, int(c)) for name, cs in entry["classes"].items() for c in (cs if isinstance(cs, (list, tuple)) else [cs])]
        sets = df.sparkSession.createDataFrame(codes, "name string, value int")
    if sets is None:  # every code is a class of its own
        sets = df.select(F.col(value).cast("string").alias("name"), F.col(value).alias("value")).distinct()
    return class_shares(df, sets, zone, value, edge)


def temporal_statistic(df: DataFrame, poly: str, day: str, value: str, stat: str) -> DataFrame:
    """poly, day and a statistic of a polygon's pixels on each day: avg, var (population), cv (in percent) or per<X>."""
    v = F.col(value)
    made = {"avg": F.avg(v), "var": F.var_pop(v), "cv": 100 * F.stddev_pop(v) / F.when(F.avg(v) != 0, F.avg(v))}
    agg = F.percentile(v, int(stat[3:]) / 100) if stat.startswith("per") else made[stat]
    return df.groupBy(poly, day).agg(agg.alias(stat))


def to_polygons(polys: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """Polygons with the statistics of their zone; polygons without pixels stay."""
    return polys.join(stats, key, "left")
