"""Confusion matrices, scores, separability, segment accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pair_counts(preds: DataFrame, pred: str = "pred", obs: str = "label") -> DataFrame:
    """pred, obs, n with margins: a null is the total over that side."""
    n = preds.cube(F.col(pred).alias("pred"), F.col(obs).alias("obs")).agg(F.count(F.lit(1)).alias("n"))
    return n


def confusion(preds: DataFrame, classes: list, pred: str = "pred", obs: str = "label") -> DataFrame:
    """One row a predicted class, a column ``o_<class>`` an observed one (all of ``classes``), and ``total``."""
    rows = preds.sparkSession.createDataFrame([(c,) for c in classes], f"{pred} {preds.schema[pred].dataType.simpleString()}")
    counts = preds.groupBy(pred).pivot(obs, classes).count()
    both = rows.join(counts, pred, "left")
    both = both.select(pred, *(F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"o_{c}") for c in classes))
    return both.withColumn("total", sum((F.col(f"o_{c}") for c in classes[1:]), F.col(f"o_{classes[0]}")))


def f_score(ua: Column, pa: Column, beta: float) -> Column:
    down = beta * beta * ua + pa
    return F.round(F.when(down > 0, (1 + beta * beta) * ua * pa / down).otherwise(0.0), 3)


def class_scores(preds: DataFrame, pred: str = "pred", obs: str = "label") -> DataFrame:
    """class, n_pred, n_obs, hits, UA, PA, F1, F05, F025: accuracies are rounded before the F scores."""
    side = lambda c, n: preds.groupBy(F.col(c).alias("class")).agg(F.count(F.lit(1)).alias(n))
    hits = preds.filter(F.col(pred) == F.col(obs)).groupBy(F.col(obs).alias("class")).agg(F.count(F.lit(1)).alias("hits"))
    both = side(pred, "n_pred").join(side(obs, "n_obs"), "class", "full_outer").join(hits, "class", "left").na.fill(0)
    ratio = lambda n: F.round(F.when(F.col(n) > 0, F.col("hits") / F.col(n)).otherwise(0.0), 3)
    both = both.withColumn("UA", ratio("n_pred")).withColumn("PA", ratio("n_obs"))
    return both.withColumns({n: f_score(F.col("UA"), F.col("PA"), b) for n, b in (("F1", 1.0), ("F05", 0.5), ("F025", 0.25))})


def overall_scores(preds: DataFrame, pred: str = "pred", obs: str = "label") -> DataFrame:
    """One row: OA, Kappa, BA, UA_macro, F1_macro, F1_wt, F1_min, PA_min."""
    by_class = class_scores(preds, pred, obs)
    one = by_class.agg(
        F.sum("hits").alias("hits"), F.sum("n_obs").alias("n"), F.sum(F.col("n_obs") * F.col("n_pred")).alias("cross"), F.avg("PA").alias("BA"), F.avg("UA").alias("UA_macro"),
        F.avg("F1").alias("F1_macro"), (F.sum(F.col("F1") * F.col("n_obs")) / F.sum("n_obs")).alias("F1_wt"), F.min("F1").alias("F1_min"), F.min("PA").alias("PA_min"),
    )
    oa, chance = F.col("hits") / F.col("n"), F.col("cross") / (F.col("n") * F.col("n"))
    return one.select(F.round(oa, 3).alias("OA"), F.round((oa - chance) / F.when(chance < 1, 1 - chance), 3).alias("Kappa"), *(F.round(c, 3).alias(c) for c in ("BA", "UA_macro", "F1_macro", "F1_wt", "F1_min", "PA_min")))


def binary_scores(preds: DataFrame, positive, pred: str = "pred", obs: str = "label") -> DataFrame:
    """One row: TP, FP, FN, TN, OA, F1, kappa of one class against all others."""
    p, o = F.col(pred) == positive, F.col(obs) == positive
    one = preds.agg(F.count_if(p & o).alias("TP"), F.count_if(p & ~o).alias("FP"), F.count_if(~p & o).alias("FN"), F.count_if(~p & ~o).alias("TN"))
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("TP", "FP", "FN", "TN"))
    down = (tp + fp) * (fp + tn) + (tp + fn) * (fn + tn)
    ua, pa = F.round(tp / F.when(tp + fp > 0, tp + fp), 3), F.round(tp / F.when(tp + fn > 0, tp + fn), 3)
    return one.withColumn("OA", F.round((tp + tn) / (tp + fp + fn + tn), 3)).withColumn("F1", f_score(ua, pa, 1.0)).withColumn("kappa", F.round(2 * (tp * tn - fn * fp) / F.when(down != 0, down), 3))


def recall(preds: DataFrame, group: list[str], hits: list, pred: str = "pred") -> DataFrame:
    """Share of rows of a group that are predicted as one of ``hits``."""
    return preds.groupBy(*group).agg(F.round(F.avg(F.col(pred).isin(hits).cast("double")), 3).alias("recall"), F.count(F.lit(1)).alias("n"))


def small_field_flags(width: Column, source: Column, small: float, medium: float) -> Column:
    return F.when(source != "field", F.lit("other")).when(width < small, "small").when(width < medium, "medium").otherwise("big")


def run_scores(scores: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Mean and sample deviation over runs."""
    return scores.groupBy(*keys).agg(*(f(m).alias(f"{m}_{n}") for m in measures for n, f in (("mean", F.avg), ("std", F.stddev_samp))))


def best_models(scores: DataFrame, keys: list[str], measure: str, tie: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.col(measure).desc_nulls_last(), F.col(tie))
    return scores.withColumn("gl_n", F.row_number().over(w)).filter("gl_n = 1").drop("gl_n")


def latest_scores(log: DataFrame, key: str, order: str) -> DataFrame:
    """The last entry of each model in an append-only log."""
    return best_models(log, [key], order, key)


LEVELS = (5, 10, 20, 80, 90, 95)


#: Parts into which a round of ``pre_post_summary`` cuts the values between the least and the largest that are left.
CELLS = 65_536


def _wanted(hist: DataFrame, part: list[str]) -> DataFrame:
    """Bins (gl_bin, rows gl_k) that hold a rank of ``gl_want``, with the ranks counted from their own first row."""
    below = F.sum("gl_k").over(Window.partitionBy(*part).orderBy("gl_bin")) - F.col("gl_k")
    inside = F.filter("gl_want", lambda w: (w["rank"] >= F.col("gl_below")) & (w["rank"] < F.col("gl_below") + F.col("gl_k")))
    moved = F.transform(inside, lambda w: F.struct(w["i"].alias("i"), (w["rank"] - F.col("gl_below")).alias("rank")))
    return hist.withColumn("gl_below", below).withColumn("gl_want", moved).filter(F.size("gl_want") > 0)


def pre_post_summary(rows: DataFrame, keys: list[str], season: str) -> DataFrame:
    """By index, for all seasons together and each: n, mean, sample deviation and quantiles of pre - post, levels (all truncated), and five
    measures of separability of the two: M (population deviations), f divergence, Bhattacharyya, Jeffries-Matusita, Jensen-Shannon.

    Quantiles are exact: rows are counted in bins that rise with pre - post (64 to a power of two, which the sums go by as well), those bins that
    hold a quantile again in ``CELLS`` parts, twice, and then by value, of which a part has at most some 16,000. So the rows are read four
    times, and what is kept of them does not grow. Terms that are not numbers are left out of sums.
    """
    p, q, d = F.col("pre"), F.col("post"), F.col("gl_d")
    x = rows.filter("pre is not null and post is not null").select(*keys, F.col(season).alias("gl_s"), p.cast("double").alias("pre"), q.cast("double").alias("post"))
    x = x.withColumn("gl_d", p - q + 0.0)  # no -0.0
    m = (p + q) / 2
    log = lambda a, b: F.when((a / F.when(b != 0, b)) > 0, F.ln(a / F.when(b != 0, b)))
    number = lambda c: F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c)).otherwise(0.0)
    terms = {"gl_tf": p * log(p, q), "gl_tbc": F.sqrt(F.when(p * q >= 0, p * q)), "gl_tp": p * log(p, m), "gl_tq": q * log(q, m)}
    octave = F.when(F.isnan(d), 300_000).when(d == 0, 0).otherwise(F.signum(d).cast("int") * F.when(F.abs(d) < float("inf"), F.floor(F.log2(F.abs(d)) * 64) + 70_000).otherwise(200_000))
    sums = {f"gl_{name}_{s}": F.sum(v) for name, c in (("delta", d), ("pre", p), ("post", q)) for s, v in (("s", c), ("ss", c * c))}
    sums |= {f"gl_{n}": F.sum(number(f"gl_t{n}")) for n in ("f", "bc", "p", "q")}
    hist = x.withColumns({**terms, "gl_bin": octave.cast("long")}).groupBy(*keys, "gl_s", "gl_bin").agg(F.count(F.lit(1)).alias("gl_k"), F.min("gl_d").alias("gl_lo"), F.max("gl_d").alias("gl_hi"), *(c.alias(n) for n, c in sums.items()))

    # Each bin counts for its season and for all.  ``gl_own`` has the seasons that a group takes rows of, ``gl_sums`` what else is asked of it.
    group = [*keys, "gl_all", "gl_g"]
    hist = hist.withColumn("gl_all", F.explode(F.array(F.lit(False), F.lit(True)))).withColumn("gl_g", F.when(~F.col("gl_all"), F.col("gl_s")))
    hist = hist.groupBy(*group, "gl_bin").agg(F.sum("gl_k").alias("gl_k"), F.min("gl_lo").alias("gl_lo"), F.max("gl_hi").alias("gl_hi"), F.collect_set(F.struct("gl_s")).alias("gl_own"), *(F.sum(n).alias(n) for n in sums))
    every = Window.partitionBy(*group)
    own = F.array_sort(F.array_distinct(F.flatten(F.collect_set("gl_own").over(every))))
    hist = hist.withColumns({"gl_own": own, "gl_sums": F.struct(F.sum("gl_k").over(every).alias("gl_n"), *(F.sum(n).over(every).alias(n) for n in sums))}).drop(*sums)
    at = [(F.col("gl_sums.gl_n") - 1) * F.lit(level / 100) for level in LEVELS]
    ranks = [r(c).cast("long") for c in at for r in (F.floor, F.ceil)]
    hist = hist.withColumn("gl_want", F.array(*(F.struct(F.lit(i).alias("i"), r.alias("rank")) for i, r in enumerate(ranks))))
    carried = [*group, "gl_own", "gl_sums", "gl_want"]
    found = _wanted(hist, group).select(*carried, "gl_lo", "gl_hi")
    for last in (False, False, True):
        cells = F.broadcast(found.select(*(F.col(k).alias(f"gl_k{i}") for i, k in enumerate(keys)), "gl_all", "gl_g", "gl_own", "gl_sums", "gl_want", "gl_lo", "gl_hi", F.explode("gl_own.gl_s").alias("gl_o")))
        same = F.col("gl_s").eqNullSafe(F.col("gl_o")) & (d >= F.col("gl_lo")) & (d <= F.col("gl_hi"))
        for i, k in enumerate(keys):
            same &= F.col(k).eqNullSafe(F.col(f"gl_k{i}"))
        part = (d - F.col("gl_lo")) / (F.col("gl_hi") - F.col("gl_lo")) * (CELLS - 1)
        cell = d if last else F.when(F.col("gl_hi") > F.col("gl_lo"), F.floor(part)).otherwise(0)
        hist = x.select(*keys, "gl_s", "gl_d").join(cells, same).groupBy(*carried, F.col("gl_lo").alias("gl_cell"), cell.alias("gl_bin")).agg(F.count(F.lit(1)).alias("gl_k"), F.min("gl_d").alias("gl_lo"), F.max("gl_d").alias("gl_hi"))
        found = _wanted(hist, [*group, "gl_cell"]).select(*carried, "gl_lo", "gl_hi")
    ends = found.select(*keys, "gl_g", "gl_all", "gl_sums", "gl_lo", F.explode("gl_want.i").alias("i")).groupBy(*keys, "gl_g", "gl_all", "gl_sums").agg(*(F.max(F.when(F.col("i") == i, F.col("gl_lo"))).alias(f"gl_{i}") for i in range(2 * len(LEVELS))))
    levels = []
    for i, c in enumerate(at):
        low, high = F.col(f"gl_{2 * i}"), F.col(f"gl_{2 * i + 1}")
        levels.append(F.when(low == high, low).otherwise((F.ceil(c) - c) * low + (c - F.floor(c)) * high))
    out = ends.select(*keys, F.col("gl_g").alias(season), "gl_sums.*", F.array(*levels).alias("gl_levels")).withColumn("gl_js", (F.col("gl_p") + F.col("gl_q")) / 2)
    n = F.col("gl_n")
    mean = lambda x: F.col(f"gl_{x}_s") / n
    dev = lambda x, less: F.sqrt(F.greatest(F.lit(0.0), (F.col(f"gl_{x}_ss") - n * mean(x) * mean(x)) / F.when(n > less, n - less)))
    cut = lambda x: F.round(x, 9).cast("int")  # noqa: E731  noise must not cost a unit
    down = dev("pre", 0) + dev("post", 0)
    bhatt = F.round(-F.ln(F.when(F.col("gl_bc") > 0, F.col("gl_bc"))), 3)
    return out.select(
        *keys, F.coalesce(season, F.lit("ALL")).alias(season), n.alias("n"), cut(mean("delta")).alias("delta_avg"), cut(F.when(n > 1, dev("delta", 1))).alias("delta_std"),
        *(cut(F.get("gl_levels", F.lit(i))).alias(f"delta_{x}") for i, x in enumerate(LEVELS)),
        *(c.alias(f"{x}_{s}") for x in ("pre", "post") for s, c in (("avg", cut(mean(x))), ("std", cut(F.when(n > 1, dev(x, 1)))))),
        F.round(F.abs(mean("pre") - mean("post")) / F.when(down != 0, down), 2).alias("sep_M"), cut(F.col("gl_f")).alias("sep_F1"), bhatt.alias("sep_bhatt"),
        cut(2 * (1 - F.exp(-bhatt))).alias("sep_jm"), cut(F.col("gl_js")).alias("sep_jen"),
    )


def separability_m(mean_a: str, mean_b: str, dev_a: str, dev_b: str) -> Column:
    down = F.col(dev_a) + F.col(dev_b)
    return F.round(F.abs(F.col(mean_a) - F.col(mean_b)) / F.when(down != 0, down), 2)


def divergences(hist: DataFrame, keys: list[str], p: str = "p", q: str = "q") -> DataFrame:
    """Bhattacharyya distance, Jeffries-Matusita, Jensen-Shannon and Kullback-Leibler of two histograms (counts by bin)."""
    w = Window.partitionBy(*keys)
    rows = hist.withColumn("gl_p", F.col(p) / F.sum(p).over(w)).withColumn("gl_q", F.col(q) / F.sum(q).over(w)).withColumn("gl_m", (F.col("gl_p") + F.col("gl_q")) / 2)
    part = lambda a, b: F.sum(F.when((F.col(a) > 0) & (F.col(b) > 0), F.col(a) * F.ln(F.col(a) / F.when(F.col(b) > 0, F.col(b)))).otherwise(0.0))
    one = rows.groupBy(*keys).agg(F.sum(F.sqrt(F.col("gl_p") * F.col("gl_q"))).alias("bc"), ((part("gl_p", "gl_m") + part("gl_q", "gl_m")) / 2).alias("js"), part("gl_p", "gl_q").alias("kl"))
    b = -F.ln(F.when(F.col("bc") > 0, F.col("bc")))
    return one.select(*keys, F.round(b, 3).alias("bhattacharyya"), F.round(2 * (1 - F.exp(-b)), 6).alias("jm"), F.round("js", 6).alias("js"), F.round("kl", 6).alias("kl"))


def overlap_scores(pairs: DataFrame, ref: str, pred: str, x: str, y: str) -> DataFrame:
    """ref, pred, iou, over, under, shift of pixel rows (pixel, ref or null, pred or null) for each reference and its largest overlap."""
    size = lambda c, n: pairs.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(f"n_{n}"), F.avg(x).alias(f"x_{n}"), F.avg(y).alias(f"y_{n}"))
    both = pairs.filter(F.col(ref).isNotNull() & F.col(pred).isNotNull()).groupBy(ref, pred).agg(F.count(F.lit(1)).alias("shared"))
    best = both.groupBy(ref).agg(F.max(F.struct("shared", (-F.col(pred)).alias("p"))).alias("m")).select(ref, (-F.col("m.p")).alias(pred), F.col("m.shared").alias("shared"))
    out = best.join(size(ref, "r"), ref).join(size(pred, "p"), pred)
    return out.select(
        ref, pred, (F.col("shared") / (F.col("n_r") + F.col("n_p") - F.col("shared"))).alias("iou"), (1 - F.col("shared") / F.col("n_r")).alias("over"),
        (1 - F.col("shared") / F.col("n_p")).alias("under"), F.hypot(F.col("x_r") - F.col("x_p"), F.col("y_r") - F.col("y_p")).alias("shift"),
    )


def relative_error(pred: Column, ref: Column) -> Column:
    """Positive where too much: pred/ref - 1; negative where too little: 1 - ref/pred."""
    return F.when(pred >= ref, pred / F.when(ref > 0, ref) - 1).otherwise(1 - ref / F.when(pred > 0, pred))


def chip_accuracy(polys: DataFrame, region: str, kind: str, area: str) -> DataFrame:
    """Number, mean and total area of predicted and reference polygons by region, with signed relative errors."""
    n = polys.groupBy(region).pivot(kind, ["pred", "ref"]).agg(F.count(F.lit(1)).alias("n"), F.avg(area).alias("mean"), F.sum(area).alias("area"))
    return n.select(region, *(F.round(relative_error(F.col(f"pred_{m}"), F.col(f"ref_{m}")), 6).alias(f"{m}_error") for m in ("n", "mean", "area")))


def field_shape(area: Column, perimeter: Column) -> list[Column]:
    """APR (area over perimeter) and APrEf (100 perimeter / (4 sqrt area))."""
    return [(area / F.when(perimeter > 0, perimeter)).alias("APR"), (100 * perimeter / F.when(area > 0, 4 * F.sqrt(area))).alias("APrEf")]


def segmentation_accuracy(pixels: DataFrame, ref: str, pred: str, region: str, x: str, y: str) -> tuple[DataFrame, DataFrame]:
    """Scores of predicted against reference segments: by reference (``overlap_scores`` with region and iou >= 0.5 as ``hit``), and by region:
    mean iou, share of hits, number of both, signed error of their number."""
    home = pixels.filter(F.col(ref).isNotNull()).groupBy(ref).agg(F.min(region).alias(region))
    by_ref = overlap_scores(pixels, ref, pred, x, y).join(home, ref).withColumn("hit", F.col("iou") >= 0.5)
    n = pixels.groupBy(region).agg(F.count_distinct(ref).alias("n_ref"), F.count_distinct(pred).alias("n_pred"))
    means = by_ref.groupBy(region).agg(F.avg("iou").alias("iou"), F.sum(F.col("hit").cast("int")).alias("hits"))
    out = n.join(means, region, "left")
    hits = F.coalesce("hits", F.lit(0)) / F.when(F.col("n_ref") > 0, F.col("n_ref"))
    return by_ref, out.select(region, "n_ref", "n_pred", "iou", hits.alias("hits"), relative_error(F.col("n_pred"), F.col("n_ref")).alias("n_error"))


def holdout_scores(preds: DataFrame, group: str, hits: list, pred: str = "pred", obs: str = "label") -> DataFrame:
    """Accuracy and recall (share predicted as one of ``hits``) of each hold-out group, and of all (``ALL``)."""
    out = preds.groupingSets([[F.col(group)], []], F.col(group)).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col(pred) == F.col(obs)).cast("double")), 3).alias("OA"), F.round(F.avg(F.col(pred).isin(hits).cast("double")), 3).alias("recall"),
        F.grouping(group).alias("gl_all"),
    )
    return out.select(F.when(F.col("gl_all") == 1, "ALL").otherwise(F.col(group).cast("string")).alias(group), "n", "OA", "recall")
