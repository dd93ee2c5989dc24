"""Class models on feature tables with Spark ML, and the registry of feature models."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def feature_model(spark: SparkSession, name: str, indices: list[str], stats: list[str], singles: list[str] | None = None) -> DataFrame:
    """One row: a feature model with its band names in order."""
    bands = [f"{i}_{s}" for i in indices for s in stats] + [f"sing_{x}" for x in singles or []]
    return spark.createDataFrame([(name, indices, stats, bands)], "name string, indices array<string>, stats array<string>, band_names array<string>")


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("var_")]


def ordered_bands(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Columns in the order of a model, found with or without ``sing_`` and ``poly_``."""
    have = {c.removeprefix("sing_").removeprefix("poly_"): c for c in df.columns}
    lost = [n for n in names if n.removeprefix("sing_").removeprefix("poly_") not in have]
    if lost:
        raise ValueError(f"missing bands: {lost}")
    return df.select(*keys, *(F.col(f"`{have[n.removeprefix('sing_').removeprefix('poly_')]}`").alias(n) for n in names))


def classifier(algorithm: str, trees: int = 100, seed: int = 88, depth: int = 10):
    """RF, or GB as one boosted model a class."""
    from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier

    if algorithm.upper() == "RF":
        return RandomForestClassifier(featuresCol="features", labelCol="label_i", numTrees=trees, maxDepth=depth, seed=seed)
    return OneVsRest(classifier=GBTClassifier(featuresCol="features", maxIter=trees, maxDepth=min(depth, 5), seed=seed), labelCol="label_i", featuresCol="features")


def fit(train: DataFrame, label: str, algorithm: str = "RF", trees: int = 100, seed: int = 88, depth: int = 10):
    """A fitted pipeline over the ``var_`` columns."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="label_i", stringOrderType="alphabetAsc", handleInvalid="keep" if algorithm.upper() != "RF" else "error"),
        VectorAssembler(inputCols=feature_columns(train), outputCol="features", handleInvalid="skip"),
        classifier(algorithm, trees, seed, depth),
    ]).fit(train)


def predict(model, feats: DataFrame, name: str = "pred") -> DataFrame:
    """Classes of pixels; the label need not be there."""
    from pyspark.ml import PipelineModel

    labels = F.array(*map(F.lit, model.stages[0].labels))
    out = PipelineModel(stages=model.stages[1:]).transform(feats)
    return out.withColumn(name, F.get(labels, F.col("prediction").cast("int"))).drop("features", "rawPrediction", "probability", "prediction")


def importances(model, spark: SparkSession) -> DataFrame:
    """feature, importance by impurity."""
    names, values = model.stages[1].getInputCols(), model.stages[2].featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values, strict=True)], "feature string, importance double")


def permutation_importance(model, test: DataFrame, label: str, seed: int = 88) -> DataFrame:
    """feature, importance: loss of accuracy when a column's values are dealt to other rows."""
    from functools import reduce

    hit = lambda df: predict(model, df).agg(F.avg((F.col("pred") == F.col(label)).cast("double")).alias("a"))
    test = test.withColumn("gl_i", F.xxhash64(F.struct(*test.columns), F.lit(0)))
    base = hit(test).select(F.col("a").alias("base"))
    groups = test.count() // 20_000 + 1  # values move within groups of rows that a hash deals out
    rows = []
    for c in feature_columns(test):
        group = F.pmod("gl_i", F.lit(groups))
        from pyspark.sql import Window

        a = Window.partitionBy("gl_g").orderBy("gl_i")
        b = Window.partitionBy("gl_g").orderBy(F.xxhash64("gl_i", F.lit(seed)), "gl_i")
        left = test.withColumn("gl_g", group).withColumn("gl_n", F.row_number().over(a))
        right = left.select("gl_g", F.row_number().over(b).alias("gl_n"), F.col(c).alias("gl_v"))
        moved = left.join(right, ["gl_g", "gl_n"]).withColumn(c, F.col("gl_v")).drop("gl_v", "gl_n", "gl_g")
        rows.append(hit(moved).crossJoin(base).select(F.lit(c).alias("feature"), (F.col("base") - F.col("a")).alias("importance")))
    return reduce(DataFrame.unionByName, rows)


def top_features(importance: DataFrame, n: int) -> DataFrame:
    return importance.orderBy(F.col("importance").desc(), "feature").limit(n)


def grid(**options: list) -> list[dict]:
    """All combinations of options."""
    return [dict(zip(options, values, strict=True)) for values in product(*options.values())]


def grid_scores(train: DataFrame, test: DataFrame, label: str, options: list[dict]) -> DataFrame:
    """Scores of a model for each set of options."""
    from functools import reduce

    from .scores import overall_scores

    rows = []
    for i, o in enumerate(options):
        preds = predict(fit(train, label, **o), test)
        rows.append(overall_scores(preds, "pred", label).withColumn("run", F.lit(i)).withColumn("options", F.lit(str(o))))
    return reduce(DataFrame.unionByName, rows)


def temporal_classes(probs: DataFrame, keys: list[str], year: str, classes: list[int], columns: list[str], stay: float = 0.9) -> DataFrame:
    """keys, year, class: the most probable sequence of classes (Viterbi), given yearly probabilities and the chance that a class stays.

    A series is one row with an array of its years; batches of series go to NumPy.
    """
    from collections.abc import Iterator

    import numpy as np
    import pandas as pd

    move = np.full((len(classes), len(classes)), np.log((1 - stay) / max(1, len(classes) - 1) + 1e-12))
    np.fill_diagonal(move, np.log(stay))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for rows in b["gl_p"]:
                p = np.log(np.clip(np.array([list(r["p"]) for r in rows], float), 1e-12, None))
                best, back = p[0], []
                for t in range(1, len(p)):
                    step = best[:, None] + move
                    back.append(step.argmax(axis=0))
                    best = step.max(axis=0) + p[t]
                path = [int(best.argmax())]
                for s in reversed(back):
                    path.append(int(s[path[-1]]))
                out.append([{"year": int(r["y"]), "class": classes[k]} for r, k in zip(rows, reversed(path), strict=True)])
            yield b[keys].assign(gl_c=out)

    rows = probs.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col(year).alias("y"), F.array(*columns).alias("p")))).alias("gl_p"))
    schema = ", ".join(f"`{k}` {probs.schema[k].dataType.simpleString()}" for k in keys)
    done = rows.mapInPandas(run, schema + ", gl_c array<struct<year:int,class:int>>")
    return done.select(*keys, F.explode("gl_c").alias("c")).select(*keys, F.col("c.year").alias(year), F.col("c.class").alias("class"))
