"""Text quality by Bradley-Terry pairwise ranking.

A linear score of text features is learned from preference pairs, a text of
label 1 over one of label 0, by the logistic loss on differences of features.
The threshold is that quantile of the scores of the labelled texts which parts
the labels best; scores are shifted so that the threshold is ``CUT``.

The learner sees at most ``SAMPLE`` texts of each label (the first by a hash of
their id) and ``PAIRS`` pairs; every text is scored.  Inputs of a score come
from the text alone.

Defined results: a null or empty text has all features zero and gets a score
like any other; a row whose id is null is held out by the remainder of the empty
string and never learned from; of rows that repeat a labelled id the least text
is learned from, and repeated rows get the same score; a label other than 0 and
1 is not used; without texts of both labels every score is 0.5; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_name

SAMPLE, PAIRS, SEED = 8000, 60_000, 7
CUT, FOLDS = 0.3, 5
PENALTY, STEPS = 1e-3, 25
WIDTH = 95 + 4 + 9


def features(text: str | None) -> np.ndarray:
    """Shares of ASCII characters and of other bytes, and how words and lines are made and repeated."""
    out = np.zeros(WIDTH)
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return out
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    out[:95] = np.sqrt(h[32:127])
    out[95:99] = np.sqrt([h[10], h[9] + h[11:14].sum(), h[128:].sum(), h[65:91].sum()])
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    n = max(1, len(words))
    counts = Counter(words)
    top = max(counts.values(), default=0)
    pairs = Counter(zip(words, words[1:], strict=False))
    out[99:] = [
        np.log1p(len(words)) / 10, len(counts) / n, top / n, sum(map(len, words)) / n / 10, len(set(lines)) / max(1, len(lines)),
        len(lines) / n, sum(v for v in pairs.values() if v > 1) / n, sum(len(w) == 1 for w in words) / n, sum(w[-1] in ".,;:!?" for w in words) / n,
    ]
    return out


@dataclass
class Ranker:
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = self.raw(x) - self.threshold + np.log(CUT / (1 - CUT))
        return np.where(z >= 0, 1 / (1 + np.exp(-np.abs(z))), np.exp(-np.abs(z)) / (1 + np.exp(-np.abs(z))))


def fit(x: np.ndarray, label: np.ndarray) -> Ranker | None:
    """Newton's method on the pairs; None without texts of both labels."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return None
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - centre) / scale
    rng = np.random.default_rng(SEED)
    n = min(PAIRS, 20 * max(len(good), len(bad)))
    diff = z[good[rng.integers(0, len(good), n)]] - z[bad[rng.integers(0, len(bad), n)]]
    w = np.zeros(x.shape[1])
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # of the other order
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / n + PENALTY * np.eye(len(w)), diff.T @ p / n - PENALTY * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    out = Ranker(w, centre, scale, 0.0)
    # The quantile with the best mean of both labels' shares on their side.
    r = out.raw(x)
    cuts = np.quantile(r, np.linspace(0, 1, 1001))
    right = (r[good][None, :] >= cuts[:, None]).mean(axis=1) + (r[bad][None, :] < cuts[:, None]).mean(axis=1)
    best = np.flatnonzero(right >= right.max() - 1e-12)
    out.threshold = float((cuts[best[0]] + cuts[best[-1]]) / 2)
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == 0


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Ranker | None:
    """Fit on at most ``SAMPLE`` texts of each label outside the held-out fold."""
    known = labels.select(F.col(id_col).alias("k"), F.col(label_col).cast("int").alias("label")).filter("k is not null and label in (0, 1)").filter(~held_out(F.col("k")))
    some = [known.filter(F.col("label") == v).orderBy(F.xxhash64("k"), "k").limit(SAMPLE) for v in (0, 1)]
    sample = F.broadcast(some[0].unionByName(some[1]))  # at most 2 * SAMPLE rows
    found = docs.select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(sample, "k")
    found = found.groupBy("k", "label").agg(F.min("text").alias("text"))  # ids that repeat

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"k": batch["k"], "label": batch["label"], "x": [features(t) for t in batch["text"]]})

    rows = found.mapInPandas(run, "k long, label int, x array<double>").toPandas().sort_values(["k", "label"], kind="stable")
    if not len(rows):
        return None
    return fit(np.stack(rows["x"].to_numpy()), rows["label"].to_numpy())


def scored(model: Ranker | None):
    """A function of the text column that gives the score."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            out = np.full(len(s), 0.5)
            for i in range(0, len(s), 512):
                if model is not None:
                    out[i : i + 512] = model.scores(np.stack([features(t) for t in s.iloc[i : i + 512]]))
            yield pd.Series(out)

    return score


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    score = scored(learn(docs, labels, id_col, text_col))
    out = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with all their columns."""
    score, at = scored(learn(docs, labels, id_col, text_col)), free_name(docs, "gl_score")
    return docs.withColumn(at, score(F.col(text_col))).filter(F.col(at) >= CUT).drop(at)
