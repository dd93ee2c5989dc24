"""Near copies by five-word shingles, against brute force."""

import random
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest
from gridloom.llm import jaccard, simhash

from .conftest import SF
from .test_free import union, words_of


def components_by_force(rows):
    """The smallest doc_id of each row's component."""
    sets = []
    for r in rows:
        w = words_of(r["text"])
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            where[g].append(i)
    pairs = []
    for i, s in enumerate(sets):
        for j in {j for g in s for j in where[g] if j > i}:
            both = len(s & sets[j])
            if 5 * both >= 4 * (len(s) + len(sets[j]) - both):
                pairs.append((i, j))
    roots = union(len(rows), pairs)
    least = defaultdict(lambda: 1 << 62)
    for r, root in zip(rows, roots, strict=True):
        least[root] = min(least[root], r["doc_id"])
    return {r["doc_id"]: least[root] for r, root in zip(rows, roots, strict=True)}


def edited(r, n=80):
    """Texts that drift away from each other, at similarities on both sides of 0.8."""
    out = []
    for _ in range(n):
        w = [f"w{r.randint(0, 10**6)}" for _ in range(r.randint(30, 200))]
        for _ in range(6):
            out.append(" ".join(w))
            for _ in range(r.randint(1, 4)):
                w[r.randrange(len(w))] = f"e{r.randint(0, 10**6)}"
    return out


@pytest.fixture(scope="module")
def near(spark, docs):
    more = list(enumerate(edited(random.Random(7)), 10**6)) + [(1, ""), (2, " \n"), (3, None), (4, "Two words"), (5, "two WORDS"), (6, "two others")]
    return docs.withColumn("doc_id", docs["doc_id"] + 100).select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))


@pytest.mark.parametrize("chunk", [1_000_000, 300])
def test_near_copies(near, monkeypatch, chunk):
    """The same components where a cell is one unit and where it is many."""
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    want = components_by_force(near.collect())
    assert len(set(want.values())) < near.count() - 200
    assert {r["doc_id"]: r["component_id"] for r in jaccard.near_copies(near).collect()} == want


@pytest.mark.parametrize("dense", [8, 1, 10**9])
def test_alike(monkeypatch, dense):
    """Lists, bits and both give the components of all pairs."""
    monkeypatch.setattr(jaccard, "DENSE", dense)
    r = np.random.default_rng(11)
    sets = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.array([5], np.uint64)]
    for _ in range(12):
        base = r.integers(0, 4000, r.integers(3, 90))
        for _ in range(r.integers(1, 12)):
            x = base.copy()
            x[r.random(len(x)) < 0.07] = r.integers(0, 4000)
            sets.append(np.unique(x).astype(np.uint64))
    links = [(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets[:i]) if 5 * len(np.intersect1d(x, y)) >= 4 * len(np.union1d(x, y))]
    a, b = jaccard.alike(sets)
    assert {(max(p), min(p)) for p in zip(a.tolist(), b.tolist(), strict=True)} <= set(links)
    got, want = union(len(sets), zip(a, b, strict=True)), union(len(sets), links)
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_radius():
    """Pairs at 0.8, of small and large sets, are well within the radius."""
    r = np.random.default_rng(12)
    for n, m in ((4, 5), (8, 10), (40, 50), (400, 500)):
        for k in range(60):
            x = r.integers(0, 2**63, m, dtype=np.uint64)
            y = x[:n] if k % 2 else np.r_[x[: n - (m - n) // 2], r.integers(0, 2**63, (m - n) // 2, dtype=np.uint64)]
            both = len(np.intersect1d(x, y))
            if 5 * both >= 4 * (len(x) + len(y) - both):
                assert np.bitwise_count(jaccard.fingerprint(x) ^ jaccard.fingerprint(y)).sum() <= jaccard.RADIUS - 20


def test_odd(odd):
    got = jaccard.near_copies(odd)
    assert got.count() == odd.count() and jaccard.near_copies(odd.limit(0)).count() == 0


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_stage(spark, near, sf):
    """The stage keeps the smallest doc_id of each brute-force component."""
    df = near if sf == SF else spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    got = [r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, df, sf).collect()]
    assert sorted(got) == sorted(set(components_by_force(df.collect()).values()))


@pytest.mark.parametrize("stage", [False, True])
def test_repeated_ids(spark, stage):
    """Rows that share a doc_id, or have none, stay unless they are near copies themselves."""
    r = random.Random(9)
    a, b, c, d, e = (" ".join(f"w{r.randint(0, 10**6)}" for _ in range(80)) for _ in range(5))
    rows = [(1, a), (None, a + " z"), (None, b), (None, c), (7, d), (7, e), (7, e), (8, e + " z"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if stage:
        got = corpus_pipeline.drop_near_copies(spark, df, SF)
    else:
        same = [(i, t and t.removesuffix(" z")) for i, t in rows]  # equal texts are within any radius
        got = simhash.drop_near_duplicates(spark.createDataFrame(same, "doc_id long, text string"))
    assert sorted(((x["doc_id"], x["text"] or "") for x in got.collect()), key=str) == sorted([(1, a), (None, b), (None, c), (7, d), (7, e), (None, "")], key=str)
