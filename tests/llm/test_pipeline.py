"""The pipeline's stages, one after the other, against brute force."""

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from gridloom.llm import quality_classifier

from .conftest import SF
from .test_free import ids_of, words_of
from .test_jaccard import components_by_force
from .test_native import low


def test_stages(spark, docs, labels, tmp_path, vocabulary):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    tables, now = [docs], docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SF).write.parquet(str(tmp_path / str(i)))
        now = spark.read.parquet(str(tmp_path / str(i)))
        tables.append(now)
        if i < 4:
            assert now.columns == docs.columns
    ids = [[r["doc_id"] for r in t.select("doc_id").collect()] for t in tables]
    good = {r["doc_id"] for r in quality_classifier.score_quality(docs, labels).filter("predicted = 1").collect()}
    assert sorted(ids[1]) == sorted(good)
    groups = defaultdict(list)
    for r in tables[1].collect():
        groups[low(r["text"])].append(r["doc_id"])
    assert sorted(ids[2]) == sorted(map(max, groups.values()))
    assert set(ids[3]) <= set(ids[2]) and len(ids[3]) == len(set(ids[3]))
    assert max(Counter(ids[4]).values()) <= 2 and set(ids[4]) <= set(ids[3])
    size = sum(len(words_of(r["text"])) for r in tables[3].collect())
    assert abs(sum(len(words_of(r["text"])) for r in tables[4].collect()) - 1.5 * size) <= 20
    near = components_by_force(tables[2].collect())
    assert sorted(ids[3]) == sorted(set(near.values()))
    v = vocabulary("word_bpe_49k.json")
    want = Counter()
    for r in tables[4].collect():
        x = ids_of(vocabulary, r["text"], 2)
        want[r["doc_id"], len(x)] += len(x)
    got = Counter()
    for p in tables[5].collect():
        got[p["doc_id"], p["doc_tokens"]] += p["length"]
    assert got == want and v


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0 and "sequence_id" in got.columns


@pytest.mark.parametrize("rows", [None, 0])
def test_odd_and_empty(spark, docs, odd, tmp_path, rows):
    """Nulls in any column, empty and long texts, rows that repeat, columns with names that stages use; and no row at all."""
    now = odd.unionByName(docs.limit(40), allowMissingColumns=True)
    now = now.limit(0) if rows == 0 else now
    names = now.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = now
        stage(spark, now, SF).write.parquet(str(tmp_path / str(i)))
        now = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert now.columns == names
        if i < 3:
            assert now.count() <= before.count()
        assert (now.count() == 0) == (rows == 0)
