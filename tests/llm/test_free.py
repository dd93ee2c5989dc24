"""The other operators against brute force, round trips and held-out accuracy."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from gridloom.llm import components, encoding, mixing, packing, quality_classifier, simhash, suffix_dedup, token_counts, token_files


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def union(n, pairs):
    p = list(range(n))

    def find(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    for a, b in pairs:
        p[find(a)] = find(b)
    return [find(i) for i in range(n)]


def distances(f):
    x = f[:, None] ^ f[None, :]
    return np.unpackbits(x.view(np.uint8).reshape(len(f), len(f), 8), axis=2).sum(axis=2)


def clustered(n):
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, n // 6, dtype=np.uint64)
    out = [base]
    for k in range(1, 6):
        x = base.copy()
        for _ in range(k):
            x ^= np.uint64(1) << r.integers(0, 64, len(base), dtype=np.uint64)
        out.append(x)
    return np.unique(np.concatenate(out))


def test_bit_sliced_links():
    f = clustered(700)
    want = distances(f) <= 4
    a, b = simhash.links_in_blocks(f, np.zeros(len(f), np.int64))
    got = np.eye(len(f), dtype=bool)
    got[a, b] = got[b, a] = True
    assert (got == want).all()
    a, b = simhash.links_in_large(f)
    assert want[a, b].all()
    x, y = union(len(f), zip(a, b, strict=True)), union(len(f), zip(*np.nonzero(want), strict=True))
    assert len(set(zip(x, y, strict=True))) == len(set(x)) == len(set(y))


def test_counters():
    """The carry-save counters against plain popcounts, for each radius."""
    r = np.random.default_rng(3)
    f = np.concatenate([clustered(300), r.integers(0, 2**63, 200, dtype=np.uint64)])
    for radius in (0, 3, 4, 5, 6, 7, 8, 30, 40):
        row, lane = simhash.lanes(simhash.near(simhash.spread(f)[:, :, None], simhash.planes(f), radius))
        got = np.zeros((len(f), -(-len(f) // 64) * 64), bool)
        got[row, lane] = True
        assert (got[:, : len(f)] == (distances(f) <= radius)).all()
    wide = r.integers(0, 2**63, (300, 16), dtype=np.uint64)
    wide[1::2] = wide[::2]
    for i in range(1, 300, 2):
        for bit in r.permutation(1024)[: i + 120]:
            wide[i, bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    far = np.bitwise_count(wide[:, None, :] ^ wide[None, :, :]).sum(axis=2)
    want = union(300, zip(*np.nonzero(far <= 272), strict=True))
    for a, b in (simhash.links_in_blocks(wide, np.zeros(300, np.int64), 272), simhash.links_in_large(wide, 272)):
        assert (far[a, b] <= 272).all()
        got = union(300, zip(a, b, strict=True))
        assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))
        assert len(set(zip(simhash.groups_of(a, b, 300).tolist(), want, strict=True))) == len(set(want))


@pytest.mark.parametrize(("chunk", "full"), [(1 << 15, 64), (20, 64), (1 << 15, 0)])
def test_buckets_cross_batches(monkeypatch, spark, chunk, full):
    """Small, large and cut buckets, and more bands, give the same components."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    monkeypatch.setattr(simhash, "FULL", full)
    monkeypatch.setattr(simhash, "banding", lambda n, plain=simhash.banding: plain(n if full else n << 20))
    f = clustered(600)
    nodes = spark.createDataFrame([(int(x),) for x in f.view(np.int64)], "fp long")
    at = {int(x): i for i, x in enumerate(f.view(np.int64))}
    want = union(len(f), zip(*np.nonzero(distances(f) <= 4), strict=True))
    monkeypatch.setattr(simhash, "LARGE", 8)
    got = union(len(f), [(at[r["a"]], at[r["b"]]) for r in simhash.links(nodes).collect()])
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def slow_fingerprint(text):
    w = words_of(text)
    if not w:
        return 0
    grams = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    bits = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if bits[b] * 2 > len(grams))


def test_simhash(docs, odd):
    for df in (docs, odd.filter("doc_id is not null").dropDuplicates(["doc_id"])):
        rows = df.select("doc_id", "text").collect()
        f = np.array([slow_fingerprint(r["text"]) for r in rows], np.uint64)
        roots = union(len(f), zip(*np.nonzero(distances(f) <= 4), strict=True))
        least = defaultdict(lambda: 1 << 62)
        for r, root in zip(rows, roots, strict=True):
            least[root] = min(least[root], r["doc_id"])
        want = {r["doc_id"]: (f"{int(x):016x}", least[root]) for r, x, root in zip(rows, f, roots, strict=True)}
        assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(df).collect()} == want
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    rows = odd.collect()
    roots = union(len(rows), zip(*np.nonzero(distances(np.array([slow_fingerprint(r["text"]) for r in rows], np.uint64)) <= 4), strict=True))
    best = {}
    for r, root in zip(rows, roots, strict=True):
        key = (r["doc_id"] is None, r["doc_id"] or 0, hashlib.md5((r["text"] or "").encode()).digest())
        best[root] = min(best.get(root, key), key)
    kept = [(r["doc_id"] is None, r["doc_id"] or 0, hashlib.md5((r["text"] or "").encode()).digest()) for r in left.collect()]
    assert sorted(kept) == sorted(best.values())
    assert simhash.simhash_components(odd.limit(0)).count() == 0 and simhash.drop_near_duplicates(odd.limit(0)).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = dict(components.connected_components(links).collect())
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert components.connected_components(links.limit(0)).count() == 0


def test_encoder_equals_library(docs, vocabulary):
    enc = encoding.Encoder(vocabulary("word_bpe_49k.json"))
    assert enc.by_piece
    r = np.random.default_rng(2)
    texts = [r["text"] for r in docs.collect()] + ["don't we'll <|endoftext|> x ", "\x1c\x1d a\x85b 日本 \U0001f600 Σας İstanbul ½", "", None]
    texts += ["".join(r.choice(list("aZé'1_-<|> \n\tßÿ×½Ààſ"), 40)) for _ in range(1000)]
    for t in texts:
        assert np.frombuffer(enc.encode(t), enc.dtype).tolist() == enc.tokenizer.encode(t or "", add_special_tokens=False).ids


def ids_of(vocabulary, text, end):
    from tokenizers import Tokenizer

    global _tokenizer
    _tokenizer = globals().get("_tokenizer") or Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    return np.array(_tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_token_files(docs, odd, vocabulary, spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 1 << 16)
    v = vocabulary("word_bpe_49k.json")
    for df in (docs, odd):
        rows = sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["text"] is not None, r["text"] or ""))
        want, at = [], 0
        for r in rows:
            x = ids_of(vocabulary, r["text"], 1)
            want.append((r["doc_id"], at, len(x), zlib.crc32(x)))
            at += len(x)
        assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in token_files.token_files(spark, df, v, 1).collect())
    manifest = token_files.write_tokens(docs, str(tmp_path / "t"), v, 1).orderBy("start").collect()
    assert len(manifest) > 1
    shard = token_files.Shard(manifest[1]["path"])
    some = docs.filter(f"doc_id = {manifest[1]['first_key']}").first()
    assert (shard.get(some["doc_id"]) == ids_of(vocabulary, some["text"], 1)).all()
    assert shard.get(10**12) is None and (shard.find(np.arange(10**9, 10**9 + 1000)) == -1).all()
    assert token_files.token_files(spark, odd.limit(0), v, 1).count() == 0


def test_corpus(spark, vocabulary, monkeypatch, tmp_path):
    """Keyed access over shards, with keys that repeat over several; the lazy lookup equals the whole index."""
    monkeypatch.setattr(token_files, "SHARD_BYTES", 2000)
    rows = [(i * 3 if i % 4 else 21, f"text {i} " * (i % 9)) for i in range(400)] + [(None, f"none {i}") for i in range(40)] + [(21, "again " * 9)] * 200
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).cache()
    manifest = token_files.write_tokens(df, str(tmp_path / "t"), vocabulary("word_bpe_49k.json"), 1)
    corpus = token_files.Corpus(manifest)
    assert len(corpus.paths) > 5
    by = defaultdict(list)
    for i, t in rows:
        by[i].append(t)
    for i, ts in by.items():
        if i is not None:
            assert corpus.get(i).tolist() in [ids_of(vocabulary, t, 1).tolist() for t in ts]
    assert corpus.get(1) is None and corpus.get(-5) is None and corpus.get(10**9) is None
    for path in corpus.paths:
        shard = token_files.Shard(path)
        keys = np.unique(shard.section("keys", np.int64)[shard.section("flags", np.uint8) == 0])
        assert [shard.slot_of(int(k)) for k in keys] == shard.find(keys).tolist()
    sums = sum(r["n_tokens"] for r in token_files.read_tokens(manifest).collect())
    assert sums == sum(len(ids_of(vocabulary, t, 1)) for _, t in rows)


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(-(2**62), 2**62, 20_000))
    index = token_files.PerfectHash.of(keys)
    assert sorted(index.slots(keys)) == list(range(len(keys)))
    assert len(token_files.PerfectHash.of(keys[:0]).slots(keys[:3])) == 3


def test_packing(docs, odd, vocabulary, monkeypatch):
    monkeypatch.setattr(packing, "PART_TOKENS", 30_000)
    v = vocabulary("word_bpe_49k.json")
    for df, length in ((docs, 4096), (odd, 512)):
        got = packing.pack_documents(df, v, 2, length).collect()
        seqs = defaultdict(list)
        for p in got:
            seqs[p["sequence_id"]].append(p)
        for s in seqs.values():
            at = 0
            for p in sorted(s, key=lambda p: p["offset"]):
                assert p["offset"] == at and p["length"] > 0
                at += p["length"]
            assert at == s[0]["sequence_length"] <= length and at & (at - 1) == 0
        rows = df.collect()
        assert sum(p["length"] for p in got) == sum(len(ids_of(vocabulary, r["text"], 2)) for r in rows)
        for r in {r["doc_id"]: r for r in rows if sum(q["doc_id"] == r["doc_id"] for q in rows) == 1}.values():
            x, at = ids_of(vocabulary, r["text"], 2), 0
            for p in sorted((p for p in got if p["doc_id"] == r["doc_id"]), key=lambda p: p["start"]):
                assert (p["start"], p["doc_tokens"], p["ids_crc32"]) == (at, len(x), zlib.crc32(x[at : at + p["length"]]))
                at += p["length"]
            assert at == len(x)
    assert packing.pack_documents(odd.limit(0), v, 2).count() == 0


def test_round_robin_owes():
    """Credit from before is served first, and a source that runs out leaves its room to others."""
    first = {}
    for q, _, _, n, window, _, _ in packing.round_robin([[4096] * 4, [4096] * 4], [0.5, 0.5], [2048.0, -2048.0], 4096):
        first[window, q] = first.get((window, q), 0) + n
    assert first[0, 0] == 4096 and (0, 1) not in first and first[1, 0] == first[1, 1] == 2048
    got = list(packing.round_robin([[100], [8000]], [0.9, 0.1], [0.0, 0.0], 4096))
    assert sum(x[3] for x in got) == 8100


def test_packing_targets(spark, vocabulary, monkeypatch):
    """Windows over several partitions keep target proportions while sources last, whatever ids rows have."""
    monkeypatch.setattr(packing, "PART_TOKENS", 60_000)
    r = np.random.default_rng(5)
    rows = [(None if k % 2 else 7, " ".join(f"{x}" for x in r.integers(0, 9, 300)), "ab"[k % 2]) for k in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    v = vocabulary("word_bpe_49k.json")
    own = packing.pack(packing.encoded(df, v, 2), 4096, "<u2", True)
    total = own.groupBy("sequence_id").agg({"length": "sum"}).count()
    sizes = [x["n"] for x in packing.encoded(df, v, 2).collect()]
    assert own.agg({"length": "sum"}).first()[0] == sum(sizes) and total >= sum(sizes) // 4096
    assert own.agg({"sequence_id": "max"}).first()[0] == total - 1
    # source b is the null ids; targets 3 to 1
    got = packing.pack_documents(df, v, 2, weights={"a": 3.0, "b": 1.0}).collect()
    assert sum(p["length"] for p in got) == sum(sizes)
    share = defaultdict(lambda: [0, 0])
    for p in got:
        share[p["sequence_id"]][p["doc_id"] is None] += p["length"]
    both = [a / (a + b) for a, b in share.values() if a and b and a + b == 4096]
    assert len(both) > 10 and abs(np.median(both) - 0.75) < 0.1
    with pytest.raises(ValueError, match="weights"):
        packing.pack_documents(df, v, 2, weights={"a": -1.0})


def test_running_sums(spark):
    from gridloom.llm import shared

    r = np.random.default_rng(6)
    rows = [(int(i), "ab"[int(r.integers(2))] if i % 5 else None, int(r.integers(100))) for i in r.permutation(500)]
    got = shared.running_sums(spark.createDataFrame(rows, "i long, k string, v long"), "i", ["v"], ["k"], block=16).collect()
    assert len(got) == 500 and all(x["v_before"] == sum(v for i, k, v in rows if i < x["i"] and k == x["k"]) for x in got)
    assert [shared.tasks_for(n, 10) for n in (0, 1, 10, 11, 25)] == [1, 1, 10, 6, 9]


def test_round_robin_keeps_proportions():
    r = np.random.default_rng(4)
    queues = [list(map(int, r.integers(50, 900, n))) for n in (600, 300, 100)]
    total = sum(map(sum, queues))
    shares = [sum(q) / total for q in queues]
    got = np.zeros((total // 4096 + 20, 3))
    for q, _, _, n, window, _, _ in packing.round_robin(queues, shares, [0.0] * 3, 4096):
        got[window, q] += n
    running = got[: total // 4096].cumsum(axis=0) / (4096 * np.arange(1, total // 4096 + 1))[:, None]
    assert np.abs(running[5:] - shares).max() < 0.03


def test_mixing(docs, odd, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 3)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 5000)
    for df in (docs, odd):
        got = mixing.mix_digest(df)
        rows = got.collect()
        src = df.groupBy("source").count().count()
        by = defaultdict(list)
        for r in rows:
            assert r["taken"] <= 2 * r["size"]
            by[r["target"], r["source_size"]].append(r)
        total = sum(r["size"] for r in rows)
        assert len(rows) == df.count() and src >= len(by)
        assert abs(sum(r["taken"] for r in rows) - 1.5 * total) <= src
        mixed = mixing.mix(df)
        assert mixed.columns == df.columns
        assert mixed.agg({"text": "count"}).first()[0] is not None
        assert sum(len(words_of(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in rows)
        assert sorted(map(str, got.select("doc_id", "taken").collect())) == sorted(map(str, mixing.mix_digest(df.repartition(3)).select("doc_id", "taken").collect()))
    assert mixing.mix_digest(odd.limit(0)).count() == 0 and mixing.mix(odd.limit(0)).count() == 0


def test_mixing_by_source(spark, docs, odd, monkeypatch):
    """Each source's words against the targets worked out here, and blocks, quotas and shards that grow."""
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 2)
    monkeypatch.setattr(mixing, "SHARD_WORDS", 700)
    monkeypatch.setattr(mixing, "SUBTREE", 5)
    for most in (1 << 18, 3):
        monkeypatch.setattr(mixing, "MOST_BLOCKS", most)
        monkeypatch.setattr(mixing, "MOST_SHARDS", most)
        for df in (docs, odd):
            size, taken = defaultdict(int), defaultdict(int)
            for r in df.select("source", "text").collect():
                size[r["source"]] += len(words_of(r["text"]))
            for r in mixing.mix(df).collect():
                taken[r["source"]] += len(words_of(r["text"]))
            order = sorted(size, key=lambda s: (s is None, s or ""))
            w, left, free, want = [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(size.values()), set(range(len(order))), {}
            while free:
                per = left / sum(w[i] for i in free)
                full = {i for i in free if per * w[i] > 2 * size[order[i]]}
                for i in full or free:
                    want[order[i]] = 2 * size[order[i]] if full else per * w[i]
                left -= sum(2 * size[order[i]] for i in full)
                free -= full or set(free)
            assert all(abs(taken[s] - want[s]) <= 1 for s in order)
            told = {(r["source_size"], r["target"]) for r in mixing.mix_digest(df).collect()}
            assert {t for _, t in told} == {float(x) for x in want.values()} or all(any(abs(t - x) < 1e-6 for x in want.values()) for _, t in told)
    named = docs.withColumn("gl_order", docs["doc_id"]).withColumn("gl_shard", docs["doc_id"]).withColumn("gl_order_", docs["doc_id"]).withColumn("a.b", docs["doc_id"])
    assert mixing.mix(named).columns == named.columns and mixing.mix(named).count() > 0
    monkeypatch.setattr(mixing, "MOST_SOURCES", 1)
    with pytest.raises(ValueError, match="sources"):
        mixing.mix_digest(docs)


def test_targets():
    t = mixing.targets([10, 100, 100])
    assert t[0] == 20 and sum(t) == 315 and all(x <= 2 * s for x, s in zip(t, [10, 100, 100], strict=True))
    whole = mixing.split_tree([500, 70, 3], 37)
    assert all((mixing.split_tree([500, 70, 3], 37, low=a, high=min(37, a + 5)) == whole[:, a : a + 5]).all() for a in range(0, 37, 5))
    q = mixing.split_tree([50, 7, 0], 6)
    assert q.sum(axis=1).tolist() == [50, 7, 0] and (mixing.split_tree([50, 7, 0], 6) == q).all() and q.sum(axis=0).max() - q.sum(axis=0).min() <= 3


def test_quality_classifier(spark, docs, labels, odd):
    sf = "/root/testdata/sf0.01"
    d, y = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality_classifier.score_quality(d, y)
    assert got.count() == d.count()
    held = got.join(y, "doc_id").filter("held_out").toPandas()
    assert (held.predicted == held.quality).mean() > 0.95
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id) and held.score.between(0, 1).all()
    assert quality_classifier.score_quality(odd, labels).count() == odd.count()
    none = quality_classifier.score_quality(odd, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_classifier.keep_quality(odd, labels).columns == odd.columns
    assert quality_classifier.score_quality(odd.limit(0), labels).count() == 0


def test_pair_loss():
    """The fit is where the logistic loss on differences, with its penalty, has no slope; the threshold parts the labels as well as any quantile."""
    r = np.random.default_rng(8)
    label = r.integers(0, 2, 400)
    x = r.normal(size=(400, 6)) + label[:, None] * np.array([1.0, 0.5, 0, 0, -0.7, 0])
    m = quality_classifier.fit(x, label)
    z = (x - m.centre) / m.scale
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    rng = np.random.default_rng(quality_classifier.SEED)
    n = min(quality_classifier.PAIRS, 20 * max(len(good), len(bad)))
    diff = z[good[rng.integers(0, len(good), n)]] - z[bad[rng.integers(0, len(bad), n)]]
    loss = lambda w: np.log1p(np.exp(-diff @ w)).mean() + quality_classifier.PENALTY / 2 * w @ w
    for k in range(6):
        for step in (1e-3, -1e-3):
            assert loss(m.weights + step * np.eye(6)[k]) > loss(m.weights)
    raw = m.raw(x)
    best = max((raw[good] >= c).mean() + (raw[bad] < c).mean() for c in np.quantile(raw, np.linspace(0, 1, 1001)))
    assert (raw[good] >= m.threshold).mean() + (raw[bad] < m.threshold).mean() >= best - 0.02
    assert ((m.scores(x) >= quality_classifier.CUT) == (raw >= m.threshold)).mean() > 0.99


def test_classifier_on_repeated_ids(spark, docs, labels):
    """A labelled id that very many rows repeat gives one text, and the same model each time."""
    some = docs.join(labels, "doc_id").select(docs.columns)
    many = some.unionByName(spark.range(500).selectExpr(f"{some.first()['doc_id']} AS doc_id", "concat('zz ', id) AS text", "'en' AS lang", "'s' AS source", "1 AS n_chars").select(docs.columns))
    a, b = (quality_classifier.learn(df, labels) for df in (many, many.repartition(5)))
    assert (a.weights == b.weights).all() and a.threshold == b.threshold


def test_token_counts(docs, odd, vocabulary, monkeypatch):
    v = vocabulary("piece_bpe_32k.model")
    scores = token_counts.scores_of(v)
    t = token_counts.Trie(scores)

    def slow(word):
        w, best = token_counts.MARK + word, [(0.0, 0)]
        for i in range(1, len(w) + 1):
            n = len(w[i - 1].encode())
            c = [(best[i - 1][0] + n * t.byte, best[i - 1][1] + n)]
            c += [(scores[w[j:i]] + best[j][0], best[j][1] + 1) for j in range(max(0, i - 40), i) if w[j:i] in scores]
            best.append(max(c, key=lambda x: (x[0], -x[1])))
        return best[-1][1]

    known = {}
    for df in (docs, odd.filter("doc_id is not null").dropDuplicates(["doc_id"]).filter("length(text) < 200000")):
        texts = dict(df.select("doc_id", "text").collect())
        for r in token_counts.token_counts(df, v).collect():
            w = (texts[r["doc_id"]] or "").split()
            for x in set(w) - known.keys():
                known[x] = slow(x)
            assert (r["n_pretokens"], r["n_tokens"]) == (len(w), sum(known[x] for x in w))
    monkeypatch.setattr(token_counts, "NODES", 50)
    assert all(t.count(w) == slow(w) for w in ("日本\U0001f600", "a" * 60, "theft", "the", "then"))
    assert token_counts.token_counts(odd, v).count() == odd.count() and token_counts.token_counts(odd.limit(0), v).count() == 0


def test_token_counts_by_a_table(spark, tmp_path):
    """Scores of a unigram table, as they stand in it."""
    path = tmp_path / "scores.vocab"
    path.write_text("<unk>\t0\n<s>\t0\n▁\t-2\na\t-3\nb\t-3\nab\t-4\n▁ab\t-9\nba\t-20\n")
    assert token_counts.scores_of(str(path)) == {"▁": -2, "a": -3, "b": -3, "ab": -4, "▁ab": -9, "ba": -20}
    df = spark.createDataFrame([(1, "ab ba aba"), (2, "c")], "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(df, str(path)).collect()}
    assert got == {1: 2 + 3 + 3, 2: 2}  # ▁ ab, ▁ b a, ▁ ab a; ▁ and one byte


def shared_by_force(rows):
    texts = [words_of(t) for _, t in rows]
    seen = defaultdict(set)
    for i, w in enumerate(texts):
        for a in range(len(w) - 49):
            seen[tuple(w[a : a + 50])].add(i)
    out = []
    for i, w in enumerate(texts):
        spans = []
        for a in range(len(w) - 49):
            if len(seen[tuple(w[a : a + 50])]) > 1:
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = a + 50
                else:
                    spans.append([a, a + 50])
        out += [(rows[i][0], a, b) for a, b in spans]
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [40_000, 7])
def test_suffix_dedup(spark, docs, monkeypatch, rows):
    """With few ``rows`` a task, beginnings go over many tasks, and windows that only two tasks together can tell."""
    monkeypatch.setattr(suffix_dedup, "TASK_ROWS", rows)
    passage = " ".join(f"p{i}" for i in range(57))
    more = [(10**6 + i, f"a{i} b{i} {passage} c{i} " + " ".join(f"t{i}x{k}" for k in range(60))) for i in range(9)]
    more += [(4 * 10**6 + i, f"{'g ' * i} h{i % 3} {passage[:-40 + i]} k{i % 5}") for i in range(40)]
    more += [(5 * 10**6, "one " + "z " * 50 + "two"), (5 * 10**6 + 1, "z " * 300), (5 * 10**6 + 2, "m n o " * 40), (5 * 10**6 + 3, "q " + "o m n " * 30)]
    more += [(2 * 10**6, "x " * 300), (2 * 10**6 + 1, "y " + "x " * 120 + "z"), (None, passage), (3 * 10**6, None), (3 * 10**6 + 1, "")]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted(((r["doc_id"], r["start"], r["after"]) for r in suffix_dedup.shared_spans(df).collect()), key=str)
    assert got == shared_by_force([tuple(r) for r in df.collect()])


def test_suffix_dedup_odd(odd):
    got = suffix_dedup.shared_spans(odd.unionByName(odd)).collect()
    assert {r["doc_id"] for r in got} == {5} and {(r["start"], r["after"]) for r in got} == {(0, 30_000)}
    assert suffix_dedup.shared_spans(odd.limit(0)).count() == 0
