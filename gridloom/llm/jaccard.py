"""Near copies by the Jaccard similarity of word shingles.

Two texts are linked where their sets of five-word shingles (A-Z lower-cased)
agree by 0.8 or more; components of links are groups of near copies.

1. Each distinct text has a SimHash of 1,024 bits over its set of shingles, and
   32 buckets, each named by four minimum hashes.  A pair at 0.8 shares no bucket
   with a chance of (1 - 0.8^4)^32, about 5e-8; more similar pairs with less.
2. In each bucket the fingerprints are compared by the bit-sliced search of
   ``simhash``.  Two texts at 0.8 differ in some 155 bits (192 where sets are very
   small), with a deviation of 12; ``RADIUS`` is more than six deviations beyond.
   Texts so connected are a cell.  Every text is in one cell at most.
3. The sets of a cell come together, and all its pairs are settled by exact
   similarity.  Cells with very many shingles are cut into chunks, and every two
   chunks are a unit of work that any task may take.  Of the links found in a
   unit, each text gives one at most.

So no pairs are sent but links, at most one a text and bucket or unit.

Defined results: a text of fewer than five words is one shingle; null, empty and
blank texts equal each other and nothing else; repeated rows share their
component; a component of null doc_ids only has a null id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import batch_rows, broadcast_if_small, saved, text_digest
from .simhash import groups_of, links_in_buckets
from .suffix_dedup import _STEP, _mix, _spans, word_hashes

WORDS = 5
#: The least similarity of a link, as a fraction.
LEAST = (4, 5)
BANDS, ROWS = 32, 4
#: Words of a fingerprint, and the bits in which those of one cell differ at most.
WIDTH, RADIUS = 16, 272
#: Shingles of a chunk of a cell, about; shares of a unit's texts from which a shingle is a bit of a row, not a list.
CHUNK, DENSE = 250_000, 8

_FACTORS = np.random.default_rng(5).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEEDS = np.random.default_rng(6).integers(0, 2**63, WIDTH, dtype=np.uint64)


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, text by text, and how many each text has."""
    hashes, text = word_hashes(texts)
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    n_words = np.diff(cut)
    n = np.where(n_words > 0, np.maximum(1, n_words - words + 1), 0)
    first = np.repeat(cut[:-1] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return _spans(_mix(hashes + np.uint64(1)), first, first + np.repeat(np.minimum(words, n_words), n), _STEP), n


def fingerprint(grams: np.ndarray) -> np.ndarray:
    """``WIDTH`` words: the majority of each bit over a set of hashes."""
    total = np.zeros(64 * WIDTH, np.int64)
    for i in range(0, len(grams), 255):  # bytes hold counts up to 255
        x = _mix(grams[i : i + 255, None] ^ _SEEDS[None, :])
        total += np.unpackbits(x.view(np.uint8).reshape(len(x), -1), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * total > len(grams), bitorder="little").view(np.uint64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id, digest, bands (bucket of each) and fp (the fingerprint's bytes) of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                grams, n = shingles(part.column("text"), words)
                least, some = np.zeros((len(n), BANDS * ROWS), np.uint64), n > 0
                if some.any():
                    at = (np.cumsum(n) - n)[some]
                    for k, factor in enumerate(_FACTORS):
                        least[some, k] = np.minimum.reduceat(grams * factor, at)
                band = np.full((len(n), BANDS), np.arange(BANDS), np.uint64)
                for k in range(ROWS):
                    band = _mix(band * np.uint64(0x9E3779B97F4A7C15) + least[:, k::ROWS] + np.uint64(1))
                # the last bits name the band
                band = (band & ~np.uint64(31)) | np.arange(BANDS, dtype=np.uint64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * BANDS, pa.int32()), pa.array(band.ravel().view(np.int64)))
                fps = [fingerprint(np.unique(x)).tobytes() for x in np.split(grams, np.cumsum(n)[:-1])]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("digest"), lists, pa.array(fps, pa.binary())], ["doc_id", "digest", "bands", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, digest binary, bands array<long>, fp binary")


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(node, component, n, grams): the set of shingles, sorted, as bytes."""
    for batch in batches:
        for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            grams, n = shingles(part.column("text"), words)
            sets = [np.unique(x) for x in np.split(grams, np.cumsum(n)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), part.column("component"), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], ["node", "component", "n", "grams"]
            )


def alike(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect all sets whose similarity is ``LEAST`` or more; sets are distinct numbers.

    Shingles that few sets have are lists of sets; others are bits, and what two sets share of them is a count of common bits.
    """
    n = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    order = np.argsort(size, kind="stable")  # a set is compared with those that are not much larger
    size, of = size[order], np.repeat(np.arange(n), size[order])
    _, shingle, times = np.unique(np.concatenate([sets[i] for i in order]) if n else np.zeros(0, np.uint64), return_inverse=True, return_counts=True)
    kept = times[shingle] > 1
    shingle, of = shingle[kept], of[kept]
    dense = times > max(1, n // DENSE)
    column = np.cumsum(dense) - 1
    del times
    bits = np.zeros((n, -(-max(1, int(dense.sum())) // 64) * 64), np.uint8)
    is_dense = dense[shingle]
    bits[of[is_dense], column[shingle[is_dense]]] = 1
    rows = np.packbits(bits, axis=1).view(np.uint64)
    del bits
    rare, of = shingle[~is_dense], of[~is_dense]
    by_shingle = np.argsort(rare, kind="stable")
    listed, members = rare[by_shingle], of[by_shingle]
    begin, after = np.searchsorted(listed, np.arange(len(dense))), np.searchsorted(listed, np.arange(len(dense)), side="right")
    own = np.searchsorted(of, np.arange(n + 1))
    end = np.searchsorted(size * LEAST[0], size * LEAST[1], side="right")  # the first that is too large
    group, left, right = np.arange(n), [], []
    for i in range(n - 1):
        other = np.arange(i + 1, end[i])
        other = other[group[other] != group[i]]
        if not len(other):
            continue
        both = np.bitwise_count(rows[other] & rows[i]).sum(axis=1, dtype=np.int64)
        lists = [members[begin[s] : after[s]] for s in rare[own[i] : own[i + 1]]]
        if lists:
            both += np.bincount(np.concatenate(lists), minlength=n)[other]
        good = other[(LEAST[0] + LEAST[1]) * both >= LEAST[0] * (size[i] + size[other])]
        if len(good):
            names, first = np.unique(group[good], return_index=True)
            left.append(np.full(len(first), i))
            right.append(good[first])
            least = min(group[i], names[0])
            group[np.isin(group, [group[i], *names])] = least
    none = np.zeros(0, np.int64)
    return (order[np.concatenate(left)], order[np.concatenate(right)]) if left else (none, none)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of rows (unit, node, grams) sorted by unit, each member of a group with its least."""

    def links(rows: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        if len(rows) > 1:
            node = np.array([x for x, _ in rows], np.int64)
            a, b = alike([np.frombuffer(x, np.uint64) for _, x in rows])
            if len(a):
                group = groups_of(a, b, len(rows))
                i = np.flatnonzero(group != np.arange(len(rows)))
                yield pa.RecordBatch.from_arrays([pa.array(node[group[i]]), pa.array(node[i])], ["a", "b"])

    held: list[tuple[int, bytes]] = []
    now = None
    for batch in batches:
        for unit, node, grams in zip(*(batch.column(c).to_pylist() for c in ("unit", "node", "grams")), strict=True):
            if unit != now:
                yield from links(held)
                held, now = [], unit
            held.append((node, grams))
    yield from links(held)


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, group (one long a component), component_id (the smallest doc_id reachable)."""
    spark = docs.sparkSession
    rows = saved(signatures(docs, id_col, text_col, words), "signatures")
    nodes = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.first("bands").alias("bands"), F.first("fp").alias("fp"))  # equal texts have equal ones
    nodes = saved(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    each = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = saved(each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket"), "buckets")
    members = saved(each.join(broadcast_if_small(shared), "bucket").select("bucket", "node"), "members")
    members = members.join(nodes.select("node", "fp"), "node").select("bucket", "node", "fp")  # fingerprints of shared buckets only
    cells = saved(connected_components(saved(links_in_buckets(members, RADIUS), "near")), "cells")

    some = broadcast_if_small(saved(nodes.join(cells, "node").select("digest", "node", "component"), "some"))
    texts = docs.select(text_digest(F.col(text_col)).alias("digest"), F.col(text_col).alias("text"))
    texts = texts.join(some, "digest").dropDuplicates(["node"]).select("node", "component", "text")
    with batch_rows(spark, 256):
        sets = saved(texts.mapInArrow(lambda batches: _sets(batches, words), "node long, component long, n long, grams binary"), "sets")
        large = sets.groupBy("component").agg(F.ceil(F.sum("n") / CHUNK).cast("int").alias("chunks")).filter("chunks > 1")
        cut = sets.join(broadcast_if_small(saved(large, "large")), "component", "left").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: j != F.col("mine"))
        units = F.transform(others, lambda j: F.xxhash64("component", F.least(j, F.col("mine")), F.greatest(j, F.col("mine"))))
        dealt = cut.select(F.explode(F.when(F.col("chunks").isNull(), F.array("component")).otherwise(units)).alias("unit"), "node", "grams")
        links = saved(dealt.repartition("unit").sortWithinPartitions("unit").mapInArrow(_settled, "a long, b long"), "links")
    joined = saved(connected_components(links), "joined")
    linked = nodes.join(joined, "node").select("digest", "least", "component")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    changed = linked.join(least, "component").select("digest", "component", "component_id")
    every = nodes.select("digest", "node", "least").join(changed, "digest", "left")
    ids = saved(every.select("digest", F.coalesce("component", "node").alias("group"), F.coalesce("component_id", "least").alias("component_id")), "ids")
    return rows.select("doc_id", "digest").join(broadcast_if_small(ids), "digest")
