"""Near-duplicates by SimHash, compared in bit-sliced form.

Fingerprints are 64-bit majorities over the hashes of word shingles.  Distinct
ones are dealt into buckets: 64 bits make some bands (``banding``), two that
differ in at most four bits share all bands but four, so every choice of so many
bands is a table of its own.  More fingerprints make more and narrower bands, so
that buckets stay small.  Sorted by bucket, 64 fingerprints at a time are turned
into 64 bit planes; one fingerprint is compared with all of a block by XOR on
the planes, with bit-sliced counters of carry-save adders, and blocks in which
every lane is beyond the radius are abandoned.  Of a group that is
found each member gives one link; buckets above ``CHUNK`` are cut into chunks, and
every two chunks are a unit of work that any task may take.

Links are merged to components by large-star and small-star rounds on tables.
Equal fingerprints are one node throughout, so copies are never paired, and a
bucket holds distinct fingerprints only.

Defined results: a null or empty text has fingerprint zero, linked like any
other; repeated rows share their component; a component of null doc_ids only
has a null id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import broadcast_if_small, free_name, saved, text_digest

SEED, RADIUS = 42, 4
#: Buckets from this size are searched one by one, those above CHUNK in units of two chunks; links connect the same in each way.
LARGE, CHUNK = 256, 1 << 14
#: Fingerprints in a bucket, about, up to which bands are not made narrower; at most so many bands.
FULL, MOST_BANDS = 64, 9
WORDS = 4


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Lower-cases A-Z, hashes the shingles of a text and takes the majority of each bit."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    h = xxhash.xxh64_intdigest
    if len(w) <= words:
        hashes = [h(b" ".join(w), SEED)]
    else:
        hashes = [h(b" ".join(s), SEED) for s in zip(*(w[i:] for i in range(words)), strict=False)]
    bits = np.zeros(64, np.int64)
    x = np.array(hashes, "<u8")
    for i in range(0, n, 1 << 16):
        bits += np.unpackbits(x[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, by_text: bool = False) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long; with ``by_text`` also the digest of the text."""
    more = ["digest"] if by_text else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                fps = np.array([fingerprint(t.as_py(), words) for t in part.column("text")], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fps), *map(part.column, more)], ["doc_id", "fp", *more])

    columns = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")]
    digests = [text_digest(F.col(text_col)).alias(c) for c in more]
    return docs.select(*columns, *digests).mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{c} binary" for c in more)]))


def banding(n: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each band for ``n`` fingerprints; all bands but four are equal where at most four bits differ."""
    bands = RADIUS + 2
    while bands < MOST_BANDS and n >> (64 * (bands - RADIUS) // bands) > FULL:
        bands += 1
    sizes = [64 // bands + (i < 64 % bands) for i in range(bands)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(bands)]


def buckets(fp: Column, bands: list[tuple[int, int]]) -> Column:
    """The bucket of each table: the table's number above the bits of its bands."""

    def bucket(t: int, chosen: tuple[tuple[int, int], ...]) -> Column:
        out = F.lit(t).cast("long")
        for at, n in chosen:
            out = F.shiftleft(out, n).bitwiseOR(F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << n) - 1)))
        return out

    return F.array(*(bucket(t, chosen) for t, chosen in enumerate(combinations(bands, len(bands) - RADIUS))))


def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of the blocks of 64 fingerprints, each of one word or a row of words: word [b, k] has bit b of the 64 in block k.  The last block is filled with zeros."""
    fps = fps.reshape(len(fps), -1)
    blocks, width = -(-len(fps) // 64), fps.shape[1]
    out = np.zeros((64 * width, blocks), np.uint64)
    for k in range(0, blocks, 256):
        some = fps[64 * k : 64 * (k + 256)]
        x = np.zeros((-(-len(some) // 64) * 64, width), np.uint64)
        x[: len(some)] = some
        bits = np.unpackbits(x.view(np.uint8).reshape(-1, 64, 8 * width), axis=2, bitorder="little")  # block, lane, bit
        out[:, k : k + len(bits)] = np.ascontiguousarray(np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little")).view(np.uint64)[:, :, 0]
    return out


_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A carry-save adder: sum and carry of three planes, lane by lane."""
    u = a ^ b
    return u ^ c, (a & b) | (u & c)


def above(counters: list[np.ndarray], limit: int) -> np.ndarray:
    """Lanes whose count, the lowest bit first, is above the limit."""
    more, equal = np.zeros_like(counters[0]), np.full_like(counters[0], _ONES)
    for k in reversed(range(len(counters))):
        if limit >> k & 1:
            equal &= counters[k]
        else:
            more |= equal & counters[k]
            equal &= ~counters[k]
    return more


def near(bits: np.ndarray, stored: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each query and block the lanes within the radius, as words.

    ``bits`` [bits, q, k]: bit b of each query as a word of ones or zeros, for
    each block or (k = 1) for all; ``stored`` [bits, k]: the planes.  Eight
    planes at a time go through seven carry-save adders into three counter
    planes, and what they carry into as many more as the radius needs; a lane
    that counts beyond the radius is dead, and blocks with dead lanes only are
    abandoned.
    """
    q, k = np.broadcast_shapes(bits.shape[1:], (1, stored.shape[1]))
    out = np.zeros((q, k), np.uint64)
    at, total = np.arange(k), len(stored)
    count = [np.zeros((q, k), np.uint64) for _ in range(max(3, radius.bit_length()))]
    dead = np.zeros((q, k), np.uint64)
    look = 8 if total <= 64 else 64
    for b in range(0, total, 8):
        x = [bits[b + i] ^ stored[b + i] for i in range(8)]
        ones, twos, fours = count[:3]
        ones, c = add(ones, x[0], x[1])
        ones, d = add(ones, x[2], x[3])
        twos, e = add(twos, c, d)
        ones, c = add(ones, x[4], x[5])
        ones, d = add(ones, x[6], x[7])
        twos, f = add(twos, c, d)
        fours, carry = add(fours, e, f)
        count[:3] = ones, twos, fours
        for i in range(3, len(count)):
            count[i], carry = count[i] ^ carry, count[i] & carry
        dead |= carry
        if (b + 8) % look == 0 or b + 8 == total:
            dead |= above(count, radius)
            live = (dead != _ONES).any(axis=0)
            if not live.any():
                return out
            if live.mean() < 0.6 and b + 8 < total:
                at, dead, stored = at[live], dead[:, live], stored[:, live]
                count = [c[:, live] for c in count]
                if bits.shape[2] > 1:
                    bits = bits[:, :, live]
    out[:, at] = ~dead
    return out


def spread(fps: np.ndarray) -> np.ndarray:
    """[bits, n]: each bit of each fingerprint as a word of ones or zeros."""
    words = fps.reshape(len(fps), -1).T
    bits = (words[:, None, :] >> np.arange(64, dtype=np.uint64)[None, :, None]) & np.uint64(1)
    return (np.uint64(0) - bits).reshape(-1, len(fps))


def lanes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, lane) of the bits set in words [row, block]."""
    bits = np.unpackbits(np.ascontiguousarray(words).view(np.uint8).reshape(len(words), -1), axis=1, bitorder="little")
    return np.nonzero(bits)


def links_in_blocks(fps: np.ndarray, bucket: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal bucket within the radius, of rows sorted by bucket: all blocks at once, block against the d-th after it."""
    stored, n = planes(fps), len(fps)
    blocks = stored.shape[1]
    first, last = bucket[::64], bucket[np.minimum(np.arange(blocks) * 64 + 63, n - 1)]
    left, right = [], []
    d, some = 0, np.arange(blocks)
    while len(some):
        others = stored[:, some + d]
        for lane in range(64):
            i = some * 64 + lane
            ok = i < n
            if d:
                ok[ok] = bucket[i[ok]] == first[some[ok] + d]
            if not ok.any():
                continue
            i, other = i[ok], some[ok] + d
            hits = near(spread(fps[i])[:, None, :], others if ok.all() else others[:, ok], radius)[0]
            if hits.any():
                row, at = lanes(hits[:, None])
                a, b = i[row], other[row] * 64 + at
                good = (b > a) & (b < n)
                a, b = a[good], b[good]
                good = bucket[a] == bucket[b]
                left.append(a[good])
                right.append(b[good])
        d += 1
        some = some[some + d < blocks]
        some = some[last[some] == first[some + d]]
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def links_in_large(fps: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all within the radius, in one large bucket: each block against itself and those after it.

    Of links between the same two groups of one block's search one is given, so copies of a kind don't give all their pairs.
    """
    n, stored, group = len(fps), planes(fps), np.arange(len(fps))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(stored.shape[1]):
        ask = spread(fps[64 * k : 64 * k + 64])[:, :, None]
        for j in range(k, stored.shape[1], 64):  # at most 2^18 pairs at once
            words = near(ask, stored[:, j : j + 64], radius)
            row, block = np.nonzero(words)
            i, lane = lanes(words[row, block][:, None])
            a, b = 64 * k + row[i], 64 * (j + block[i]) + lane
            good = (a < b) & (b < n)
            a, b = a[good], b[good]
            low, high = np.minimum(group[a], group[b]), np.maximum(group[a], group[b])
            apart = np.flatnonzero(low != high)
            if not len(apart):
                continue
            _, first = np.unique(low[apart] * n + high[apart], return_index=True)
            one = apart[first]
            left.append(a[one])
            right.append(b[one])
            group = merged(group, low[one], high[one])
    return np.concatenate(left), np.concatenate(right)


def groups_of(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least member of each row's group, of ``n`` rows that the pairs link."""
    group = np.arange(n)
    while True:
        least = np.minimum(group[a], group[b])
        new = group.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, group, new)
        new = new[new]
        if (new == group).all():
            return group
        group = new


def merged(group: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Groups, each named by its least member, after the groups ``low`` and ``high`` of each pair are joined."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    for x, y in zip(low.tolist(), high.tolist(), strict=True):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)
    names = np.arange(len(group))
    for x in root:
        names[x] = find(x)
    return names[group]


def _links_of(batches: Iterator[pa.RecordBatch], radius: int = RADIUS) -> Iterator[pa.RecordBatch]:
    """Links in rows (bucket, node, fp) sorted by bucket, each member of a group with its least; a bucket may go over batches.  Without fp the node is the fingerprint."""

    def found(node: np.ndarray, fps: np.ndarray, bucket: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        sizes = np.diff(np.r_[starts, len(bucket)])
        for s, n in zip(starts[sizes >= LARGE], sizes[sizes >= LARGE], strict=True):
            yield from told(node[s : s + n], *links_in_large(fps[s : s + n], radius))
        small = np.flatnonzero(np.repeat((sizes > 1) & (sizes < LARGE), sizes))
        for at in range(0, len(small), most):  # a bucket that is cut here is read again with the next
            some = small[max(0, at - LARGE) : at + most]
            yield from told(node[some], *links_in_blocks(fps[some], bucket[some], radius))

    def told(node: np.ndarray, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(a):
            group = groups_of(a, b, len(node))
            i = np.flatnonzero(group != np.arange(len(group)))
            yield pa.RecordBatch.from_arrays([pa.array(node[group[i]]), pa.array(node[i])], ["a", "b"])

    held: list[pa.RecordBatch] = []
    rows, most = 0, 1 << 18

    def arrays() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        t = pa.Table.from_batches(held).combine_chunks()
        node = t["node"].to_numpy()
        fps = np.frombuffer(b"".join(t["fp"].to_pylist()), np.uint64).reshape(len(node), -1) if "fp" in t.column_names else node.view(np.uint64)
        return node, fps, t["bucket"].to_numpy()

    for batch in batches:
        if not batch.num_rows:
            continue
        if not held and "fp" in batch.schema.names:
            most = (1 << 18) // max(1, len(batch.column("fp")[0].as_py()) // 8)
        held.append(batch)
        rows += batch.num_rows
        last = batch.column("bucket")[batch.num_rows - 1].as_py()
        if rows < most or held[0].column("bucket")[0].as_py() == last:
            continue
        node, fps, bucket = arrays()
        cut = int(np.searchsorted(bucket, last))
        yield from found(node[:cut], fps[:cut], bucket[:cut])
        held = pa.Table.from_batches(held).slice(cut).to_batches()
        rows -= cut
    if held:
        yield from found(*arrays())


def links_in_buckets(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all nodes of a bucket within the radius, of ``rows`` (bucket, node, and fp if it is not the node)."""
    large = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CHUNK)
    large = saved(large.select("bucket", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "large")
    cut = rows.join(broadcast_if_small(large), "bucket", "left").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: j != F.col("mine"))
    units = F.transform(others, lambda j: F.xxhash64("bucket", F.least(j, F.col("mine")), F.greatest(j, F.col("mine"))))
    rest = [c for c in rows.columns if c != "bucket"]
    rows = cut.select(F.explode(F.when(F.col("chunks").isNull(), F.array("bucket")).otherwise(units)).alias("bucket"), *rest)
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda batches: _links_of(batches, radius), "a long, b long")


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` at four or fewer differing bits."""
    return links_in_buckets(nodes.select(F.explode(buckets(F.col("fp"), banding(nodes.count()))).alias("bucket"), F.col("fp").alias("node")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, by_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp, component_id (the smallest doc_id reachable); with ``by_text`` also digest and group (one long a component)."""
    rows = saved(fingerprints(docs, id_col, text_col, words, by_text), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    joined = connected_components(saved(links(nodes), "links"))
    linked = nodes.join(joined, nodes["fp"] == joined["node"]).select("fp", "least", "component")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    changed = linked.join(least, "component").select("fp", "component_id", *(["component"] if by_text else []))
    group = [F.coalesce("component", "fp").alias("group")] if by_text else []
    ids = saved(nodes.join(changed, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"), *group), "ids")
    return rows.join(broadcast_if_small(ids), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    found = near_duplicates(docs, id_col, text_col)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def copies(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """doc_id, digest and group of each row."""
    return near_duplicates(docs, id_col, text_col, words, by_text=True)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, find: Callable[..., DataFrame] = copies) -> DataFrame:
    """One row of each component: that of the smallest doc_id (null comes last), of rows that repeat it that of the smallest text digest.

    ``find`` gives doc_id, digest and group of each row.  Rows are told by doc_id and text, so rows of other components that
    repeat a doc_id, or have none, stay.  What goes is broadcast while few, else joined by a shuffle.
    """
    key, text = free_name(docs, "gl_id"), free_name(docs, "gl_digest")
    found = saved(find(docs, id_col, text_col, words).select("doc_id", "digest", "group"), "found")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")
    best = found.groupBy("group").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("group", "best")
    several = found.join(broadcast_if_small(saved(best, "best")), "group")
    wins = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("digest") == F.col("best.digest"))
    names = [F.col("doc_id").alias(key), F.col("digest").alias(f"{text}k")]
    gone = broadcast_if_small(saved(several.filter(~wins).select(*names).distinct(), "gone"))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(key)) & (F.col(text) == F.col(f"{text}k"))
    kept = docs.withColumn(text, text_digest(F.col(text_col))).join(gone, same, "left_anti")
    twice = saved(several.filter(wins).groupBy("doc_id", "digest").count().filter("count > 1").select(*names), "twice")
    if twice.limit(1).count():  # rows that repeat a doc_id and a text
        again = broadcast_if_small(twice)
        kept = kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates([id_col, text]))
    return kept.drop(text)
