"""Passages that several documents share, by sparse suffix arrays.

Texts become words (A-Z lower-cased), words 32-bit hashes.  Of each window of
``MIN_WORDS`` words the K-gram with the smallest hash, the leftmost of equal
ones, is its minimiser; equal windows have it at the same place, so only the
suffixes at minimisers are kept, each with the words that its windows reach to
the left and to the right.

1. Suffixes whose first K words begin no suffix of another row end here.
2. The others are sorted over all tasks by the words that follow, so a frequent
   beginning spans as many tasks as it needs.  Rows that equal one that a task
   has seen in another row are decided there and not sort.
3. In a task neighbours are compared word by word.  For each number of words to
   the left, suffixes whose following words agree far enough are an interval of
   the order; the words to the left, sorted too, cut it into classes.  A class
   with two rows is a shared window, and adjoining windows extend the match left
   and right.
4. Intervals that touch the first or last suffix of a task may go on in the next
   one: their windows are compared across tasks, one row a class and task.
5. Windows found merge into spans.

Words are compared by their 32-bit hashes: two windows that differ in some words
are taken for equal with a chance of 2^-32 for each such word.

Defined results: a null or empty text shares nothing; rows that repeat a
document share all its windows; an empty table gives an empty result; a passage
that occurs twice in one row only is not shared; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import saved, setting

MIN_WORDS, K = 50, 16
REACH = MIN_WORDS - K + 1
#: Suffixes that a task sorts, about, and contexts that a task remembers, so that copies are sent once; results depend on neither.
TASK_ROWS, KNOWN = 40_000, 100_000
#: Keys of 336 bytes that the driver sees for each task, to set the ranges; Spark takes 3 million at most.
SAMPLES = "20"
SLICE = 256

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_OTHER = 0xC2B2AE3D27D4EB4F
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0 to base^n modulo 2^64."""
    if len(_powers.get(base, ())) <= n:
        x = np.full(max(n + 1, 1 << 16), base, np.uint64)
        x[0] = 1
        _powers[base] = np.multiply.accumulate(x)
    return _powers[base]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _spans(values: np.ndarray, first: np.ndarray, after: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[first:after] for each pair, whatever its place."""
    n = len(values)
    back = _power(pow(base, -1, 1 << 64), n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _power(base, n)[:n], dtype=np.uint64)])
    return _mix((sums[after] - sums[first]) * back[first])


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the index of each word's text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] if len(texts) else np.zeros(1, np.int64)
    ink = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = ink & (np.r_[True, ~ink[:-1]] | edge[:-1]) if len(data) else ink
    end = ink & (np.r_[~ink[1:], True] | edge[1:]) if len(data) else ink
    first, after = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return _spans(_LOWER[data].astype(np.uint64) + np.uint64(1), first, after, _BASE), np.searchsorted(offsets, first, side="right") - 1


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of all words, none of them 0, and the index of each word's text."""
    words, text = word_hashes(texts)
    return np.maximum((words >> np.uint64(32)).astype(np.uint32), 1), text


def minimisers(words: np.ndarray, text: np.ndarray) -> dict[str, np.ndarray]:
    """Minimisers of all windows: ``at`` (place in ``words``), ``lo`` and ``hi`` (first and last window that it is the minimiser of),
    ``more`` (windows after ``hi`` that repeat it, in a run of one word) and ``key``."""
    n = len(words)
    starts = np.arange(max(0, n - MIN_WORDS + 1))
    inside = text[starts] == text[starts + MIN_WORDS - 1] if len(starts) else np.zeros(0, bool)
    if not inside.any():
        none = np.zeros(0, np.int64)
        return {"at": none, "lo": none, "hi": none, "more": none, "key": none.view(np.uint64)}
    grams = np.arange(n - K + 1)
    key = _spans(_mix(words.astype(np.uint64) + np.uint64(1)), grams, grams + K, _STEP)
    at = starts + np.lib.stride_tricks.sliding_window_view(key, REACH).argmin(axis=1)
    a, at = starts[inside], at[inside]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (a[1:] != a[:-1] + 1)])
    last = np.r_[new[1:], len(a)] - 1
    at, lo, hi = at[new], a[new], a[last]
    # Of equal windows one after the other, all of one word, the first stands for the others.
    changes = np.concatenate([[0], np.cumsum(words[1:] != words[:-1])])
    plain = (changes[lo] == changes[lo + MIN_WORDS - 1]) & (lo == hi) & (at == lo)
    again = np.r_[False, plain[1:] & plain[:-1] & (at[1:] == at[:-1] + 1)]
    first = np.flatnonzero(~again)
    more = np.diff(np.r_[first, len(at)]) - 1
    return {"at": at[first], "lo": lo[first], "hi": hi[first], "more": more, "key": key[at[first]]}


def suffixes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row_id, doc_id, words (as bytes), at and key of the minimisers; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
                words, text = words_of(part.column("text"))
                m = minimisers(words, text)
                cut = np.searchsorted(text, np.arange(part.num_rows + 1))
                of = np.searchsorted(m["at"], cut)
                lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.array(x, kind))
                rel = m["at"] - cut[text[m["at"]]] if len(m["at"]) else m["at"]
                raw = pa.array([words[i:j].tobytes() for i, j in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_id"), part.column("doc_id"), raw, lists(rel, pa.int32()), lists(m["key"].view(np.int64), pa.int64())],
                    ["row_id", "doc_id", "words", "at", "key"],
                )

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return saved(rows.mapInArrow(run, "row_id long, doc_id long, words binary, at array<int>, key array<long>"), "suffixes")


_CONTEXTS = {"right": pa.binary(), "left": pa.binary(), "row_id": pa.int64(), "doc_id": pa.int64(), "places": pa.list_(pa.int32()), "more": pa.list_(pa.int32()), "start": pa.int64(), "after": pa.int64()}
_CONTEXTS_SQL = "right binary, left binary, row_id long, doc_id long, places array<int>, more array<int>, start long, after long"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of suffixes that begin like others: ``right`` and ``left``, the words that their windows reach (left: the nearest first), with all
    their places in the row; or ``start`` and ``after``, a span decided here, where another row had the same words.  The first such
    copy goes on without places, so that the row it equals finds it."""
    known: dict[tuple[bytes, bytes], int] = {}  # row, or -1 where a copy has been sent
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _CONTEXTS.values(), strict=True)], list(_CONTEXTS))

    for batch in batches:
        for part in (batch.slice(i, SLICE) for i in range(0, batch.num_rows, SLICE)):
            for row, doc, raw, places in zip(*(part.column(c).to_pylist() for c in ("row_id", "doc_id", "words", "places")), strict=True):
                words = np.frombuffer(raw, np.uint32)
                n, m = len(words), minimisers(words, np.zeros(len(words), np.int64))
                ahead, back = words.astype(">u4").tobytes(), words[::-1].astype(">u4").tobytes()
                some = np.flatnonzero(np.isin(m["at"], places))
                own: dict[tuple[bytes, bytes], list[tuple[int, int, int, int]]] = {}
                for at, lo, hi, more in zip(*(m[c][some].tolist() for c in ("at", "lo", "hi", "more")), strict=True):
                    own.setdefault((ahead[4 * at : 4 * (hi + MIN_WORDS)], back[4 * (n - at) : 4 * (n - lo)]), []).append((at, lo, hi, more))
                for context, found in own.items():
                    seen = known.get(context)
                    if seen is None:
                        if len(known) >= KNOWN:
                            known.clear()
                        known[context] = row
                        out.append((*context, row, doc, [x[0] for x in found], [x[3] for x in found], None, None))
                        continue
                    if seen >= 0:
                        known[context] = -1
                        out.append((*context, row, doc, [], [], None, None))
                    out.extend((None, None, row, doc, None, None, lo, hi + MIN_WORDS + more) for _, lo, hi, more in found)
                if len(out) >= 8192:
                    yield flush()
    if out:
        yield flush()


def _matrix(rows: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row, filled up with 0, and how many."""
    n = np.array([len(x) // 4 for x in rows], np.int64)
    out = np.zeros((len(rows), width), np.uint32)
    out[np.arange(width)[None, :] < n[:, None]] = np.frombuffer(b"".join(rows), ">u4")
    return out, n


def common_prefixes(rows: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of each row but the first, how many words it begins with like the row before it."""
    same = np.cumprod(rows[1:] == rows[:-1], axis=1, dtype=np.uint8).sum(axis=1, dtype=np.int64)
    return np.minimum(same, np.minimum(n[1:], n[:-1]))


def _equal(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Which classes occur in two rows or more: neighbours after sorting."""
    order = np.lexsort((row, h))
    h, row = h[order], row[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    last = np.r_[first[1:], len(h)] - 1
    out = np.zeros(len(h), bool)
    out[order] = np.repeat(row[first] != row[last], last - first + 1)
    return out


def window_classes(right: np.ndarray, n_right: np.ndarray, left: np.ndarray, n_left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each number l of words to the left: l, the suffixes with such a window, the class of each window, and the interval it lies in.

    Rows are in suffix order.  Windows are equal where they are in the same
    interval of that order at depth ``MIN_WORDS`` - l, and of the order of the
    words to the left at depth l.
    """
    n = len(right)
    follow = common_prefixes(right, n_right)
    order = np.lexsort(left.T[::-1])
    before = common_prefixes(left[order], n_left[order])
    rank = np.zeros(n, np.int64)
    for l in range(REACH):  # noqa: E741
        has = np.flatnonzero((n_left >= l) & (n_right >= MIN_WORDS - l))
        if not len(has):
            continue
        interval = np.concatenate([[0], np.cumsum(follow < MIN_WORDS - l)])
        rank[order] = np.concatenate([[0], np.cumsum(before < l)])
        yield l, has, interval[has] * n + rank[has], interval


_FOUND = "w binary, row_id long, doc_id long, start long, after long, sure boolean"


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (start, after) of suffixes in order; ``w`` names a window that may occur in another task too, which ``sure`` says is shared."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    t = pa.Table.from_batches(held)
    n, row, doc = t.num_rows, t["row_id"].to_numpy(), t["doc_id"].combine_chunks()
    right, n_right = _matrix(t["right"].to_pylist(), MIN_WORDS)
    left, n_left = _matrix(t["left"].to_pylist(), REACH - 1)
    places, more = t["places"].combine_chunks(), t["more"].combine_chunks()
    n_places = np.diff(places.offsets.to_numpy())
    first = np.cumsum(n_places) - n_places
    places, more = places.flatten().to_numpy().astype(np.int64), more.flatten().to_numpy().astype(np.int64)

    def of_places(i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix in ``i`` its places: which of ``i``, and the index of the place."""
        which = np.repeat(np.arange(len(i)), n_places[i])
        return which, first[i][which] + np.arange(len(which)) - np.repeat(np.cumsum(n_places[i]) - n_places[i], n_places[i])

    def rows(i: np.ndarray, w: list | None, start: np.ndarray | None, after: np.ndarray | None, sure: bool) -> pa.RecordBatch:
        none = lambda kind: pa.nulls(len(i), kind)
        return pa.RecordBatch.from_arrays(
            [pa.array(w, pa.binary()) if w is not None else none(pa.binary()), pa.array(row[i]), doc.take(pa.array(i)),
             pa.array(start, pa.int64()) if start is not None else none(pa.int64()), pa.array(after, pa.int64()) if after is not None else none(pa.int64()), pa.array(np.full(len(i), sure))],
            ["w", "row_id", "doc_id", "start", "after", "sure"],
        )

    both = np.zeros((n, REACH - 1 + MIN_WORDS), np.uint64)
    both[:, : REACH - 1] = left[:, ::-1]
    both[:, REACH - 1 :] = right
    found = np.zeros((n, REACH), bool)  # by window, the leftmost first
    for l, has, kind, interval in window_classes(right, n_right, left, n_left):  # noqa: E741
        twice = _equal(kind, row[has])
        s = REACH - 1 - l
        found[has, s] = twice
        edge = (interval[has] == interval[0]) | (interval[has] == interval[-1])
        _, told = np.unique(kind[edge & twice], return_index=True)
        told, alone = has[edge & twice][told], has[edge & ~twice]
        for i, sure in ((told, True), (alone, False)):
            if len(i):
                w = _mix(both[i, s : s + MIN_WORDS] + np.uint64(1))
                pair = [_mix((w * _power(base, MIN_WORDS)[None, :MIN_WORDS]).sum(axis=1, dtype=np.uint64)) for base in (_BASE, _OTHER)]
                names = [x.tobytes() for x in np.ascontiguousarray(np.stack(pair, axis=1))]
                if sure:
                    yield rows(i, names, None, None, True)
                    continue
                which, at = of_places(i)
                if len(which):
                    yield rows(i[which], [names[k] for k in which], places[at] - l, places[at] - l + MIN_WORDS + more[at], False)
                if (n_places[i] == 0).any():
                    yield rows(i[n_places[i] == 0], [names[k] for k in np.flatnonzero(n_places[i] == 0)], None, None, False)
    no = np.zeros(n, bool)
    i, s = np.nonzero(found & ~np.c_[no, found[:, :-1]])
    _, e = np.nonzero(found & ~np.c_[found[:, 1:], no])
    which, at = of_places(i)
    if len(which):
        yield rows(i[which], None, places[at] - (REACH - 1) + s[which], places[at] - (REACH - 1) + e[which] + MIN_WORDS + more[at], True)


_KEPT = ("right", "left", "row_id", "doc_id", "places", "more")


def shared_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per longest span of words, each in a window of ``MIN_WORDS`` that another row has too: doc_id, start, after, n_words (places count words from 0)."""
    rows = suffixes(docs, id_col, text_col)
    each = rows.select("row_id", F.explode(F.arrays_zip("at", "key")).alias("s")).select("row_id", "s.at", "s.key")
    keys = saved(each.groupBy("key").agg(F.min("row_id").alias("a"), F.max("row_id").alias("b")).filter("a <> b").select("key"), "keys")  # so that the join can split a frequent one
    places = each.join(keys, "key").groupBy("row_id").agg(F.collect_list("at").alias("places"))  # of one text
    contexts = saved(rows.select("row_id", "doc_id", "words").join(places, "row_id").mapInArrow(_contexts, _CONTEXTS_SQL), "contexts")
    entries = contexts.filter("start is null").select(*_KEPT)
    in_order = entries.repartitionByRange(int(entries.count() // TASK_ROWS) + 1, "right", "left", "row_id").sortWithinPartitions("right", "left")
    with setting(docs.sparkSession, "spark.sql.execution.rangeExchange.sampleSizePerPartition", SAMPLES):
        found = saved(in_order.mapInArrow(_shared, _FOUND), "found")
    across = found.filter("w is not null")
    shared = across.groupBy("w").agg(F.min("row_id").alias("a"), F.max("row_id").alias("b"), F.max("sure").alias("sure")).filter("sure or a <> b").select("w")
    more = across.filter("start is not null").join(shared, "w", "left_semi")
    spans = contexts.filter("start is not null").select("row_id", "doc_id", "start", "after")
    for part in (found.filter("w is null"), more):
        spans = spans.unionByName(part.select("row_id", "doc_id", "start", "after"))
    one = F.sort_array(F.collect_set(F.struct("start", "after")))  # of one text
    none = F.array().cast("array<struct<start:bigint,after:bigint>>")

    def add(acc, x):
        last = F.element_at(acc, -1)
        longer = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["after"], x["after"]).alias("after"))))
        return F.when((F.size(acc) > 0) & (F.get(acc, F.size(acc) - 1)["after"] >= x["start"]), longer).otherwise(F.concat(acc, F.array(x)))

    merged = spans.groupBy("row_id", "doc_id").agg(F.aggregate(one, none, add).alias("spans"))
    return merged.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.start", "s.after", (F.col("s.after") - F.col("s.start")).alias("n_words"))
