"""Packing token ids into sequences by deficit round-robin over source queues.

Each window credits every source with its target share of the window's tokens,
by default its share of all tokens; sources are then served in turn while their
credit lasts.  What a source gets
too little or too much is carried on to the next window, and, since the sums
before a partition are known, into the next partition.  Documents are cut where
credit or window ends.  The last ids of a partition go to windows whose sizes
are powers of two, so no sequence needs padding.  Where targets are other than
the sources' own shares, a source that has run out leaves its room to the others.

Rows are dealt to partitions by a number of their own, so neither ids, sources
nor copies make one large.  A task works on its partitions one after the other.

Defined results: a null or empty text has only the end id; a null source is a
source of its own; repeated rows are packed each; an empty table gives no piece;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoding import encoder, end_bytes
from .shared import batch_rows, broadcast_if_small, running_sums, saved, tasks_for

LENGTH = 4096
#: Ids that a partition holds in memory at once, and the credit from which a source is served in its turn.
PART_TOKENS, MIN_PIECE = 2_000_000, 256

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long"


def encoded(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """row_id, doc_id, source, n and the ids with the end id, as bytes; computed once and written."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        end = end_bytes(enc, end_id)
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                ids = [enc.encode(t) + end for t in part.column("text").to_pylist()]
                n = pa.array([len(x) // enc.dtype.itemsize for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("row_id"), part.column("doc_id"), part.column("source"), n, pa.array(ids, pa.binary())], ["row_id", "doc_id", "source", "n", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    with batch_rows(docs.sparkSession, 1024):
        return saved(rows.mapInArrow(encode, "row_id long, doc_id long, source string, n long, ids binary"), "ids")


def window_sizes(tokens: int, length: int) -> Iterator[int]:
    """Full windows, then powers of two."""
    for _ in range(tokens // length):
        yield length
    for bit in reversed(range(length.bit_length())):
        if tokens % length >> bit & 1:
            yield 1 << bit


def round_robin(queues: list[list[int]], shares: list[float], credit: list[float], length: int) -> Iterator[tuple[int, int, int, int, int, int, int]]:
    """(queue, document, start, length, window, offset, window's size) of each piece; queues hold the sizes of their documents."""
    heads, starts = [0] * len(queues), [0] * len(queues)
    credit, turn = list(credit), 0
    live = [q for q in range(len(queues)) if queues[q]]
    for window, size in enumerate(window_sizes(sum(map(sum, queues)), length)):
        for q, share in enumerate(shares):
            credit[q] += share * size
        room, idle = size, 0
        while room:
            if idle >= len(live):  # no source has enough credit: the one that has most is served
                turn = max(range(len(live)), key=lambda i: credit[live[i]])
            turn %= len(live)
            q = live[turn]
            if credit[q] < MIN_PIECE and idle < len(live):
                turn, idle = turn + 1, idle + 1
                continue
            take = min(queues[q][heads[q]] - starts[q], room, max(int(credit[q]), MIN_PIECE))
            yield q, heads[q], starts[q], take, window, size - room, size
            room, idle = room - take, 0
            credit[q] -= take
            starts[q] += take
            if starts[q] == queues[q][heads[q]]:
                heads[q], starts[q] = heads[q] + 1, 0
                if heads[q] == len(queues[q]):
                    live.remove(q)


def shares_of(total: int, sums: DataFrame, weights: dict[str | None, float] | None) -> DataFrame:
    """(s, share) of each source: of all tokens, or by ``weights``, in which a source that is not named has 0."""
    sizes = sums.groupBy(F.col("source").alias("s")).agg(F.sum("n").alias("size"))
    if weights is None:
        return sizes.select("s", (F.col("size") / F.lit(max(1, total))).alias("share"))
    if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("weights must be 0 or more, and some above 0")
    weight = F.lit(0.0)
    for source, w in weights.items():
        weight = F.when(F.col("s").eqNullSafe(F.lit(source)), F.lit(float(w))).otherwise(weight)
    return sizes.select("s", (weight / F.lit(float(sum(weights.values())))).alias("share"))


def pack(rows: DataFrame, length: int = LENGTH, dtype: str = "<u2", with_ids: bool = False, weights: dict[str | None, float] | None = None) -> DataFrame:
    """Pieces of the sequences of ``encoded`` rows (schema ``PIECES``; with their ids as 32-bit integers if asked for).

    ``weights`` names target proportions of sources in place of their own.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    total = rows.agg(F.sum("n")).first()[0] or 0
    parts = int(total // PART_TOKENS) + 1
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row_id"), F.lit(parts)))
    # One row for each partition and source: what is owed to a source when a partition begins.
    sums = saved(rows.groupBy("part", "source").agg(F.sum("n").alias("n")), "sums")
    windows = F.floor(F.col("all") / length) + F.bit_count(F.col("all") % length)
    totals = running_sums(sums.groupBy("part").agg(F.sum("n").alias("all")).withColumn("windows", windows), "part", ["all", "windows"])
    totals = totals.select("part", "all_before", F.col("windows_before").alias("first_sequence"))
    shares = broadcast_if_small(saved(shares_of(total, sums, weights), "shares"))
    plan = (
        running_sums(sums, "part", ["n"], ["source"])
        .join(totals, "part")
        .join(shares, F.col("source").eqNullSafe(F.col("s")))
        .select(F.col("part").alias("p"), "s", "share", (F.col("share") * F.col("all_before") - F.col("n_before")).alias("owed"), "first_sequence")
    )
    dealt = rows.join(broadcast_if_small(saved(plan, "plan")), (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")), "left").drop("p", "s")
    tasks = tasks_for(parts)
    dealt = dealt.repartitionById(tasks, F.pmod("part", F.lit(tasks)).cast("int")).sortWithinPartitions("part", "source", "doc_id", "row_id")
    width = np.dtype(dtype)

    def one(part: list[tuple]) -> Iterator[dict]:
        queues: dict = {}
        for row in part:
            queues.setdefault(row["source"], []).append(row)
        order = list(queues)
        ids = [[np.frombuffer(r["ids"], width).astype("<u4") for r in queues[s]] for s in order]
        first = [queues[s][0] for s in order]
        sizes = [[len(x) for x in xs] for xs in ids]
        for q, d, start, n, window, offset, size in round_robin(sizes, [r["share"] for r in first], [r["owed"] for r in first], length):
            row, cut = queues[order[q]][d], ids[q][d][start : start + n]
            out = {
                "doc_id": row["doc_id"], "start": start, "length": n, "ids_crc32": zlib.crc32(cut), "doc_tokens": row["n"],
                "sequence_id": row["first_sequence"] + window, "offset": offset, "sequence_length": size,
            }
            yield out | {"ids": cut.tobytes()} if with_ids else out

    schema = PIECES + ", ids binary" * with_ids
    kinds = pa.schema([(x.split()[0], pa.binary() if x.endswith("binary") else pa.int64()) for x in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts_of() -> Iterator[list[dict]]:
            held: list[dict] = []
            for row in (r for b in batches for i in range(0, b.num_rows, 1024) for r in b.slice(i, 1024).to_pylist()):
                if held and held[0]["part"] != row["part"]:
                    yield held
                    held = []
                held.append(row)
            if held:
                yield held

        for part in parts_of():
            out = []
            for piece in one(part):
                out.append(piece)
                if len(out) == 4096:
                    yield pa.RecordBatch.from_pylist(out, kinds)
                    out = []
            if out:
                yield pa.RecordBatch.from_pylist(out, kinds)

    return dealt.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, length: int = LENGTH, with_ids: bool = False, weights: dict[str | None, float] | None = None) -> DataFrame:
    """Pieces of the sequences that hold all ids of ``docs``."""
    dtype = encoder(vocabulary).dtype.str
    return pack(encoded(docs, vocabulary, end_id), length, dtype, with_ids, weights)
