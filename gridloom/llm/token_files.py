"""Token ids as binary shards with a minimal perfect hash index.

A shard holds the raw ids of its documents in ascending order of their keys,
and an index from a key to the place of its ids.  The index is a chain of bit
arrays: a key whose bit at a level no other key shares is placed there, all
others go on to the next level.  The number of bits set before a key's bit is
its slot, so slots have no holes.  A slot stores a fingerprint of its key, which
tells an absent key but for one in 2^32, and the place and number of ids.

Each level keeps the number of bits set before every ``RANK_BITS``-th bit, so a
key is found by a few small reads, whatever the size of the shard: opening a
shard reads its last few hundred bytes, and ``get`` one stretch of bits and one
count a level, one slot and the ids.  ``Corpus`` finds the shard of a key first.

File: ids | keys int64 | flags uint8 (1: the key is null) | lengths int64 |
slots | bits and counts of all levels | JSON with the sections | its length,
uint64 | magic.

Defined results: a null or empty text has only the end id; rows with equal keys
are adjacent, and a lookup gives the first; rows with a null key come last and
are not in the index; other columns are ignored; an empty table writes no shard.
"""

from __future__ import annotations

import bisect
import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .encoding import encoder, end_bytes
from .shared import batch_rows, new_path, saved

MAGIC = b"GLTOKEN2"
SLOT = np.dtype([("fingerprint", "<u4"), ("records", "<u4"), ("offset", "<u8"), ("length", "<u8")])
#: Bits of a level per key that reaches it, levels before the rest is listed, bits to a count.
GAMMA, LEVELS, RANK_BITS = 2.0, 40, 512
#: Bytes of text in a shard, about; beyond so many shards they grow with the input.
SHARD_BYTES, MOST_SHARDS = 32 << 20, 50_000


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Slots 0 to n - 1 for n distinct int64 keys."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, np.sort(rest)
        self.before = []
        n = 0
        for bits in levels:
            self.before.append(n + np.concatenate([[0], np.cumsum(bits, dtype=np.int64)]))
            n += int(bits.sum())
        self.placed = n

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        while len(left) and len(levels) < LEVELS:
            size = max(8, int(GAMMA * len(left)))
            at = (mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels, left)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; of an absent key some slot or -1."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            if not len(todo):
                break
            at = (mixed(keys[todo], level) % np.uint64(len(bits))).astype(np.int64)
            here = bits[at]
            out[todo[here]] = self.before[level][at[here]]
            todo = todo[~here]
        if len(todo) and len(self.rest):
            i = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            same = self.rest[i] == keys[todo]
            out[todo[same]] = self.placed + i[same]
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)


def filesystem(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


def write_shard(path: str, records: Iterator[tuple[int | None, bytes]], dtype: np.dtype) -> tuple[int, int]:
    """Write (key, ids) in ascending order of keys to a file that appears when it is whole; documents and ids."""
    fs, target = filesystem(path)
    fs.create_dir(target.rpartition("/")[0], recursive=True)
    part = f"{target}.{uuid.uuid4().hex}.part"
    keys, flags, lengths = [], [], []
    with fs.open_output_stream(part) as out:
        for key, ids in records:
            out.write(ids)
            keys.append(key or 0)
            flags.append(key is None)
            lengths.append(len(ids) // dtype.itemsize)
        key, flag, length = np.asarray(keys, np.int64), np.asarray(flags, np.uint8), np.asarray(lengths, np.int64)
        offset = np.cumsum(length) - length
        known, first, records_of = np.unique(key[flag == 0], return_index=True, return_counts=True)
        index = PerfectHash.of(known)
        slots = np.zeros(len(known), SLOT)
        at = index.slots(known)
        slots["fingerprint"][at], slots["records"][at] = fingerprints(known), records_of
        slots["offset"][at], slots["length"][at] = offset[flag == 0][first], length[flag == 0][first]
        sections = {"keys": key, "flags": flag, "lengths": length, "slots": slots, "rest": index.rest}
        for i, bits in enumerate(index.levels):
            sections |= {f"level{i}": np.packbits(bits, bitorder="little"), f"ranks{i}": index.before[i][:-1:RANK_BITS].astype("<i8")}
        told, place = {}, int(length.sum()) * dtype.itemsize
        for name, x in sections.items():
            told[name] = [place, x.nbytes]
            place += x.nbytes
            out.write(x.tobytes())
        head = json.dumps({"sections": told, "dtype": dtype.str, "levels": [len(x) for x in index.levels]}).encode()
        out.write(head + len(head).to_bytes(8, "little") + MAGIC)
    if fs.get_file_info(target).is_file:  # a task that ran twice
        fs.delete_file(part)
    else:
        fs.move(part, target)
    return len(keys), int(length.sum())


class Shard:
    """A shard file: keyed access by a few small reads, and its records in order."""

    def __init__(self, path: str):
        fs, target = filesystem(path)
        self.file = fs.open_input_file(target)
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"{path} is not a token shard")
        n = int.from_bytes(tail[:8], "little")
        told = json.loads(self.file.read_at(n, size - 16 - n))
        self.dtype, self.sections, self.levels = np.dtype(told["dtype"]), told["sections"], told["levels"]
        self.slot_count = self.sections["slots"][1] // SLOT.itemsize

    def section(self, name: str, dtype, first: int = 0, count: int | None = None) -> np.ndarray:
        """A section, or ``count`` values from the ``first`` on."""
        at, n = self.sections[name]
        width = np.dtype(dtype).itemsize
        count = n // width - first if count is None else count
        return np.frombuffer(self.file.read_at(count * width, at + first * width), dtype)

    def index(self) -> PerfectHash:
        """The whole index, to look up many keys."""
        levels = [np.unpackbits(self.section(f"level{i}", np.uint8), count=k, bitorder="little").astype(bool) for i, k in enumerate(self.levels)]
        return PerfectHash(levels, self.section("rest", np.int64))

    def slot_of(self, key: int) -> int:
        """The slot of a key, of an absent one some slot or -1."""
        one = np.asarray([key], np.int64)
        for level, size in enumerate(self.levels):
            at = int(mixed(one, level)[0] % np.uint64(size))
            block = at // RANK_BITS
            first, last = block * RANK_BITS // 8, min(-(-size // 8), (block + 1) * RANK_BITS // 8)
            bits = np.unpackbits(self.section(f"level{level}", np.uint8, first, last - first), bitorder="little")
            inside = at - block * RANK_BITS
            if bits[inside]:
                return int(self.section(f"ranks{level}", "<i8", block, 1)[0] + bits[:inside].sum())
        rest = self.section("rest", np.int64)  # keys that no level parts: as good as always none
        i = int(np.searchsorted(rest, key))
        return self.slot_count - len(rest) + i if i < len(rest) and rest[i] == key else -1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slots of many keys, by the whole index; -1 where a slot's fingerprint is another."""
        keys = np.asarray(keys, np.int64)
        at = self.index().slots(keys)
        ok = at >= 0
        ok[ok] = self.section("slots", SLOT)["fingerprint"][at[ok]] == fingerprints(keys[ok])
        return np.where(ok, at, -1)

    def read(self, offset: int, length: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(int(length) * self.dtype.itemsize, int(offset) * self.dtype.itemsize), self.dtype)

    def get(self, key: int) -> np.ndarray | None:
        """The ids of a key, of its first record if it has several."""
        at = self.slot_of(key)
        if at < 0:
            return None
        slot = self.section("slots", SLOT, at, 1)[0]
        if slot["fingerprint"] != fingerprints(np.asarray([key], np.int64))[0]:
            return None
        return self.read(slot["offset"], slot["length"])

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys, flags, offsets and lengths of all records, those of known keys from their slots; of records that repeat a key from the second on, and of
        null keys, by the lengths in order."""
        keys, flags, lengths = self.section("keys", np.int64), self.section("flags", np.uint8), self.section("lengths", np.int64).copy()
        offsets = np.cumsum(lengths) - lengths
        known = np.flatnonzero(flags == 0)
        first = known[np.flatnonzero(np.r_[True, keys[known][1:] != keys[known][:-1]])] if len(known) else known
        at = self.find(keys[first])
        if (at < 0).any():
            raise ValueError("a key of the shard is not in its index")
        slots = self.section("slots", SLOT)[at]
        offsets[first], lengths[first] = slots["offset"], slots["length"]
        return keys, flags, offsets, lengths


class Corpus:
    """Keyed access to all shards of a manifest (rows with path and first_key); shards are opened when first asked for."""

    def __init__(self, manifest: DataFrame):
        rows = manifest.select("path", "first_key").filter("first_key is not null").orderBy("first_key", "path").collect()  # one row a shard
        self.paths, self.first = [r["path"] for r in rows], [r["first_key"] for r in rows]
        self.open: dict[int, Shard] = {}

    def get(self, key: int) -> np.ndarray | None:
        """The ids of a key, of its first record if it has several; None if it is absent."""
        after = bisect.bisect_right(self.first, key)
        low = bisect.bisect_left(self.first, key)
        for i in range(max(0, low - 1), after):  # a key that many records repeat may go over shards
            if i not in self.open:
                self.open[i] = Shard(self.paths[i])
            ids = self.open[i].get(key)
            if ids is not None:
                return ids
        return None


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as shards in ``path``; one row a shard: shard, path, first_key, n_docs, n_tokens, start (ids in all shards before).

    Texts are dealt out by ranges of the key, and of a number that tells rows of
    one key apart, so that each task encodes and writes one shard; nothing but the
    texts is shuffled, once.
    """
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    key = F.col("doc_id").asc_nulls_last()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(min(MOST_SHARDS, int(size // SHARD_BYTES) + 1), key, "row_id").sortWithinPartitions(key, "row_id").drop("row_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, shard, first = encoder(vocabulary), TaskContext.get().partitionId(), []
        end = end_bytes(enc, end_id)

        def records() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                    for k, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                        first or first.append(k)
                        yield k, enc.encode(text) + end

        rows = records()
        one = next(rows, None)
        if one is not None:
            name = f"{path}/shard-{shard:07d}.tok"
            n_docs, n_tokens = write_shard(name, (x for xs in ([one], rows) for x in xs), enc.dtype)
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "path": [name], "first_key": pa.array(first[:1], pa.int64()), "n_docs": [n_docs], "n_tokens": [n_tokens]}
            )

    with batch_rows(docs.sparkSession, 1024):
        told = saved(rows.mapInArrow(write, "shard long, path string, first_key long, n_docs long, n_tokens long"), "manifest")
    before = Window.orderBy(F.col("first_key").asc_nulls_last(), "shard").rowsBetween(Window.unboundedPreceding, -1)
    return told.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))  # one row a shard


def read_tokens(manifest: DataFrame) -> DataFrame:
    """One row per document from the shard files, found by its key: doc_id, start, n_tokens, ids_crc32 (of the ids as 32-bit integers)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                shard = Shard(path)
                keys, flags, offsets, lengths = shard.records()
                for i in range(0, len(offsets), 4096):
                    some = slice(i, i + 4096)
                    crcs = [zlib.crc32(shard.read(o, n).astype("<u4")) for o, n in zip(offsets[some], lengths[some], strict=True)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(keys[some], pa.int64(), mask=flags[some] == 1), "start": offsets[some] + start,
                        "n_tokens": lengths[some], "ids_crc32": pa.array(crcs, pa.int64()),
                    })

    n = max(1, manifest.count())
    return manifest.select("path", "start").repartition(n).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write ``docs`` and read them back."""
    return read_tokens(write_tokens(docs, path or new_path(spark, "tokens"), vocabulary, end_id))
