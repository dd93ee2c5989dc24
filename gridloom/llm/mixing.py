"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents of a source fall into blocks by a hash of their id, size and text.  A
source's target is met by whole passes over its blocks and a last pass over some
of them, in an order that a hash permutes; in the one block where the target
ends, documents are taken in hashed order and one of them is cut at a word.
Every (pass, block) is a draw.  The draws of all sources are split over the
output shards by a binary tree: at each node the left half gets a
multivariate-hypergeometric sample of the node's draws, so a shard's counts are
those of a random shuffle and add up exactly.  Tasks work out the tree below
their own shards; every node's sample depends on its place only.  A shard then
takes its next draws of each source in permuted order, disjoint from all other
shards, and is shuffled locally.

The driver holds one row per source, at most ``MOST_SOURCES``; more are an
error.  A source has at most ``MOST_BLOCKS`` blocks and the mix ``MOST_SHARDS``
shards; beyond that, blocks and shards grow with the input.

Defined results: a null text has size 0; a null source is the last source; rows
that repeat an id and a text fall into one block; a source without words has
target 0; an empty table gives an empty result; other columns are ignored
(``mix_digest``) or returned as they are (``mix``).  The same rows give the same
mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import broadcast_if_small, free_name, running_sums, saved

WORD, SPACE = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
WEIGHTS, SHARE, MOST = (5, 2, 1), Fraction(3, 2), 2
#: Documents in a block and words in an output shard, about, at least.
BLOCK_DOCS, SHARD_WORDS, SEED = 4096, 8_000_000, 20240917
MOST_SOURCES, MOST_BLOCKS, MOST_SHARDS, SUBTREE = 100_000, 1 << 18, 50_000, 512


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD}+")), F.lit(0)).cast("long")


def targets(sizes: list[int], weights: tuple[int, ...] = WEIGHTS, share: Fraction = SHARE, most: int = MOST) -> list[Fraction]:
    """Targets of sources in order: ``share`` of all sizes by weight, none above ``most`` times its size, the excess shared again."""
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out: dict[int, Fraction] = {}
    left = share * sum(sizes)
    while len(out) < len(sizes):
        free = [i for i in range(len(sizes)) if i not in out]
        per = left / sum(w[i] for i in free)
        above = [i for i in free if per * w[i] > most * sizes[i]]
        if not above:
            out |= {i: per * w[i] for i in free}
        for i in above:
            out[i] = Fraction(most * sizes[i])
            left -= out[i]
    return [out[i] for i in range(len(sizes))]


def split_tree(draws: list[int], shards: int, seed: int = SEED, low: int = 0, high: int | None = None) -> np.ndarray:
    """[source, shard]: how many draws of each source each shard from ``low`` to below ``high`` gets."""
    high = shards if high is None else high
    out = np.zeros((len(draws), high - low), np.int64)
    todo = [(np.asarray(draws, np.int64), 0, shards)]
    while todo:
        count, first, n = todo.pop()
        if first >= high or first + n <= low or not count.sum():
            continue
        if n == 1:
            out[:, first - low] = count
            continue
        half = n // 2
        rng = np.random.Generator(np.random.PCG64([seed, first, n]))
        left = rng.multivariate_hypergeometric(count, int(count.sum()) * half // n, method="marginals")
        todo += [(left, first, half), (count - left, first + half, n - half)]
    return out


def quotas(spark: SparkSession, draws: list[int], shards: int, seed: int = SEED) -> DataFrame:
    """(no, shard, quota) of each source, by its number, and shard; tasks take ``SUBTREE`` shards each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                low, high = k * SUBTREE, min(shards, (k + 1) * SUBTREE)
                found = split_tree(draws, shards, seed, low, high)
                no, at = np.nonzero(found)
                yield pa.RecordBatch.from_arrays([pa.array(no, pa.int64()), pa.array(at + low, pa.int64()), pa.array(found[no, at])], ["no", "shard", "quota"])

    parts = -(-shards // SUBTREE)
    return spark.range(0, parts, 1, parts).mapInArrow(run, "no long, shard long, quota long")


class Mix:
    """The plan over a table: ``sources`` (source, n_blocks, source_size, target) and ``draws`` (source, block, array of draws)."""

    def __init__(self, rows: DataFrame, seed: int = SEED):
        """``rows`` has doc_id, source, size and mark."""
        spark = rows.sparkSession
        found = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).orderBy(F.col("source").asc_nulls_last()).limit(MOST_SOURCES + 1).collect()
        if len(found) > MOST_SOURCES:
            raise ValueError(f"more than {MOST_SOURCES} sources")
        want = targets([r["size"] for r in found])
        told = [(r["source"], i, min(MOST_BLOCKS, -(-r["n"] // BLOCK_DOCS)), r["size"], float(t), round(t)) for i, (r, t) in enumerate(zip(found, want, strict=True))]
        self.seed = seed
        self.sources = spark.createDataFrame(told, "source string, no long, n_blocks long, source_size long, target double, words long").coalesce(1)
        self.shards = min(MOST_SHARDS, max(1, -(-sum(t[5] for t in told) // SHARD_WORDS)))
        blocks = saved(
            self.with_block(rows).groupBy("source", "no", "block", "source_size", "words").agg(F.sum("size").alias("size")), "blocks"
        )
        whole = F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.greatest("source_size", F.lit(1)))).otherwise(0).cast("int")
        left = F.col("words") - F.col("whole") * F.col("source_size")
        place = Window.partitionBy("source").orderBy(F.xxhash64("block", F.lit(seed)), "block")
        blocks = (
            blocks.withColumn("whole", whole).withColumn("left", left)
            .withColumn("before", F.coalesce(F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            # limit: words that the last pass takes of the block; -1 is the whole block
            .withColumn("limit", F.when(F.col("before") + F.col("size") <= F.col("left"), -1).when(F.col("before") < F.col("left"), F.col("left") - F.col("before")).otherwise(0))
        )
        full = F.transform(F.sequence(F.lit(1), F.col("whole")), lambda p: F.struct(p.alias("pass"), F.lit(-1).cast("long").alias("limit")))
        last = F.array(F.struct((F.col("whole") + 1).alias("pass"), F.col("limit").cast("long").alias("limit")))
        none = F.array().cast("array<struct<pass:int,limit:bigint>>")
        each = F.concat(F.when(F.col("whole") > 0, full).otherwise(none), F.when(F.col("limit") != 0, last).otherwise(none))
        draws = blocks.select("source", "no", "block", F.explode(each).alias("d")).select("source", "no", "block", "d.*")
        in_turn = Window.partitionBy("source").orderBy("pass", F.xxhash64("block", "pass", F.lit(seed)), "block")
        draws = saved(draws.withColumn("k", F.row_number().over(in_turn)), "draws")
        counts = {r["no"]: r["n"] for r in draws.groupBy("no").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a source
        shares = saved(quotas(spark, [counts.get(t[1], 0) for t in told], self.shards, seed), "quotas")
        # The quotas of a source in turn name the shard of each of its draws.
        upto = running_sums(shares, "shard", ["quota"], ["no"])
        shard_of = upto.select(F.col("no").alias("s"), F.col("shard").cast("int").alias("shard"), F.explode(F.sequence(F.col("quota_before") + 1, F.col("quota_before") + F.col("quota"))).alias("j"))
        placed = draws.join(shard_of, (F.col("no") == F.col("s")) & (F.col("k") == F.col("j")))
        self.draws = saved(
            placed.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("pass", "shard", "limit"))).alias("draws"), F.max("limit").alias("limit")), "plan"
        )  # a block has at most MOST + 1 draws

    def with_block(self, rows: DataFrame) -> DataFrame:
        """``rows`` (doc_id, source, size, mark, ...) with their source's columns and their block."""
        s = broadcast_if_small(self.sources.withColumnRenamed("source", "s"))
        return rows.join(s, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").withColumn("block", F.pmod(F.xxhash64("doc_id", "size", "mark", F.lit(self.seed)), F.col("n_blocks")))

    def drawn(self, rows: DataFrame) -> DataFrame:
        """``rows`` (doc_id, source, size, mark, ...) with ``draws``, an array of struct(pass, shard, words)."""
        plan = broadcast_if_small(self.draws.select(F.col("source").alias("s"), F.col("block").alias("b"), "draws", "limit"))
        both = self.with_block(rows).join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left").drop("s", "b")
        part = F.coalesce(F.col("limit") > 0, F.lit(False))
        order = Window.partitionBy("source", "block").orderBy(F.xxhash64("doc_id", "mark", F.lit(self.seed + 1)), "doc_id", "size", "mark").rowsBetween(Window.unboundedPreceding, -1)
        cut = both.filter(part).withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))  # one block a source
        both = both.filter(~part).withColumn("before", F.lit(0).cast("long")).unionByName(cut)
        words = lambda d: F.when(d["limit"] < 0, F.col("size")).otherwise(F.greatest(F.lit(0), F.least(F.col("size"), d["limit"] - F.col("before"))))
        none = F.array().cast("array<struct<pass:int,shard:int,limit:bigint>>")
        taken = F.transform(F.coalesce("draws", none), lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), words(d).cast("long").alias("words")))
        return both.withColumn("draws", F.filter(taken, lambda d: d["words"] > 0)).drop("block", "limit", "before", "n_blocks", "words", "no")


def _of(id_col: str, text_col: str, source_col: str) -> list[Column]:
    """doc_id, source, size and mark, a hash of the text."""
    text = F.col(text_col)
    return [F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size_of(text).alias("size"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark")]


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return saved(docs.select(*_of(id_col, text_col, source_col)), "sizes")


def mix_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, and the shards of its draws."""
    rows = measured(docs, id_col, text_col, source_col)
    drawn = Mix(rows).drawn(rows)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"])
    return drawn.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.transform("draws", lambda d: d["shard"]).alias("shards"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed table: rows of ``docs``, repeated or left out, dealt to output shards and shuffled in each; all columns of ``docs``.

    Of a document that the target cuts, the text up to its last word taken is
    left, and ``n_chars``, if there is such a column, is its length.
    """
    rows = measured(docs, id_col, text_col, source_col)
    plan = Mix(rows)
    all_of = free_name(docs, "gl_row")
    held = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(all_of), *_of(id_col, text_col, source_col))
    drawn = plan.drawn(held).select(all_of, "doc_id", "mark", "size", F.explode("draws").alias("d"))
    cut = F.col("d.words") < F.col("size")
    head = F.concat(F.lit(f"^(?:{SPACE}*+{WORD}++){{"), F.col("d.words").cast("string"), F.lit("}+"))
    text = F.when(cut, F.call_function("regexp_extract", F.col(f"{all_of}.{text_col}"), head, F.lit(0))).otherwise(F.col(f"{all_of}.{text_col}"))
    cols = []
    for c in docs.columns:
        value = F.col(f"{all_of}.`{c}`")
        cols.append((text if c == text_col else F.when(cut, F.length(text).cast(docs.schema[c].dataType)).otherwise(value) if c == "n_chars" else value).alias(c))
    shard, order = free_name(docs, "gl_shard"), free_name(docs, "gl_order")
    mixed = drawn.select(*cols, F.col("d.shard").alias(shard), F.xxhash64("doc_id", "mark", "d.pass", F.lit(plan.seed + 2)).alias(order))
    return mixed.repartitionById(plan.shards, F.col(shard).cast("int")).sortWithinPartitions(shard, order).select(*[F.col(f"`{c}`") for c in docs.columns])
