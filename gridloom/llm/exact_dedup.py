"""Exact duplicates by a heavy-hitter split.

A Misra-Gries type frequent-items sketch over the digests of all rows proposes
the frequent ones.  Their exact counts and winners, at most ``TOP`` rows, are
broadcast, so that copies in a large group are decided where they are read.
The remaining digests, none of which holds many rows, are counted with partial
sums and shuffled; those that occur once need nothing more.

Defined results: null text equals empty text; of rows that repeat a doc_id and
a text exactly one stays; a null doc_id loses against any other; an empty table
gives an empty result; other columns are ignored (``exact_duplicates``) or
returned as they are (``drop_exact_duplicates``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import broadcast_if_small, free_name, saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Frequent digests that are verified and broadcast, and entries of the sketch.  A digest outside has less than about a thousandth of all rows.
TOP, TRACKED = 1000, 5000


def normalised(text: Column) -> Column:
    """Lower-case A-Z only.  On ASCII texts, lower() does just that and is faster."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, UPPER, LOWER))


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def _grouped(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_row, group_size) of the digests that occur twice or more."""
    best = rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row_id")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return best.filter("group_size > 1").select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"), "group_size")


def _frequent(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, keep_row, group_size) of the verified frequent digests, at most TOP rows."""
    proposed = (
        rows.agg(F.expr(f"approx_top_k(hex(digest), {TOP}, {TRACKED})").alias("found"))
        .select(F.explode("found.item").alias("item"))
        .select(F.unhex("item").alias("digest"))
    )
    return _grouped(rows.join(F.broadcast(proposed), "digest", "left_semi"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = saved(
        docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("digest"), F.monotonically_increasing_id().alias("row_id")),
        "digests",
    )
    frequent = F.broadcast(saved(_frequent(rows), "frequent"))
    hot = rows.join(frequent, "digest")
    rest = rows.join(frequent, "digest", "left_anti")
    groups = broadcast_if_small(saved(_grouped(rest), "rest"))
    alone = [F.coalesce("keep_id", "doc_id"), F.coalesce("keep_row", "row_id"), F.coalesce("group_size", F.lit(1).cast("long"))]
    rest = rest.join(groups, "digest", "left").select("digest", "doc_id", "row_id", *(c.alias(n) for c, n in zip(alone, ("keep_id", "keep_row", "group_size"), strict=True)))
    return hot.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Only digests that occur twice or more are joined to the texts: by a
    broadcast while few, by a shuffle beyond ``shared.BROADCAST_ROWS``.
    """
    d, g = free_name(docs, "gl_digest"), free_name(docs, "gl_group")
    found = exact_duplicates(docs, id_col, text_col).filter("group_size > 1")
    groups = saved(
        found.groupBy(F.unhex("text_sha256").alias(d)).agg(
            F.struct(
                F.first("keep_id").alias("keep_id"), F.count_if(F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("same")
            ).alias(g)
        ),
        "groups",
    )
    joined = docs.withColumn(d, digest(F.col(text_col))).join(broadcast_if_small(groups), d, "left")
    winner = F.col(id_col).eqNullSafe(F.col(f"{g}.keep_id"))
    kept = joined.filter(F.col(g).isNull() | (winner & (F.col(f"{g}.same") == 1))).select(docs.columns)
    if groups.filter(F.col(f"{g}.same") > 1).limit(1).count():  # rows that repeat a doc_id and a text
        kept = kept.unionByName(joined.filter(winner & (F.col(f"{g}.same") > 1)).dropDuplicates([d]).select(docs.columns))
    return kept
