"""A training corpus from the table ``documents``: rank, deduplicate, mix, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before
it kept; all but the last return the columns of ``documents``.

Defined results of every stage: a null text counts as empty; rows are told by
doc_id and text, so rows that repeat an id, or have none, stay unless their texts
are copies; rows that repeat an id and a text are copies; other columns are
carried along, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import exact_dedup, jaccard, mixing, packing, quality_classifier, simhash
from gridloom.llm.queries import table, vocabulary
from gridloom.llm.shared import limit_batches, saved


def rank_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score passes, learned from the labels of those in ``docs``; without labels of both kinds all pass."""
    limit_batches(spark)
    return quality_classifier.keep_quality(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for the case of A-Z the one with the largest doc_id; one without an id loses against any other."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard similarity 0.8 or more) the one with the smallest doc_id."""
    limit_batches(spark)
    return simhash.drop_near_duplicates(docs, words=jaccard.WORDS, find=jaccard.near_copies)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, left out or cut so that sources come near their targets, shuffled; a null source is a source, a document without words is left out."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, each with the mixture of the corpus; an empty text is its end id."""
    limit_batches(spark)
    return packing.pack_documents(docs, vocabulary(), end_id=2)


STAGES = [
    ("quality_classifier", rank_quality),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The stages learn, hash and encode; SQL can't express them.  tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result but the last is written as Parquet and read again."""
    docs = table(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
