"""A corpus pipeline of five stages, each calling one operator of ``layerkit.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's documents; all but the last return the
columns of ``documents``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from layerkit.llm import jaccard, mixing, packing, queries, suffixes, toxicity
from layerkit.llm.common import stored
from layerkit.sources.tables import load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the grammar scores 0.5 or more."""
    return toxicity.clean(docs, toxicity.fitted(docs, load(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity: that of the smallest id."""
    return jaccard.keep_one(docs)


def drop_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that a document with a smaller id has."""
    return suffixes.deduplicated(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: each document once for every copy taken."""
    return mixing.emit(mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences of 2048 tokens."""
    return packing.query(docs, queries.tokenizer_path())


STAGES = [("toxicity", drop_toxic), ("jaccard", drop_near_copies), ("suffixes", drop_passages), ("mixing", mix), ("packing", pack)]

#: Tokenised, learned and rounded stages have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), spark, f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
