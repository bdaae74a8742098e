"""The corpus pipeline: documents without toxic, bad and repeated ones, mixed by source and packed into sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which is written as
Parquet and read again for the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vistaframe.llm import jaccard, mixing, packing, quality, toxicity
from vistaframe.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity reaches the threshold calibrated for their language."""
    return toxicity.without_toxic(docs, toxicity.network(spark, docs, sf_dir))


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose quality is below the limit."""
    return quality.good_documents(docs, quality.field_of(spark, docs, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return jaccard.one_of_each(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source up to its target: rows are left out, repeated, or at the cut shortened."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the mix into sequences of 2,048 ids: a row for each piece."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_bad),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
