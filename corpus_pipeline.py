"""A corpus pipeline: language ID, near-copy removal, mixing to target weights, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written
as Parquet into shared storage and read again as the next stage's docs.  All stages but the
last return the columns of documents.  Nulls, empty texts, repeated rows, empty tables and
further columns are treated as the operators' modules say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import langid, mixing, ngram_join, packing
from ledgerloom.llm.storage import new_folder, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without letters, and those the network takes for no language's, go."""
    return langid.keep_known(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word Jaccard links of 0.8 or more."""
    return ngram_join.keep_one(docs, width=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the source weights take it; repeats are repeated rows."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their bins."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the trained network nor best-fit packing
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
