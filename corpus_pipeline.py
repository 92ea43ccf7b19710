"""Corpus pipeline: documents -> quality -> exact dedup -> near dedup -> mix -> packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. ``run`` writes
each result as Parquet in the shared checkpoint folder and reads it again as
the next stage's documents. All stages but the last return the columns of
``documents``; the last returns one row per packed piece.

Defined cases are those of the operators: rejected are texts without a token;
rows that repeat are one row after exact dedup; null ids are never near
duplicates; an empty table passes all stages as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqrisk.llm import exact_dedup, minhash, mixing, packing, quality
from seqrisk.llm.common import read, saved
from seqrisk.llm.queries import TOP_GRADE, grades, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that rate as good and not toxic (the top grade)."""
    model = quality.train(docs, grades(read(spark, sf_dir, "labels")), top=TOP_GRADE)
    return quality.keep_good(docs, model, grade=TOP_GRADE)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.take_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents placed into sequences."""
    return packing.pack_documents(docs, vocabulary())


STAGES = [("quality_classifier", quality_classifier), ("exact_dedup", exact_copies), ("minhash_near_dedup", near_copies),
          ("source_mix", source_mix), ("best_fit_packing", best_fit_packing)]

# Trained models, dependent rounding and a genetic algorithm cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
