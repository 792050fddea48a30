"""From raw documents to packed sequences: quality, line dedup, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beadloom.llm import jaccard, line_dedup, mixing, packing, quality
from beadloom.llm.common import read, stash


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from the labels of documents that reached this stage."""
    model = quality.train_on(docs, read(spark, sf_dir, "labels"))
    return quality.kept(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; those that hold nothing else go. n_chars follows the text."""
    found = line_dedup.dedup_lines(docs)
    left = found.filter((F.col("n_removed") == 0) | (F.length(F.regexp_replace("text", r"\s+", "")) > 0))
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", n_chars).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: sets of five words, similarity of 0.8 or more."""
    return jaccard.one_of_each(docs, n=5, percent=80).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, and those of small sources up to mixing.MAX_REPEATS times."""
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality_classifier", classify_quality),
    ("line_dedup", dedup_lines),
    ("jaccard_join", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: A trained classifier and a tokenizer can't be had in SQL; tests hold each stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
