"""A training corpus from raw documents, in five stages, each written before the next one reads it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import language_id, line_dedup, mixing, order_minhash, packing
from earshot.session import shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: How often a scarce source may be read for every time a plentiful one is.
MAX_REPEATS = 1.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the others go."""
    return language_id.keep_identified(docs).select(COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that three or more of them share; n_chars follows the text."""
    kept = line_dedup.dedup_lines(docs)
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed).select(COLUMNS)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return order_minhash.drop_near_duplicates(docs).select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of scarce sources again until their weight is met."""
    return mixing.mix(docs, max_repeats=MAX_REPEATS).select(COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, placed in windows at their sources' shares."""
    return packing.pieces_digest(packing.pack(docs))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("source_mixing", mix_sources),
    ("packing", pack_windows),
]

#: Tokenising and near duplicates are beyond SQL; tests/llm holds each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
