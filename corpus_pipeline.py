"""Cleaning and packing a training corpus.

Five stages, each a function of (session, documents, folder of tables): quality rules remove documents, exact and near
duplicates leave one document of each group, secrets are masked inside the texts that hold them, and what is left is packed
into sequences. All stages but the last return the columns of their input. ``run`` writes every stage to the shared
folder and reads it back for the next one, so a lost executor costs at most the running stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodmark.llm import exact_dedup, near_dedup, packing, quality, secrets
from floodmark.plans.shipping import ship_package
from floodmark.plans.staging import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Near duplicates: words per shingle, least similarity in percent.
SHINGLE_WORDS, SIMILARITY = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a hard rule go, and those of bad hosts that break a soft rule."""
    return quality.keep_good(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the smallest id stays."""
    return exact_dedup.dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of near copies the smallest id stays."""
    ship_package(spark)
    return near_dedup.dedup(docs, SHINGLE_WORDS, SIMILARITY)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of a secret is masked; the document stays and its length is counted again."""
    ship_package(spark)
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("pack_sequences", pack_sequences),
]
#: SQL has no tokenizer and no Markov model; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
