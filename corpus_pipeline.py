"""Corpus pipeline: toxic documents, exact copies and near copies go, passages that repeat are taken
out, and what stays is packed. Each stage works on all that its predecessor kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridspark.llm import exact_dedup, jaccard_join, packing, substring_dedup, toxicity
from gridspark.llm.common import ship
from gridspark.session import remove_folder, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on `labels`, scores as toxic go."""
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_harmless(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the smallest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the smallest doc_id stays."""
    ship(spark)
    return jaccard_join.keep_first(docs, words=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of 35 words that start at two or more places are taken out everywhere."""
    ship(spark)
    return substring_dedup.remove(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens, as one row per piece with its ids."""
    ship(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", harmless),
    ("exact_dedup", exact_copies),
    ("jaccard_join", near_copies),
    ("substring_dedup", repeated_passages),
    ("packing", packed),
]
# Classifier, similarity join and tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet in the shared folder and read again; a
    stage's table goes as soon as the next one's is written."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, before)
        before = f"{folder}/{name}"
    return docs
