"""Corpus clean-up: toxic texts, exact and near copies and leaked test passages go, the rest is mixed by source."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.llm.common import small_batches
from reviewlens.llm.decontamination import without_leaks
from reviewlens.llm.exact_dedup import distinct_documents
from reviewlens.llm.mixing import mix_rows
from reviewlens.llm.queries import trained_toxicity
from reviewlens.llm.simhash import one_of_each
from reviewlens.llm.toxicity import REJECT
from reviewlens.session import shared_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the rejection score; the model learns from the labelled documents of ``sf_dir``."""
    score = trained_toxicity(spark, sf_dir).score(F.col("text"))
    return small_batches(docs).where(score < REJECT)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per text, the one with the largest id."""
    return distinct_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per group of near copies, the one with the smallest id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the mix takes, with the number of ``copies`` it takes of each."""
    return mix_rows(docs).where("copies > 0")


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: Trained scores, fingerprints and a fitted mix are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = shared_dir(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = os.path.join(base, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
