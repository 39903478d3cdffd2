"""Registry of queries and the lexicons they use on the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The test tables are invented prose in English, French, German and Spanish, so they get lexicons
# of their own. Insults stand for an aspect, the language for a label with several classes.
INSULTS = ["trash", "pathetic", "idiot", "worthless", "disgusting", "stupid", "clown", "loser", "scum", "moron"]
STOPWORDS = ["the", "of", "and", "le", "la", "de", "der", "die", "und", "el"]
SLANG = {
    "the": "definite", "and": "plus", "with": "having", "that": "which", "le": "lui", "les": "eux",
    "des": "certains", "der": "jener", "und": "plus", "die": "jene", "el": "aquel", "que": "cual",
}
STEMS = {
    "english": (["the", "tha"], ["of", "and"]),
    "french": (["eau", "éeau"], ["le", "les"]),
    "german": (["schei", "kei"], ["der", "und"]),
    "insult": ([], INSULTS),
}
TOXIC = {"toxic": ([], INSULTS)}
KEYWORDS = {
    "en": ["the", "of", *INSULTS], "fr": ["le", "la", "eaux"], "de": ["der", "die", "und"], "es": ["el", "la", "de"],
}
TURN_KEYWORDS = {"user": ["the", "of", "le", "der", "el"], "assistant": ["and", "the", "la", "die", "und", "de"]}
SEED = 42


WIDE_WORK = {"documents", "conversations", "lineitem"}
#: A table of fewer splits than this is small: it holds no more bytes than these splits can.
FEW_SPLITS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. A file of one row group is read by one task, so small tables for heavy work are spread out.

    Decided by the layout of the files: a table with splits enough for 16 tasks is never moved, whatever the cores.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    if name in WIDE_WORK and rows.rdd.getNumPartitions() < min(cores, FEW_SPLITS):
        return rows.repartition(2 * cores)
    return rows


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name with a ``q_`` prefix, and its SQL if there is one."""

    def add(query: Query) -> Query:
        name = f"q_{query.__name__}"
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their labels."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns under one string id."""
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return table(spark, sf_dir, "conversations").select(key.alias("doc_id"), "role", "text")
