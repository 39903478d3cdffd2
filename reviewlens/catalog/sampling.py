"""Samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.catalog import sql as Q
from reviewlens.catalog.registry import SEED, labelled, register, table
from reviewlens.operators import labels, sampling
from reviewlens.plans.corpora import build_review_corpus

_LABELLED = "(SELECT d.doc_id, d.text, d.lang, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


@register(
    f"""SELECT doc_id, lang, quality FROM (SELECT *, row_number() OVER (PARTITION BY lang, quality
      ORDER BY {Q.first_of('doc_id')}) AS k FROM {_LABELLED}) WHERE k <= 30"""
)
def cap_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = sampling.cap_per_group(labelled(spark, sf_dir), ["lang", "quality"], 30, "doc_id", SEED)
    return kept.select("doc_id", "lang", "quality")


@register(
    f"""SELECT lang, quality, count(*) AS available, least(30, count(*)) AS taken FROM {_LABELLED} GROUP BY lang, quality"""
)
def group_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.group_availability(labelled(spark, sf_dir), ["lang", "quality"], 30)


@register(f"SELECT doc_id, lang FROM documents ORDER BY {Q.first_of('doc_id')} LIMIT 400")
def sample_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_exact(table(spark, sf_dir, "documents").select("doc_id", "lang"), 400, "doc_id", SEED)


@register(
    f"""SELECT l_orderkey, count(*) AS n FROM (SELECT l_orderkey FROM lineitem ORDER BY {Q.first_of('l_orderkey')} LIMIT 1001)
    GROUP BY l_orderkey"""
)
def sample_repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exactly 1,001 lines although lines share the id of their order: the last order is taken in part."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return sampling.sample_exact(lines, 1001, "l_orderkey", SEED).groupBy("l_orderkey").agg(F.count("*").alias("n"))


@register(f"WITH {Q.stratified('documents', 'lang', 'doc_id')} SELECT doc_id, lang, is_test FROM split")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sampling.stratified_split(docs, "lang", 0.2, "doc_id", SEED)


@register(
    f"""SELECT doc_id, row_number() OVER (ORDER BY {Q.first_of('doc_id')}) <= (SELECT ceil(count(*) * 0.2::DOUBLE)
      FROM documents) AS is_test FROM documents"""
)
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_split(table(spark, sf_dir, "documents").select("doc_id"), 0.2, "doc_id", SEED)


@register(f"SELECT doc_id, lang FROM documents ORDER BY {Q.first_of('doc_id', 7)} LIMIT 50")
def shuffle_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader sees who opens the shuffled table: its first fifty rows."""
    return sampling.shuffle_rows(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 7).limit(50)


@register(f"SELECT doc_id, lang, row_number() OVER (ORDER BY {Q.first_of('doc_id', 7)}) AS position FROM documents")
def shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their place in the shuffled table."""
    return sampling.shuffled_positions(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 7)


_CHOICES = ["Semarang", "Solo", "Bali", "Kuta", "Ubud"]


@register(f"SELECT doc_id, {_CHOICES}[1 + {Q.pick('doc_id', '42:loc', '5')}] AS place FROM documents")
def random_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = sampling.random_choice("42:loc", F.col("doc_id"), _CHOICES)
    return table(spark, sf_dir, "documents").select("doc_id", picked.alias("place"))


LANG_NAMES = {"en": "english", "fr": "french", "de": "german"}
QUALITY_NAMES = {"0": "negatif", "1": "positif"}


@register(
    f"""SELECT doc_id, trim(text) AS text, {Q.text_map(LANG_NAMES)}[lang] AS aspect,
      {Q.text_map(QUALITY_NAMES)}[quality::VARCHAR] AS sentiment FROM {_LABELLED}
    WHERE text <> '' AND lang IN {Q.text_list(list(LANG_NAMES))}"""
)
def label_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = labelled(spark, sf_dir).select(
        "doc_id", "text", F.col("lang").alias("aspect"), F.col("quality").cast("string").alias("sentiment")
    )
    return labels.filter_valid_and_remap(raw, LANG_NAMES, QUALITY_NAMES)


@register(
    f"""WITH r AS (SELECT doc_id, trim(text) AS text, {Q.text_map(LANG_NAMES)}[lang] AS aspect,
        {Q.text_map(QUALITY_NAMES)}[quality::VARCHAR] AS sentiment FROM {_LABELLED}
      WHERE text <> '' AND lang IN {Q.text_list(list(LANG_NAMES))})
    SELECT doc_id, text, aspect, sentiment FROM (SELECT *, row_number() OVER (PARTITION BY aspect, sentiment
      ORDER BY {Q.first_of('doc_id')}) AS k FROM r) WHERE k <= 20"""
)
def review_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balanced corpus as one job: labels cleaned and mapped, then twenty rows per aspect and sentiment."""
    raw = labelled(spark, sf_dir).select(
        "doc_id", "text", F.col("lang").alias("aspect"), F.col("quality").cast("string").alias("sentiment")
    )
    return build_review_corpus(raw, "doc_id", LANG_NAMES, QUALITY_NAMES, 20, SEED)
