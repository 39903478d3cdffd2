"""Readers and writers, through files in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.catalog import sql as Q
from reviewlens.catalog.registry import KEYWORDS, labelled, register, table
from reviewlens.catalog.text import keyword_labels_sql
from reviewlens.functions import bio as B
from reviewlens.plans.corpora import bio_table
from reviewlens.session import shared_dir
from reviewlens.sources.readers import read_bio_sentences, read_bio_tsv, read_labelled_raw, read_reviews, sentences
from reviewlens.sources.writers import write_bio_sentences, write_bio_tsv, write_csv


@register(
    """SELECT text, lang AS aspect, quality::VARCHAR AS sentiment FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""
)
def scan_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nine-column sheet with text, aspect and sentiment at positions 6, 7 and 8."""
    path = shared_dir(spark, "scan-labelled")
    columns = ["doc_id", "source", "n_chars", "toxic", "doc_id AS again", "source AS also", "text", "lang", "quality"]
    write_csv(labelled(spark, sf_dir).selectExpr(*columns), path)
    return read_labelled_raw(spark, path)


@register(
    """SELECT d.doc_id::VARCHAR AS doc_id, text, lang, quality::VARCHAR AS quality
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL AND text <> ''"""
)
def scan_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with or without labels through CSV; the incomplete ones are dropped."""
    path = shared_dir(spark, "scan-dropna")
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    write_csv(docs.select("doc_id", "text", "lang", "quality"), path)
    return read_reviews(spark, path, ["text", "lang", "quality"])


@register(
    f"""WITH {keyword_labels_sql('documents', 'doc_id', 'lang', KEYWORDS, Q.tokens('text'))},
      u AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS i, t, labels FROM kw)
    SELECT doc_id, i - 1 AS pos, t[i] AS token, labels[i] AS label FROM u"""
)
def bio_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table of all documents, written to and read from tab-separated files."""
    docs = table(spark, sf_dir, "documents").withColumn("tokens", B.ner_tokenize(F.col("text")))
    tagged = docs.withColumn("labels", B.keyword_bio_tag(F.col("tokens"), F.col("lang"), KEYWORDS))
    path = shared_dir(spark, "bio-roundtrip")
    write_bio_tsv(bio_table(tagged, "doc_id"), path, compression="gzip")
    return read_bio_tsv(spark, path).withColumn("pos", F.col("pos").cast("long"))


@register(
    f"""WITH {keyword_labels_sql('documents', 'doc_id', 'lang', KEYWORDS, Q.tokens('text'))}
    SELECT array_to_string(t, ' ') AS tokens, array_to_string(labels, ' ') AS labels, count(*) AS sentences
    FROM kw WHERE len(t) > 0 GROUP BY ALL"""
)
def bio_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token table in files whose sentences use the same ten ids again and again; blank lines tell them apart."""
    docs = table(spark, sf_dir, "documents").withColumn("tokens", B.ner_tokenize(F.col("text")))
    tagged = docs.withColumn("labels", B.keyword_bio_tag(F.col("tokens"), F.col("lang"), KEYWORDS))
    path = shared_dir(spark, "bio-sentences")
    write_bio_sentences(tagged.withColumn("doc_id", F.col("doc_id") % 10), path)
    found = sentences(read_bio_sentences(spark, path)).select("sentence.token", "sentence.label")
    found = found.select(F.array_join("token", " ").alias("tokens"), F.array_join("label", " ").alias("labels"))
    return found.groupBy("tokens", "labels").agg(F.count("*").alias("sentences"))
