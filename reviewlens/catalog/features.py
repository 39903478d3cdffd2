"""Counts, vocabulary and TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.catalog import sql as Q
from reviewlens.catalog.registry import register, table
from reviewlens.functions import text as T
from reviewlens.operators import features
from reviewlens.session import stored


@register("SELECT lang, count(*) AS count FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.value_counts(table(spark, sf_dir, "documents"), "lang")


@register(
    f"""WITH t AS (SELECT doc_id, unnest({Q.words(Q.clean('lower(text)'))}) AS term FROM documents)
    SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL"""
)
def bow(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = T.split_words(T.clean_text(F.lower("text")))
    counts = features.bag_of_words(table(spark, sf_dir, "documents"), "doc_id", words)
    return counts.withColumn("tf", F.col("tf").cast("long"))


@register(f"WITH {Q.terms('documents', 'doc_id')}, {Q.idf('documents')} SELECT term, tf, df FROM vocab")
def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.vocabulary(table(spark, sf_dir, "documents"), features.word_terms(F.col("text")))


@register(
    f"""WITH {Q.terms('documents', 'doc_id')}, {Q.idf('documents')}, {Q.weights('doc_id')}
    SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf"""
)
def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights over the 5,000 most frequent unigrams and bigrams."""
    docs = table(spark, sf_dir, "documents")
    terms = features.word_terms(F.col("text"))
    weights = features.TfidfStages.fit_text(docs, F.col("text")).long(docs, "doc_id", terms)
    return weights.withColumn("weight", F.round("weight", 6))


_ALL_WORDS = f"{Q.terms('documents', 'doc_id', bigrams=False)}, {Q.idf('documents', 1, None)}"


@register(
    f"""WITH {_ALL_WORDS}, {Q.weights('doc_id')} SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf"""
)
def tfidf_all_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights over every word of the corpus, however many there are."""
    docs = table(spark, sf_dir, "documents")
    terms = features.word_terms(F.col("text"), 1)
    idf = stored(features.with_idf(features.vocabulary(docs, terms, 1, None), docs.count()), "idf")
    return features.tfidf_long(docs, "doc_id", terms, idf).withColumn("weight", F.round("weight", 6))


@register(
    f"""WITH {_ALL_WORDS}
    SELECT n AS n_texts, count(*) AS n_features, sum(df)::BIGINT AS n_nonzero,
           round(1 - sum(df) / (n * count(*))::DOUBLE, 9) AS sparsity FROM vocab GROUP BY n"""
)
def tfidf_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    stats = features.tfidf_stats(docs, features.word_terms(F.col("text"), 1))
    return stats.withColumn("sparsity", F.round("sparsity", 9))


_FIRST = ", ".join(
    f"round(coalesce(max(CASE WHEN place = {i} THEN weight END), 0), 6) AS term_{i}" for i in range(1, 11)
)


@register(
    f"""WITH {_ALL_WORDS}, {Q.weights('doc_id')},
      first_terms AS (SELECT term, row_number() OVER (ORDER BY term) AS place FROM vocab ORDER BY term LIMIT 10),
      cells AS (SELECT doc_id, place, weight FROM tfidf t JOIN first_terms f ON t.term = f.term)
    SELECT d.doc_id, {_FIRST} FROM documents d LEFT JOIN cells c ON d.doc_id = c.doc_id GROUP BY d.doc_id"""
)
def tfidf_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense weights of the first ten terms in alphabetical order."""
    docs = table(spark, sf_dir, "documents")
    terms = features.word_terms(F.col("text"), 1)
    vocab = stored(features.vocabulary(docs, terms, 1, None), "vocabulary")
    first = [r["term"] for r in vocab.select("term").orderBy("term").limit(10).collect()]
    names = {term: f"term_{i}" for i, term in enumerate(first, 1)}
    cells = features.tfidf_preview(docs, "doc_id", terms, features.with_idf(vocab, docs.count()), names)
    return cells.select("doc_id", *[F.round(n, 6).alias(n) for n in names.values()])


@register(
    """SELECT lang, count(*) AS n, round(any_value(n_all) / (any_value(k) * count(*))::DOUBLE, 9) AS weight
    FROM documents, (SELECT count(*) AS n_all, count(DISTINCT lang) AS k FROM documents) GROUP BY lang"""
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = features.class_weights(table(spark, sf_dir, "documents"), "lang")
    return weights.withColumn("weight", F.round("weight", 9))
