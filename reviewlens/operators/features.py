"""Counts, vocabulary and TF-IDF."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions.arrays import let, term_counts
from reviewlens.functions.text import WORD
from reviewlens.operators.joins import BROADCAST_ROWS, bounded, lookup_join, salted_lookup
from reviewlens.session import stored


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first; nulls are skipped."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), column)


def word_terms(text: Column, max_n: int = 2) -> Column:
    """Lowercased runs of two or more word characters and their n-grams up to ``max_n``."""
    words = F.regexp_extract_all(F.lower(text), F.lit(rf"[{WORD}]{{2,}}"), F.lit(0))

    def grams(w: Column) -> Column:
        parts = [w]
        joined = w
        for n in range(2, max_n + 1):
            count = F.greatest(F.size(w) - (n - 1), F.lit(0))
            joined = F.zip_with(
                F.slice(joined, F.lit(1), count),
                F.slice(w, F.lit(n), count),
                lambda a, b: F.concat_ws(" ", a, b),
            )
            parts.append(joined)
        return F.concat(*parts)

    return words if max_n == 1 else let(words, grams)


def bag_of_words(df: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """Long form ``(id, term, tf)``. Counted inside each row, so there is no shuffle."""
    return df.select(id_col, F.inline(term_counts(tokens)))


def vocabulary(df: DataFrame, terms: Column, min_df: int = 2, max_features: int | None = 5000) -> DataFrame:
    """``(term, tf, df)`` of terms in at least ``min_df`` texts, the most frequent first, ties by term.

    Rows are counted one by one before the shuffle, so the document frequency is a row count.
    """
    counts = (
        df.select(F.inline(term_counts(terms)))
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.count("*").alias("df"))
        .where(F.col("df") >= min_df)
    )
    return counts if max_features is None else counts.orderBy(F.desc("tf"), "term").limit(max_features)


def words_and_pairs(df: DataFrame, text: Column, min_df: int = 2, max_features: int = 5000) -> DataFrame:
    """``vocabulary`` of ``word_terms``, where most pairs are never shuffled.

    Words are counted first. A pair is no more frequent than its words, so where there are ``max_features``
    words, only pairs of words at least as frequent as the last of them can enter.
    """
    words = word_terms(text, 1)
    counts = stored(
        df.select(F.inline(term_counts(words))).groupBy("term").agg(F.sum("tf").alias("tf"), F.count("*").alias("df")), "words"
    )
    valid = counts.where(F.col("df") >= min_df)
    last = valid.orderBy(F.desc("tf"), "term").limit(max_features).agg(F.count("*").alias("n"), F.min("tf").alias("tf")).first()
    pairs = F.filter(word_terms(text, 2), lambda t: F.contains(t, F.lit(" ")))
    if last["n"] >= max_features:
        known = [r["term"] for r in counts.where(F.col("tf") >= last["tf"]).select("term").limit(4 * max_features + 1).collect()]
        if len(known) <= 4 * max_features:  # else too many words tie with the last one, and all pairs are counted
            pairs = let(words, lambda w: _known_pairs(w, known))
    found = vocabulary(df, pairs, min_df, None).unionByName(valid)
    return found.orderBy(F.desc("tf"), "term").limit(max_features)


def _known_pairs(words: Column, known: list[str]) -> Column:
    """Neighbouring words that are both known, joined by a space; no other pair is put together."""
    count = F.greatest(F.size(words) - 1, F.lit(0))
    joined = F.zip_with(
        F.slice(words, F.lit(1), count), F.slice(words, F.lit(2), count),
        lambda a, b: F.when(a.isin(known) & b.isin(known), F.concat_ws(" ", a, b)),
    )
    return F.array_compact(joined)


def with_idf(vocab: DataFrame, n_texts: int) -> DataFrame:
    return vocab.withColumn("idf", F.log((F.lit(1.0) + n_texts) / (F.lit(1.0) + F.col("df"))) + 1)


@dataclass(frozen=True)
class TfidfStages:
    """A fitted vocabulary, at most ``max_features`` terms, and its weights."""

    terms: list[str]
    idf: list[float]

    @classmethod
    def fit(cls, df: DataFrame, terms: Column, min_df: int = 2, max_features: int = 5000) -> TfidfStages:
        return cls._of(df, vocabulary(df, terms, min_df, max_features))

    @classmethod
    def fit_text(cls, df: DataFrame, text: Column, min_df: int = 2, max_features: int = 5000) -> TfidfStages:
        """As ``fit`` for ``word_terms(text)``."""
        return cls._of(df, words_and_pairs(df, text, min_df, max_features))

    @classmethod
    def _of(cls, df: DataFrame, vocab: DataFrame) -> TfidfStages:
        rows = with_idf(vocab, df.count()).orderBy("term").collect()
        return cls([r["term"] for r in rows], [r["idf"] for r in rows])

    def stages(self, terms_col: str, out_col: str) -> list:
        """Savable ML stages: counts, times idf, unit length."""
        counts = CountVectorizerModel.from_vocabulary(
            self.terms, inputCol=terms_col, outputCol=f"{out_col}_tf", minTF=1.0
        )
        weights = ElementwiseProduct(
            scalingVec=Vectors.dense(self.idf), inputCol=f"{out_col}_tf", outputCol=f"{out_col}_tfidf"
        )
        return [counts, weights, Normalizer(p=2.0, inputCol=f"{out_col}_tfidf", outputCol=out_col)]

    def transform(self, df: DataFrame, terms_col: str, out_col: str) -> DataFrame:
        for stage in self.stages(terms_col, out_col):
            df = stage.transform(df)
        return df.drop(f"{out_col}_tf", f"{out_col}_tfidf")

    def long(self, df: DataFrame, id_col: str, terms: Column) -> DataFrame:
        """``(id, term, weight)`` without a shuffle."""
        vectors = self.transform(df.select(id_col, terms.alias("_terms")), "_terms", "_vector")
        inner = F.unwrap_udt(F.col("_vector"))
        entries = F.inline(F.arrays_zip(inner["indices"].alias("i"), inner["values"].alias("weight")))
        names = F.array(*[F.lit(t) for t in self.terms])
        cells = vectors.select(id_col, entries).toDF(id_col, "_i", "weight")
        return cells.select(id_col, F.get(names, F.col("_i")).alias("term"), "weight")


def tfidf_long(df: DataFrame, id_col: str, terms: Column, idf: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``(id, term, weight)`` for a vocabulary ``(term, idf)`` of any size."""
    raw = _raw_weights(df, id_col, terms, idf, max_rows).where("raw is not null")
    rows = raw.groupBy(id_col).agg(
        F.collect_list(F.struct("term", "raw")).alias("_cells"), F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("_norm")
    )
    cells = F.transform(
        "_cells", lambda c: F.struct(c["term"].alias("term"), (c["raw"] / F.col("_norm")).alias("weight"))
    )
    return rows.select(id_col, F.inline(cells))


def tfidf_preview(
    df: DataFrame, id_col: str, terms: Column, idf: DataFrame, columns: dict[str, str], max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Dense weights of a few terms, one row per text; ``columns`` maps term to column name."""
    raw = _raw_weights(df, id_col, terms, idf, max_rows)
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")))
    cells = [
        F.coalesce(F.max(F.when(F.col("term") == term, F.col("raw"))) / norm, F.lit(0.0)).alias(name)
        for term, name in columns.items()
    ]
    return raw.groupBy(id_col).agg(*cells)


def _raw_weights(df: DataFrame, id_col: str, terms: Column, idf: DataFrame, max_rows: int) -> DataFrame:
    counts = df.select(id_col, F.inline_outer(term_counts(terms)))
    if bounded(idf.select("term", "idf"), max_rows) is None and "df" in idf.columns:
        # The document frequencies say how many rows a term has, so the texts are not counted again.
        joined = salted_lookup(counts, idf.select("term", "idf", "df"), "term", "df")
    else:
        joined = lookup_join(counts, idf.select("term", "idf"), ["term"], [id_col], how="left", max_rows=max_rows)
    return joined.select(id_col, "term", (F.col("tf") * F.col("idf")).alias("raw"))


def tfidf_stats(df: DataFrame, terms: Column, min_df: int = 1) -> DataFrame:
    """Texts, features and the share of zero cells; the non-zero cells are the document frequencies."""
    n_texts = df.count()
    return (
        vocabulary(df, terms, min_df, None)
        .agg(F.count("*").alias("n_features"), F.coalesce(F.sum("df"), F.lit(0)).alias("n_nonzero"))
        .select(
            F.lit(n_texts).cast("long").alias("n_texts"),
            "n_features",
            "n_nonzero",
            F.try_subtract(
                F.lit(1.0), F.try_divide(F.col("n_nonzero"), F.lit(n_texts) * F.col("n_features"))
            ).alias("sparsity"),
        )
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight ``rows / (classes * rows of the class)`` per class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n"), F.count("*")).first()
    return counts.withColumn("weight", F.lit(float(totals[0] or 0)) / (F.lit(totals[1]) * F.col("n")))
