"""Balanced review corpus and weakly labelled token corpus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from reviewlens.functions import bio
from reviewlens.functions.fixed_values import (
    ASPECT_MAP, ASPECT_WORDS, CITIES, CORPUS_SENTENCES, HOTELS, ROWS_PER_GROUP, SEED, SENTIMENT_MAP, TEMPLATES,
)
from reviewlens.functions.text import split_words
from reviewlens.operators.joins import lookup_join
from reviewlens.operators.labels import filter_valid_and_remap
from reviewlens.operators.sampling import cap_per_group, pick_index, random_choice, sample_exact

Choices = Sequence[str] | DataFrame


def build_review_corpus(
    raw: DataFrame,
    id_col: str,
    aspect_map: Mapping[str, str] = ASPECT_MAP,
    sentiment_map: Mapping[str, str] = SENTIMENT_MAP,
    n: int = ROWS_PER_GROUP,
    seed: int = SEED,
) -> DataFrame:
    """Clean labels, then at most ``n`` random rows per aspect and sentiment."""
    return cap_per_group(
        filter_valid_and_remap(raw, aspect_map, sentiment_map), ["aspect", "sentiment"], n, id_col, seed
    )


def with_choice(df: DataFrame, id_col: str, seed: str, choices: Choices, out: str) -> DataFrame:
    """An independent random choice per row, from a list or from a table.

    A table has ``idx``, the numbers 0 to n-1, and ``value``.
    """
    if not isinstance(choices, DataFrame):
        return df.withColumn(out, random_choice(seed, F.col(id_col), choices))
    picked = df.withColumn("_idx", pick_index(seed, F.col(id_col), choices.count()))
    table = choices.select(F.col("idx").cast("long").alias("_idx"), F.col("value").alias(out))
    return lookup_join(picked, table, ["_idx"], [id_col]).drop("_idx")


def wrap_snippets(
    df: DataFrame, id_col: str, text: str, hotels: Choices, places: Choices, templates: Sequence[str], seed: int
) -> DataFrame:
    """Add ``hotel``, ``loc`` and ``sentence``: the text in a random carrier sentence."""
    df = with_choice(df, id_col, f"{seed}:hotel", hotels, "hotel")
    df = with_choice(df, id_col, f"{seed}:loc", places, "loc")
    df = with_choice(df, id_col, f"{seed}:template", list(templates), "_template")
    sentence = bio.wrap_in_template(F.col("_template"), F.col("hotel"), F.col("loc"), F.col(text))
    return df.withColumn("sentence", sentence).drop("_template")


def label_sentences(df: DataFrame, id_col: str, text: str, aspect: str, lexicon: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(id, tokens, labels)`` for wrapped snippets."""
    words = df.withColumn("tokens", split_words(F.col("sentence"))).withColumn("_words", split_words(F.col(text)))
    tagged = words.withColumn("_tags", bio.keyword_bio_tag(F.col("_words"), F.col(aspect), lexicon)).withColumn(
        "_spans", bio.gazetteer_span_tag(F.col("tokens"), F.col("hotel"), F.col("loc"))
    )
    known = bio.token_label_map(F.col("_words"), F.col("_tags"))
    labels = bio.project_snippet_labels(F.col("tokens"), F.col("_spans"), known)
    return tagged.select(id_col, "tokens", labels.alias("labels"))


def build_bio_corpus(
    df: DataFrame,
    id_col: str,
    text: str = "text",
    aspect: str = "aspect",
    lexicon: Mapping[str, Sequence[str]] = ASPECT_WORDS,
    hotels: Choices = HOTELS,
    places: Choices = CITIES,
    templates: Sequence[str] = TEMPLATES,
    n: int = CORPUS_SENTENCES,
    seed: int = SEED,
) -> DataFrame:
    """``(id, tokens, labels)``: a sample of texts in carrier sentences, labelled by lexicon and gazetteers."""
    sample = sample_exact(df, n, id_col, seed)
    return label_sentences(wrap_snippets(sample, id_col, text, hotels, places, templates, seed), id_col, text, aspect, lexicon)


def bio_table(corpus: DataFrame, id_col: str) -> DataFrame:
    """``(doc_id, pos, token, label)``, one row per token."""
    zipped = F.arrays_zip(F.col("tokens").alias("token"), F.col("labels").alias("label"))
    return corpus.select(F.col(id_col).alias("doc_id"), F.posexplode(zipped)).select(
        "doc_id", "pos", "col.token", "col.label"
    )
