"""Score reviews: aspect, sentiment and entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from reviewlens.functions import bio, text as T
from reviewlens.functions.fixed_values import SLANG, STOPWORDS
from reviewlens.operators.labels import require_columns
from reviewlens.operators.joint_tagger import JointTagger
from reviewlens.operators.tagger import Tagger


def score_reviews(
    df: DataFrame,
    models: Mapping[str, PipelineModel],
    text: str = "text",
    slang: Mapping[str, str] = SLANG,
    stopwords: Sequence[str] = STOPWORDS,
    keep_clean: bool = False,
) -> DataFrame:
    """Append the output of every model, each reading the same cleaned text in column ``clean_text``.

    The models are independent. Rows without text get null. Works on streams as well.
    """
    require_columns(df, [text])
    clean = T.clean_or_lower(T.preprocess(F.col(text), slang, stopwords), F.col(text))
    scored = df.withColumn("clean_text", clean)
    for model in models.values():
        scored = model.transform(scored)
    return scored if keep_clean else scored.drop("clean_text")


def prediction_counts(scored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(target, value, count)``: how often each value was predicted; rows without prediction are skipped."""
    values = F.array(*[F.struct(F.lit(c).alias("target"), F.col(f"`{c}`").alias("value")) for c in columns])
    counted = scored.select(F.inline(values)).where(F.col("value").isNotNull())
    return counted.groupBy("target", "value").agg(F.count("*").alias("count"))


def analyse_reviews(
    df: DataFrame, id_col: str, models: Mapping[str, PipelineModel], tagger: Tagger | JointTagger, text: str = "text", **options
) -> DataFrame:
    """Classes and entities of every review in one table; ids must be unique."""
    tagged = tag_reviews(df, id_col, tagger, text)
    return score_reviews(df, models, text, **options).join(tagged, id_col, "left")


def tag_reviews(df: DataFrame, id_col: str, tagger: Tagger | JointTagger, text: str = "text") -> DataFrame:
    """``(id, tokens, labels, entities, highlighted)`` of the raw text."""
    tokens = df.select(id_col, bio.ner_tokenize(F.col(text)).alias("tokens"))
    tagged = tagger.tag(tokens, id_col, "tokens")
    return tagged.withColumn("entities", bio.bio_decode(F.col("tokens"), F.col("labels"))).withColumn(
        "highlighted", bio.highlight(F.col("tokens"), F.col("labels"))
    )
