"""Row filters, label clean-up and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from reviewlens.functions import text as T
from reviewlens.operators.joins import map_values


def filter_valid_and_remap(
    df: DataFrame,
    aspect_map: Mapping[str, str],
    sentiment_map: Mapping[str, str],
    text: str = "text",
    aspect: str = "aspect",
    sentiment: str = "sentiment",
) -> DataFrame:
    """Keep rows with text and known labels, rename the labels, strip the text."""
    return (
        df.where((F.col(text) != "") & F.col(aspect).isin(*aspect_map) & F.col(sentiment).isin(*sentiment_map))
        .withColumn(text, T.strip_spaces(F.col(text)))
        .withColumn(aspect, map_values(F.col(aspect), aspect_map))
        .withColumn(sentiment, map_values(F.col(sentiment), sentiment_map))
    )


def drop_incomplete(df: DataFrame, columns: Sequence[str], missing: Sequence[str] = ()) -> DataFrame:
    """Drop rows where one of ``columns`` is null or spells a missing value."""
    complete = df.na.drop(subset=list(columns))
    for name in columns:
        if missing:
            complete = complete.where(~F.col(name).isin(*missing))
    return complete


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df


def nonblank_rows(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(T.nonblank(F.col(text)))
