"""Score reviews as their files arrive, with the operators of the batch plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from reviewlens.operators.joint_tagger import JointTagger
from reviewlens.operators.tagger import Tagger
from reviewlens.plans.scoring import prediction_counts, score_reviews, tag_reviews


def read_arriving(
    spark: SparkSession,
    path: str,
    schema: StructType,
    format: str = "parquet",
    max_files: int = 1000,
    name_pattern: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Stream of new files; ``max_files`` bounds a micro-batch, the rest waits for the next one.

    CSV files whose cells hold no line breaks can be split: turn ``multi_line`` off.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    if format == "csv":
        reader = reader.options(header=True, multiLine=multi_line, quote='"', escape='"')
    return reader.format(format).load(path)


def _append(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(sink)
    )


def score_stream(
    stream: DataFrame, models: Mapping[str, PipelineModel], sink: str, checkpoint: str, **options
) -> StreamingQuery:
    """Append scored rows to Parquet; stateless, so restarts resume from the checkpoint exactly once."""
    return _append(score_reviews(stream, models, **options), sink, checkpoint)


def tag_stream(
    stream: DataFrame, id_col: str, tagger: Tagger | JointTagger, sink: str, checkpoint: str, text: str = "text"
) -> StreamingQuery:
    """Append token labels, entities and highlighted texts to Parquet; stateless as well."""
    return _append(tag_reviews(stream, id_col, tagger, text), sink, checkpoint)


def count_stream(scored: DataFrame, columns: Sequence[str], sink: str, checkpoint: str) -> StreamingQuery:
    """Running totals of every predicted value, kept as state: one row per target and value, whatever arrives.

    Each micro-batch writes the totals it changed to a folder named by its number. A batch that is run again after
    a failure replaces its own folder, so nothing is counted twice.
    """

    def write(totals: DataFrame, batch: int) -> None:
        totals.write.mode("overwrite").parquet(f"{sink}/batch={batch}")

    return (
        prediction_counts(scored, columns).writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )


def read_totals(spark: SparkSession, sink: str) -> DataFrame:
    """``(target, value, count)`` after the last batch that ``count_stream`` wrote."""
    changes = spark.read.schema("target string, value string, count long, batch long").parquet(sink)
    return changes.groupBy("target", "value").agg(F.max_by("count", "batch").alias("count"))
