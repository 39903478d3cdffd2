"""Writers for result tables, token corpora, reports and models."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.sources.readers import ordered_rows


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, UTF-8, quotes doubled as spreadsheets expect."""
    df.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_bio_tsv(rows: DataFrame, path: str, compression: str = "none") -> None:
    """Token table to tab-separated files, whole sentences in order; nothing is quoted or escaped.

    Range partitions keep equal ids together, so no sentence is torn; sentences of the same id follow each other.
    With ``compression="gzip"`` the files take a tenth of the disk; each is then read by one task, as it was written.
    """
    ordered = ordered_rows(rows).withColumnRenamed("doc_id", "sentence_id")
    ordered.write.mode("overwrite").csv(
        path, sep="\t", header=True, quote="", escape="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        compression=compression,
    )


def write_bio_sentences(sentences: DataFrame, path: str) -> None:
    """Rows ``(doc_id, tokens, labels)`` as lines ``id, token, label`` with a blank line after every sentence.

    Sentences stay where they are; nothing is shuffled or sorted. A null id
    is written as ``-``. A sentence without tokens writes one blank line.
    """
    sentence = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    line = lambda t, y: F.concat_ws("\t", sentence, t, y)
    lines = F.transform(F.zip_with("tokens", "labels", line), lambda x: F.concat(x, F.lit("\n")))
    sentences.select(F.array_join(lines, "").alias("value")).write.mode("overwrite").text(path)


def write_report(report: DataFrame, path: str) -> None:
    """Metric rows of every candidate as JSON lines."""
    report.write.mode("overwrite").json(path)


def write_evaluation(path: str, report: DataFrame, matrices: DataFrame, errors: DataFrame) -> None:
    """Metric rows and confusion matrices of every candidate, and wrong rows of the best, in folders of their own."""
    write_report(report, f"{path}/metrics")
    matrices.write.mode("overwrite").json(f"{path}/matrices")
    errors.write.mode("overwrite").json(f"{path}/errors")


def write_tagger_report(path: str, report: DataFrame, accuracy: DataFrame) -> None:
    """The entity report and the token accuracy of a tagger."""
    write_report(report, f"{path}/entities")
    accuracy.write.mode("overwrite").json(f"{path}/accuracy")


_MANIFEST = "version long, folder string, names array<string>"


def _saved(spark: SparkSession, path: str) -> DataFrame:
    spark.createDataFrame([], _MANIFEST).write.mode("append").json(f"{path}/manifest")  # makes the folder, adds no row
    return spark.read.schema(_MANIFEST).json(f"{path}/manifest")


def save_models(path: str, **models: PipelineModel) -> None:
    """All models as one new version below ``path``, all or none.

    Every version has a folder of its own. The manifest names it once all its models are written, by the move of one file,
    so a job that dies half-way leaves the version before it in use. Older versions stay until they are deleted.
    """
    spark = SparkSession.active()
    folder = f"versions/{uuid.uuid4().hex}"
    for name, model in models.items():
        model.write().save(f"{path}/{folder}/{name}")
    last = _saved(spark, path).agg(F.max("version")).first()[0] or 0
    row = spark.createDataFrame([(last + 1, folder, list(models))], _MANIFEST)
    row.coalesce(1).write.mode("append").json(f"{path}/manifest")


def load_models(path: str, *names: str) -> dict[str, PipelineModel]:
    """The named models, or all, of the last whole version that ``save_models`` left."""
    versions = _saved(SparkSession.active(), path).orderBy(F.desc("version"), F.desc("folder"))
    last = versions.first()
    if last is None:
        raise FileNotFoundError(f"no whole version of models below {path}")
    missing = sorted(set(names) - set(last["names"]))
    if missing:
        raise KeyError(f"models not in the last version: {', '.join(missing)}")
    return {name: PipelineModel.load(f"{path}/{last['folder']}/{name}") for name in names or last["names"]}
