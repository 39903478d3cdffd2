"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word in contracts that speak of whitespace in ASCII only.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_batches(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Rows and bytes of a batch that tasks exchange with Python. The defaults hold ten thousand whole texts, in the JVM and
#: in every Python worker at once.
BATCH_ROWS, BATCH_BYTES = 500, 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the Arrow batches of its session bounded for rows that hold whole texts."""
    conf, rows = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(rows)) <= BATCH_ROWS:
        conf.set(rows, str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def hash_sample(df: DataFrame, key: Column, fraction: float) -> DataFrame:
    """The rows whose hashed ``key`` lies in the first ``fraction`` of the hash range; the same on every run."""
    if fraction >= 1:
        return df
    return df.where(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 40)) < F.lit(int(fraction * (1 << 40))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, wanted: Column, max_rows: int) -> DataFrame:
    """``(text, label)`` of ``docs`` for about ``max_rows`` of the labelled ids at most, chosen by the hash of the id.

    ``wanted`` is a condition on ``doc_id``. Null ids and labels are left out; of several labels for an id
    the largest counts. The sample of ids is broadcast: it is bounded by ``max_rows``, not by the data.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & wanted)
    ids = ids.groupBy("doc_id").agg(F.max(label).alias("label"))
    ids = hash_sample(ids, F.col("doc_id"), max_rows / max(ids.count(), 1))
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", "label")
