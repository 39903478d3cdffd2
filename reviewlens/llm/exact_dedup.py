"""Exact duplicates: combined locally, then per salt, then per digest, comparing whole texts each time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import text_or_empty
from reviewlens.operators.joins import salted_lookup
from reviewlens.session import stored

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def combine(rows: DataFrame, first: Sequence[Column], merge: Sequence[Column], salts: int = SALTS) -> DataFrame:
    """One row per text of ``rows`` with ``_digest`` and ``_text``, in three stages.

    The map side of the first grouping merges the copies of a task. Its shuffle deals a digest to
    ``salts`` places by the task it comes from, so a text that fills a third of the table arrives as one
    row per task, spread over all places. The second grouping combines the at most ``salts`` winners of a
    digest. Both group by digest *and* text: equal digests never merge different texts.
    """
    salted = rows.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = salted.groupBy("_digest", "_salt", "_text").agg(*first)
    return winners.repartition("_digest").groupBy("_digest", "_text").agg(*merge)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row; the largest id of equal texts stays.

    Null text counts as empty. Null ids never stay unless the whole group has none (then ``keep_id`` is
    null and all stay); repeated rows with one id and one text are all marked alike. An empty table gives
    an empty result, and other columns are not read.
    """
    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")).withColumn("_digest", digest(F.col("_text")))
    groups = combine(
        rows,
        [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")],
        [F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")],
        salts,
    )
    # Each text was compared in full above. A digest that turned out to have one text now stands for it.
    lean = stored(
        groups.groupBy("_digest").agg(
            F.count("*").alias("_texts"), F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
        ),
        "exact-groups",
    )
    shared = lean.where("_texts > 1").select("_digest")
    marked = salted_lookup(rows.select("doc_id", "_digest", F.sha2("_text", 256).alias("text_sha256")), lean, "_digest", "group_size")
    if not shared.isEmpty():  # different texts with one digest: look these up by their texts
        own = groups.join(shared, "_digest", "left_semi").drop("_digest")
        by_text = (
            rows.join(shared, "_digest", "left_semi").drop("_digest").withColumn("text_sha256", F.sha2("_text", 256))
        )
        marked = marked.where("_texts = 1").unionByName(
            salted_lookup(by_text, own, "_text", "group_size"), allowMissingColumns=True
        )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")
    return marked.select("doc_id", "keep_id", "group_size", kept, "text_sha256")


def distinct_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest=sha256
) -> DataFrame:
    """One whole row of ``docs`` per text: the one with the largest id.

    The rows travel with their texts through the same stages, so nothing is joined back. Of repeated rows
    with one id one stays (the largest by the other columns); a null text stays null and equals an empty one.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    row = F.struct(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").isNull().alias("no_text"),
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
    )
    text = text_or_empty(F.col(f"`{text_col}`"))
    rows = docs.select(text.alias("_text"), row.alias("_row")).withColumn("_digest", digest(F.col("_text")))
    best = combine(rows, [F.max("_row").alias("_row")], [F.max("_row").alias("_row")], salts)
    back = {c: F.col(f"_row.c{i}") for i, c in enumerate(others)} | {
        id_col: F.col("_row.id"),
        text_col: F.when(~F.col("_row.no_text"), F.col("_text")),
    }
    return best.select(*[back[c].alias(c) for c in docs.columns])
