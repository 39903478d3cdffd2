"""Classification metrics. All of them derive from one small table of counts per label pair.

A null prediction is wrong and is no class; rows whose actual label is null are not evaluated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def confusion_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """``(actual, predicted, n)`` for the pairs that occur."""
    return df.where(F.col(actual).isNotNull()).groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def accuracy(counts: DataFrame) -> DataFrame:
    hits = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0))
    return counts.agg(ratio(hits, F.sum("n")).alias("accuracy"), F.sum("n").alias("rows"))


def ratio(part: Column, whole: Column) -> Column:
    """0 on zero division."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def class_totals(counts: DataFrame) -> DataFrame:
    """Per label, over the union of actual and predicted ones: hits, predicted and support."""
    zero = F.lit(0).cast("long")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(zero)
    as_actual = F.struct(
        F.col("actual").alias("label"), hit.alias("tp"), zero.alias("n_pred"), F.col("n").alias("support")
    )
    as_predicted = F.struct(
        F.col("predicted").alias("label"), zero.alias("tp"), F.col("n").alias("n_pred"), zero.alias("support")
    )
    return (
        counts.select(F.inline(F.array(as_actual, as_predicted)))
        .where("label IS NOT NULL")
        .groupBy("label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "n_pred", "support")])
    )


def _scores(tp: Column, n_pred: Column, support: Column) -> list[Column]:
    return [
        ratio(tp, n_pred).alias("precision"),
        ratio(tp, support).alias("recall"),
        ratio(2 * tp, n_pred + support).alias("f1_score"),
        support.alias("support"),
    ]


def class_report(counts: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """``(label, precision, recall, f1_score, support)``, without the labels in ``exclude``."""
    totals = class_totals(counts)
    if exclude:
        totals = totals.where(~F.col("label").isin(*exclude))
    return totals.select("label", *_scores(F.col("tp"), F.col("n_pred"), F.col("support")))


def averages(counts: DataFrame, exclude: Sequence[str] = (), micro: bool = False) -> DataFrame:
    """Rows ``macro avg`` and ``weighted avg``, with ``micro avg`` on request, shaped like the report."""
    totals = class_totals(counts)
    if exclude:
        totals = totals.where(~F.col("label").isin(*exclude))
    names = ["precision", "recall", "f1_score"]
    scored = totals.select("tp", "n_pred", *_scores(F.col("tp"), F.col("n_pred"), F.col("support")))
    summed = scored.agg(
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in names],
        *[c.alias(f"micro_{n}") for n, c in zip(names, _scores(F.sum("tp"), F.sum("n_pred"), F.sum("support")))],
        F.sum("support").alias("support"),
    )
    kinds = ["macro", "weighted"] + (["micro"] if micro else [])
    rows = [
        F.struct(
            F.lit(f"{kind} avg").alias("label"), *[F.col(f"{kind}_{c}").alias(c) for c in names], F.col("support")
        )
        for kind in kinds
    ]
    return summed.select(F.inline(F.array(*rows)))


def full_report(counts: DataFrame, exclude: Sequence[str] = (), micro: bool = False) -> DataFrame:
    return class_report(counts, exclude).unionByName(averages(counts, exclude, micro))


def confusion_matrix(counts: DataFrame) -> DataFrame:
    """Long matrix over the actual labels, zeros filled in."""
    labels = counts.agg(F.sort_array(F.collect_set("actual")).alias("_labels"))
    cells = labels.select("_labels", F.explode("_labels").alias("actual")).select(
        "actual", F.explode("_labels").alias("predicted")
    )
    return cells.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0).cast("long")).alias("n")
    )


def confusion_matrix_wide(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per actual label, one column per predicted label."""
    known = counts.where(F.col("actual").isin(*labels))
    return known.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("n")).na.fill(0)


def _wrong(actual: Column, predicted: Column) -> Column:
    return actual.isNotNull() & ~actual.eqNullSafe(predicted)


def error_examples(df: DataFrame, actual: str, predicted: str, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first ``n`` wrong rows."""
    return df.where(_wrong(F.col(actual), F.col(predicted))).orderBy(*order_by).limit(n)


def error_count(counts: DataFrame) -> DataFrame:
    wrong = F.when(_wrong(F.col("actual"), F.col("predicted")), F.col("n")).otherwise(F.lit(0))
    return counts.agg(F.sum(wrong).alias("errors"), F.sum("n").alias("rows"))


def token_pairs(df: DataFrame, id_col: str, tokens: str, actual: str, predicted: str) -> DataFrame:
    """One row per token ``(id, pos, token, actual, predicted)`` from three parallel arrays."""
    zipped = F.arrays_zip(
        F.col(tokens).alias("token"), F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    )
    return df.select(id_col, F.posexplode(zipped)).select(
        id_col, "pos", "col.token", "col.actual", "col.predicted"
    )


def report_metrics(counts: DataFrame) -> DataFrame:
    """One row with accuracy and macro F1."""
    f1 = ratio(2 * F.col("tp"), F.col("n_pred") + F.col("support"))
    return class_totals(counts).agg(
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"), F.avg(f1).alias("f1_macro")
    )


def best_candidate(metrics: DataFrame) -> DataFrame:
    """Highest ``f1_macro``; the first candidate on a tie."""
    return metrics.orderBy(F.desc("f1_macro"), "candidate_order").limit(1)
