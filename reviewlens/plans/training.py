"""Train, compare and report models."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.functions.fixed_values import SEED, TEST_FRACTION
from reviewlens.operators import evaluation as ev
from reviewlens.operators.classifier import LEARNERS, fit_classifier, quoted
from reviewlens.operators.features import TfidfStages
from reviewlens.operators.sampling import random_split, stratified_split
from reviewlens.operators.joint_tagger import JointTagger
from reviewlens.operators.tagger import Tagger, fit_tagger
from reviewlens.session import stored
from reviewlens.sources.writers import save_models, write_evaluation


@dataclass(frozen=True)
class Trained:
    """Best model, metric rows and confusion matrix of every candidate, and the best model's wrong test rows."""

    task: str
    best: str
    model: PipelineModel
    report: DataFrame
    matrices: DataFrame
    errors: DataFrame


def candidate_metrics(
    train: DataFrame, test: DataFrame, label: str, text: str, learners: Sequence[str], **fit_options
) -> list[tuple[str, PipelineModel, DataFrame]]:
    """Every learner fitted on the same TF-IDF weights, with its confusion counts on ``test``."""
    tfidf = TfidfStages.fit_text(train, F.col(quoted(text)), fit_options.pop("min_df", 2), fit_options.pop("max_features", 5000))
    found = []
    for learner in learners:
        model = fit_classifier(train, label, learner, text, "predicted", tfidf, **fit_options)
        counts = ev.confusion_counts(model.transform(test), label, "predicted")
        found.append((learner, model, stored(counts, "confusion")))
    return found


def compare(task: str, counts: Mapping[str, DataFrame]) -> tuple[str, DataFrame, DataFrame]:
    """The candidate with the highest macro F1, the first on a tie, and the metric rows and matrices of all."""
    scores = None
    for order, (name, each) in enumerate(counts.items()):
        row = ev.report_metrics(each).select(F.lit(name).alias("candidate"), F.lit(order).alias("candidate_order"), "*")
        scores = row if scores is None else scores.unionByName(row)
    best = ev.best_candidate(scores).first()["candidate"]
    report = matrices = None
    for name, each in counts.items():
        rows = metric_rows(task, name, each).withColumn("is_best", F.lit(name == best))
        cells = ev.confusion_matrix(each).select(F.lit(task).alias("task"), F.lit(name).alias("candidate"), F.lit(name == best).alias("is_best"), "*")
        report = rows if report is None else report.unionByName(rows)
        matrices = cells if matrices is None else matrices.unionByName(cells)
    return best, report, matrices


def metric_rows(task: str, candidate: str, counts: DataFrame) -> DataFrame:
    """The class report, its averages and an ``accuracy`` row."""
    accuracy = ev.report_metrics(counts).select(
        F.lit("accuracy").alias("label"),
        *[F.col("accuracy").alias(c) for c in ("precision", "recall", "f1_score")],
        F.lit(None).cast("long").alias("support"),
    )
    return ev.full_report(counts).unionByName(accuracy).select(
        F.lit(task).alias("task"), F.lit(candidate).alias("candidate"), "*"
    )


def train_and_evaluate(
    df: DataFrame,
    label: str,
    id_col: str,
    task: str,
    text: str = "text",
    preprocess: Column | None = None,
    learners: Sequence[str] = LEARNERS,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    n_errors: int = 5,
    **fit_options,
) -> Trained:
    """Stratified split, every learner, and the one with the highest macro F1.

    ``preprocess`` is applied to the training and test text; leave it out for text that is clean.
    """
    if preprocess is not None:
        df = df.withColumn(text, preprocess)
    # Candidates and metrics read the split many times, so it is written once; nothing stays in memory.
    named = [F.col(quoted(c)) for c in (id_col, text, label)]
    labelled = df.where(F.col(quoted(label)).isNotNull()).select(*named)
    split = stored(stratified_split(labelled, label, fraction, id_col, seed), "split")
    train, test = split.where("NOT is_test"), split.where("is_test")
    found = candidate_metrics(train, test, label, text, learners, **fit_options)
    best, report, matrices = compare(task, {name: counts for name, _, counts in found})
    model = next(m for name, m, _ in found if name == best)
    wrong = ev.error_examples(model.transform(test), label, "predicted", [id_col], n_errors)
    errors = wrong.select(F.lit(task).alias("task"), F.col(quoted(text)).alias("text"), F.col(quoted(label)).alias("actual"), "predicted")
    return Trained(task, best, model, report, matrices, errors)


def train_both(
    reviews: DataFrame, id_col: str, path: str, text: str = "text", targets: Sequence[str] = ("aspect", "sentiment"), **options
) -> dict[str, Trained]:
    """Train every target, and store the winners, their names and the whole evaluation below ``path``."""
    done = {t: train_and_evaluate(reviews, t, id_col, t, text, **options) for t in targets}
    save_models(f"{path}/models", **{t: d.model for t, d in done.items()})
    write_evaluation(
        f"{path}/report",
        *[reduce(DataFrame.unionByName, [getattr(d, part) for d in done.values()]) for part in ("report", "matrices", "errors")],
    )
    return done


@dataclass(frozen=True)
class TrainedTagger:
    tagger: Tagger | JointTagger
    report: DataFrame
    accuracy: DataFrame
    errors: DataFrame


def train_tagger(
    corpus: DataFrame,
    id_col: str,
    fraction: float = TEST_FRACTION,
    seed: int = SEED,
    n_errors: int = 5,
    fit: Callable[..., Tagger | JointTagger] = fit_tagger,
    **fit_options,
) -> TrainedTagger:
    """Split by sentence, fit (``fit_joint_tagger`` trains emissions and transitions as one), and report entity labels without ``O``."""
    split = stored(random_split(stored(corpus, "corpus"), fraction, id_col, seed), "split")
    train, test = split.where("NOT is_test"), split.where("is_test")
    tagger = fit(train, **fit_options)
    predicted = tagger.tag(test, id_col, "tokens").select(id_col, F.col("labels").alias("predicted"))
    tokens = ev.token_pairs(test.join(predicted, id_col), id_col, "tokens", "labels", "predicted")
    tokens = stored(tokens, "tokens")
    counts = ev.confusion_counts(tokens, "actual", "predicted")
    return TrainedTagger(
        tagger,
        ev.full_report(counts, exclude=["O"], micro=True),
        ev.accuracy(counts),
        ev.error_examples(tokens, "actual", "predicted", [id_col, "pos"], n_errors),
    )
