"""TF-IDF text classifiers on MLlib."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, NaiveBayesModel
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from reviewlens.functions.text import WORD
from reviewlens.operators.features import TfidfStages, class_weights

ROWS_PER_TASK = 20_000
MAX_CLASSES = 10_000
LEARNERS = ("logistic_regression", "naive_bayes")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def terms_stage(text: str, out: str) -> SQLTransformer:
    """Savable stage for the unigrams and bigrams of ``word_terms``; null text gives no terms."""
    words = rf"regexp_extract_all(lower(coalesce({quoted(text)}, '')), '[{WORD}]{{2,}}', 0)".replace("\\", "\\\\")
    w = quoted(f"{out}_w")
    pairs = (
        f"zip_with(slice({w}, 1, greatest(size({w}) - 1, 0)), "
        f"slice({w}, 2, greatest(size({w}) - 1, 0)), (a, b) -> concat_ws(' ', a, b))"
    )
    return SQLTransformer(
        statement=f"SELECT * EXCEPT ({w}), concat({w}, {pairs}) AS {quoted(out)} FROM (SELECT *, {words} AS {w} FROM __THIS__)"
    )


def logistic_regression(n_train: int, c: float = 1.0, max_iter: int = 1000, tol: float = 1e-4) -> LogisticRegression:
    """L2 with inverse strength ``c`` on the sum of losses; MLlib averages them, hence ``1 / (c n)``."""
    return LogisticRegression(
        regParam=1.0 / (c * max(n_train, 1)), elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol
    )


def unsmoothed_priors(model: NaiveBayesModel, counts: list[int]) -> NaiveBayesModel:
    """Predict with the plain class shares as priors.

    MLlib smooths the priors. Its thresholds divide the probabilities, so the ratio of both priors
    takes the smoothing out again.
    """
    total = sum(counts)
    return model.setThresholds([math.exp(pi) / (n / total) for pi, n in zip(model.pi.toArray(), counts)])


def fit_classifier(
    train: DataFrame,
    label: str,
    learner: str = "naive_bayes",
    text: str = "text",
    out: str = "prediction",
    tfidf: TfidfStages | None = None,
    min_df: int = 2,
    max_features: int = 5000,
    max_iter: int = 1000,
    tol: float = 1e-4,
) -> PipelineModel:
    """Fit TF-IDF and one learner on labelled text; the model appends the string column ``out``.

    Rows without a label are left out; a row without text counts as an empty one. Labels are indexed in
    alphabetical order. Only the vocabulary, of at most ``max_features``
    terms, the class counts and the weights come to the driver.
    """
    if learner not in LEARNERS:
        raise ValueError(f"unknown learner: {learner}")
    train = train.where(F.col(label).isNotNull())
    terms = f"{out}_terms"
    tfidf = tfidf or TfidfStages.fit_text(train, F.col(quoted(text)), min_df, max_features)
    features = PipelineModel([terms_stage(text, terms), *tfidf.stages(terms, f"{out}_features")])
    weights = class_weights(train, label).orderBy(quoted(label)).limit(MAX_CLASSES + 1).collect()
    if len(weights) > MAX_CLASSES:
        raise ValueError(f"{len(weights)} classes: their weights and models would not fit one machine")
    labels = [r[label] for r in weights]
    weight_of = F.create_map(*[F.lit(x) for r in weights for x in (r[label], r["weight"])])
    columns = {"featuresCol": f"{out}_features", "rawPredictionCol": f"{out}_raw", "probabilityCol": f"{out}_prob",
               "predictionCol": f"{out}_index"}
    indexed = StringIndexerModel.from_labels(
        [str(x) for x in labels], inputCol=label, outputCol=f"{out}_label"
    ).transform(features.transform(train))
    n_rows = sum(r["n"] for r in weights)
    held = indexed.select(f"{out}_features", f"{out}_label", F.element_at(weight_of, F.col(label)).alias("weight")).persist()
    try:
        if learner == "naive_bayes":  # one pass, in the tasks that make the features
            estimator = NaiveBayes(modelType="multinomial", smoothing=1.0, labelCol=f"{out}_label", **columns)
            model = unsmoothed_priors(estimator.fit(held), [r["n"] for r in weights])
        else:
            # Iterations are jobs over this table: a few rows in many partitions would cost more than they compute.
            # It is made by all tasks first, for the few that iterate would make it alone.
            held.count()
            estimator = logistic_regression(n_rows, max_iter=max_iter, tol=tol)
            estimator.setParams(labelCol=f"{out}_label", weightCol="weight", **columns)
            model = estimator.fit(held.coalesce(max(1, n_rows // ROWS_PER_TASK)))
    finally:
        held.unpersist()
    names = IndexToString(inputCol=f"{out}_index", outputCol=f"{out}_name", labels=[str(x) for x in labels])
    scratch = ", ".join(
        quoted(f"{out}_{s}") for s in ("terms", "features_tf", "features_tfidf", "features", "raw", "prob", "index", "name")
    )
    finish = SQLTransformer(
        statement=f"SELECT * EXCEPT ({scratch}), CASE WHEN {quoted(text)} IS NOT NULL "
        f"THEN {quoted(f'{out}_name')} END AS {quoted(out)} FROM __THIS__"
    )
    return PipelineModel([*features.stages, model, names, finish])


def certificate(train: DataFrame, label: str, model: PipelineModel, out: str = "prediction", c: float = 1.0) -> DataFrame:
    """``(label, n, start, largest)``: whether a fitted logistic regression ended at its optimum.

    The gradient of the penalised loss is computed over all of ``train`` for every class and weight, the intercepts
    included. ``start`` is its largest entry at weights of zero, ``largest`` what is left of it at the fitted weights;
    at the optimum of this convex problem that is zero. One aggregation, over at most classes times features groups.
    """
    train = train.where(F.col(label).isNotNull())
    fitted, names = model.stages[-3], model.stages[-2].getLabels()
    n = {str(r[label]): (r["n"], r["weight"]) for r in class_weights(train, label).limit(MAX_CLASSES).collect()}  # as many as were fitted
    total = sum(rows * weight for rows, weight in n.values())
    penalty = 1.0 / (c * max(sum(rows for rows, _ in n.values()), 1))
    scored = PipelineModel(model.stages[:-2]).transform(train)
    n_classes = len(names)
    weight_of = F.create_map(*[F.lit(x) for name, (_, weight) in n.items() for x in (name, weight)])
    actual = F.col(label).cast("string")
    vector = F.unwrap_udt(f"{out}_features")  # sparse vectors carry the places of their values
    slots = F.coalesce(vector["indices"], F.sequence(F.lit(0), F.size(vector["values"]) - 1))
    cells = F.concat(  # slot -1 is the intercept
        F.array(F.struct(F.lit(-1).alias("slot"), F.lit(1.0).alias("x"))),
        F.arrays_zip(slots.alias("slot"), vector["values"].alias("x")),
    )
    rows = scored.select(
        vector_to_array(F.col(f"{out}_prob")).alias("_p"),
        F.array(*[(actual == name).cast("double") for name in names]).alias("_y"),
        F.element_at(weight_of, actual).alias("_w"),
        F.inline(cells),
    )
    error = lambda p: F.sum(F.col("_w") * F.col("x") * p) / total
    sums = rows.groupBy("slot").agg(
        *[error(F.get("_p", F.lit(k)) - F.get("_y", F.lit(k))).alias(f"g{k}") for k in range(n_classes)],
        *[error(F.lit(1.0 / n_classes) - F.get("_y", F.lit(k))).alias(f"s{k}") for k in range(n_classes)],
    )
    matrix = fitted.coefficientMatrix.toArray()
    if len(matrix) < n_classes:  # two classes share one row of weights, with opposite signs
        matrix = np.vstack([-matrix[0], matrix[0]])
    fields = ", ".join(f"w{k} double" for k in range(n_classes))
    numbers = [(slot, *map(float, column)) for slot, column in enumerate(matrix.T)]
    spark = train.sparkSession
    weights = spark.createDataFrame([(-1, *[0.0] * n_classes), *numbers], f"slot int, {fields}")
    left = weights.join(sums, "slot", "left").agg(
        *[F.max(F.abs(F.coalesce(f"g{k}", F.lit(0.0)) + penalty * F.col(f"w{k}"))).alias(f"g{k}") for k in range(n_classes)],
        *[F.max(F.abs(f"s{k}")).alias(f"s{k}") for k in range(n_classes)],
    )
    per_class = [
        F.struct(F.lit(name).alias("label"), F.lit(n[name][0]).cast("long").alias("n"), F.col(f"s{k}").alias("start"), F.col(f"g{k}").alias("largest"))
        for k, name in enumerate(names)
    ]
    return left.select(F.inline(F.array(*per_class)))
