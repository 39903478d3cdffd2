"""Sequence tagger: hashed token features (at most ``num_features`` slots), multinomial regression, label transitions, best path."""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, SQLTransformer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from reviewlens.functions.arrays import let
from reviewlens.functions.bio import feature_names, token_features

NUM_FEATURES = 1 << 18
TOKENS_PER_TASK = 100_000

# The path function travels to the workers by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def feature_rows(tokens: Column) -> Column:
    """``array<array<string>>``: the ``name=value`` features of every token."""
    return F.transform(token_features(tokens), feature_names)


def transition_counts(df: DataFrame, labels: str) -> DataFrame:
    """``(prev, label, n)`` of neighbouring labels; ``prev`` is null at the start of a sentence."""
    pairs = let(
        F.col(labels),
        lambda tags: F.transform(tags, lambda y, i: F.struct(F.get(tags, i - 1).alias("prev"), y.alias("label"))),
    )
    return df.select(F.inline(pairs)).groupBy("prev", "label").agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Tagger:
    """Token classifier and label statistics; ``log_*`` follow the order of ``labels``."""

    emissions: PipelineModel
    labels: list[str]
    log_prior: list[float]
    log_start: list[float]
    log_transition: list[list[float]]

    def save(self, spark: SparkSession, path: str) -> None:
        self.emissions.write().overwrite().save(f"{path}/emissions")
        state = {k: getattr(self, k) for k in ("labels", "log_prior", "log_start", "log_transition")}
        row = spark.createDataFrame([(json.dumps(state),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Tagger:
        state = json.loads(spark.read.text(f"{path}/labels").first()["value"])
        return cls(PipelineModel.load(f"{path}/emissions"), **state)

    def tag(self, df: DataFrame, id_col: str, tokens: str) -> DataFrame:
        return tag_tokens(df, id_col, tokens, self)


def fit_tagger(
    sentences: DataFrame,
    tokens: str = "tokens",
    labels: str = "labels",
    c1: float = 0.1,
    c2: float = 0.1,
    max_iter: int = 100,
    num_features: int = NUM_FEATURES,
    smoothing: float = 1.0,
) -> Tagger:
    """Fit on sentences with parallel arrays of tokens and labels.

    ``c1`` and ``c2`` weigh the absolute and squared weights against the summed loss; MLlib averages
    the loss, so both are divided by the number of tokens.
    """
    rows = sentences.select(
        F.inline(F.arrays_zip(feature_rows(F.col(tokens)).alias("features"), F.col(labels).alias("label")))
    )
    hashing = SQLTransformer(
        statement=f"SELECT *, transform(features, f -> string(pmod(hash(f), {num_features}))) AS slots FROM __THIS__"
    )
    slots = hashing.transform(rows).persist()
    # Slots that no training token uses would get weight 0, so the vectors leave them out.
    used = sorted(r["slot"] for r in slots.select(F.explode("slots").alias("slot")).distinct().collect())
    counting = CountVectorizerModel.from_vocabulary(used or ["0"], inputCol="slots", outputCol="vector", minTF=1.0)
    counting = counting.setBinary(True)
    counts = transition_counts(sentences, labels).collect()
    names = sorted({r["label"] for r in counts})
    pair_n = {(r["prev"], r["label"]): r["n"] for r in counts}
    total = sum(pair_n.values())

    def shares(prev: str | None) -> list[float]:
        row = [pair_n.get((prev, name), 0) + smoothing for name in names]
        return [math.log(x / sum(row)) for x in row]

    prior = [math.log(sum(n for (_, y), n in pair_n.items() if y == name) / total) for name in names]
    indexed = StringIndexerModel.from_labels(names, inputCol="label", outputCol="y").transform(counting.transform(slots))
    ready = indexed.select("vector", "y").coalesce(max(1, total // TOKENS_PER_TASK)).persist()
    try:
        model = LogisticRegression(
            featuresCol="vector",
            labelCol="y",
            family="multinomial",
            regParam=(c1 + 2 * c2) / max(total, 1),
            elasticNetParam=c1 / (c1 + 2 * c2),
            standardization=False,
            maxIter=max_iter,
        ).fit(ready)
    finally:
        ready.unpersist()
        slots.unpersist()
    return Tagger(PipelineModel([hashing, counting, model]), names, prior, shares(None), [shares(name) for name in names])


def best_paths(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best label index per token for sentences stacked in ``scores``, all sentences in step."""
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    offsets, lengths = offsets[order], lengths[order]
    running = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), side="left")
    back = np.zeros(scores.shape, dtype=np.int32)
    best = start + scores[offsets[: running[0]]] if len(running) else scores[:0]
    for t in range(1, len(running)):
        alive = running[t]
        at = offsets[:alive] + t
        options = best[:alive, :, None] + step[None]
        back[at] = options.argmax(axis=1)
        best[:alive] = options.max(axis=1) + scores[at]
    path = np.zeros(len(scores), dtype=np.int64)
    if len(running):
        used = running[0]
        path[offsets[:used] + lengths[:used] - 1] = best.argmax(axis=1)
    for t in range(len(running) - 1, 0, -1):
        at = offsets[: running[t]] + t
        path[at - 1] = back[at, path[at]]
    return path


def path_decoder(tagger: Tagger) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Turn token rows ``(id, pos, token, probs)`` into sentence rows ``(id, tokens, labels)``.

    A sentence begins at position 0 and its rows follow each other; one cut by the end of a batch
    waits for the next. A row without position stands for a sentence without tokens. A path needs all earlier scores and back pointers. Kept as a growing array
    in a native fold they would cost quadratic time on long texts, hence this step on Arrow batches.
    """
    prior, start = np.array(tagger.log_prior), np.array(tagger.log_start)
    step, names = np.array(tagger.log_transition), pa.array(tagger.labels)

    def sentences(rows: pa.Table, begins: np.ndarray) -> pa.RecordBatch:
        ids, places, tokens, probs = (c.combine_chunks() for c in rows.columns)
        real = places.is_valid()
        mask = real.to_numpy(zero_copy_only=False)
        flat = probs.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(names))[mask]
        scores = np.log(np.maximum(flat, 1e-12)) - prior
        before = np.concatenate([[0], np.cumsum(mask)])
        bounds = before[np.append(begins, rows.num_rows)]
        path = best_paths(scores, np.diff(bounds), start, step)
        at, tokens = pa.array(bounds, pa.int32()), tokens.filter(real)
        lists = [pa.ListArray.from_arrays(at, x) for x in (tokens, names.take(pa.array(path)))]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(begins)), *lists], [rows.column_names[0], "tokens", "labels"])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if waiting is None else pa.concat_tables([waiting, rows])
            begins = np.flatnonzero(rows.column(1).fill_null(0).to_numpy() == 0)
            waiting = rows
            if len(begins) > 1:
                yield sentences(rows.slice(0, begins[-1]), begins[:-1])
                waiting = rows.slice(begins[-1])
        if waiting is not None and waiting.num_rows:
            yield sentences(waiting, np.array([0]))

    return decode


def token_probabilities(df: DataFrame, id_col: str, tokens: str, tagger: Tagger) -> DataFrame:
    """``(id, pos, token, probs)`` with the classifier's label probabilities, in the order of ``labels``."""
    parts = F.arrays_zip(F.col(tokens).alias("token"), feature_rows(F.col(tokens)).alias("features"))
    return _probabilities(df.select(id_col, F.posexplode(parts)), id_col, tagger)


def _probabilities(tokens: DataFrame, id_col: str, tagger: Tagger) -> DataFrame:
    features = F.coalesce("col.features", F.array().cast("array<string>")).alias("features")
    rows = tokens.select(id_col, "pos", "col.token", features)
    hashing, counting, model = tagger.emissions.stages
    intercepts = model.interceptVector.toArray()
    if not np.isfinite(intercepts).all():  # MLlib's sign of a single label
        scored = tagger.emissions.transform(rows)
        return scored.select(id_col, "pos", "token", vector_to_array("probability").alias("probs"))
    score = label_shares(np.array(counting.vocabulary, dtype=np.int64), model.coefficientMatrix.toArray(), intercepts)
    slots = F.array_distinct(F.col("slots").cast("array<int>"))
    return hashing.transform(rows).select(id_col, "pos", "token", F.arrow_udf(score, "array<double>")(slots).alias("probs"))


def label_shares(slots: np.ndarray, coefficients: np.ndarray, intercepts: np.ndarray) -> Callable[[pa.Array], pa.Array]:
    """Function on the lists of a token's slots: the label probabilities of the regression. Unknown slots weigh nothing.

    The same as the vectors of the fitted stages would give, without making a vector of each token.
    """
    order, n = np.argsort(slots), len(intercepts)
    known, weights = slots[order], np.hstack([coefficients[:, order], np.zeros((n, 1))])

    def shares(lists: pa.Array) -> pa.Array:
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        at = np.searchsorted(known, flat)
        at = np.where(known[np.minimum(at, len(known) - 1)] == flat, at, len(known))
        token = np.repeat(np.arange(len(sizes)), sizes)
        margins = np.stack([np.bincount(token, w[at], len(sizes)) + b for w, b in zip(weights, intercepts)], axis=1)
        odds = np.exp(margins - margins.max(axis=1, keepdims=True))
        odds /= odds.sum(axis=1, keepdims=True)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * n, pa.int32()), pa.array(odds.ravel()))

    return shares


def tag_tokens(df: DataFrame, id_col: str, tokens: str, tagger: Tagger) -> DataFrame:
    """``(id, tokens, labels)``, one row per text; texts without tokens have empty arrays.

    Nothing is shuffled: the exploded tokens of a text stay together in their task, are scored there
    and gathered again. So it works on streams as well.
    """
    parts = F.arrays_zip(F.col(tokens).alias("token"), feature_rows(F.col(tokens)).alias("features"))
    rows = _probabilities(df.select(id_col, F.posexplode_outer(parts)), id_col, tagger)
    return decode_paths(rows, id_col, tagger)


def decode_paths(rows: DataFrame, id_col: str, tagger: Tagger) -> DataFrame:
    """``(id, tokens, labels)`` from token rows ``(id, pos, token, probs)`` that follow each other."""
    words = ArrayType(StringType())
    schema = StructType([rows.schema[id_col], StructField("tokens", words), StructField("labels", words)])
    return rows.mapInArrow(path_decoder(tagger), schema)
