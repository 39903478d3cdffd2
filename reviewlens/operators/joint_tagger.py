"""Sequence tagger trained as one model: emissions and transitions share the likelihood of whole sentences.

The weights maximise the summed log-likelihood less ``c1`` times their absolute and ``c2`` times their squared values.
Every step of the fit is one job: tasks run forward-backward over their own sentences and give the gradient of the slots
they saw, Spark adds these in blocks of slots, and only the sums reach the driver. Sentences never leave their tasks.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from reviewlens.operators.tagger import NUM_FEATURES, TOKENS_PER_TASK, best_paths, feature_rows
from reviewlens.session import discard, stored

HISTORY = 6
#: Sentences with about this many tokens are worked through at once.
TOKENS_AT_ONCE = 100_000
#: Samples of an eighth, a 64th and so on are fitted first, the smallest of them with at least this many tokens.
LEAST_SAMPLE = 250_000
#: Places of a gradient that tasks hand on in one piece.
BLOCK = 1 << 14

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class JointTagger:
    """``weights`` has a row per entry of ``slots``; all follow the order of ``labels``.

    ``largest`` is the largest subgradient a token at the end of the fit, so how far from the optimum it stopped.
    """

    labels: list[str]
    num_features: int
    slots: np.ndarray
    weights: np.ndarray
    start: np.ndarray
    step: np.ndarray
    largest: float = 0.0

    def save(self, spark: SparkSession, path: str) -> None:
        keep = np.flatnonzero(self.weights.any(axis=1))
        state = {"labels": self.labels, "num_features": self.num_features, "start": self.start.tolist(),
                 "step": self.step.tolist(), "largest": self.largest}
        rows = zip(self.slots[keep].tolist(), self.weights[keep].tolist())
        spark.createDataFrame(rows, "slot int, weights array<double>").write.mode("overwrite").parquet(f"{path}/weights")
        row = spark.createDataFrame([(json.dumps(state),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/labels")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> JointTagger:
        state = json.loads(spark.read.text(f"{path}/labels").first()["value"])
        rows = spark.read.parquet(f"{path}/weights").orderBy("slot").collect()
        n = len(state["labels"])
        return cls(
            state["labels"], state["num_features"], np.array([r["slot"] for r in rows], dtype=np.int64),
            np.array([r["weights"] for r in rows]).reshape(-1, n), np.array(state["start"]),
            np.array(state["step"]).reshape(n, n), state["largest"],
        )

    def tag(self, df: DataFrame, id_col: str, tokens: str) -> DataFrame:
        """``(id, tokens, labels)``, one row per text; texts without tokens have empty arrays. No shuffle, streams as well."""
        words = ArrayType(StringType())
        schema = StructType([df.schema[id_col], StructField("tokens", words), StructField("labels", words)])
        known = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
        return df.select(id_col, known.alias("tokens"), slot_rows(known, self.num_features)).mapInArrow(_path_tagger(self), schema)


def slot_rows(tokens: Column, num_features: int) -> Column:
    """``slots``: the hashed features of every token."""
    return F.transform(
        feature_rows(tokens), lambda names: F.transform(names, lambda f: F.pmod(F.hash(f), F.lit(num_features)))
    ).alias("slots")


def in_step(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First token and length of sentences, longest first, and how many have a token at each place."""
    offsets = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    offsets, lengths = offsets[order], lengths[order]
    longest = lengths[0] if len(lengths) else 0
    return offsets, lengths, np.searchsorted(-lengths, -np.arange(longest), side="left")


def expectations(scores: np.ndarray, lengths: np.ndarray, start: np.ndarray, step: np.ndarray):
    """Forward-backward over sentences stacked in ``scores``.

    Returns the summed log of their normalisers, the label probabilities of every token, and the expected
    number of label pairs.
    """
    offsets, lengths, running = in_step(lengths)
    pairs = np.zeros(step.shape)
    if not len(running):
        return 0.0, np.zeros(scores.shape), pairs
    top = step.max()
    moves = np.exp(step - top)
    ahead, behind = scores.copy(), np.zeros(scores.shape)
    ahead[offsets[: running[0]]] += start
    for t in range(1, len(running)):
        at = offsets[: running[t]] + t
        high = ahead[at - 1].max(axis=1, keepdims=True)
        ahead[at] += high + top + np.log(np.exp(ahead[at - 1] - high) @ moves)
    for t in range(len(running) - 1, 0, -1):
        at = offsets[: running[t]] + t
        rest = scores[at] + behind[at]
        high = rest.max(axis=1, keepdims=True)
        behind[at - 1] = high + top + np.log(np.exp(rest - high) @ moves.T)
    used = running[0]
    last = ahead[offsets[:used] + lengths[:used] - 1]
    high = last.max(axis=1)
    norm = high + np.log(np.exp(last - high[:, None]).sum(axis=1))
    of_token = np.zeros((len(scores), 1))
    for t in range(len(running)):
        of_token[offsets[: running[t]] + t, 0] = norm[: running[t]]
    for t in range(1, len(running)):
        at = offsets[: running[t]] + t
        high = ahead[at - 1].max(axis=1, keepdims=True)
        after = np.exp(scores[at] + behind[at] + high + top - of_token[at])
        pairs += moves * (np.exp(ahead[at - 1] - high).T @ after)
    return float(norm.sum()), np.exp(ahead + behind - of_token), pairs


def _row_table(slots: np.ndarray) -> np.ndarray:
    """Row of every slot up to the last known one; the others, and all beyond, have row ``len(slots)``."""
    table = np.full(int(slots[-1]) + 2 if len(slots) else 1, len(slots), dtype=np.int32)
    table[slots] = np.arange(len(slots))
    return table


def _rows_of(slots: pa.ListArray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sentence lengths, features a token, and the weight row of every feature, see ``_row_table``."""
    lengths = slots.value_lengths().to_numpy(zero_copy_only=False)
    tokens = slots.flatten()
    sizes = tokens.value_lengths().to_numpy(zero_copy_only=False)
    flat = tokens.flatten().to_numpy(zero_copy_only=False)
    return lengths.astype(np.int64), sizes.astype(np.int64), table[np.minimum(flat, len(table) - 1)]


def _emissions(rows: np.ndarray, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Summed weights of the features of each token, label by label; the last row of ``weights`` is zero."""
    token = np.repeat(np.arange(len(sizes)), sizes)
    columns = [np.bincount(token, weights=column[rows], minlength=len(sizes)) for column in np.ascontiguousarray(weights.T)]
    return np.stack(columns, axis=1) if columns else np.zeros((len(sizes), 0))


def _pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of sentences with about ``TOKENS_AT_ONCE`` tokens; a longer sentence stands alone."""
    lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
    upto, begin = np.cumsum(lengths), 0
    while begin < len(lengths):
        before = upto[begin - 1] if begin else 0
        end = max(int(np.searchsorted(upto, before + TOKENS_AT_ONCE, side="right")), begin + 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _padded(weights: np.ndarray) -> np.ndarray:
    return np.vstack([weights, np.zeros((1, weights.shape[1]))])


def _path_tagger(tagger: JointTagger) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = pa.array(tagger.labels, pa.string())

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, table = _padded(tagger.weights), _row_table(tagger.slots)
        for batch in batches:
            for piece in _pieces(batch, "slots"):
                lengths, sizes, rows = _rows_of(piece.column("slots"), table)
                path = best_paths(_emissions(rows, sizes, weights), lengths, tagger.start, tagger.step)
                at = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
                labels = pa.ListArray.from_arrays(at, names.take(pa.array(path)))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), labels], [piece.schema.names[0], "tokens", "labels"])

    return tag


def _gradient_of(point, slots: np.ndarray, n: int):
    """Task function: blocks ``(block, value)`` of the gradient of the task's sentences; the last place is their loss."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = point.value
        cells = len(slots) * n
        weights, start, step = _padded(x[:cells].reshape(-1, n)), x[cells : cells + n], x[cells + n :].reshape(n, n)
        table, by_label = _row_table(slots), np.zeros((n, len(slots) + 1))
        total, loss = np.zeros(len(x) + 1), 0.0
        for batch in batches:
            for piece in _pieces(batch, "slots"):
                lengths, sizes, rows = _rows_of(piece.column("slots"), table)
                y = piece.column("y").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                scores = _emissions(rows, sizes, weights)
                norm, probs, pairs = expectations(scores, lengths, start, step)
                first = np.zeros(len(y), dtype=bool)
                first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
                later = np.flatnonzero(~first)
                loss += norm - scores[np.arange(len(y)), y].sum() - start[y[first]].sum() - step[y[later - 1], y[later]].sum()
                np.add.at(pairs, (y[later - 1], y[later]), -1.0)
                probs[np.arange(len(y)), y] -= 1.0
                for k in range(n):
                    by_label[k] += np.bincount(rows, weights=np.repeat(probs[:, k], sizes), minlength=len(slots) + 1)
                total[cells : cells + n] += probs[first].sum(axis=0)
                total[cells + n : -1] += pairs.ravel()
        total[:cells], total[-1] = by_label[:, :-1].T.ravel(), loss
        parts = [(k, total[k * BLOCK : (k + 1) * BLOCK]) for k in range(-(-len(total) // BLOCK))]
        for k, values in parts:
            if values.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([values.tobytes()], pa.binary())], ["block", "value"])

    return add


def _summed(blocks: pa.Table) -> pa.Table:
    """The blocks of one place added."""
    total = sum(np.frombuffer(v.as_buffer(), dtype=np.float64) for v in blocks.column("value"))
    return pa.table({"block": blocks.column("block").slice(0, 1), "value": pa.array([total.tobytes()], pa.binary())})


def prepared(sentences: DataFrame, tokens: str, labels: str, num_features: int, names: list[str]) -> DataFrame:
    """``(slots, y)`` of sentences with tokens; ``y`` are places in ``names``."""
    places = F.transform(F.col(labels), lambda y: F.array_position(F.array(*[F.lit(x) for x in names]), y).cast("int") - 1)
    return sentences.where(F.size(tokens) > 0).select(slot_rows(F.col(tokens), num_features), places.alias("y"))


def loss_and_gradient(ready: DataFrame, point: np.ndarray, slots: np.ndarray, n: int) -> tuple[float, np.ndarray]:
    """Summed negative log-likelihood and its gradient, added over the tasks by one shuffle of blocks."""
    shared = ready.sparkSession.sparkContext.broadcast(point)
    try:
        parts = ready.mapInArrow(_gradient_of(shared, slots, n), "block int, value binary")
        sums = parts.groupBy("block").applyInArrow(_summed, "block int, value binary").toArrow()
    finally:
        shared.destroy()
    total = np.zeros(len(point) + 1)
    for block, value in zip(sums.column("block").to_pylist(), sums.column("value").to_pylist()):
        part = np.frombuffer(value, dtype=np.float64)
        total[block * BLOCK : block * BLOCK + len(part)] = part
    return float(total[-1]), total[:-1]


def subgradient(x: np.ndarray, gradient: np.ndarray, c1: float) -> np.ndarray:
    """The subgradient of least size of a smooth part with ``gradient`` plus ``c1`` times the absolute weights."""
    at_zero = np.sign(gradient) * np.maximum(np.abs(gradient) - c1, 0.0)
    return np.where(x != 0, gradient + c1 * np.sign(x), at_zero)


def _direction(slope: np.ndarray, moved: list[np.ndarray], turned: list[np.ndarray]) -> np.ndarray:
    """Downhill direction from the curvature of the last moves."""
    q, shares = -slope, []
    for s, y in zip(reversed(moved), reversed(turned)):
        shares.append((s @ q) / (s @ y))
        q = q - shares[-1] * y
    if moved:
        q = q * (moved[-1] @ turned[-1]) / (turned[-1] @ turned[-1])
    for s, y, share in zip(moved, turned, reversed(shares)):
        q = q + (share - (y @ q) / (s @ y)) * s
    return np.where(q * slope < 0, q, 0.0)


def minimise(evaluate, x: np.ndarray, c1: float, bar: float, max_iter: int, history: int = HISTORY) -> tuple[np.ndarray, float]:
    """Least ``evaluate(x)[0] + c1 * |x|`` by limited-memory steps that stay in the orthant they start in.

    Ends when no subgradient exceeds ``bar``, after ``max_iter`` steps, or when no step is downhill. Also returns
    the largest subgradient left.
    """
    value, gradient = evaluate(x)
    value += c1 * np.abs(x).sum()
    moved: list[np.ndarray] = []
    turned: list[np.ndarray] = []
    slope = subgradient(x, gradient, c1)
    for _ in range(max_iter):
        if not np.abs(slope).max(initial=0.0) > bar:
            break
        side = np.where(x != 0, np.sign(x), -np.sign(slope))
        way = _direction(slope, moved, turned)
        rate = 1.0 if moved else 1.0 / np.linalg.norm(slope)
        while rate > 1e-12:
            there = x + rate * way
            there = np.where(there * side > 0, there, 0.0) if c1 else there
            new_value, new_gradient = evaluate(there)
            new_value += c1 * np.abs(there).sum()
            if new_value <= value + 1e-4 * (slope @ (there - x)):
                break
            rate /= 2
        else:
            if not moved:
                break
            moved, turned = [], []
            continue
        s, y = there - x, new_gradient - gradient
        if s @ y > 1e-12 * (y @ y):
            moved, turned = [*moved, s][-history:], [*turned, y][-history:]
        x, value, gradient = there, new_value, new_gradient
        slope = subgradient(x, gradient, c1)
    return x, float(np.abs(slope).max(initial=0.0))


def _penalised(ready: DataFrame, slots: np.ndarray, n: int, c2: float, weight: float = 1.0):
    """Loss and gradient with the square penalty; every sentence counts ``weight`` times."""

    def evaluate(x: np.ndarray) -> tuple[float, np.ndarray]:
        loss, gradient = loss_and_gradient(ready, x, slots, n)
        return weight * loss + c2 * (x @ x), weight * gradient + 2 * c2 * x

    return evaluate


def fit_joint_tagger(
    sentences: DataFrame,
    tokens: str = "tokens",
    labels: str = "labels",
    c1: float = 0.1,
    c2: float = 0.1,
    max_iter: int = 100,
    tol: float = 1e-5,
    num_features: int = NUM_FEATURES,
) -> JointTagger:
    """Fit on sentences with parallel arrays of tokens and labels; it ends when no subgradient exceeds ``tol`` a token.

    The driver holds the weights, at most ``num_features`` times the labels, and ``HISTORY`` pairs of such vectors.
    Sentences without tokens say nothing and take no part. One with a null label,
    or not one label a token, is an error, as is a table without tokens.
    """
    known = sentences.select(F.col(tokens).alias("tokens"), F.col(labels).alias("labels"))
    odd = (F.size("tokens") != F.size("labels")) | F.exists("labels", lambda y: y.isNull())
    held = stored(known.where(F.size("tokens") > 0), "sentences")
    bad = held.where(F.coalesce(odd, F.lit(True))).count()
    if bad:
        raise ValueError(f"{bad} sentences do not have one label for each token")
    counts = held.select(F.explode("labels").alias("label")).groupBy("label").count().collect()
    names = sorted(r["label"] for r in counts)
    n, total = len(names), sum(r["count"] for r in counts)
    if not n:
        raise ValueError("no sentence has tokens")
    # Every step is a job over this table: a task should have tokens enough to be worth its gradient, and more tasks than
    # run in a few waves only give more gradients to add.
    tasks = max(1, min(total // TOKENS_PER_TASK, 3 * held.sparkSession.sparkContext.defaultParallelism))
    ready = prepared(held, "tokens", "labels", num_features, names)
    ready = stored(ready.coalesce(tasks), "slots")
    seen = ready.select(F.explode(F.flatten("slots")).alias("slot")).distinct().toArrow()
    slots = np.sort(seen.column("slot").to_numpy()).astype(np.int64)
    x = np.zeros(len(slots) * n + n + n * n)
    # The optimum is unique, so where the steps begin only decides how many passes over all sentences are left.
    shares = [8**k for k in range(1, 20) if total // 8**k >= LEAST_SAMPLE]
    for share in reversed(shares):
        sample = stored(ready.where(F.pmod(F.xxhash64("slots", "y"), F.lit(share)) == 0).coalesce(max(1, min(total // share // TOKENS_PER_TASK, tasks))), "sample")
        x, _ = minimise(_penalised(sample, slots, n, c2, share), x, c1, tol * total, max_iter)
        discard(sample)
    x, largest = minimise(_penalised(ready.coalesce(tasks), slots, n, c2), x, c1, tol * total, max_iter)
    discard(held, ready)
    cells = len(slots) * n
    return JointTagger(
        names, num_features, slots, x[:cells].reshape(-1, n), x[cells : cells + n], x[cells + n :].reshape(n, n),
        largest / total,
    )


def certificate(
    sentences: DataFrame, tagger: JointTagger, c1: float, c2: float, tokens: str = "tokens", labels: str = "labels"
) -> DataFrame:
    """``(label, tokens, expected, largest)`` of a fit on ``sentences``, from one pass over all of them.

    ``expected`` is the number of tokens the model gives a label, ``largest`` the largest subgradient among the label's
    weights, both a token: zero at the optimum, which is unique. Every label of the sentences must be known to the tagger.
    """
    n = len(tagger.labels)
    x = np.concatenate([tagger.weights.ravel(), tagger.start, tagger.step.ravel()])
    ready = prepared(sentences, tokens, labels, tagger.num_features, tagger.labels)
    counts = ready.select(F.explode("y").alias("y")).groupBy("y").agg(F.count("*").alias("tokens"))
    _, gradient = loss_and_gradient(ready, x, tagger.slots, n)
    left = np.abs(subgradient(x, gradient + 2 * c2 * x, c1))
    blocks = np.vstack([left[: -n * n].reshape(-1, n), left[-n * n :].reshape(n, n)])
    drift = gradient[-n * n :].reshape(n, n).sum(axis=0) + gradient[-n * n - n : -n * n]
    rows = list(zip(range(n), tagger.labels, blocks.max(axis=0).tolist(), drift.tolist()))
    sizes = sentences.sparkSession.createDataFrame(rows, "y int, label string, _left double, _drift double")
    total = sum(r["tokens"] for r in counts.collect())
    return counts.join(F.broadcast(sizes), "y").select(
        "label", "tokens", ((F.col("tokens") + F.col("_drift")) / total).alias("expected"), (F.col("_left") / total).alias("largest")
    )
