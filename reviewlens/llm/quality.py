"""Quality classifier by co-training: two views of a document teach each other, then vote.

The text view sees what is written, the metadata view where a page comes from, how long it is, and how it is
laid out. Each labels documents it is sure of for the other one, over a few rounds.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import hash_sample, small_batches, text_or_empty
from reviewlens.session import stored

ROUNDS, SURE, PSEUDO_WEIGHT = 3, 0.95, 0.3
LANGS, SOURCES = 8, 32
LETTERS, UPPER, DIGITS, MARKS = re.compile(r"[^\W\d_]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]"), re.compile(r"\d"), re.compile(r"[#$%&*|!@<>{}=~^_]")


def text_view(text: str) -> list[float]:
    """Shares of letters, capitals, digits and marks, word lengths, and how often words and lines repeat."""
    n, words, lines = max(len(text), 1), text.split(), text.split("\n")
    count, letters = max(len(words), 1), LETTERS.findall(text)
    seen = Counter(words)
    top = seen.most_common(1)[0][1] if seen else 0
    inside = sum(map(len, letters))
    return [
        inside / n, len(UPPER.findall(text)) / max(inside, 1), len(DIGITS.findall(text)) / n, len(MARKS.findall(text)) / n,
        sum(map(len, words)) / count / 10, len(letters) / count, math.log1p(len(words)) / 10, len(seen) / count,
        math.log1p(len(seen)) / 10, top / count, 1 - len(set(lines)) / len(lines), (text.count(".") + text.count(",")) / count,
    ]


def metadata_view(source: str | None, lang: str | None, n_chars: int | None, text: str) -> list[float]:
    """Hashed source and language, stated length, and the layout in lines."""
    one_hot = [0.0] * (SOURCES + LANGS)
    if source is not None:
        one_hot[zlib.crc32(source.encode()) % SOURCES] = 1.0
    if lang is not None:
        one_hot[SOURCES + zlib.crc32(lang.encode()) % LANGS] = 1.0
    sizes = [len(line) for line in text.split("\n")]
    stated = math.log1p(max(n_chars or 0, 0))
    return [
        *one_hot, float(n_chars is None), stated / 10, stated * stated / 100, math.log1p(len(sizes)) / 10,
        math.log1p(sum(sizes) / len(sizes)) / 10, math.log1p(max(sizes)) / 10, math.log1p(min(sizes)) / 10,
    ]


def _views(source: pa.Array, lang: pa.Array, n_chars: pa.Array, text: pa.Array) -> pa.Array:
    rows = list(zip(source.to_pylist(), lang.to_pylist(), n_chars.to_pylist(), text.to_pylist()))
    kind = pa.list_(pa.float64())
    views = [pa.array([text_view(r[3]) for r in rows], kind), pa.array([metadata_view(*r) for r in rows], kind)]
    return pa.StructArray.from_arrays(views, ["text", "meta"])


def views(docs: DataFrame, columns: Sequence[str] = ("source", "lang", "n_chars", "text")) -> Column:
    """``struct<text, meta>`` of feature arrays; nulls count as unknown, a null text as empty."""
    source, lang, n_chars, text = [F.col(f"`{c}`") for c in columns]
    of = F.arrow_udf(_views, "struct<text: array<double>, meta: array<double>>")
    return of(source.cast("string"), lang.cast("string"), n_chars.cast("long"), text_or_empty(text))


@dataclass
class Linear:
    intercept: float
    weights: tuple[float, ...]

    def logit(self, features: Column) -> Column:
        if not self.weights:
            return F.lit(self.intercept)
        products = F.zip_with(features, F.array(*[F.lit(w) for w in self.weights]), lambda x, w: x * w)
        return F.aggregate(products, F.lit(self.intercept), lambda a, x: a + x)


def _fit(rows: DataFrame, regularization: float = 1e-3) -> Linear:
    """Logistic regression of ``label`` on ``x`` with ``weight``; a constant where there is one class or none."""
    found = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("weight").alias("n")).collect()}
    if len(found) < 2:
        return Linear({1.0: 4.0, 0.0: -4.0}.get(next(iter(found), None), 0.0), ())
    data = rows.select(array_to_vector("x").alias("features"), "label", "weight")
    model = LogisticRegression(regParam=regularization, maxIter=60, weightCol="weight").fit(data)
    return Linear(float(model.intercept), tuple(float(w) for w in model.coefficients))


@dataclass
class QualityModel:
    text: Linear
    meta: Linear
    both: Linear

    def score(self, views: Column) -> Column:
        return _sigmoid(self.both.logit(F.array(_bounded(self.text.logit(views["text"])), _bounded(self.meta.logit(views["meta"])))))


def _sigmoid(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def _bounded(logit: Column) -> Column:
    return F.greatest(F.lit(-12.0), F.least(F.lit(12.0), logit))


def co_train(labelled: DataFrame, pool: DataFrame, rounds: int = ROUNDS, sure: float = SURE) -> QualityModel:
    """Train on ``labelled`` (``text`` and ``meta`` features, ``label`` 0 or 1) and an unlabelled ``pool`` of features.

    Three quarters of the labelled rows, by the hash of their features, start both views. In each round a
    view passes on the pool rows it puts at ``sure`` or beyond, unless the other is as sure of the opposite,
    and both are fitted again. The last quarter then weighs the two views, which calibrates them.
    """
    gold = labelled.where("label in (0, 1)").select("text", "meta", F.col("label").cast("double").alias("label"))
    fold = F.pmod(F.xxhash64("text", "meta"), F.lit(4))
    start, rest = gold.where(fold > 0), gold.where(fold == 0)
    rows = lambda df, view: df.select(F.col(view).alias("x"), "label", F.lit(1.0).alias("weight"))
    text, meta = _fit(rows(start, "text")), _fit(rows(start, "meta"))
    bar = math.log(sure / (1 - sure))
    for _ in range(rounds):
        judged = pool.withColumns({"t": text.logit(F.col("text")), "m": meta.logit(F.col("meta"))})
        lent = lambda by, to, view: judged.where((F.abs(F.col(by)) >= bar) & (F.signum(F.col(by)) * F.col(to) > -bar)).select(  # noqa: B023, E731
            F.col(view).alias("x"), (F.col(by) > 0).cast("double").alias("label"), F.lit(PSEUDO_WEIGHT).alias("weight")
        )
        text, meta = (
            _fit(rows(start, "text").unionByName(lent("m", "t", "text"))),
            _fit(rows(start, "meta").unionByName(lent("t", "m", "meta"))),
        )
    pair = F.array(_bounded(text.logit(F.col("text"))), _bounded(meta.logit(F.col("meta"))))
    both = _fit(rest.select(pair.alias("x"), "label", F.lit(1.0).alias("weight")), 1e-2)
    return QualityModel(text, meta, both if both.weights else Linear(0.0, (1.0, 1.0)))


def quality(docs: DataFrame, labels: DataFrame, held_out: Column, max_labelled: int = 20_000) -> DataFrame:
    """``(doc_id, held_out, score, predicted, text_score, meta_score)`` for every row of ``docs``.

    ``labels`` has ``doc_id`` and ``quality``. About ``max_labelled`` labelled rows outside ``held_out`` are used for
    fitting at most, chosen by the hash of the id, and all others there are the unlabelled pool; everything is scored.
    Rows are scored by their own columns, so repeated rows and null ids are no special case.
    """
    rows = small_batches(docs).select("doc_id", held_out.alias("held_out"), views(docs).alias("views"))
    rows = stored(rows, "views")
    ids = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    ids = ids.where(~held_out)
    ids = stored(hash_sample(ids, F.col("doc_id"), max_labelled / max(ids.count(), 1)), "labels")
    free = rows.where("not held_out and doc_id is not null").select("doc_id", "views.text", "views.meta")
    gold = stored(free.join(F.broadcast(ids), "doc_id"), "labelled")
    pool = stored(free.join(F.broadcast(ids), "doc_id", "left_anti"), "pool")
    model = co_train(gold, pool)
    score = model.score(F.col("views"))
    scored = rows.select(
        "doc_id", "held_out", score.alias("score"),
        _sigmoid(model.text.logit(F.col("views.text"))).alias("text_score"), _sigmoid(model.meta.logit(F.col("views.meta"))).alias("meta_score"),
    )
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_score", "meta_score")
