import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlens.operators import joint_tagger as J
from reviewlens.plans.scoring import tag_reviews
from reviewlens.plans.training import train_tagger
from reviewlens.session import shared_dir


def all_paths(scores, lengths, start, step):
    """Normalisers, token probabilities and pair counts from every path of every sentence."""
    n, at, norm = scores.shape[1], 0, 0.0
    probs, pairs = np.zeros(scores.shape), np.zeros(step.shape)
    for length in lengths:
        if not length:
            continue
        own, weights = scores[at : at + length], {}
        for p in itertools.product(range(n), repeat=int(length)):
            weights[p] = start[p[0]] + sum(own[i][y] for i, y in enumerate(p)) + sum(step[a][b] for a, b in zip(p, p[1:]))
        total = np.logaddexp.reduce(list(weights.values()))
        norm += total
        for p, w in weights.items():
            share = np.exp(w - total)
            probs[at + np.arange(length), list(p)] += share
            for a, b in zip(p, p[1:]):
                pairs[a, b] += share
        at += length
    return norm, probs, pairs


def test_expectations_equal_all_paths():
    rng = np.random.default_rng(5)
    lengths = np.array([3, 0, 5, 1, 4])
    scores, start, step = rng.normal(size=(13, 3)) * 3, rng.normal(size=3), rng.normal(size=(3, 3)) * 2
    for got, want in zip(J.expectations(scores, lengths, start, step), all_paths(scores, lengths, start, step)):
        assert np.allclose(got, want)
    nothing = J.expectations(np.zeros((0, 3)), np.array([], dtype=int), start, step)
    assert nothing[0] == 0 and not nothing[2].any()


@pytest.fixture(scope="module")
def corpus(spark):
    """The label depends on the word and on the label before it, so neither emissions nor transitions suffice."""
    rng, rows = np.random.default_rng(1), []
    for i in range(120):
        words, tags, inside = [], [], False
        for _ in range(int(rng.integers(1, 7))):
            word = str(rng.choice(["hotel", "Solo", "kamar", "ok"]))
            tags.append("B-X" if word == "hotel" else "I-X" if inside and word == "Solo" else "O")
            inside = tags[-1] != "O"
            words.append(word)
        rows.append((i, words, tags))
    return spark.createDataFrame(rows, "id long, tokens array<string>, labels array<string>").repartition(3).persist()


def test_gradient_equals_enumeration(spark, corpus, monkeypatch):
    monkeypatch.setattr(J, "TOKENS_AT_ONCE", 5)
    names = ["B-X", "I-X", "O"]
    few = corpus.where("id < 12 AND size(tokens) < 6")
    ready = J.prepared(few, "tokens", "labels", 64, names)
    rows = ready.collect()
    slots = np.unique([s for r in rows for token in r["slots"] for s in token])
    cells, rng = len(slots) * 3, np.random.default_rng(2)
    x = rng.normal(size=cells + 3 + 9)
    place = {s: i for i, s in enumerate(slots)}

    def loss(v):
        weights, start, step, total = v[:cells].reshape(-1, 3), v[cells : cells + 3], v[cells + 3 :].reshape(3, 3), 0.0
        for r in rows:
            scores = np.array([sum(weights[place[s]] for s in token) for token in r["slots"]])
            y = r["y"]
            own = start[y[0]] + sum(scores[i][k] for i, k in enumerate(y)) + sum(step[a][b] for a, b in zip(y, y[1:]))
            total += all_paths(scores, [len(y)], start, step)[0] - own
        return total

    value, gradient = J.loss_and_gradient(ready, x, slots, 3)
    assert value == pytest.approx(loss(x))
    for i in [*rng.choice(cells, 12, replace=False), *range(cells, len(x))]:
        bump = np.zeros(len(x))
        bump[i] = 1e-5
        assert gradient[i] == pytest.approx((loss(x + bump) - loss(x - bump)) / 2e-5, abs=1e-4)


@pytest.mark.parametrize("c1", [0.0, 0.7])
def test_minimise_finds_the_known_optimum(c1):
    scale, goal = np.array([1.0, 40.0, 3.0, 0.5]), np.array([2.0, -1.0, 0.1, 0.0])
    x, left = J.minimise(lambda v: (0.5 * scale @ (v - goal) ** 2, scale * (v - goal)), np.zeros(4), c1, 1e-9, 200)
    assert np.allclose(x, np.sign(goal) * np.maximum(np.abs(goal) - c1 / scale, 0)) and left <= 1e-9


def test_fit_is_optimal_and_learns_order(spark, corpus):
    tagger = J.fit_joint_tagger(corpus, c1=0.05, c2=0.05, num_features=1 << 10, max_iter=200)
    assert tagger.largest <= 1e-5
    rows = J.certificate(corpus, tagger, 0.05, 0.05).collect()
    truth = {r["label"]: r["count"] for r in corpus.select(F.explode("labels").alias("label")).groupBy("label").count().collect()}
    assert {r["label"]: r["tokens"] for r in rows} == truth
    assert all(r["largest"] <= 2e-5 for r in rows) and sum(r["expected"] for r in rows) == pytest.approx(1)
    found = {r["id"]: r["labels"] for r in tagger.tag(corpus.select("id", "tokens"), "id", "tokens").collect()}
    assert found == {r["id"]: r["labels"] for r in corpus.collect()}
    plan = tagger.tag(corpus.select("id", "tokens"), "id", "tokens")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_samples_save_passes_over_all_sentences(spark, corpus, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 7)
    whole, passes = corpus.count(), []

    def counted(ready, *rest, real=J.loss_and_gradient):
        passes.append(ready.count())
        return real(ready, *rest)

    monkeypatch.setattr(J, "loss_and_gradient", counted)
    taggers, counts = [], []
    for least in (1 << 30, 50):
        monkeypatch.setattr(J, "LEAST_SAMPLE", least, raising=False)
        passes.clear()
        taggers.append(J.fit_joint_tagger(corpus, c1=0.05, c2=0.05, num_features=1 << 10, max_iter=200, tol=1e-3))
        counts.append(sum(n == whole for n in passes))
    assert len(passes) > counts[1] and counts[1] < counts[0]
    assert all(t.largest <= 1e-3 for t in taggers)
    found = [{r["id"]: r["labels"] for r in t.tag(corpus.select("id", "tokens"), "id", "tokens").collect()} for t in taggers]
    assert found[0] == found[1]


def test_storage_report_and_blank_texts(spark, corpus):
    done = train_tagger(corpus, "id", fit=J.fit_joint_tagger, num_features=1 << 10, max_iter=60)
    assert done.accuracy.first()["accuracy"] > 0.9
    path = shared_dir(spark, "joint")
    done.tagger.save(spark, path)
    again = J.JointTagger.load(spark, path)
    texts = spark.createDataFrame([(1, "hotel Solo kamar zzz"), (2, " "), (3, None)], "id int, text string")
    first = sorted((r["id"], r["tokens"], r["labels"]) for r in tag_reviews(texts, "id", again).collect())
    assert first == sorted((r["id"], r["tokens"], r["labels"]) for r in tag_reviews(texts, "id", done.tagger).collect())
    assert [len(labels) for _, _, labels in first] == [4, 0, 0]


def test_odd_sentences_and_empty_tables(spark):
    schema = "id long, tokens array<string>, labels array<string>"
    for row in [(1, ["a", "b"], ["O"]), (1, ["a"], [None]), (1, ["a"], None)]:
        with pytest.raises(ValueError, match="1 sentences"):
            J.fit_joint_tagger(spark.createDataFrame([row], schema))
    with pytest.raises(ValueError, match="no sentence"):
        J.fit_joint_tagger(spark.createDataFrame([(1, [], []), (2, None, None)], schema))
