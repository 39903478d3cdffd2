"""Toxicity by a weighted finite-state grammar over clauses.

Seven small transducers read a clause: insults and threats carry a weight, reported speech and negation
weaken what follows, a person addressed strengthens it. Two of them read from right to left and mark hits
with somebody addressed after them and those before a closing negation; the other five read the marked
clause from left to right. Each direction is composed once into a single machine; a clause scores the sum of its weights times the factors on its path. Isolated words score nothing by
themselves: only clauses with an insult or a threat are read, and a document is judged by its clauses.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import small_batches, text_or_empty
from reviewlens.session import stored

INSULTS = (
    "idiot moron stupid loser clown trash scum pathetic worthless disgusting imbécile crétin connard idiota imbécil "
    "estúpido estúpida asqueroso dummkopf abschaum trottel arschloch ekelhaft"
).split()
THREATS = "kill hurt destroy beat shoot tuer tuerai frapper détruire töten umbringen schlagen matar mataré golpear".split()
TARGETS = "you your yours yourself toi vous ton votre du dich dir ihr euch tú usted ustedes vosotros".split()
NEGATIONS = "not no never neither nor without cannot nicht kein keine nie ne pas jamais sans nunca jamás sin".split()
REPORTS = "said says wrote quoted called claims reportedly dit écrit déclare sagte schrieb dijo dice escribió".split()

#: A document is toxic from this score on.
REJECT = 0.3
SCOPE = 3
REPORTED, NEGATED, AIMED = 0.5, 0.4, 1.5
CLAUSE = re.compile(r"[.!?;:,\n|()]")
TOKEN = re.compile(r"[^\W\d_]+|[\"«»“”„]")


@dataclass
class Transducer:
    """Arcs ``(state, symbol) -> (state, symbol out, factor)``; a missing arc copies the symbol and stays."""

    arcs: dict = field(default_factory=dict)
    start: object = 0

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, symbol, 1.0))


def compose(first: Transducer, second: Transducer, symbols: set[str]) -> Transducer:
    """The machine that feeds the output of ``first`` to ``second``; factors multiply."""
    arcs, todo, seen = {}, [(first.start, second.start)], set()
    while todo:
        state = todo.pop()
        if state in seen:
            continue
        seen.add(state)
        for symbol in symbols:
            a, middle, f = first.step(state[0], symbol)
            b, out, g = second.step(state[1], middle)
            arcs[state, symbol] = ((a, b), out, f * g)
            todo.append((a, b))
    return Transducer(arcs, (first.start, second.start))


#: Hits with somebody addressed after them, as the pass from the right marks them.
AHEAD = {"insult": "aimed insult", "threat": "aimed threat"}
HITS = (*AHEAD, *AHEAD.values())
SYMBOLS = {"word", "target", "negation", "report", "quote", *HITS}


def reported_speech() -> Transducer:
    """After a verb of saying, or between quotation marks, hits are somebody else's."""
    arcs = {(n, "report"): (2, "word", 1.0) for n in range(2)}
    arcs |= {(0, "quote"): (1, "word", 1.0), (1, "quote"): (0, "word", 1.0), (2, "quote"): (2, "word", 1.0)}
    return Transducer(arcs | {(n, hit): (n, hit, REPORTED) for n in (1, 2) for hit in HITS})


def negation() -> Transducer:
    """A negation weakens hits among the next ``SCOPE`` words."""
    arcs: dict = {(n, "negation"): (SCOPE, "word", 1.0) for n in range(SCOPE + 1)}
    for n in range(1, SCOPE + 1):
        arcs |= {(n, s): (n - 1, s, NEGATED if s in HITS else 1.0) for s in SYMBOLS - {"negation"}}
    return Transducer(arcs)


def target() -> Transducer:
    """Hits weigh more where somebody is addressed in the clause, before them or, as marked, after them."""
    arcs = {(0, "target"): (1, "word", 1.0)} | {(1, hit): (1, hit, AIMED) for hit in HITS}
    return Transducer(arcs | {(0, hit): (0, hit, AIMED) for hit in AHEAD.values()})


def threat() -> Transducer:
    """A threat counts when somebody is addressed before or, as marked, after it; alone it is an ordinary verb."""
    return Transducer({(0, "target"): (1, "target", 1.0), (0, "threat"): (0, "word", 0.0)})


def insult() -> Transducer:
    """Every further insult of a clause weighs a little less."""
    return Transducer({(n, hit): (min(n + 1, 3), "insult", 0.8**n) for n in range(4) for hit in ("insult", AHEAD["insult"])})


def addressed_ahead() -> Transducer:
    """From right to left: marks the hits that somebody addressed follows."""
    return Transducer({(0, "target"): (1, "target", 1.0)} | {(1, hit): (1, mark, 1.0) for hit, mark in AHEAD.items()})


def closing_negation() -> Transducer:
    """From right to left: a negation that ends the clause weakens hits among the ``SCOPE`` words before it."""
    arcs: dict = {(-1, s): (0, s, 1.0) for s in SYMBOLS} | {(-1, "quote"): (-1, "quote", 1.0)}
    arcs[-1, "negation"] = (SCOPE, "word", 1.0)
    for n in range(1, SCOPE + 1):
        arcs |= {(n, s): (n - 1, s, NEGATED if s in HITS else 1.0) for s in SYMBOLS}
    return Transducer(arcs, -1)


def grammar_from_right() -> Transducer:
    return compose(closing_negation(), addressed_ahead(), SYMBOLS)


def grammar() -> Transducer:
    machine = threat()
    for part in (reported_speech(), negation(), target(), insult()):
        machine = compose(machine, part, SYMBOLS)
    return machine


class ClauseScorer:
    """Finds lexicon stems in a text and runs the grammar over the clauses around them."""

    def __init__(self, stems: dict[str, float]):
        self.machine, self.from_right, self.weights = grammar(), grammar_from_right(), {**stems}
        self.kinds = {w: k for k, ws in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS)) for w in ws}
        for word in THREATS:
            self.weights.setdefault(word, 2.0)
        self.longest_kind = max(map(len, self.kinds))
        self.threats = set(THREATS)
        self.search = ahocorasick.Automaton()
        for stem in self.weights:
            self.search.add_word(stem, len(stem))
        self.search.make_automaton()
        self.longest = max(map(len, self.weights))

    def stem_of(self, word: str) -> str | None:
        return next((word[:n] for n in range(min(len(word), self.longest), 0, -1) if word[:n] in self.weights), None)

    def read(self, text: str) -> list[tuple[str, float]]:
        """Symbol and weight of every token."""
        found = []
        for token in TOKEN.findall(text):
            kind, weight = self.kinds.get(token), 0.0
            if kind is None:
                stem = self.stem_of(token)
                if stem is not None:
                    kind, weight = "threat" if stem in self.threats else "insult", self.weights[stem]
                else:
                    kind = "word" if token[0].isalpha() else "quote"
            found.append((kind, weight))
        return found

    def clause(self, text: str, reported: bool = False) -> float:
        """Sum of the weights times their factors; ``reported`` if a verb of saying introduces the clause."""
        marked, state = [], self.from_right.start
        for kind, weight in reversed(self.read(text)):
            state, kind, factor = self.from_right.step(state, kind)
            marked.append((kind, weight * factor))
        state, total = self.machine.start, 0.0
        if reported:
            state, _, _ = self.machine.step(state, "report")
        for kind, weight in reversed(marked):
            state, _, factor = self.machine.step(state, kind)
            total += weight * factor
        return total

    def introduced(self, text: str, start: int) -> bool:
        """Whether the clause that begins at ``start`` follows a verb of saying and a colon or comma."""
        if start == 0 or text[start - 1] not in ":,":
            return False
        end = start - 1
        while end and text[end - 1].isspace():
            end -= 1
        begin = end
        while begin and end - begin <= self.longest_kind and text[begin - 1].isalpha():
            begin -= 1
        return self.kinds.get(text[begin:end]) == "report"

    def features(self, text: str) -> list[float]:
        """Of the matched clauses: log of the summed score, best score, log of their number; all 0 without one."""
        text, scores, end = text.lower(), [], -1
        for last, size in self.search.iter(text):
            begin = last - size + 1
            if begin < end or begin and text[begin - 1].isalpha():
                continue
            found = CLAUSE.search(text, last + 1)
            stop = found.start() if found else len(text)
            start = max((text.rfind(mark, max(end, 0), begin) for mark in ".!?;:,\n|()")) + 1
            start = max(start, end, 0)
            scores.append(self.clause(text[start:stop], self.introduced(text, start)))
            end = stop
        scores = [s for s in scores if s > 0]
        if not scores:
            return [0.0, 0.0, 0.0]
        return [float(np.log1p(sum(scores))), max(scores), float(np.log1p(len(scores)))]


#: Used as they are where the labelled rows hold one class only.
DEFAULT = (-4.0, (1.5, 0.5, 0.5))
MIN_DOCS, MIN_ODDS, STEM = 3, 2.0, (4, 12)


@dataclass
class ToxicityModel:
    stems: dict[str, float]
    intercept: float
    weights: tuple[float, float, float]

    def score(self, text: Column) -> Column:
        """Probability of label 1, 0 to 1; null and empty texts get that of a text without a matched clause."""
        return _probability(self.features(text), self.intercept, self.weights)

    def features(self, text: Column) -> Column:
        stems = self.stems

        @F.arrow_udf("array<double>")
        def of(texts: pa.Array) -> pa.Array:
            scorer = _scorer(stems)
            return pa.array([scorer.features(t.as_py()) for t in texts], pa.list_(pa.float64()))

        return of(text_or_empty(text))


_SCORERS: dict[int, ClauseScorer] = {}


def _scorer(stems: dict[str, float]) -> ClauseScorer:
    key = hash(frozenset(stems.items()))
    if key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[key] = ClauseScorer(stems)
    return _SCORERS[key]


def _probability(features: Column, intercept: float, weights: tuple[float, ...]) -> Column:
    linear = F.lit(intercept)
    for i, w in enumerate(weights):
        linear = linear + F.lit(w) * F.get(features, i)
    return 1 / (1 + F.exp(-linear))


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: in how many toxic and other texts each word beginning occurs."""
    low, high = STEM
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        stems = sorted({s for s, _ in counts})
        out = [stems, [counts[s, 1] for s in stems], [counts[s, 0] for s in stems]]
        counts.clear()
        kinds = (pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["stem", "toxic", "clean"])

    for batch in batches:
        for words, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            stems = {w[:n] for w in words for n in range(min(low, len(w)), min(len(w), high) + 1)}
            counts.update((s, label) for s in stems)
            if len(counts) > 500_000:
                yield flush()
    yield flush()


def _sketch(texts: pa.Array) -> pa.Array:
    """Distinct lower-case words of a text, and the smallest hash of its three-word shingles."""
    keys, words = [], []
    for text in texts.to_pylist():
        found = [w for w in TOKEN.findall(text.lower()) if w.isalpha()]
        grams = [" ".join(found[i : i + 3]) for i in range(max(len(found) - 2, 1))]
        keys.append(min(map(xxhash.xxh3_64_intdigest, grams)) - (1 << 63))
        words.append(sorted(set(found)))
    return pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(words, pa.list_(pa.string()))], ["key", "words"])


def learn_stems(labelled: DataFrame, min_docs: int = MIN_DOCS, min_odds: float = MIN_ODDS) -> dict[str, float]:
    """Word beginnings that mark label 1, with their smoothed log odds, from ``(text, label)``.

    Near copies count once: of texts with the same smallest shingle hash one is read, so a text that was
    copied a thousand times does not make its own words look toxic. A stem must occur with label 1 more often
    than chance explains over all the stems tried: its log likelihood ratio exceeds the log of their number.
    """
    sketch = F.arrow_udf(_sketch, "struct<key: long, words: array<string>>")
    seen = labelled.select(sketch(text_or_empty(F.col("text"))).alias("s"), F.col("label").cast("int").alias("label"))
    seen = seen.select("s.key", "s.words", "label").dropDuplicates(["key"])
    sizes = {r["label"]: r["count"] for r in seen.groupBy("label").count().collect()}
    counts = (
        seen.select("words", "label")
        .mapInArrow(_stem_counts, "stem string, toxic long, clean long")
        .groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    counts = stored(counts, "stems")
    share = sizes.get(1, 0) / max(sum(sizes.values()), 1)
    if not 0 < share < 1:
        return {}
    n = F.col("toxic") + F.col("clean")
    part = lambda o, e: F.when(F.col(o) > 0, F.col(o) * F.log(F.col(o) / e)).otherwise(0.0)
    surprise = part("toxic", n * share) + part("clean", n * (1 - share))
    counts = counts.where((F.col("toxic") >= min_docs) & (surprise > math.log(max(counts.count(), 1))))
    rate = lambda n, all: F.log((F.col(n) + 0.5) / (sizes.get(all, 0) + 1))
    odds = counts.withColumn("odds", rate("toxic", 1) - rate("clean", 0)).where(F.col("odds") >= min_odds)
    found = {r["stem"]: (r["toxic"], r["odds"]) for r in odds.collect()}  # bounded by the labelled sample
    kept: dict[str, float] = {}
    longer = Counter()
    for stem, (toxic, _) in found.items():
        for n in range(1, len(stem)):
            longer[stem[:n]] = max(longer[stem[:n]], toxic)
    for stem, (toxic, score) in sorted(found.items(), key=lambda x: len(x[0])):
        if longer[stem] >= 0.95 * toxic or any(kept.get(stem[:n], -1) >= score for n in range(1, len(stem))):
            continue
        kept[stem] = round(score, 6)
    return kept


def fit_toxicity(labelled: DataFrame) -> ToxicityModel:
    """Learn stems and the weights of the clause features from ``(text, label)`` with label 0 or 1.

    Give it a bounded sample of labelled rows. Three quarters of them, by the hash of the text, give the
    stems and the rest the weights, so stems that fit by chance do not count as evidence. Rows without
    label are left out. With one class or none the built-in lexicon and weights are returned.
    """
    sample = stored(small_batches(labelled).where("label in (0, 1)").select("text", "label"), "labelled")
    stems = {w: 4.0 for w in INSULTS}
    fold = F.pmod(F.xxhash64(text_or_empty(F.col("text")), F.lit("fold")), F.lit(4))
    stems |= learn_stems(sample.where(fold > 0))
    model = ToxicityModel(stems, *DEFAULT)
    rows = sample.where(fold == 0).select(
        array_to_vector(model.features(F.col("text"))).alias("features"), F.col("label").cast("double").alias("label")
    )
    rows = stored(rows, "clauses")
    if rows.select("label").distinct().count() < 2:
        return model
    fit = LogisticRegression(regParam=1e-3, maxIter=100).fit(rows)
    return ToxicityModel(stems, float(fit.intercept), tuple(float(w) for w in fit.coefficients))
