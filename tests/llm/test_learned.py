"""Learned operators: held-out accuracy, exact counts, normalization, and the mix against its optimum."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from reviewlens.llm import brown_lm
from reviewlens.llm.common import labelled_sample
from reviewlens.llm.language_id import classify, dictionaries
from reviewlens.llm.mixing import mix, mix_rows
from reviewlens.llm.quality import co_train, quality
from reviewlens.llm.queries import QUERIES
from reviewlens.llm.toxicity import (
    AHEAD, INSULTS, SYMBOLS, ClauseScorer, addressed_ahead, closing_negation, compose, fit_toxicity, grammar,
    grammar_from_right, insult, negation, reported_speech, target, threat,
)


def collected(df):
    return [r.asDict() for r in df.collect()]


SCORER = ClauseScorer({w: 4.0 for w in INSULTS} | {"kill": 3.0})


def total(text):
    return math.expm1(SCORER.features(text)[0])


def test_grammar_scores_clauses():
    plain, aimed = total("what an idiot"), total("you are an idiot")
    assert aimed > plain > total("you are not an idiot") > 0
    assert total("she said you are an idiot") < aimed
    assert total('"you idiot" was shouted') < total("you idiot was shouted")
    assert total("i will kill you") == total("you i will kill") > 0 < total("i will destroy you and your family")
    assert total("what an idiot you are") == total("you are an idiot") > total("an idiot you are not") > 0
    assert total("he said: you are an idiot") == total("he said, you are an idiot") == total("he said you are an idiot") < aimed
    assert total('he said: "you idiot"') < total('he met: "you, idiot"')
    assert total("he met: you are an idiot") == aimed
    long = "some words " * 100_000
    assert total(long + "you idiot " + long) == total("you idiot")
    assert total("they kill time") == 0 < total("i warn you: you kill")
    assert total("not today, idiot") == plain  # a comma ends the scope
    assert total("nothing to see") == total("") == 0 and total("idiotically") > 0 == total("nonidiot")


@pytest.mark.parametrize(
    "parts, whole",
    [((threat, insult), None), ((threat, reported_speech, negation, target, insult), grammar), ((closing_negation, addressed_ahead), grammar_from_right)],
)
def test_composition_runs_the_parts_in_turn(parts, whole):
    draw, machine = random.Random(2), whole() if whole else compose(*(p() for p in parts), SYMBOLS)
    for _ in range(200):
        state, states = machine.start, [p().start for p in parts]
        for symbol in draw.choices(sorted(SYMBOLS), k=10):
            state, composed, factor = machine.step(state, symbol)
            product = 1.0
            for n, part in enumerate(parts):
                states[n], symbol, f = part().step(states[n], symbol)
                product *= f
            assert composed == symbol and factor == pytest.approx(product)
    assert len({s for s, _ in machine.arcs}) < 200


@given(st.lists(st.sampled_from(["you", "idiot", "kill", "not", "said", "time", '"']), max_size=12))
def test_hits_are_marked_by_what_follows(words):
    """Against a reading of the clause by positions: a threat counts if and only if somebody is addressed in it."""
    found = SCORER.read(" ".join(words))
    kinds = [k for k, _ in found]
    state, marked = SCORER.from_right.start, []
    for kind in reversed(kinds):
        state, kind, _ = SCORER.from_right.step(state, kind)
        marked.insert(0, kind)
    for n, kind in enumerate(kinds):
        if kind in AHEAD:
            assert marked[n] == (AHEAD[kind] if "target" in kinds[n + 1 :] else kind)
    only_threats = [w for w in words if w != "idiot"]
    assert (SCORER.clause(" ".join(only_threats)) > 0) == ("kill" in only_threats and "you" in only_threats)


def test_toxicity_learns_words_it_does_not_know(spark, odd, none):
    draw = random.Random(1)
    words = [f"{a}{b}" for a in "bo da fe gu hi".split() for b in "lan mir nes por quin".split()]
    def text(bad):
        found = draw.choices(words, k=60)
        return " ".join(found[:30] + ["zorkel" + draw.choice(["a", "en", ""])] * bad + found[30:])
    rows = [(text(i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    model = fit_toxicity(spark.createDataFrame(rows, "text string, label int"))
    assert any(s.startswith("zork") for s in model.stems)
    new = spark.createDataFrame([(text(i % 2), i % 2) for i in range(60)], "text string, label int")
    out = new.select("label", (model.score(F.col("text")) >= 0.3).cast("int").alias("p")).collect()
    assert sum(r["label"] == r["p"] for r in out) >= 58
    scores = [r[0] for r in odd.select(model.score(F.col("text"))).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)
    assert fit_toxicity(new.limit(0)).stems == {w: 4.0 for w in INSULTS}
    assert none.select(model.score(F.col("text"))).count() == 0


def test_a_much_copied_text_teaches_once(spark):
    rows = [("special terms of one text that was copied very often indeed", 1)] * 200 + [(f"word{i} and some other words", i % 2) for i in range(200)]
    model = fit_toxicity(spark.createDataFrame(rows, "text string, label int"))
    assert not any(s.startswith("special") for s in model.stems)


def test_labelled_sample(spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (3, 0, 0)], "doc_id long, toxic int, label int")
    out = labelled_sample(docs, labels, "toxic", F.col("doc_id") != 99, 100)
    assert sorted(r["label"] for r in out.collect()) == [0, 1]


def test_language(spark, docs, rows, odd, none):
    learned = dictionaries(docs.where(F.col("doc_id") % 3 > 0))
    out = collected(docs.where(F.col("doc_id") % 3 == 0).select("lang", classify(F.col("text"), learned).alias("f")))
    assert sum(r["lang"] == r["f"]["lang"] for r in out) / len(out) > 0.9
    found = collected(odd.select("doc_id", "text", classify(F.col("text"), learned).alias("f")))
    assert all((r["f"]["lang"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) and 0 <= r["f"]["score"] <= 1 for r in found)
    assert none.select(classify(F.col("text"), learned)).count() == 0
    assert dictionaries(none) == {}
    assert collected(odd.select(classify(F.col("text"), {}).alias("f")))[0]["f"]["lang"] == "und"
    tie = dict.fromkeys(("b", "a"), b"the same dictionary of both")
    first = odd.where("doc_id = 5").select(classify(F.col("text"), tie).alias("f")).first()["f"]
    assert (first["lang"], first["reliable"], first["margin"]) == ("a", False, 0.0)


def lm_rows(rows):
    return [{**r, "held_out": zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2} for r in rows]


def test_language_model(spark, sf_dir, rows):
    out = {r["doc_id"]: r for r in collected(QUERIES["op3_brown_lm"](spark, sf_dir))}
    tokens = lambda r: r["text"].encode().lower().split()
    train = [r for r in lm_rows(rows) if not r["held_out"]]
    counts = Counter(w for r in train for w in tokens(r))
    n, v = sum(counts.values()) + len(train), len(counts) + 1
    for r in lm_rows(rows):
        words, got = tokens(r), out[r["doc_id"]]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(train) + 1) / (n + v + 1))
        assert got["held_out"] == r["held_out"] and got["base_score"] == pytest.approx(base, rel=1e-9)
        assert (got["n_tokens"], got["n_known"], got["train_tokens"]) == (len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n)
    held = [o for o in out.values() if o["held_out"]]
    assert sum(o["score"] for o in held) > sum(o["base_score"] for o in held)


def test_language_model_is_a_distribution(spark):
    texts = spark.createDataFrame([("a b a c a b a rare",), ("b a b a other c",)] * 6, "text string")
    model = brown_lm.train(texts)
    words = ["a", "b", "c", "rare", "other"]
    df = spark.createDataFrame([(f"a {w}",) for w in [*words, "never"]] + [("a",)], "text string").select("text", F.col("text").alias("t"))
    scores = {r["t"]: r["score"] for r in collected(brown_lm.score(df, model))}
    # Words after "a", the end after "a": remove what both texts share, the first word and the last transition.
    logs = np.log10(model.transitions)
    cls = lambda w: int(model.classes[model.listed[w.encode()]]) if w.encode() in model.listed else brown_lm.CLASSES + 1 + brown_lm.ending(w.encode())
    start = scores["a"] - logs[cls("a"), 0]
    following = {w: 10 ** (scores[f"a {w}"] - start - logs[cls(w), 0]) for w in [*words, "never"]}
    unseen = set(range(brown_lm.ENDINGS)) - {brown_lm.ending(b"never")}
    other = sum(10 ** logs[cls("a"), brown_lm.CLASSES + 1 + e] / model.ending_mass[e] for e in unseen)
    empty = sum(10 ** logs[cls("a"), c] for c in range(1, brown_lm.CLASSES + 1) if c not in {cls(w) for w in words})
    assert sum(following.values()) + other + empty + 10 ** logs[cls("a"), 0] == pytest.approx(1, abs=1e-6)


def test_seldom_words_of_a_large_corpus_are_clustered(spark):
    common = " ".join(f"w{i % 400}" for i in range(1000))
    texts = [(common,)] * 1200 + [("w1 seldom w2 w3 also w4",)] * 6 + [("w1 once",)]
    model = brown_lm.train(spark.createDataFrame(texts, "text string"))
    assert model.tokens > 1_200_000
    assert all(1 <= model.classes[model.listed[w]] <= brown_lm.CLASSES for w in (b"seldom", b"also", b"w399"))
    assert b"once" not in model.listed


@pytest.mark.parametrize("most", [3, brown_lm.PACKED])
def test_exchange_against_plain_counts(spark, most):
    """Class pairs by hand from the texts; a step by hand for every word of a batch; pieces of any size give the same classes."""
    draw = random.Random(5)
    groups = [[f"{g}{i}".encode() for i in range(40)] for g in "abc"]
    texts = [[draw.choice(groups[(i + j) % 3]) for j in range(1 + draw.randrange(12))] + [b"x"] * (i % 3) for i in range(2000)]
    keys = np.array(sorted(brown_lm.key_of(w) for g in groups for w in g), np.int64)
    start = brown_lm.Clustering(keys, np.array([1 + i % 6 for i in range(len(keys))], np.uint8))
    symbols = brown_lm.symbols_of(keys)
    lines = [[0, *symbols(t), 0] for t in texts]
    pairs = Counter(p for line in lines for p in zip(line, line[1:]))
    table = spark.createDataFrame([(b" ".join(t).decode(),) for t in texts], "text string").repartition(3)
    packed = brown_lm.contexts(table, keys, 20_000_000 // most, most)  # many buckets, or few
    assert (packed.where("part").count() > 0) == (most == 3)

    def by_hand(classes):
        out = np.zeros((brown_lm.TOTAL, brown_lm.TOTAL))
        for (a, b), n in pairs.items():
            out[classes[a], classes[b]] += n
        return out

    table = by_hand(start.of_symbols())
    assert (brown_lm.transition_counts(packed, start.of_symbols()) == table).all()
    after, counts = brown_lm.exchange(packed, start, 1e-3)
    assert (counts == by_hand(after.of_symbols())).all() and brown_lm.likelihood(counts) > brown_lm.likelihood(table)
    first, logs = start.of_symbols().astype(int), np.log(brown_lm.probabilities(table))
    size, want, pays = table.sum(axis=1), {}, lambda m: m * (math.log(max(m, 1)) + math.log(m + brown_lm.PRIOR))
    for w in range(1, len(keys) + 1):
        right, left = ([(p[1 - i], n) for p, n in pairs.items() if p[i] == w] for i in (0, 1))
        n, fits = sum(m for _, m in right), []
        for k in range(1, brown_lm.CLASSES + 1):
            without = size[k] - n * (k == first[w])
            worth = sum(m * (logs[k, first[b]] + math.log(size[k] + brown_lm.PRIOR)) for b, m in right) + sum(m * logs[first[a], k] for a, m in left)
            fits.append(worth - pays(without + n) + pays(without))
        if max(fits) > fits[first[w] - 1] + 1e-9:
            want[w] = 1 + int(np.argmax(fits))
    got = brown_lm.moves(packed, start, table, 0, 1)
    assert {i + 1: int(k) for i, (k, own) in enumerate(zip(got.classes, start.classes)) if k != own} == want


def test_endings_agree_on_both_sides(spark):
    words = [b"", b"a", b"ab", b"abc", "größe".encode(), b"longer word"]
    df = spark.createDataFrame([(bytearray(w),) for w in words], "w binary").select("w", brown_lm.ending_of(F.col("w")).alias("e"))
    assert all(brown_lm.ending(bytes(r["w"])) == r["e"] for r in df.collect())


def test_language_model_on_odd_tables(odd, none):
    model = brown_lm.train(odd.select(F.coalesce("text", F.lit("")).alias("text")))
    out = collected(brown_lm.score(odd, model))
    assert len(out) == odd.count() and all(r["score"] < 0 and r["n_known"] == r["n_tokens"] for r in out)
    assert sorted(r["n_tokens"] for r in out)[:4] == [1, 1, 1, 1]
    assert brown_lm.score(none, model).count() == 0
    untaught = collected(brown_lm.score(odd, brown_lm.train(none.select("text"))))
    assert all(r["train_tokens"] == r["n_known"] == 0 and r["base_score"] == 0 for r in untaught)


def test_quality(spark, docs, odd, none, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality(docs, labels, F.pmod("doc_id", F.lit(5)) == 2).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in out) / len(out) > 0.9
    for df in (odd, none):
        scored = collected(quality(df, labels, F.pmod("doc_id", F.lit(5)) == 2))
        assert len(scored) == df.count() and all(0 <= r["score"] <= 1 for r in scored)


def test_quality_learns_from_every_unlabelled_row(spark, monkeypatch):
    pools = []
    monkeypatch.setattr("reviewlens.llm.quality.co_train", lambda gold, pool: pools.append(pool) or co_train(gold, pool, 0))
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(3).alias("n_chars"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    quality(docs, labels, F.pmod("doc_id", F.lit(10)) == 9)
    assert pools[0].count() == 54_000 - 90


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    left = share * sum(sizes.values())
    while open_:
        full = {s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) >= cap * sizes[s]}
        if not full:
            target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            break
        target |= {s: cap * sizes[s] for s in full}
        left -= sum(cap * sizes[s] for s in full)
        open_ -= full
    return target


def check_mix(df, near):
    out, source = collected(mix(df)), {r["doc_id"]: r["source"] for r in df.select("doc_id", "source").collect()}
    sizes, taken, first = defaultdict(int), defaultdict(int), {}
    for r in out:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        first[s] = (r["source_size"], r["target"])
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    far = Counter(source[r["doc_id"]] for r in out if abs(r["copies"] - r["rate"]) >= 1)
    assert all(n <= 2 for n in far.values())
    wanted = targets_by_hand(sizes)
    for s in sizes:
        assert first[s] == (sizes[s], pytest.approx(wanted[s])) and abs(taken[s] - wanted[s]) <= near * max(wanted[s], 1)
    return out


def test_mix(docs):
    out = check_mix(docs, 0.02)
    again = collected(mix(docs.repartition(7)))
    key = lambda r: (r["doc_id"], r["copies"])
    assert sorted(map(key, out)) == sorted(map(key, again))
    rates = defaultdict(set)
    for r in out:  # within a source the rate is one exponential of the size, cut at the cap
        rates[r["source_size"], r["target"]].add((r["size"], r["rate"]))
    for pairs in rates.values():
        slopes = [math.log(rate) / size for size, rate in pairs if size and rate < 2]
        assert not slopes or max(slopes) - min(slopes) < 1e-4


def test_mix_of_one_hot_source_in_many_buckets(spark):
    rows = [(i, "w " * (1 + (i * 7919) % 97), "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(df, 0.01)
    small = collected(mix(df, bucket_rows=50))
    assert len(small) == 3000 and sum(abs(r["copies"] - r["rate"]) > 1 for r in small) <= 2 * 66


def test_mix_of_odd_tables(odd, none):
    out = collected(mix(odd))
    assert len(out) == odd.count() and all(r["copies"] == 1 and r["taken"] == 0 for r in out if r["size"] == 0)
    rows = mix_rows(odd)
    assert rows.columns == [c for c in odd.columns if c != "copies"] + ["copies"] and rows.count() == odd.count()
    assert mix(none).count() == mix_rows(none).count() == 0
