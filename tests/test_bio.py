import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from reviewlens.functions import bio as B, fixed_values as V
from reviewlens.functions.text import split_words
from reviewlens.operators import evaluation as ev
from reviewlens.operators.tagger import Tagger, best_paths, fit_tagger, tag_tokens
from reviewlens.plans.corpora import bio_table, build_bio_corpus
from reviewlens.plans.scoring import tag_reviews
from reviewlens.plans.training import train_tagger
from reviewlens.session import shared_dir
from reviewlens.streaming.scoring import read_arriving, tag_stream


def entities(tokens, labels):
    found, i = [], 0
    while i < len(labels):
        if labels[i].startswith("B-"):
            end = i + 1
            while end < len(labels) and labels[end] == "I-" + labels[i][2:]:
                end += 1
            found.append((" ".join(tokens[i:end]), labels[i][2:], i, end))
            i = end
        else:
            i += 1
    return found


def test_decode_equals_a_scan(spark):
    rng = random.Random(1)
    names = ["O", "B-HOTEL", "I-HOTEL", "B-LOC", "I-LOC"]
    rows = []
    for n in range(300):
        size = rng.randrange(9)
        rows.append((n, [f"w{i}" for i in range(size)], [rng.choice(names) for _ in range(size)]))
    df = spark.createDataFrame(rows, "i int, t array<string>, l array<string>")
    got = {r["i"]: [tuple(e) for e in r["e"]] for r in df.select("i", B.bio_decode(F.col("t"), F.col("l")).alias("e")).collect()}
    assert got == {i: entities(t, l) for i, t, l in rows}


def test_features(spark):
    words = ["Hotel", "ABC", "x1", "123", "É", "iPhone", "A-B", "³"]
    df = spark.createDataFrame([(words,)], "t array<string>")
    rows = df.select(F.inline(B.token_features(F.col("t")))).orderBy("pos").collect()
    for i, (w, r) in enumerate(zip(words, rows)):
        assert (r["lower"], r["suffix"], r["is_upper"], r["is_title"]) == (w.lower(), w[-3:], w.isupper(), w.istitle())
        assert r["prev_lower"] == (words[i - 1].lower() if i else None)
        assert r["next_is_title"] == (words[i + 1].istitle() if i + 1 < len(words) else None)
        assert (r["bos"], r["eos"]) == (i == 0, i == len(words) - 1)
    assert [r["is_digit"] for r in rows[:7]] == [w.isdigit() for w in words[:7]]


def test_keyword_tags_and_last_label(spark):
    df = spark.createDataFrame([(["Kamar", "ac", "x", "ac"], "kamar"), (["kamar"], "zzz")], "t array<string>, a string")
    tagged = df.withColumn("l", B.keyword_bio_tag(F.col("t"), F.col("a"), V.ASPECT_WORDS))
    rows = tagged.select("l", B.token_label_map(F.col("t"), F.col("l")).alias("m")).collect()
    assert rows[0]["l"] == ["B-ASPECT", "I-ASPECT", "O", "B-ASPECT"]
    assert rows[0]["m"] == {"Kamar": "B-ASPECT", "ac": "B-ASPECT", "x": "O"}
    assert rows[1]["l"] == ["O"]


def span_scan(tokens, phrase, place):
    labels, i = [], 0
    while i < len(tokens):
        if phrase and tokens[i : i + len(phrase)] == phrase:
            labels += ["B-HOTEL"] + ["I-HOTEL"] * (len(phrase) - 1)
            i += len(phrase)
        else:
            labels.append("B-LOC" if tokens[i] == place else None)
            i += 1
    return labels


def test_spans_equal_a_scan(spark):
    rng = random.Random(2)
    rows = []
    for n in range(200):
        phrase = [rng.choice("ab") for _ in range(rng.randrange(1, 4))]
        rows.append((n, [rng.choice("abc") for _ in range(rng.randrange(12))], " ".join(phrase), rng.choice("abc")))
    df = spark.createDataFrame(rows, "i int, t array<string>, p string, c string")
    got = {r["i"]: r["s"] for r in df.select("i", B.gazetteer_span_tag(F.col("t"), F.col("p"), F.col("c")).alias("s")).collect()}
    assert got == {i: span_scan(t, p.split(), c) for i, t, p, c in rows}


def test_highlight(spark):
    df = spark.createDataFrame([(["<a>", "Solo", "q"], ["O", "B-LOC", "I-ODD"])], "t array<string>, l array<string>")
    html = df.select(B.highlight(F.col("t"), F.col("l")), B.highlight(F.col("t"), F.col("l"), escape=False)).first()
    assert html[0].startswith("&lt;a&gt; <span style=") and 'title="B-LOC">Solo</span>' in html[0]
    assert V.OTHER_COLOR in html[0] and html[1].startswith("<a> ")


def test_paths_equal_brute_force():
    rng = np.random.default_rng(3)
    lengths = np.array([3, 0, 5, 1, 4])
    scores, start, step = rng.normal(size=(13, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    path, at = best_paths(scores, lengths, start, step), 0
    for n in lengths:
        own = scores[at : at + n]

        def total(p):
            return start[p[0]] + sum(own[i][y] for i, y in enumerate(p)) + sum(step[a][b] for a, b in zip(p, p[1:]))

        if n:
            assert tuple(path[at : at + n]) == max(itertools.product(range(3), repeat=int(n)), key=total)
        at += n
    assert len(best_paths(np.zeros((0, 3)), np.array([], dtype=int), start, step)) == 0


def test_corpus_and_tagger(spark, tmp_path):
    snippets = ["kamar bersih dan ac dingin", "sarapan enak sekali , menu banyak", "lokasi dekat mall", "harga murah banget"]
    aspects = ["kamar", "sarapan", "lokasi", "harga"]
    rows = [(i, f"{snippets[i % 4]} {'ramai ' * (i % 3)}nomor {i}", aspects[i % 4]) for i in range(160)]
    df = spark.createDataFrame(rows, "id long, text string, aspect string")
    corpus = build_bio_corpus(df, "id", n=120).persist()
    assert corpus.count() == 120
    table = bio_table(corpus, "id")
    assert table.where("label = 'B-HOTEL'").count() == 120 and table.where("label = 'B-LOC'").count() == 120
    done = train_tagger(corpus, "id", num_features=1 << 12, max_iter=25)
    assert done.accuracy.first()["accuracy"] > 0.95
    assert {"B-HOTEL", "micro avg"} <= {r["label"] for r in done.report.collect()}

    path = shared_dir(spark, "tagger")
    done.tagger.save(spark, path)
    again = Tagger.load(spark, path)
    texts = spark.createDataFrame([(1, "Saya di Hotel Santika di Semarang , kamar bersih"), (2, "")], "id int, text string")
    first = tag_reviews(texts, "id", done.tagger).collect()
    assert [(r["id"], r["labels"]) for r in first] == [(r["id"], r["labels"]) for r in tag_reviews(texts, "id", again).collect()]
    first.sort()
    assert [(r["id"], r["tokens"], r["highlighted"]) for r in first[1:]] == [(2, [], "")]
    assert ("Hotel Santika", "HOTEL") in [(e["text"], e["type"]) for e in first[0]["entities"]]

    plan = tag_tokens(corpus.select("id", "tokens"), "id", "tokens", again)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, "tokens must not be shuffled"

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    texts.repartition(2).write.parquet(source)
    stream = read_arriving(spark, source, texts.schema)
    tag_stream(stream, "id", again, out, str(tmp_path / "state")).awaitTermination()
    assert sorted(spark.read.parquet(out).collect()) == first
    blanks = spark.createDataFrame([(1, " "), (2, None), (3, ""), (4, "Solo")], "id int, text string")
    assert [(r["id"], len(r["labels"]), r["entities"] is not None) for r in sorted(tag_reviews(blanks, "id", again).collect())] == [
        (1, 0, True), (2, 0, True), (3, 0, True), (4, 1, True),
    ]


def test_sentences_survive_batch_ends(spark):
    rows = [(i, [f"w{j}" for j in range(i % 40)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, tokens array<string>").coalesce(1)
    corpus = df.withColumn("labels", F.transform("tokens", lambda t, j: F.when(j % 2 == 0, "B-X").otherwise("O")))
    tagger = fit_tagger(corpus, num_features=64, max_iter=3)
    whole = sorted(map(tuple, tag_tokens(df, "id", "tokens", tagger).collect()))
    assert [(i, t) for i, t, _ in whole] == rows
    assert all(len(t) == len(y) for _, t, y in whole)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert sorted(map(tuple, tag_tokens(df, "id", "tokens", tagger).collect())) == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_token_errors_pair_the_right_tokens(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["O", "B-X"], ["O", "O"])], "id int, t array<string>, y array<string>, p array<string>")
    pairs = ev.token_pairs(df, "id", "t", "y", "p")
    assert [tuple(r) for r in ev.error_examples(pairs, "actual", "predicted", ["id", "pos"]).collect()] == [(1, 1, "b", "B-X", "O")]


def test_labels_follow_stripped_tokens(spark):
    df = spark.createDataFrame([("di Solo : kamar, ok .kamar:", "kamar ok")], "s string, x string")
    words, snippet = split_words(F.col("s")), split_words(F.col("x"))
    known = B.token_label_map(snippet, B.keyword_bio_tag(snippet, F.lit("kamar"), V.ASPECT_WORDS))
    spans = B.gazetteer_span_tag(words, F.lit("Hotel Z"), F.lit("Solo"))
    assert df.select(B.project_snippet_labels(words, spans, known)).first()[0] == [
        "O", "B-LOC", "O", "B-ASPECT", "O", "B-ASPECT",
    ]
