"""Steps whose time, shuffle or memory must not grow faster than the tables."""

import gzip
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlens.catalog import evaluation, models
from reviewlens.operators import classifier, features, joins, similarity, tagger
from reviewlens.session import stored
from reviewlens.sources import readers as R, writers as W


def exchanged(spark, df):
    """Output columns of every exchange of ``df``, broadcasts left out."""
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [part.splitlines()[1] for part in plan.split("\n(") if ") Exchange" in part]


def small_tables(spark, base, folders):
    """Documents, labels and conversations; as folders of several files, or as one file each."""
    draw = random.Random(3)
    words = {lang: [f"{lang}{k}" for k in range(12)] for lang in ("en", "de")}
    docs = [(i, " ".join(draw.choices(words[lang], k=8)), lang) for i in range(40) for lang in [("en", "de")[i % 2]]]
    turns = [(i, t, "user", " ".join(draw.choices(words["en"], k=5))) for i in range(6) for t in range(3)]
    tables = {
        "documents": spark.createDataFrame(docs, "doc_id long, text string, lang string"),
        "labels": spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(40)], "doc_id long, quality int, toxic int"),
        "conversations": spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"),
    }
    for name, rows in tables.items():
        path = base / f"{name}.parquet"
        rows.repartition(3 if folders else 1).write.parquet(str(path if folders else base / name))
        if not folders:
            next((base / name).glob("part-*.parquet")).rename(path)
    return str(base)


@pytest.mark.parametrize("folders", [True, False])
def test_stream_score_reads_folders_and_files(spark, tmp_path, folders):
    base = small_tables(spark, tmp_path, folders)
    columns = ["turn_id", "clean_text", "predicted_aspect", "predicted_sentiment"]
    streamed, batch = (sorted(q(spark, base).select(*columns).collect()) for q in (models.stream_score, models.joint_score))
    assert len(streamed) == 18 and streamed == batch


def test_candidates_are_counted_once(spark, tmp_path):
    base = small_tables(spark, tmp_path, True)
    counts = evaluation._candidates(spark, base)
    assert not any("documents.parquet" in f for c in counts.values() for f in c.inputFiles())
    assert {name: sum(r["n"] for r in c.collect()) for name, c in counts.items()} == {"never": 40, "keywords": 40}


@pytest.mark.parametrize("max_rows", [0, 10_000])
def test_cosine_join_does_not_shuffle_beside_a_small_side(spark, max_rows):
    draw = random.Random(5)
    texts = [(i, draw.choices(["a", "b", "c", None, "e", "f"], k=draw.randint(0, 9))) for i in range(60)] + [(60, None), (None, ["a"])]
    df = spark.createDataFrame(texts, "id long, w array<string>")
    got = similarity.cosine_join(df, df.withColumnRenamed("id", "other"), 0.7, "id", "other", "w", "w", max_rows=max_rows)
    want = {}
    for i, a in texts:
        for j, b in texts:
            x, y = (Counter(w for w in words or [] if w) for words in (a, b))
            if None not in (i, j) and x and y:
                cosine = sum(x[w] * y[w] for w in x) / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5
                want |= {(i, j): cosine} if cosine >= 0.7 - similarity.ROUNDING else {}
    found = {(r["id"], r["other"]): r["cosine"] for r in got.collect()}
    assert set(found) == set(want) and len(want) > 60 and all(abs(found[p] - want[p]) < 1e-9 for p in want)
    assert max_rows == 0 or not exchanged(spark, got)


def test_small_pieces_of_the_cosine_join(spark, monkeypatch):
    for name in ("PAIRS_AT_ONCE", "PRODUCTS_AT_ONCE", "WORDS_AT_ONCE"):
        monkeypatch.setattr(similarity, name, 7)
    texts = [(i, [f"w{(i + k) % 11}" for k in range(i % 6)]) for i in range(40)]
    df = spark.createDataFrame(texts, "id long, w array<string>")
    got, rare = (
        {(r["id"], r["o"]): round(r["cosine"], 9) for r in similarity.cosine_join(df, df.withColumnRenamed("id", "o"), 0.5, "id", "o", "w", "w", max_rows=n).collect()}
        for n in (100, 0)
    )
    assert got == rare and len(got) > 40


def test_token_lines_are_not_shuffled_to_number_sentences(spark, tmp_path):
    rows = [(i % 3, [f"t{i}_{k}" for k in range(i % 9)], ["O"] * (i % 9)) for i in range(300)]
    W.write_bio_sentences(spark.createDataFrame(rows, "doc_id long, tokens array<string>, labels array<string>"), str(tmp_path / "bio"))
    read = R.read_bio_sentences(spark, str(tmp_path / "bio"))
    assert not any("token" in line or "value" in line for line in exchanged(spark, read))
    assert sorted(r["token"] for r in read.collect()) == sorted(t for _, ts, _ in rows for t in ts)


def test_token_lines_are_taken_apart_in_columns(spark, tmp_path):
    """No line is stripped or split one by one by the engine; spaces of any kind and bytes that are no text are as before."""
    lines = ["sentence_id\ttoken\tlabel", "\u30001\ta b\tO\u00a0", "1\tc\tB-X\t", "1\ttoo\tmany\tfields", " \u2003", "", "2\t\tO", "sentence_id2\tx\tO", "y\tsentence_id\tO"]
    (tmp_path / "a.tsv").write_bytes("\n".join(lines).encode())
    (tmp_path / "b.tsv").write_bytes(b"1\tx\xff\tO\n \n 1\ty\tO ")
    read = R.read_bio_sentences(spark, str(tmp_path))
    plan = read._sc._jvm.PythonSQLUtils.explainString(read._jdf.queryExecution(), "simple")
    assert "split(" not in plan and "trim(" not in plan.lower()
    rows = read.select("doc_id", "pos", F.hex(F.col("token").cast("binary")).alias("t"), "label").collect()
    want = [(0, 0, "a b"), (0, 1, "c"), (2, 0, ""), (2, 1, "x"), (2, 2, "sentence_id"), (3, 0, None), (4, 0, "y")]
    assert [(r["doc_id"], r["pos"], r["t"]) for r in sorted(rows)] == [(d, p, "78FF" if t is None else t.encode().hex().upper()) for d, p, t in want]
    assert sorted(r["label"] for r in rows) == ["B-X", "O", "O", "O", "O", "O", "O"]


def test_token_files_shuffle_packed_runs(spark, tmp_path):
    odd = [(None, 0, "n", "O"), (7, 3, None, "O"), (7, 0, "a\x1fb", "O"), (7, 1, "x", None), (8, None, "z", "O"), (9, 1, "twice", "O"), (9, 1, "twice", "O")]
    rows = [(d, p, f"t{d}_{p}", "O") for d in range(20, 60) for p in range(d % 7)] + odd
    table = spark.createDataFrame(rows, "doc_id long, pos int, token string, label string")
    for name, source in (("whole", table.coalesce(1)), ("torn", table.repartition(5, F.rand(1)))):
        path = str(tmp_path / name)
        found = R.ordered_rows(source)
        assert "tokens#" in exchanged(spark, found)[-1] or "tokens#" in exchanged(spark, found)[0]
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, rows))
        W.write_bio_tsv(source.where("doc_id >= 20"), path, compression="gzip")
        files = [[line.split("\t") for line in gzip.open(f, "rt").read().splitlines()[1:]] for f in sorted((tmp_path / name).glob("*.gz"))]
        lines = [(int(d), int(p)) for lines in files for d, p, *_ in lines]
        assert lines == sorted((d, p) for d, p, *_ in rows if d and d >= 20)
        assert sorted(map(tuple, R.read_bio_tsv(spark, path).collect())) == sorted(r for r in rows if r[0] and r[0] >= 20)


def test_sentences_are_gathered_before_the_shuffle(spark):
    rows = spark.range(0, 4000, 1, 2).select(
        F.when(F.col("id") >= 100, F.floor(F.col("id") / 100)).alias("doc_id"), (F.col("id") % 100).cast("int").alias("pos"),
        F.concat(F.lit("t"), "id").alias("token"), F.when(F.col("id") % 7 > 0, "O").alias("label"),
    )
    whole, torn = R.sentences(rows), R.sentences(rows.repartition(5, F.rand(1)))
    want = {None if d == 0 else d: [(p, f"t{100 * d + p}", "O" if (100 * d + p) % 7 else None) for p in range(100)] for d in range(40)}
    for found in (whole, torn):
        assert {r["doc_id"]: [tuple(t) for t in r["sentence"]] for r in found.collect()} == want
    assert whole.schema["sentence"].dataType.elementType.names == ["pos", "token", "label"]
    plan = whole._sc._jvm.PythonSQLUtils.explainString(whole._jdf.queryExecution(), "simple")
    assert plan.index("Exchange hashpartitioning") < plan.index("MapInArrow")


@pytest.mark.parametrize("learner", ["naive_bayes", "logistic_regression"])
def test_features_are_made_by_all_tasks(spark, monkeypatch, learner):
    seen = []

    def spy(cls):
        fit = cls.fit

        def watched(self, rows, *args):
            seen.append((rows.rdd.getNumPartitions(), rows.storageLevel.useMemory))
            return fit(self, rows, *args)

        monkeypatch.setattr(cls, "fit", watched)

    spy(classifier.NaiveBayes if learner == "naive_bayes" else classifier.LogisticRegression)
    counted = []
    monkeypatch.setattr(classifier, "logistic_regression", lambda *a, **k: counted.append(1) or classifier.LogisticRegression(maxIter=5))
    rows = spark.range(0, 60, 1, 6).select(
        F.concat(F.lit("word"), F.col("id") % 5, F.lit(" other"), F.col("id") % 3).alias("text"), (F.col("id") % 2).cast("string").alias("label")
    )
    tfidf = features.TfidfStages(["word1", "word2", "other1"], [1.0, 1.0, 1.0])
    model = classifier.fit_classifier(rows, "label", learner, tfidf=tfidf)
    assert model.transform(rows).count() == 60
    assert seen == ([(6, True)] if learner == "naive_bayes" else [(1, False)])


def test_only_known_words_are_paired(spark):
    df = spark.createDataFrame([(["a", "b", "c", "a", "b"],), (["a"],), ([],), (None,)], "w array<string>")
    got = [r[0] for r in df.select(features._known_pairs(F.col("w"), ["a", "b"])).collect()]
    assert got == [["a b", "a b"], [], [], None]


def counting(spark, kind):
    """A function for a column that passes values on, and the number of rows it has seen."""
    seen = spark.sparkContext.accumulator(0)

    def passed(x):
        seen.add(1)
        return x

    return F.udf(passed, kind), seen


def test_lookup_join_counts_costly_rows_once(spark):
    watch, seen = counting(spark, "string")
    rows = spark.range(30).select("id", watch((F.col("id") % 4).cast("string")).alias("k"))
    table = spark.createDataFrame([(str(k), k) for k in range(3)], "k string, v int")
    got = joins.lookup_join(rows, table, ["k"], ["id"], max_rows=0)
    assert seen.value == 30
    assert sorted((r["id"], r["v"]) for r in got.where("v is not null").collect()) == [(i, i % 4) for i in range(30) if i % 4 < 3]


@pytest.mark.parametrize("preview", [False, True])
def test_weights_of_all_words_read_the_texts_once(spark, preview):
    watch, seen = counting(spark, "array<string>")
    texts = spark.createDataFrame([(i, ["a", f"w{i}", "a"] if i else []) for i in range(9)], "id long, w array<string>")
    idf = stored(features.with_idf(features.vocabulary(texts, F.col("w"), 1, None), 9), "idf")
    if preview:
        got = features.tfidf_preview(texts, "id", watch("w"), idf, {"a": "a"}, max_rows=0)
    else:
        got = features.tfidf_long(texts, "id", watch("w"), idf, max_rows=0)
    rows = got.collect()
    assert seen.value == 9 and len(rows) == (9 if preview else 16)


def test_typos_of_a_middling_vocabulary_move_no_keys(spark):
    known = spark.createDataFrame([(f"{k:05d}word", k) for k in range(4000)], "word string, rank int")
    words = spark.createDataFrame([("00007wird",), ("zzz",)], "word string")
    got = similarity.correct_words(words, known, 1)
    assert not any("_key" in columns for columns in exchanged(spark, got))
    assert {r["word"]: (r["corrected"], r["distance"]) for r in got.collect()} == {"00007wird": ("00007word", 1), "zzz": ("zzz", None)}


def test_small_dictionaries_move_no_texts(spark):
    texts = [(1, ["a", None, "c", "a"]), (2, []), (3, None), (1, ["c"]), (None, ["a"])]
    df = spark.createDataFrame(texts, "id long, w array<string>")
    table = spark.createDataFrame([("a", "z"), ("a", "b"), (None, "n"), ("q", "r")], "word string, replacement string")
    got = joins.replace_words(df, "id", "w", table, "o")
    assert not exchanged(spark, got)
    want = [(1, ["b", "n", "c", "b"]), (2, []), (3, None), (1, ["c"]), (None, ["a"])]
    assert sorted(map(str, ((r["id"], r["o"]) for r in got.collect()))) == sorted(map(str, want))
    none = joins.replace_words(df, "id", "w", table.limit(0), "o")
    assert [r["o"] for r in none.collect()] == [w for _, w in texts]


@pytest.mark.parametrize("with_pos", [True, False])
def test_token_lines_are_taken_apart_once(spark, tmp_path, with_pos):
    lines = ["sentence_id\tpos\ttoken\tlabel", "3\t0\ta\tO", "", "3\t1\tb\tO", "bad\tline", "4\t0\tc\tB-X"]
    lines = lines if with_pos else [line.replace("\t0\t", "\t").replace("\t1\t", "\t") for line in lines]
    (tmp_path / "t.tsv").write_text("\n".join(lines))
    got = R.read_bio_tsv(spark, str(tmp_path), with_pos)
    assert got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("split(") == 1
    assert sorted(map(tuple, got.collect())) == [(3, 0, "a", "O"), (3, 1, "b", "O"), (4, 0, "c", "B-X")]


def test_token_scores_equal_the_stages_without_vectors(spark):
    rows = [(1, ["Hotel", "A", "di", "Solo"], ["B", "I", "O", "L"]), (2, ["kamar", "di", "Hotel", "A"], ["O", "O", "B", "I"])]
    corpus = spark.createDataFrame(rows, "id long, tokens array<string>, labels array<string>")
    fitted = tagger.fit_tagger(corpus, num_features=16, max_iter=20)  # so few slots that features of a token share them
    texts = spark.createDataFrame([(1, ["Solo", "zzz", "Hotel"]), (2, []), (3, None)], "id long, tokens array<string>")
    got = tagger.token_probabilities(texts, "id", "tokens", fitted)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "ArrowEvalPython" in plan and "UDF(" not in plan
    features = texts.where("id = 1").select(F.posexplode(tagger.feature_rows(F.col("tokens"))).alias("pos", "features"))
    want = {r["pos"]: r["probability"].toArray() for r in fitted.emissions.transform(features).collect()}
    found = {(r["id"], r["pos"]): r["probs"] for r in got.collect()}
    assert set(found) == {(1, k) for k in want} and len(want) == 3
    assert all(found[1, k] == pytest.approx(p, abs=1e-12) for k, p in want.items())
    alone = tagger.fit_tagger(corpus.withColumn("labels", F.transform("tokens", lambda t: F.lit("O"))), num_features=16)
    assert all(r["probs"] == [1.0] for r in tagger.token_probabilities(texts, "id", "tokens", alone).collect())
