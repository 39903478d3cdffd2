import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import fixed_values as V
from reviewlens.operators import evaluation as ev, features, joins, labels, sampling, similarity
from reviewlens.operators.classifier import certificate, fit_classifier
from reviewlens.plans.corpora import build_review_corpus
from reviewlens.plans.training import train_and_evaluate, train_both
from reviewlens.sources.readers import read_evaluation
from reviewlens.sources.writers import load_models


def order(seed, i):
    return hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i


@pytest.fixture(scope="module")
def skewed(spark):
    """Most rows in one group, one group of a single row, one null group."""
    rows = [(i, "hot" if i % 10 < 7 else f"g{i % 10}") for i in range(3000)] + [(9001, "one"), (9002, None)]
    return spark.createDataFrame(rows, "id long, g string")


def test_cap_takes_the_first_of_each_group(skewed):
    got = {r["id"] for r in sampling.cap_per_group(skewed, ["g"], 25, "id", 7).collect()}
    groups = {}
    for r in skewed.collect():
        groups.setdefault(r["g"], []).append(r["id"])
    expected = {i for ids in groups.values() for i in sorted(ids, key=lambda i: order(7, i))[:25]}
    assert got == expected and {9001, 9002} <= got


def test_cap_without_broadcast(skewed, monkeypatch):
    whole = {r["id"] for r in sampling.cap_per_group(skewed, ["g"], 25, "id", 7).collect()}
    for module in (joins, sampling):
        monkeypatch.setattr(module, "bounded", lambda *_: None)
    assert {r["id"] for r in sampling.cap_per_group(skewed, ["g"], 25, "id", 7).collect()} == whole


def test_sample_and_split_sizes(skewed):
    ids = sorted((r["id"] for r in skewed.collect()), key=lambda i: order(1, i))
    assert {r["id"] for r in sampling.sample_exact(skewed, 40, "id", 1).collect()} == set(ids[:40])
    assert sampling.sample_exact(skewed, 10**6, "id", 1).count() == 3002
    test = {r["id"] for r in sampling.random_split(skewed, 0.2, "id", 1).where("is_test").collect()}
    assert test == set(ids[: math.ceil(3002 * 0.2)])


def test_stratified_split_shares(skewed):
    known = skewed.where("g IS NOT NULL")
    split = sampling.stratified_split(known, "g", 0.2, "id", 3)
    counts = {r["g"]: (r["n"], r["t"]) for r in split.groupBy("g").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert sum(t for _, t in counts.values()) == math.ceil(3001 * 0.2)
    n_train = 3001 - math.ceil(3001 * 0.2)
    floors = {g: n * n_train // 3001 for g, (n, _) in counts.items()}
    by_rest = sorted(counts, key=lambda g: (-(counts[g][0] * n_train % 3001), g))
    more = set(by_rest[: n_train - sum(floors.values())])
    assert {g: n - t for g, (n, t) in counts.items()} == {g: f + (g in more) for g, f in floors.items()}


def test_lookup_join_paths_agree(spark, skewed):
    table = spark.createDataFrame([("hot", 1), ("g8", 2), (None, 3)], "g string, v int")
    small = joins.lookup_join(skewed, table, ["g"], ["id"])
    large = joins.lookup_join(skewed, table, ["g"], ["id"], max_rows=0)
    assert small.columns == large.columns == ["id", "g", "v"]
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)
    assert small.count() == skewed.count()


def levenshtein(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_typos_equal_brute_force(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 7)))
    words, vocabulary = sorted({word() for _ in range(150)}), list(dict.fromkeys(word() for _ in range(40)))
    df = spark.createDataFrame([(w,) for w in words], "word string")
    known = similarity.vocabulary_of(vocabulary, df)
    expected = {}
    for w in words:
        d, rank = min((levenshtein(w, v), i) for i, v in enumerate(vocabulary))
        expected[w] = (vocabulary[rank], d) if d <= 2 else (w, None)
    got = similarity.correct_words(df, known, 2).collect()
    assert {r["word"]: (r["corrected"], r["distance"]) for r in got} == expected
    none = similarity.correct_words(df, known.limit(0)).collect()
    assert all(r["corrected"] == r["word"] for r in none)


def test_typo_examples(spark):
    df = spark.createDataFrame([(1, ["kamr", "bersi", "pelayann", "lokasi", "wifi"])], "id int, w array<string>")
    words = similarity.vocabulary_of(["kamar", "bersih", "pelayanan", "lokasi", "fasilitas", "harga", "sarapan"], df)
    fixed = similarity.correct_typos(df, "id", "w", words, "fixed").first()["fixed"]
    assert fixed == ["kamar", "bersih", "pelayanan", "lokasi", "wifi"]


def test_remap_and_corpus(spark):
    rows = [(0, " a ", "hotel", "positive"), (1, "", "kamar", "positive"), (2, None, "kamar", "negative"),
            (3, "b", "lainnya", "negative"), (4, "c", "restoran", "netral"), (5, "d", "harga", "negative"), (6, "e", None, "positive")]
    raw = spark.createDataFrame(rows, "id int, text string, aspect string, sentiment string")
    kept = labels.filter_valid_and_remap(raw, V.ASPECT_MAP, V.SENTIMENT_MAP).orderBy("id").collect()
    assert [tuple(r) for r in kept] == [(0, "a", "fasilitas", "positif"), (5, "d", "harga", "negatif")]
    assert build_review_corpus(raw, "id").count() == 2
    with pytest.raises(ValueError):
        labels.require_columns(raw, ["text", "absent"])


def test_vocabulary_and_idf(spark):
    df = spark.createDataFrame([(1, "aa bb aa"), (2, "aa cc"), (3, "x y")], "id int, text string")
    terms = features.word_terms(F.col("text"))
    vocab = features.vocabulary(df, terms, 1, None)
    assert {r["term"]: (r["tf"], r["df"]) for r in vocab.collect()} == {
        "aa": (3, 2), "bb": (1, 1), "cc": (1, 1), "aa bb": (1, 1), "bb aa": (1, 1), "aa cc": (1, 1),
    }
    stages = features.TfidfStages.fit(df, terms, min_df=2)
    assert stages.terms == ["aa"] and stages.idf[0] == pytest.approx(math.log(4 / 3) + 1)
    idf = features.with_idf(vocab, 3)
    everything = features.TfidfStages.fit(df, terms, min_df=1)
    by_vector = {(r[0], r[1]): r[2] for r in everything.long(df, "id", terms).collect()}
    for max_rows in (100, 0):
        by_join = {(r[0], r[1]): r[2] for r in features.tfidf_long(df, "id", terms, idf, max_rows).collect()}
        assert by_join == pytest.approx(by_vector)


# A published confusion matrix of six classes, its accuracy and macro F1.
MATRIX = [
    [48, 0, 1, 1, 0, 2], [1, 50, 1, 0, 0, 0], [4, 0, 47, 1, 0, 0], [4, 1, 1, 46, 0, 0], [3, 0, 2, 0, 44, 3], [0, 1, 1, 0, 0, 50],
]
ACCURACY, F1_MACRO = 0.9134615384615384, 0.9141942533064028


def test_metrics_give_back_published_ones(spark):
    rows = [(f"c{i}", f"c{j}", n) for i, row in enumerate(MATRIX) for j, n in enumerate(row) if n]
    counts = spark.createDataFrame(rows, "actual string, predicted string, n long")
    found = ev.report_metrics(counts).first()
    assert (found["accuracy"], found["f1_macro"]) == pytest.approx((ACCURACY, F1_MACRO))
    full = ev.confusion_matrix(counts)
    assert full.count() == 36 and full.where("n = 0").count() == 36 - len(rows)
    wide = ev.confusion_matrix_wide(counts, [f"c{i}" for i in range(6)]).orderBy("actual").collect()
    assert [list(r)[1:] for r in wide] == MATRIX


def test_zero_division_and_foreign_predictions(spark):
    counts = spark.createDataFrame([("a", "b", 3)], "actual string, predicted string, n long")
    report = {r["label"]: tuple(r)[1:] for r in ev.full_report(counts, micro=True).collect()}
    assert report["a"] == (0.0, 0.0, 0.0, 3) and report["b"] == (0.0, 0.0, 0.0, 0) and report["micro avg"][3] == 3
    assert [tuple(r) for r in ev.confusion_matrix(counts).collect()] == [("a", "a", 0)]


def test_best_candidate_prefers_the_first(spark):
    rows = spark.createDataFrame([("x", 1, 0.5), ("y", 0, 0.5)], "candidate string, candidate_order int, f1_macro double")
    assert ev.best_candidate(rows).first()["candidate"] == "y"


def reviews(spark, n=120):
    good, bad = ["bersih nyaman", "ramah sekali", "enak mantap"], ["kotor bau", "jutek lambat", "mahal buruk"]
    rows = [(i, f"{(good if i % 2 else bad)[i % 3]} hotel {i % 7}", "positif" if i % 2 else "negatif") for i in range(n)]
    return spark.createDataFrame(rows, "id long, text string, sentiment string")


def test_train_and_evaluate(spark):
    done = train_and_evaluate(reviews(spark), "sentiment", "id", "sentiment", max_iter=20)
    assert done.best == "logistic_regression"
    assert done.report.where("label = 'accuracy' AND precision = 1.0").count() == 2
    assert done.matrices.groupBy("candidate").count().where("count = 4").count() == 2 and done.errors.count() == 0
    new = spark.createDataFrame([("kamar bersih nyaman",), (None,)], "text string")
    assert [r["predicted"] for r in done.model.transform(new).collect()] == ["positif", None]


def test_naive_bayes_uses_plain_class_shares(spark):
    rows = [(i, "kata sama", "a" if i < 9 else "b") for i in range(10)]
    df = spark.createDataFrame(rows, "id int, text string, y string")
    model = fit_classifier(df, "y", "naive_bayes", min_df=1)
    bayes = next(s for s in model.stages if hasattr(s, "theta"))
    smoothing = [math.exp(p) for p in bayes.pi.toArray()]
    assert bayes.getThresholds() == pytest.approx([smoothing[0] / 0.9, smoothing[1] / 0.1])


def test_shuffle_is_repeatable(skewed):
    first = [r["id"] for r in sampling.shuffle_rows(skewed, "id", 1).collect()]
    assert first == [r["id"] for r in sampling.shuffle_rows(skewed.repartition(7), "id", 1).collect()]
    assert sorted(first) != first


def test_null_predictions_are_wrong_and_no_class(spark):
    df = spark.createDataFrame([(1, "a", "a"), (2, "a", None), (3, "b", "b"), (4, None, "a")], "id int, y string, p string")
    counts = ev.confusion_counts(df, "y", "p")
    assert sorted(r["label"] for r in ev.class_report(counts).collect()) == ["a", "b"]
    found = ev.report_metrics(counts).first()
    assert found["accuracy"] == pytest.approx(2 / 3) and found["f1_macro"] == pytest.approx((2 / 3 + 1) / 2)
    assert ev.error_count(counts).first()["errors"] == 1
    assert [r["id"] for r in ev.error_examples(df, "y", "p", ["id"]).collect()] == [2]


def test_rows_without_label_and_odd_column_names(spark):
    rows = [(i, "bersih nyaman" if i % 2 else "kotor bau", "p" if i % 2 else "n") for i in range(20)] + [(98, "bersih", None), (99, None, "p")]
    df = spark.createDataFrame(rows, ["id", "review text", "the label"])
    done = train_and_evaluate(df, "the label", "id", "t", "review text", max_iter=20)
    assert done.report.where("label = 'accuracy'").count() == 2
    model = fit_classifier(df, "the label", text="review text", out="my guess")
    assert {r["id"]: r["my guess"] for r in model.transform(df).collect()}[98] == "p"


@pytest.mark.parametrize("digits, bucket_rows", [(1, 1), (1, 5), (3, 10_000), (32, 1)])
def test_refined_cuts_are_the_same(spark, digits, bucket_rows):
    df = spark.range(700).select("id", (F.col("id") % 3 == 0).cast("int").alias("g"))
    for groups, n in ((["g"], 57), ([], 123)):
        marked = sampling.mark_first(df, "id", groups, n, 9, "first", digits, bucket_rows).where("first")
        order = sorted(((hashlib.md5(f"9:{i}".encode()).hexdigest(), i) for i in range(700)))
        want = {i for g in ((0, 1) if groups else (None,)) for _, i in [x for x in order if g is None or (x[1] % 3 == 0) == g][:n]}
        assert {r["id"] for r in marked.collect()} == want


def test_a_sample_shuffles_no_ids(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    ids = spark.read.parquet(str(tmp_path / "t")).withColumn("g", F.col("id") % 2)
    marked = sampling.mark_first(ids, "id", ["g"], 10, 1, "first")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange hashpartitioning" not in marked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_one_key_in_every_row_is_split(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    table = spark.createDataFrame([("hot", 1), ("10", 2), ("x", 3)], "k string, v int")
    joined = joins.lookup_join(rows, table, ["k"], ["id"], max_rows=0, hot_keys=20)
    assert joined.columns == ["id", "k", "v"] and joined.count() == 4000
    assert joined.where("k = 'hot' AND v = 1").count() == 3600 and joined.where("v = 2").count() == 1
    assert joins.bounded(table, 3) is not None and joins.bounded(table, 2) is None and joins.bounded(table, 3, 10) is None
    sized = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.length("k"))
    assert joins.salted_lookup(rows, sized, "k", "n", 20).where(F.col("v") == F.length("k")).count() == 4000


def test_replace_words_many_hits_and_nulls(spark):
    words = [f"w{i % 7000}" for i in range(20_000)]
    df = spark.createDataFrame([(1, words), (2, []), (3, None), (4, ["a", "w1", "a", "w1"])], "id int, w array<string>")
    table = spark.range(7000).select(F.concat(F.lit("w"), F.col("id")).alias("word"), F.concat(F.lit("v"), F.col("id")).alias("replacement"))
    out = {r["id"]: r["o"] for r in joins.replace_words(df, "id", "w", table, "o").collect()}
    assert out == {1: ["v" + w[1:] for w in words], 2: [], 3: None, 4: ["a", "v1", "a", "v1"]}


def test_typos_in_very_long_and_very_short_words(spark):
    words = ["x" * 20_000, "", "a", "ab", "abc", "kamr"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    known = similarity.vocabulary_of(["kamar", "b"], df)
    got = {r["word"]: (r["corrected"], r["distance"]) for r in similarity.correct_words(df, known, 2).collect()}
    assert got == {
        words[0]: (words[0], None), "": ("b", 1), "a": ("b", 1), "ab": ("b", 1), "abc": ("b", 2), "kamr": ("kamar", 1),
    }


def test_words_and_pairs_equal_the_plain_count(spark):
    rng = random.Random(8)
    texts = [(i, " ".join(f"w{int(rng.paretovariate(0.7)) % 90:02d}" for _ in range(30))) for i in range(80)]
    df = spark.createDataFrame(texts, "id int, text string")
    for n in (5, 40, 300, 10_000):
        plain = features.vocabulary(df, features.word_terms(F.col("text")), 2, n)
        assert sorted(map(tuple, features.words_and_pairs(df, F.col("text"), 2, n).collect())) == sorted(map(tuple, plain.collect()))


def test_both_targets_are_trained_stored_and_reported(spark, tmp_path):
    rows = [(i, f"{'bersih nyaman' if i % 2 else 'kotor bau'} {'kamar' if i % 3 else 'lokasi'}", "kamar" if i % 3 else "lokasi", "p" if i % 2 else "n") for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, aspect string, sentiment string")
    done = train_both(df, "id", str(tmp_path), max_iter=20)
    report, matrices, errors = read_evaluation(spark, str(tmp_path / "report"))
    assert report.where("is_best AND label = 'accuracy'").count() == 2 and matrices.count() == 16 and errors.count() == 0
    again = load_models(str(tmp_path / "models"), "aspect", "sentiment")
    assert again["aspect"].transform(df).where("predicted <> aspect").count() == 0 and set(done) == set(again)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_probe_keys_miss_no_near_word(spark, k):
    draw = random.Random(k)
    pairs = []
    for _ in range(600):
        word = "".join(draw.choices("ab", k=draw.randint(1, 9)))
        other = list(word)
        for _ in range(draw.randint(0, k)):
            at = draw.randint(0, len(other))
            kind = draw.randrange(3)
            if kind == 0:
                other.insert(at, draw.choice("ab"))
            elif at < len(other):
                other[at : at + 1] = [] if kind == 1 else [draw.choice("ab")]
        pairs.append((word, "".join(other)))
    df = spark.createDataFrame(pairs, "known string, word string").where("length(known) > 0 and length(word) > 0")
    met = F.arrays_overlap(similarity.index_keys(F.col("known"), k), similarity.probe_keys(F.col("word"), k))
    assert df.where(F.levenshtein("known", "word") <= k).where(~met).count() == 0


def bags(n, seed):
    """Texts of few frequent and many rare words, with near copies, empty ones and a null."""
    draw = random.Random(seed)
    words = [f"w{k}" for k in range(200)]
    rows = [(i, draw.choices(words, [1 / (k + 1) for k in range(200)], k=draw.randint(1, 25))) for i in range(n)]
    rows += [(n + i, rows[i][1][: draw.randint(1, 25)] + draw.choices(words, k=2)) for i in range(n // 4)]
    return rows + [(5000, []), (5001, None), (None, ["w0"])]


def cosine_by_hand(a, b):
    x, y = Counter(a), Counter(b)
    dot = sum(x[w] * y[w] for w in x)
    return dot / math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values())) if dot else 0.0


@pytest.mark.parametrize("threshold", [0.2, 0.6, 0.9])
def test_cosine_join_equals_all_pairs(spark, threshold):
    left, right = bags(80, 1), bags(80, 2) + bags(80, 1)[:20]
    right = [(None if i is None else 100 + n, w) for n, (i, w) in enumerate(right)]
    want = {(i, j): cosine_by_hand(a, b) for i, a in left for j, b in right if a and b and i is not None and j is not None}
    want = {p: c for p, c in want.items() if c >= threshold - similarity.ROUNDING}
    one = spark.createDataFrame([(*r, 1) for r in left], "a_id long, words array<string>, term int")
    other = spark.createDataFrame([(*r, 1) for r in right], "b_id long, words array<string>, df int")
    got = similarity.cosine_join(one, other, threshold, "a_id", "b_id", "words", "words")
    assert got.columns == ["a_id", "b_id", "cosine"]
    found = {(r["a_id"], r["b_id"]): r["cosine"] for r in got.collect()}
    assert set(found) == set(want) and len(want) > 10 and all(abs(found[p] - want[p]) < 1e-9 for p in want)
    assert similarity.cosine_join(one.limit(0), other, threshold, "a_id", "b_id", "words", "words").count() == 0


def test_cosine_join_refuses_thresholds_without_a_bound(spark):
    df = spark.createDataFrame([(1, ["a"])], "id long, w array<string>")
    with pytest.raises(ValueError):
        similarity.cosine_join(df, df, 0.0, "id", "id", "w", "w")


@pytest.mark.parametrize("bucket_rows", [10_000, 3])
def test_shuffled_positions(spark, bucket_rows):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    placed = sampling.shuffled_positions(df, "doc_id", 7, bucket_rows=bucket_rows).orderBy("position").collect()
    want = sorted(range(500), key=lambda i: (hashlib.md5(f"7:{i}".encode()).hexdigest(), i))
    assert [(r["doc_id"], r["position"]) for r in placed] == [(i, n) for n, i in enumerate(want, 1)]
    assert sampling.shuffled_positions(df.limit(0), "doc_id", 7).count() == 0


def test_exact_sizes_with_repeated_ids(spark, monkeypatch):
    """Ids occur up to 900 times, some rows are the same in every column, and one id is null."""
    rows = [(7, "hot", i % 450) for i in range(900)] + [(i % 5, "cold", i) for i in range(40)] + [(None, "hot", 1), (3, None, 1)]
    df = spark.createDataFrame(rows, "id long, g string, v long").coalesce(1)
    for n in (3, 500):
        assert sampling.sample_exact(df, n, "id", 1).count() == n
    split = sampling.random_split(df, 0.2, "id", 1)
    assert split.columns == [*df.columns, "is_test"]
    found = sorted(map(repr, split.collect()))
    assert sum("is_test=True" in r for r in found) == math.ceil(942 * 0.2)
    assert sorted(map(repr, split.drop("is_test").collect())) == sorted(map(repr, df.collect()))
    assert sorted(map(repr, sampling.random_split(df.repartition(3), 0.2, "id", 1).collect())) == found
    for module in (joins, sampling):
        monkeypatch.setattr(module, "bounded", lambda *_: None)
    capped = sampling.cap_per_group(df, ["g"], 25, "id", 7)
    assert {r["g"]: r["count"] for r in capped.groupBy("g").count().collect()} == {"hot": 25, "cold": 25, None: 1}


@pytest.mark.parametrize("classes", [2, 3])
def test_certificate_tells_a_finished_fit_from_an_unfinished_one(spark, classes):
    draw = random.Random(classes)
    words = ["kamar", "bersih", "kotor", "wifi", "lambat", "ramah", "mahal"]
    rows = [(" ".join(draw.choices(words, k=draw.randint(0, 6))), draw.choice("abc"[:classes])) for _ in range(120)]
    train = spark.createDataFrame([*rows, (None, "a"), ("kamar wifi", None)], "text string, y string")
    done = fit_classifier(train, "y", "logistic_regression", tol=1e-13)
    half = fit_classifier(train, "y", "logistic_regression", max_iter=1)
    proof = {r["label"]: r for r in certificate(train, "y", done).collect()}
    assert {k: r["n"] for k, r in proof.items()} == Counter(y for _, y in [*rows, (None, "a")])
    assert all(r["start"] > 1e-3 and r["largest"] < 1e-4 * r["start"] for r in proof.values())
    assert max(r["largest"] / r["start"] for r in certificate(train, "y", half).collect()) > 0.01
