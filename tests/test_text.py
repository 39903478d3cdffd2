import unicodedata

import pytest
from pyspark.sql import functions as F

from reviewlens.functions import arrays as A, fixed_values as V, text as T

# Fixed value: a worked example; its cleaned form and rating are known.
DEMO = (
    "Nginep di Hotel Santika, kamr nya bersi bgt tp wifi nya lelet parah! rating 4/5 recomend deh @admin http://x.com"
)


def values(spark, texts, column):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["v"] for r in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_demo_sentence(spark):
    clean = values(spark, [DEMO], T.preprocess(F.col("text"), V.SLANG, V.STOPWORDS))[0]
    assert clean == "menginap hotel santika , kamar nya bersih wifi nya lelet parah ! rating 4 5 rekomendasi deh"
    kept = values(spark, ["yang Bagus"], T.preprocess(F.col("text"), V.SLANG, V.STOPWORDS, use_stopword_removal=False))
    assert kept == ["yang bagus"]


def test_slang_runs_before_marks_are_split(spark):
    assert values(spark, ["lambat bgt, bgt"], T.normalize_slang(F.col("text"), V.SLANG)) == ["lambat bgt, banget"]
    assert values(spark, ["a b\t c "], T.normalize_slang(F.col("text"), {})) == ["a b c"]


def test_cleaning_steps(spark):
    texts = ["see http://a.b/c?d www.x.y now", "mail a@b.com #tag", "x™ y   z", "Ünïcode_1 (ok)!", None, ""]
    assert values(spark, texts, T.clean_text(F.col("text"))) == [
        "see now", "mail a .com tag", "xTM y z", "Ünïcode_1 ok !", None, "",
    ]
    stepwise = T.collapse_spaces(T.strip_symbols(T.strip_hash_signs(T.strip_mentions(T.strip_urls(F.col("text"))))))
    assert values(spark, texts, stepwise) == values(spark, texts, T.clean_text(F.col("text"), nfkc=False))


def test_nfkc(spark):
    texts = ["ﬁ ① ™ Ａ", "é", "plain", None, "Größe"]
    expected = [t and unicodedata.normalize("NFKC", t) for t in texts]
    assert values(spark, texts, T.normalize_nfkc(F.col("text"))) == expected
    stable = [chr(c) for c in [*range(0x80), *range(0xC0, 0x132)]]
    assert all(unicodedata.normalize("NFKC", a + b) == a + b for a in stable for b in stable)


def test_tokenize(spark):
    assert values(spark, ["Halo, dunia!!a.b", " ", None], T.tokenize(F.col("text"))) == [
        ["Halo", ",", "dunia", "!", "!", "a", ".", "b"], [], None,
    ]


@pytest.mark.parametrize(
    "text, rating",
    [("bintang 3", None), ("4,5 / 5", 4.5), ("14/5", 4.0), ("3.5 DARI 5", 3.5), ("4 bintang", 4.0), ("٤/5", 4.0), ("", None)],
)
def test_rating(spark, text, rating):
    assert values(spark, [text], T.extract_rating(F.col("text"))) == [rating]


def test_aspects(spark):
    texts = ["AC dingin dekat kolam", "acara bauran", "Check in cepat, checkout lama", "kata"]
    assert values(spark, texts, T.detect_candidate_aspects(F.col("text"), V.ASPECT_STEMS)) == [
        ["lokasi", "fasilitas"], ["kebersihan"], ["pelayanan"], [],
    ]


def test_clean_or_lower(spark):
    clean = T.clean_or_lower(T.preprocess(F.col("text"), V.SLANG, V.STOPWORDS), F.col("text"))
    assert values(spark, ["YANG", "Kamar yang", None], clean) == ["yang", "kamar", None]


def test_bag_of_words_and_cosine(spark):
    rows = spark.createDataFrame(
        [("kamar bersih nyaman", "kamar bersih sekali"), ("", "a"), ("a a b", "a c c"), ("x", "x")], "a string, b string"
    )
    counts = [A.term_counts(T.split_words(F.col(c))) for c in "ab"]
    found = [r[0] for r in rows.select(A.cosine_similarity(*counts)).collect()]
    assert found == pytest.approx([2 / 3, 0.0, 0.4, 1.0])
    maps = [r[0] for r in rows.select(A.term_count_map(T.split_words(F.col("a")))).collect()]
    assert maps[1:3] == [{}, {"a": 2, "b": 1}]
