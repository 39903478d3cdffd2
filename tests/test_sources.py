import os

import pytest
from pyspark.sql import functions as F

from reviewlens.functions.bio import labels_of, tokens_of
from reviewlens.operators.classifier import fit_classifier
from reviewlens.plans.scoring import score_reviews
from reviewlens.plans.training import metric_rows
from reviewlens.operators.evaluation import confusion_counts
from reviewlens.session import shared_dir
from reviewlens.sources import readers as R, writers as W
from reviewlens.streaming.scoring import count_stream, read_arriving, read_totals, score_stream


def test_csv_keeps_quotes_lines_and_spaces(spark):
    rows = [('say "hi", ok', "a", "x"), ("two\nlines", "b", "y"), ("  padded ", "c", "z"), ("back\\slash", "d", "w")]
    path = shared_dir(spark, "csv")
    W.write_csv(spark.createDataFrame(rows, "text string, aspect string, sentiment string"), path)
    assert sorted(map(tuple, R.read_reviews(spark, path).collect())) == sorted(rows)


def test_reviews_drop_missing(spark, tmp_path):
    (tmp_path / "r.csv").write_text("aspect,text,sentiment\na,ok,p\n,x,p\nb,,n\nc,NaN,p\n", encoding="utf-8")
    assert [r["text"] for r in R.read_reviews(spark, str(tmp_path / "r.csv")).collect()] == ["ok"]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError):
        R.read_batch(spark, str(tmp_path / "bad.csv"))


def test_raw_sheet_by_position(spark, tmp_path):
    (tmp_path / "s.csv").write_text("a,b,c,d,e,f,t,,s,x\n0,1,2,3,4,5,txt,kamar,positive,9\n", encoding="utf-8")
    assert [tuple(r) for r in R.read_labelled_raw(spark, str(tmp_path / "s.csv")).collect()] == [("txt", "kamar", "positive")]


def test_bio_files(spark, tmp_path):
    rows = [(2, 0, 'a"b', "O"), (2, 1, "c\\d", "B-X"), (1, 0, "''", "O"), (1, 1, "#", "I-X")]
    path = shared_dir(spark, "bio")
    W.write_bio_tsv(spark.createDataFrame(rows, "doc_id long, pos int, token string, label string"), path)
    back = R.read_bio_tsv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert {r["doc_id"]: [t["token"] for t in r["sentence"]] for r in R.sentences(back).collect()} == {2: ['a"b', "c\\d"], 1: ["''", "#"]}
    both = R.sentences(back).select("doc_id", tokens_of(F.col("sentence")), labels_of(F.col("sentence")))
    assert sorted(map(tuple, both.collect())) == [(1, ["''", "#"], ["O", "I-X"]), (2, ['a"b', "c\\d"], ["O", "B-X"])]
    old = "sentence_id\ttoken\tlabel\n" + "".join(
        "".join(f"{s}\tt{s}_{i}\tO\n" for i in range(400)) + "\nbroken line\n" for s in range(20)
    )
    (tmp_path / "old.tsv").write_text(old, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        read = R.read_bio_tsv(spark, str(tmp_path / "old.tsv"), with_pos=False)
        assert spark.read.text(str(tmp_path / "old.tsv")).rdd.getNumPartitions() > 1 and read.count() == 8000
        assert read.where(F.col("token") != F.format_string("t%d_%d", "doc_id", "pos")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def sentences_by_hand(text):
    """Blank lines close a sentence, lines of other than three fields are skipped, ids are ignored."""
    found, now = [], []
    for line in map(str.strip, text.splitlines()):
        parts = line.split("\t")
        if not line:
            found, now = [*found, now], []
        elif len(parts) == 3 and parts[0] != "sentence_id":
            now.append((parts[1], parts[2]))
    return [s for s in [*found, now] if s]


@pytest.mark.parametrize("split_bytes", [300, 4000, 1 << 20])
def test_blank_lines_end_sentences(spark, tmp_path, split_bytes):
    header, folder = "sentence_id\ttoken\tlabel\n", tmp_path / "bio"
    folder.mkdir()
    long = "".join(f"1\tt{i}\tO\n" for i in range(200))
    texts = {
        "a.tsv": header + "".join("".join(f"{s % 3}\tt{s}_{i}\tB-X\n" for i in range(s % 7)) + "\n" * (s % 3) for s in range(120)),
        "b.tsv": header + long + "broken line\n" + long + " \t \n\n\n1\tlast\tO",
        "c.tsv": "1\tno\tO\n1\theader\tO\n",
        "d.tsv": "\n\n" + header,
        "e.tsv": "",
    }
    for name, text in texts.items():
        (folder / name).write_text(text, encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = R.sentences(R.read_bio_sentences(spark, str(folder))).orderBy("doc_id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [s for name in sorted(texts) for s in sentences_by_hand(texts[name])]
    assert [[(t["token"], t["label"]) for t in r["sentence"]] for r in read] == want


def test_written_sentences_come_back(spark):
    rows = [(1, ["a", "b"], ["O", "B-X"]), (1, [], []), (1, ["c"], ["O"]), (None, ["d"], ["O"])]
    path = shared_dir(spark, "bio")
    W.write_bio_sentences(spark.createDataFrame(rows, "doc_id long, tokens array<string>, labels array<string>"), path)
    back = R.sentences(R.read_bio_sentences(spark, path)).collect()
    assert sorted([t["token"] for t in r["sentence"]] for r in back) == [["a", "b"], ["c"], ["d"]]


def test_stream_totals_survive_a_restart(spark, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "totals", "state"))
    schema = "a string, b string"

    def deliver(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = read_arriving(spark, source, spark.createDataFrame([], schema).schema, max_files=1)
        count_stream(stream, ["a", "b"], sink, state).awaitTermination()
        return sorted(map(tuple, read_totals(spark, sink).collect()))

    deliver(("x", "p"), ("y", None))
    deliver(("x", "p"))
    assert run() == [("a", "x", 2), ("a", "y", 1), ("b", "p", 2)]
    assert run() == [("a", "x", 2), ("a", "y", 1), ("b", "p", 2)]
    deliver(("y", "q"), ("x", "p"))
    first = run()
    assert first == [("a", "x", 3), ("a", "y", 2), ("b", "p", 3), ("b", "q", 1)]
    # A job that dies after its rows are written but before the batch is marked as done runs the batch again.
    commits = sorted(p for p in os.listdir(f"{state}/commits") if p.isdigit())
    for name in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{state}/commits/{name}"):
            os.remove(f"{state}/commits/{name}")
    assert run() == first


def test_report_table(spark):
    pairs = spark.createDataFrame([("a", "a"), ("b", "a")], "y string, p string")
    counts = confusion_counts(pairs, "y", "p")
    rows = metric_rows("t", "m1", counts).withColumn("is_best", F.lit(True))
    rows = rows.unionByName(metric_rows("t", "m2", counts).withColumn("is_best", F.lit(False)))
    path = shared_dir(spark, "report")
    W.write_report(rows, path)
    table = R.report_table(R.read_report(spark, path))
    assert sorted(r["label"] for r in table.collect()) == ["a", "b", "macro avg", "weighted avg"]


def test_models_survive_storage_and_streams(spark, tmp_path):
    rows = [("kamar bersih nyaman", "p"), ("kotor dan bau", "n")] * 10
    train = spark.createDataFrame(rows, "clean_text string, y string")
    models = {"sentiment": fit_classifier(train, "y", text="clean_text", out="predicted_sentiment")}
    path = shared_dir(spark, "models")
    W.save_models(path, **models)
    loaded = R_load(path)
    new = spark.createDataFrame([(1, "Kamar BERSIH @x"), (2, "bau!"), (3, None), (4, " ")], "id int, text string")
    expected = sorted(map(tuple, score_reviews(new, models).collect()))
    assert [r[2] for r in expected[:3]] == ["p", "n", None]
    assert sorted(map(tuple, score_reviews(new, loaded).collect())) == expected

    source = str(tmp_path / "in")
    new.repartition(3).write.parquet(source)
    query = score_stream(
        read_arriving(spark, source, new.schema, max_files=1), loaded, str(tmp_path / "out"), str(tmp_path / "state")
    )
    query.awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == expected
    assert os.path.isdir(tmp_path / "state")


def test_a_bundle_is_whole_or_not_there(spark):
    def model(word):
        train = spark.createDataFrame([(word, "p"), ("kotor", "n")] * 4, "t string, y string")
        return fit_classifier(train, "y", text="t", out="found")

    class Broken:
        def write(self):
            raise OSError("disk full")

    def labels(models):
        texts = spark.createDataFrame([("bersih",), ("wangi",)], "t string")
        return {name: [r["found"] for r in m.transform(texts).collect()] for name, m in models.items()}

    path, old, new = shared_dir(spark, "models"), model("bersih"), model("wangi")
    with pytest.raises(OSError):
        W.save_models(path, a=old, b=Broken())
    with pytest.raises(FileNotFoundError):
        W.load_models(path)
    W.save_models(path, a=old, b=old)
    with pytest.raises(OSError):
        W.save_models(path, a=new, b=Broken())
    assert labels(W.load_models(path)) == labels({"a": old, "b": old})
    W.save_models(path, a=new, b=old)
    assert labels(W.load_models(path, "a", "b")) == labels({"a": new, "b": old})
    with pytest.raises(KeyError):
        W.load_models(path, "c")


def R_load(path):
    return W.load_models(path, "sentiment")


def test_missing_spellings_count_in_csv_only(spark, tmp_path):
    df = spark.createDataFrame([("None", "a", "p"), ("NA", "a", "p"), (None, "a", "p")], "text string, aspect string, sentiment string")
    df.write.parquet(str(tmp_path / "p"))
    W.write_csv(df, str(tmp_path / "c"))
    assert R.read_reviews(spark, str(tmp_path / "p"), format="parquet").count() == 2
    assert R.read_reviews(spark, str(tmp_path / "c")).count() == 0


def test_a_large_csv_file_is_split(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,text\n" + "".join(f"{i},word {i}\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        split = R.read_batch(spark, str(tmp_path / "t.csv"), multi_line=False)
        assert split.rdd.getNumPartitions() > 1 and split.count() == R.read_batch(spark, str(tmp_path / "t.csv")).count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
