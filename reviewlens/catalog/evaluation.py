"""Metrics of rule-based predictors, so that SQL can repeat the predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.catalog import sql as Q
from reviewlens.catalog.corpora import hashed_labels
from reviewlens.catalog.registry import KEYWORDS, TOXIC, register, table
from reviewlens.catalog.text import keyword_labels_sql
from reviewlens.functions import bio as B, text as T
from reviewlens.operators import evaluation as ev
from reviewlens.plans.training import compare
from reviewlens.session import shared_dir, stored
from reviewlens.sources.readers import read_evaluation, report_table as best_rows
from reviewlens.sources.writers import write_evaluation


def keyword_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned documents with an insult are predicted toxic. Predicted first, so no text meets the labels."""
    found = T.detect_candidate_aspects(T.clean_text(T.case_folding(F.col("text"))), TOXIC)
    predicted = F.when(F.size(found) > 0, F.lit("toxic")).otherwise(F.lit("fine"))
    actual = F.when(F.col("toxic") == 1, F.lit("toxic")).otherwise(F.lit("fine"))
    guesses = table(spark, sf_dir, "documents").select("doc_id", "lang", predicted.alias("predicted"))
    truth = table(spark, sf_dir, "labels").select("doc_id", actual.alias("actual"))
    return guesses.join(truth, "doc_id").select("doc_id", "lang", "actual", "predicted")


def with_text(spark: SparkSession, sf_dir: str, few: DataFrame) -> DataFrame:
    """The texts of a few rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.join(F.broadcast(few), "doc_id").select("doc_id", "text", "actual", "predicted")


_PATTERN = Q.stem_pattern(*TOXIC["toxic"])
_PREDICTED = f"""
      pr AS (SELECT d.doc_id, d.text, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'fine' END AS actual,
               CASE WHEN regexp_matches({Q.clean("lower(text)")}, '{_PATTERN}') THEN 'toxic' ELSE 'fine' END AS predicted
             FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def report_sql(pairs: str, exclude: str = "") -> str:
    """CTEs ``rep`` (per label) and ``avgs`` from a source of ``actual`` and ``predicted``."""
    skip = f"WHERE label <> '{exclude}'" if exclude else ""
    return f"""
      lab AS (SELECT actual AS label FROM {pairs} UNION SELECT predicted FROM {pairs}),
      base AS (SELECT label,
          (SELECT count(*) FROM {pairs} p WHERE p.actual = label AND p.predicted = label) AS tp,
          (SELECT count(*) FROM {pairs} p WHERE p.predicted = label) AS np,
          (SELECT count(*) FROM {pairs} p WHERE p.actual = label) AS support FROM lab {skip}),
      rep AS (SELECT label, CASE WHEN np = 0 THEN 0 ELSE tp / np END AS precision,
          CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall,
          CASE WHEN np + support = 0 THEN 0 ELSE 2 * tp / (np + support) END AS f1_score, support FROM base),
      avgs AS (SELECT 'macro avg' AS label, avg(precision) AS precision, avg(recall) AS recall, avg(f1_score) AS f1_score,
            sum(support)::BIGINT AS support FROM rep
          UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
            sum(f1_score * support) / sum(support), sum(support)::BIGINT FROM rep)"""


_ROUNDED = "label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, support"


def rounded(report: DataFrame) -> DataFrame:
    for name in ("precision", "recall", "f1_score"):
        report = report.withColumn(name, F.round(name, 6))
    return report


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_counts(keyword_predictions(spark, sf_dir), "actual", "predicted")


@register(
    f"WITH {_PREDICTED} SELECT round(avg((actual = predicted)::INT), 6) AS accuracy, count(*) AS rows FROM pr"
)
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.accuracy(_counts(spark, sf_dir)).withColumn("accuracy", F.round("accuracy", 6))


@register(f"WITH {_PREDICTED}, {report_sql('pr')} SELECT {_ROUNDED} FROM rep")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.class_report(_counts(spark, sf_dir)))


@register(
    f"WITH {_PREDICTED}, {report_sql('pr')} SELECT {_ROUNDED} FROM rep UNION ALL SELECT {_ROUNDED} FROM avgs"
)
def macro_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(ev.full_report(_counts(spark, sf_dir)))


@register(
    f"""WITH {_PREDICTED}, a AS (SELECT DISTINCT actual FROM pr)
    SELECT a.actual, b.actual AS predicted, (SELECT count(*) FROM pr WHERE pr.actual = a.actual AND pr.predicted = b.actual) AS n
    FROM a, a b"""
)
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.confusion_matrix(_counts(spark, sf_dir))


# Guessed from id and length, so that every class gets confused with others.
_GUESS = "CASE WHEN doc_id % 3 = 0 THEN 'en' WHEN n_chars % 2 = 0 THEN 'fr' WHEN n_chars % 5 = 0 THEN 'xx' ELSE lang END"


@register(
    f"""WITH pr AS (SELECT lang AS actual, {_GUESS} AS predicted FROM documents)
    SELECT actual, count(*) FILTER (predicted = 'de') AS de, count(*) FILTER (predicted = 'en') AS en,
      count(*) FILTER (predicted = 'es') AS es, count(*) FILTER (predicted = 'fr') AS fr FROM pr GROUP BY actual"""
)
def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    guessed = table(spark, sf_dir, "documents").selectExpr("lang", f"{_GUESS} AS guess")
    return ev.confusion_matrix_wide(ev.confusion_counts(guessed, "lang", "guess"), ["de", "en", "es", "fr"])


@register(
    f"""WITH {_PREDICTED} SELECT doc_id, text, actual, predicted FROM pr WHERE actual <> predicted ORDER BY doc_id LIMIT 5"""
)
def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keyword_predictions(spark, sf_dir).drop("lang")
    return with_text(spark, sf_dir, ev.error_examples(rows, "actual", "predicted", ["doc_id"], 5))


@register(
    f"WITH {_PREDICTED} SELECT sum((actual <> predicted)::INT)::BIGINT AS errors, count(*) AS rows FROM pr"
)
def error_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.error_count(_counts(spark, sf_dir))


# Gold labels by keyword, predictions by the hash of the token: many errors of every kind.
_TOKEN_PAIRS = f"""{keyword_labels_sql('documents', 'doc_id', 'lang', KEYWORDS, Q.tokens('text'))},
      tu AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS i, t, labels FROM kw),
      tp AS MATERIALIZED (SELECT doc_id, i - 1 AS pos, t[i] AS token, labels[i] AS actual,
        coalesce({["B-HOTEL", "B-HOTEL", "I-HOTEL", "I-HOTEL", "I-HOTEL", "B-LOC", "I-LOC", "B-ASPECT", "I-ASPECT"]}[
          ('0x' || substr(md5(t[i]), 1, 1))::INT + 1], 'O') AS predicted FROM tu)"""


def _token_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("t", B.ner_tokenize(F.col("text")))
    tagged = docs.withColumn("gold", B.keyword_bio_tag(F.col("t"), F.col("lang"), KEYWORDS))
    return ev.token_pairs(tagged.withColumn("guess", hashed_labels(F.col("t"))), "doc_id", "t", "gold", "guess")


@register(
    f"""WITH {_TOKEN_PAIRS}, {report_sql('tp', 'O')},
      micro AS (SELECT 'micro avg' AS label, sum(tp) / sum(np) AS precision, sum(tp) / sum(support) AS recall,
        2 * sum(tp) / sum(np + support) AS f1_score, sum(support)::BIGINT AS support FROM base)
    SELECT {_ROUNDED} FROM rep UNION ALL SELECT {_ROUNDED} FROM avgs UNION ALL SELECT {_ROUNDED} FROM micro"""
)
def token_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ev.confusion_counts(_token_pairs(spark, sf_dir), "actual", "predicted")
    return rounded(ev.full_report(counts, exclude=["O"], micro=True))


@register(
    f"""WITH {_TOKEN_PAIRS} SELECT doc_id, pos, token, actual, predicted FROM tp WHERE actual <> predicted
    ORDER BY doc_id, pos LIMIT 5"""
)
def token_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ev.error_examples(_token_pairs(spark, sf_dir), "actual", "predicted", ["doc_id", "pos"], 5)
    return found.withColumn("pos", F.col("pos").cast("long"))


def _candidates(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two rule-based candidates in order: the keyword predictor, and one that never says toxic.

    Every metric and matrix reads the counts again, so they are written once, and the texts are read once for both.
    """
    return _candidate_counts(keyword_predictions(spark, sf_dir))


def _candidate_counts(rows: DataFrame) -> dict[str, DataFrame]:
    counts = stored(ev.confusion_counts(rows, "actual", "predicted"), "confusion")
    never = counts.groupBy("actual").agg(F.sum("n").alias("n")).select("actual", F.lit("fine").alias("predicted"), "n")
    return {"never": never, "keywords": counts}


_CANDIDATE_ROWS = f"""{_PREDICTED},
      cand AS (SELECT 0 AS candidate_order, 'never' AS candidate, actual, 'fine' AS predicted FROM pr
        UNION ALL SELECT 1, 'keywords', actual, predicted FROM pr),
      cl AS (SELECT DISTINCT candidate, candidate_order, actual AS label FROM cand
        UNION SELECT DISTINCT candidate, candidate_order, predicted FROM cand),
      cb AS (SELECT cl.candidate, cl.candidate_order, label,
          count(*) FILTER (c.actual = label AND c.predicted = label) AS tp,
          count(*) FILTER (c.predicted = label) AS np, count(*) FILTER (c.actual = label) AS support
        FROM cl JOIN cand c ON c.candidate = cl.candidate GROUP BY ALL),
      cm AS (SELECT candidate, candidate_order, sum(tp) / sum(support) AS accuracy, avg(2 * tp / (np + support)) AS f1_macro
        FROM cb GROUP BY ALL)"""


@register(
    f"""WITH {_CANDIDATE_ROWS} SELECT candidate, candidate_order, round(accuracy, 6) AS accuracy,
      round(f1_macro, 6) AS f1_macro FROM cm ORDER BY f1_macro DESC, candidate_order LIMIT 1"""
)
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = None
    for order, (name, counts) in enumerate(_candidates(spark, sf_dir).items()):
        each = ev.report_metrics(counts).select(F.lit(name).alias("candidate"), F.lit(order).alias("candidate_order"), "*")
        rows = each if rows is None else rows.unionByName(each)
    best = ev.best_candidate(rows)
    return best.withColumn("accuracy", F.round("accuracy", 6)).withColumn("f1_macro", F.round("f1_macro", 6))


def _evaluation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metrics, matrices and errors of the two candidates, through report files."""
    # The predictions are read for the counts and for the wrong rows; without texts they are short.
    rows = stored(keyword_predictions(spark, sf_dir), "predictions")
    best, report, matrices = compare("toxic", _candidate_counts(rows))
    wrong = rows if best == "keywords" else rows.withColumn("predicted", F.lit("fine"))
    errors = with_text(spark, sf_dir, ev.error_examples(wrong, "actual", "predicted", ["doc_id"], 5))
    path = shared_dir(spark, "evaluation")
    write_evaluation(path, report, matrices, errors.select(F.lit("toxic").alias("task"), "text", "actual", "predicted"))
    return read_evaluation(spark, path)


_WINNER = f"""{_CANDIDATE_ROWS}, win AS (SELECT candidate FROM cm ORDER BY f1_macro DESC, candidate_order LIMIT 1),
      best AS (SELECT actual, predicted FROM cand WHERE candidate = (SELECT candidate FROM win))"""


@register(
    f"""WITH {_WINNER}, {report_sql('best')}
    SELECT 'toxic' AS task, {_ROUNDED} FROM rep UNION ALL SELECT 'toxic' AS task, {_ROUNDED} FROM avgs"""
)
def report_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard table: rows of the better candidate, without its accuracy row."""
    return rounded(best_rows(_evaluation(spark, sf_dir)[0]))


@register(
    f"""WITH {_WINNER}, a AS (SELECT DISTINCT actual FROM pr), c AS (SELECT DISTINCT candidate FROM cand)
    SELECT 'toxic' AS task, c.candidate, c.candidate = (SELECT candidate FROM win) AS is_best, a.actual, b.actual AS predicted,
      (SELECT count(*) FROM cand x WHERE x.candidate = c.candidate AND x.actual = a.actual AND x.predicted = b.actual) AS n
    FROM c, a, a b"""
)
def report_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion matrices of every candidate, read back from the report."""
    return _evaluation(spark, sf_dir)[1]


@register(
    f"""WITH {_WINNER}, pb AS (SELECT doc_id, text, actual,
        CASE WHEN (SELECT candidate FROM win) = 'never' THEN 'fine' ELSE predicted END AS predicted FROM pr)
    SELECT 'toxic' AS task, text, actual, predicted FROM pb WHERE actual <> predicted ORDER BY doc_id LIMIT 5"""
)
def report_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrong rows of the best candidate, read back from the report."""
    return _evaluation(spark, sf_dir)[2]
