"""Classifiers, the token tagger and scoring, in batch and on a stream."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.catalog import sql as Q
from reviewlens.catalog.corpora import TOKEN_LABELS, corpus, whole_corpus
from reviewlens.catalog.registry import SEED, SLANG, STOPWORDS, labelled, register, table, turns
from reviewlens.functions import bio as B, text as T
from reviewlens.operators.classifier import certificate as classifier_certificate, fit_classifier, logistic_regression
from reviewlens.operators.features import TfidfStages, class_weights
from reviewlens.operators.joint_tagger import certificate, fit_joint_tagger
from reviewlens.operators.sampling import stratified_split
from reviewlens.operators.tagger import Tagger, decode_paths, fit_tagger, tag_tokens, token_probabilities
from reviewlens.plans.scoring import analyse_reviews, prediction_counts, score_reviews, tag_reviews
from reviewlens.plans.training import train_and_evaluate, train_tagger
from reviewlens.session import shared_dir, stored
from reviewlens.sources.writers import load_models, save_models, write_tagger_report
from reviewlens.streaming.scoring import count_stream, read_arriving, read_totals, score_stream, tag_stream


def naive_bayes_sql(tag: str, train: str, label: str, score: str, key: str, text: str = "text") -> str:
    """CTEs that end in ``{tag}_out (key, predicted)``: TF-IDF and naive Bayes step by step."""
    chain = ", ".join(
        [
            Q.terms(train, key, text),
            Q.idf(train),
            Q.weights(key),
            f"""sums AS (SELECT {label} AS label, term, sum(weight) AS w FROM tfidf t JOIN {train} s ON s.{key} = t.{key}
                  GROUP BY ALL),
              size AS (SELECT count(*) AS v FROM vocab),
              cls AS (SELECT label, ln(n / sum(n) OVER ()) AS prior, coalesce(w, 0) AS w FROM
                  (SELECT {label} AS label, count(*) AS n FROM {train} GROUP BY ALL) LEFT JOIN
                  (SELECT label, sum(w) AS w FROM sums GROUP BY label) USING (label))""",
        ]
    )
    seen = (
        Q.terms(score, key, text).replace("ws AS", "ws2 AS").replace("FROM ws)", "FROM ws2)")
        .replace("ts AS", "ts2 AS").replace("FROM ts ", "FROM ts2 ").replace("tf AS (SELECT", "tf2 AS (SELECT")
    )
    out = f"""{chain}, {seen}, {Q.weights(key, "tf2", "test")},
      scored AS (SELECT d.{key}, c.label, any_value(c.prior) + coalesce(sum(t.weight *
          (ln(coalesce(s.w, 0) + 1) - ln(c.w + v))), 0) AS score
        FROM (SELECT {key} FROM {score}) d CROSS JOIN cls c CROSS JOIN size LEFT JOIN test t ON t.{key} = d.{key}
        LEFT JOIN sums s ON s.label = c.label AND s.term = t.term GROUP BY d.{key}, c.label),
      out AS (SELECT {key}, arg_max(label, score) AS predicted FROM scored GROUP BY {key})"""
    return f"{tag}_out AS (WITH {out} SELECT * FROM out)"


_SPLIT = f"""{Q.stratified('documents', 'lang', 'doc_id')},
      tr AS (SELECT d.doc_id, d.lang, d.text FROM documents d JOIN split s ON s.doc_id = d.doc_id WHERE NOT is_test),
      te AS (SELECT d.doc_id, d.lang, d.text FROM documents d JOIN split s ON s.doc_id = d.doc_id WHERE is_test)"""


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    split = stratified_split(docs, "lang", 0.2, "doc_id", SEED)
    return split.where("NOT is_test").drop("is_test"), split.where("is_test").drop("is_test")


@register(
    f"""WITH {_SPLIT}, {naive_bayes_sql('nb', 'tr', 'lang', 'te', 'doc_id')}
    SELECT te.doc_id, te.lang, predicted FROM te JOIN nb_out USING (doc_id)"""
)
def nb_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes on the train part, predictions for the test part."""
    train, test = _split(spark, sf_dir)
    return fit_classifier(train, "lang", "naive_bayes", out="predicted").transform(test).drop("text")


@register(
    f"""WITH {_SPLIT}, {naive_bayes_sql('nb', 'tr', 'lang', 'te', 'doc_id')}
    SELECT te.doc_id, te.lang, predicted FROM te JOIN nb_out USING (doc_id)"""
)
def model_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``nb_scores``, with the model stored and loaded in between."""
    train, test = _split(spark, sf_dir)
    path = shared_dir(spark, "models")
    save_models(path, language=fit_classifier(train, "lang", "naive_bayes", out="predicted"))
    return load_models(path, "language")["language"].transform(test).drop("text")


@register()
def lr_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``nb_scores`` with balanced logistic regression."""
    train, test = _split(spark, sf_dir)
    model = fit_classifier(train, "lang", "logistic_regression", out="predicted")
    return model.transform(test).drop("text")


@register()
def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both learners on the same split, with all their metrics."""
    docs = table(spark, sf_dir, "documents")
    return train_and_evaluate(docs, "lang", "doc_id", "lang").report


@register(
    f"""WITH {_SPLIT} SELECT lang AS label, count(*) AS n, 0.0::DOUBLE AS left_over FROM tr
    WHERE lang IS NOT NULL GROUP BY lang"""
)
def lr_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fitted regression is at its optimum: of the gradient at the start less than half a hundredth is left for any class."""
    train = stored(_split(spark, sf_dir)[0], "train")
    model = fit_classifier(train, "lang", "logistic_regression", out="predicted", tol=1e-7)
    proof = classifier_certificate(train, "lang", model, "predicted")
    # Adding 0 turns a rounded -0.0 into 0.0.
    left = F.round(F.try_divide("largest", "start"), 2) + 0.0
    return proof.select("label", "n", left.alias("left_over"))


def _models(spark: SparkSession, sf_dir: str) -> dict[str, PipelineModel]:
    """Language and quality models on preprocessed text."""
    clean = T.preprocess(F.col("text"), SLANG, STOPWORDS)
    docs = labelled(spark, sf_dir).select("doc_id", "lang", "quality", clean.alias("clean_text"))
    docs = docs.withColumn("quality", F.col("quality").cast("string")).persist()
    try:
        tfidf = TfidfStages.fit_text(docs, F.col("clean_text"))
        return {
            "aspect": fit_classifier(docs, "lang", text="clean_text", out="predicted_aspect", tfidf=tfidf),
            "sentiment": fit_classifier(docs, "quality", text="clean_text", out="predicted_sentiment", tfidf=tfidf),
        }
    finally:
        docs.unpersist()


def _scored_sql(source: str, key: str, columns: str) -> str:
    train = Q.stages("documents", "doc_id", SLANG, STOPWORDS)
    test = Q.stages(source, key, SLANG, STOPWORDS)
    for i in "1234":
        test = test.replace(f"s{i} ", f"z{i} ").replace(f"FROM s{i})", f"FROM z{i})")
    return f"""WITH {train}, {test},
      fit AS (SELECT s4.doc_id AS {key}, lang, quality::VARCHAR AS quality, clean FROM s4
        JOIN documents d ON d.doc_id = s4.doc_id JOIN labels l ON l.doc_id = s4.doc_id),
      sc AS (SELECT {key}, raw AS text, CASE WHEN trim(clean) = '' THEN lower(raw) ELSE clean END AS clean FROM z4),
      {naive_bayes_sql('a', 'fit', 'lang', 'sc', key, 'clean')},
      {naive_bayes_sql('b', 'fit', 'quality', 'sc', key, 'clean')}
    SELECT {columns}, a_out.predicted AS predicted_aspect, b_out.predicted AS predicted_sentiment
    FROM sc JOIN a_out ON a_out.{key} = sc.{key} JOIN b_out ON b_out.{key} = sc.{key}"""


@register(_scored_sql("documents", "doc_id", "sc.doc_id"))
def batch_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_reviews(docs, _models(spark, sf_dir), slang=SLANG, stopwords=STOPWORDS)
    return scored.drop("text")


@register(
    f"""WITH s AS ({_scored_sql("documents", "doc_id", "sc.doc_id")})
    SELECT 'predicted_aspect' AS target, predicted_aspect AS value, count(*) AS count FROM s GROUP BY ALL
    UNION ALL SELECT 'predicted_sentiment', predicted_sentiment, count(*) FROM s GROUP BY ALL"""
)
def predicted_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of a scored batch."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_reviews(docs, _models(spark, sf_dir), slang=SLANG, stopwords=STOPWORDS)
    return prediction_counts(scored, ["predicted_aspect", "predicted_sentiment"])


_TURNS = "(SELECT conv_id * 1000000 + turn AS turn_id, text FROM conversations)"
_TURN_SCORES = _scored_sql(_TURNS, "turn_id", "sc.turn_id, sc.clean AS clean_text")


def _numbered_turns(conversations: DataFrame) -> DataFrame:
    return conversations.select((F.col("conv_id") * 1000000 + F.col("turn")).alias("turn_id"), "text")


@register(_TURN_SCORES)
def joint_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two independent models on new texts, with the text they saw."""
    rows = _numbered_turns(table(spark, sf_dir, "conversations"))
    scored = score_reviews(rows, _models(spark, sf_dir), slang=SLANG, stopwords=STOPWORDS, keep_clean=True)
    return scored.drop("text")


@register(_TURN_SCORES)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``joint_score``, with the texts read as a stream of files."""
    schema = table(spark, sf_dir, "conversations").schema
    # A glob, for the table is one file or a folder of them, and a stream takes only folders by their plain name.
    arriving = read_arriving(spark, f"{sf_dir}/{{conversations.parquet}}", schema)
    base = shared_dir(spark, "stream-score")
    query = score_stream(
        _numbered_turns(arriving), _models(spark, sf_dir), f"{base}/scored", f"{base}/checkpoint",
        slang=SLANG, stopwords=STOPWORDS, keep_clean=True,
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/scored").drop("text")


@register(
    f"""WITH s AS ({_TURN_SCORES})
    SELECT 'predicted_aspect' AS target, predicted_aspect AS value, count(*) AS count FROM s GROUP BY ALL
    UNION ALL SELECT 'predicted_sentiment', predicted_sentiment, count(*) FROM s GROUP BY ALL"""
)
def stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals of scored turns that arrive in two deliveries; the stream ends and starts again in between."""
    rows, models = _numbered_turns(table(spark, sf_dir, "conversations")), _models(spark, sf_dir)
    base = shared_dir(spark, "stream-totals")
    for delivery in range(2):
        rows.where(F.pmod(F.xxhash64("turn_id"), F.lit(2)) == delivery).write.mode("append").parquet(f"{base}/in")
        scored = score_reviews(read_arriving(spark, f"{base}/in", rows.schema), models, slang=SLANG, stopwords=STOPWORDS)
        count_stream(scored, ["predicted_aspect", "predicted_sentiment"], f"{base}/totals", f"{base}/checkpoint").awaitTermination()
    return read_totals(spark, f"{base}/totals")


def _tagger(spark: SparkSession, sf_dir: str) -> Tagger:
    return fit_tagger(corpus(spark, sf_dir))


def _turn_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns(spark, sf_dir).select("doc_id", B.ner_tokenize(F.col("text")).alias("tokens"))


@register()
def tagger_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most likely label of every token on its own."""
    tagger = _tagger(spark, sf_dir)
    rows = token_probabilities(_turn_tokens(spark, sf_dir), "doc_id", "tokens", tagger)
    names = F.array(*[F.lit(x) for x in tagger.labels])
    best = F.get(names, F.array_position("probs", F.array_max("probs")).cast("int") - 1)
    return rows.select("doc_id", "pos", "token", best.alias("label"), F.round(F.array_max("probs"), 4).alias("prob"))


@register()
def tagger_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best label path of every turn."""
    tagged = tag_tokens(_turn_tokens(spark, sf_dir), "doc_id", "tokens", _tagger(spark, sf_dir))
    return tagged.select("doc_id", F.array_join("tokens", " ").alias("tokens"), F.array_join("labels", " ").alias("labels"))


@register()
def tagger_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token corpus split by sentence, a tagger trained on one part and reported on the other, through report files."""
    done = train_tagger(corpus(spark, sf_dir), "doc_id")
    path = shared_dir(spark, "tagger-report")
    write_tagger_report(path, done.report, done.accuracy)
    entities = spark.read.schema(done.report.schema).json(f"{path}/entities")
    accuracy = spark.read.schema(done.accuracy.schema).json(f"{path}/accuracy")
    whole = accuracy.select(
        F.lit("accuracy").alias("label"), *[F.col("accuracy").alias(c) for c in ("precision", "recall", "f1_score")], F.col("rows").alias("support")
    )
    return entities.unionByName(whole)


@register()
def joint_tagger_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``tagger_report``, with emissions and transitions trained as one model."""
    return train_tagger(corpus(spark, sf_dir), "doc_id", fit=fit_joint_tagger).report


@register(f"SELECT label, count(*) AS tokens, 0.0::DOUBLE AS largest FROM ({TOKEN_LABELS}) GROUP BY label")
def tagger_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The jointly trained tagger is at its optimum: no subgradient of a label's weights over the whole corpus is above 0."""
    sentences = stored(whole_corpus(spark, sf_dir), "corpus")
    tagger = fit_joint_tagger(sentences, c1=0.1, c2=0.1, tol=2e-4, max_iter=300)
    proof = certificate(sentences, tagger, 0.1, 0.1)
    # Adding 0 turns a rounded -0.0 into 0.0.
    return proof.select("label", "tokens", (F.round("largest", 3) + 0.0).alias("largest"))


@register()
def analysed_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes and entities of every turn from one call."""
    found = analyse_reviews(turns(spark, sf_dir).drop("role"), "doc_id", _models(spark, sf_dir), _tagger(spark, sf_dir), slang=SLANG, stopwords=STOPWORDS)
    shown = F.transform("entities", lambda e: F.concat_ws("/", e["text"], e["type"]))
    return found.select("doc_id", "predicted_aspect", "predicted_sentiment", F.array_join(shown, "; ").alias("entities"))


@register()
def tagged_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole entities of every turn, and the highlighted text."""
    tagged = tag_reviews(turns(spark, sf_dir), "doc_id", _tagger(spark, sf_dir))
    shown = F.transform("entities", lambda e: F.concat_ws("/", e["text"], e["type"]))
    return tagged.select("doc_id", F.array_join(shown, "; ").alias("entities"), "highlighted")


@register("SELECT count(*) AS turns, 0 AS only_streamed, 0 AS only_in_batch FROM conversations")
def stream_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, labels, entities and highlighting of every turn on a stream of files, compared with those of the batch plan."""
    rows, tagger = _numbered_turns(table(spark, sf_dir, "conversations")), _tagger(spark, sf_dir)
    base = shared_dir(spark, "stream-tags")
    rows.write.parquet(f"{base}/in")
    tag_stream(read_arriving(spark, f"{base}/in", rows.schema), "turn_id", tagger, f"{base}/tagged", f"{base}/checkpoint").awaitTermination()
    streamed = spark.read.parquet(f"{base}/tagged")
    digest = F.xxhash64("turn_id", "tokens", "labels", F.to_json("entities"), "highlighted").alias("digest")
    seen = streamed.select(digest, F.lit(1).alias("s"), F.lit(0).alias("b"))
    seen = seen.unionByName(tag_reviews(rows, "turn_id", tagger).select(digest, F.lit(0).alias("s"), F.lit(1).alias("b")))
    counts = seen.groupBy("digest").agg(F.sum("s").alias("s"), F.sum("b").alias("b"))
    return counts.agg(
        F.sum("s").alias("turns"), F.sum(F.greatest(F.col("s") - F.col("b"), F.lit(0))).alias("only_streamed"),
        F.sum(F.greatest(F.col("b") - F.col("s"), F.lit(0))).alias("only_in_batch"),
    )


_LR = """
      d AS (SELECT ln(n_chars + 1) AS x, quality::DOUBLE AS y,
              (SELECT count(*) FROM labels) / (2.0 * count(*) OVER (PARTITION BY quality)) AS w
            FROM documents JOIN labels USING (doc_id)),
      total AS (SELECT sum(w) AS sw, 1.0 / count(*) AS penalty FROM d),
      fit(k, a, b) AS (
        SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE
        UNION ALL
        SELECT k + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
        FROM (SELECT k, a, b, sum(w * (p - y) * x) / any_value(sw) + any_value(penalty) * a AS ga, sum(w * (p - y)) / any_value(sw) AS gb,
                sum(w * p * (1 - p) * x * x) / any_value(sw) + any_value(penalty) AS haa,
                sum(w * p * (1 - p) * x) / any_value(sw) AS hab, sum(w * p * (1 - p)) / any_value(sw) AS hbb
              FROM (SELECT f.k, f.a, f.b, d.*, total.*, 1 / (1 + exp(-(f.a * x + f.b))) AS p FROM fit f, d, total WHERE k < 25)
              GROUP BY k, a, b))"""


@register(f"WITH RECURSIVE {_LR} SELECT round(a, 3) AS weight, round(b, 2) AS intercept FROM fit ORDER BY k DESC LIMIT 1")
def lr_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced regression of quality on the log length: weights, penalty and intercept against Newton steps."""
    rows = labelled(spark, sf_dir).select("quality", F.array(F.log(F.col("n_chars") + 1)).alias("x"))
    weights = class_weights(rows, "quality").select("quality", "weight", "n")
    n = weights.agg(F.sum("n")).first()[0]
    ready = rows.join(F.broadcast(weights), "quality").select(
        array_to_vector("x").alias("features"), F.col("quality").cast("double").alias("label"), "weight"
    )
    model = logistic_regression(n, tol=1e-12).setParams(weightCol="weight").fit(ready.coalesce(1 + n // 20_000))
    # One row, made from the fitted numbers.
    values = [F.round(F.lit(float(x)), d) for x, d in ((model.coefficients[0], 3), (model.intercept, 2))]
    return weights.limit(1).select(values[0].alias("weight"), values[1].alias("intercept"))


# A tagger with fixed label statistics; its token scores come from hashes, so SQL can repeat them.
_PATH_LABELS = ["B", "I", "O"]
_START, _STEP = [-1.31, -5.17, -0.43], [[-2.03, -0.71, -1.13], [-1.93, -0.61, -0.97], [-1.21, -6.07, -0.37]]
_HASH_TURNS = "(SELECT conv_id * 1000000 + turn AS doc_id, CASE WHEN turn % 3 = 2 THEN ' ' ELSE text END AS text FROM conversations)"
_EMIT = "ln((('0x' || substr(md5(concat({y}, t[i])), 1, 4))::INT + 1) / 65537.0)"


@register(
    f"""WITH RECURSIVE a AS (SELECT doc_id, {Q.tokens('text')} AS t FROM {_HASH_TURNS}),
      e AS MATERIALIZED (SELECT doc_id, i, y, {_EMIT.format(y='y')} AS s FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM a),
              (SELECT unnest([1, 2, 3]) AS y)),
      best(doc_id, i, y, score, path) AS (
        SELECT doc_id, 1::BIGINT, y, {_START}[y]::DOUBLE + s, {_PATH_LABELS}[y] FROM e WHERE i = 1
        UNION ALL
        SELECT doc_id, i, y, m.score + s, m.path || ' ' || {_PATH_LABELS}[y] FROM (
          SELECT e.doc_id, e.i, e.y, any_value(e.s) AS s,
            max(struct_pack(score := b.score + {_STEP}[b.y][e.y]::DOUBLE, path := b.path)) AS m
          FROM best b JOIN e ON e.doc_id = b.doc_id AND e.i = b.i + 1 GROUP BY e.doc_id, e.i, e.y)),
      done AS (SELECT doc_id, arg_max(path, score) AS path FROM best b
        WHERE i = (SELECT max(i) FROM e WHERE e.doc_id = b.doc_id) GROUP BY doc_id)
    SELECT a.doc_id, array_to_string(t, ' ') AS tokens, coalesce(path, '') AS labels FROM a LEFT JOIN done USING (doc_id)"""
)
def best_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best label paths over hashed token scores; every third turn is blank and keeps its row."""
    turns_ = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000000 + F.col("turn")).alias("doc_id"), F.when(F.col("turn") % 3 == 2, " ").otherwise(F.col("text")).alias("text")
    )
    rows = turns_.select("doc_id", F.posexplode_outer(B.ner_tokenize(F.col("text"))).alias("pos", "token"))
    score = lambda y: (F.conv(F.substring(F.md5(F.concat(F.lit(str(y)), "token")), 1, 4), 16, 10).cast("double") + 1) / 65537.0
    probs = F.transform(F.array(*[score(y) for y in (1, 2, 3)]), lambda p: F.coalesce(p, F.lit(1.0)))
    fixed = Tagger(None, _PATH_LABELS, [0.0] * 3, _START, _STEP)
    paths = decode_paths(rows.select("doc_id", "pos", "token", probs.alias("probs")), "doc_id", fixed)
    return paths.select("doc_id", F.array_join("tokens", " ").alias("tokens"), F.array_join("labels", " ").alias("labels"))
