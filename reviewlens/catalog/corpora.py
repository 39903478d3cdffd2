"""Token features, entities and the weakly labelled token corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewlens.catalog import sql as Q
from reviewlens.catalog.registry import KEYWORDS, SEED, TURN_KEYWORDS, register, table, turns
from reviewlens.catalog.text import keyword_labels_sql
from reviewlens.functions import bio as B, text as T
from reviewlens.functions.fixed_values import TEMPLATES
from reviewlens.operators.tagger import transition_counts
from reviewlens.plans import corpora as plans
from reviewlens.sources.readers import sentences

TURNS = "(SELECT conv_id || '-' || turn AS doc_id, role, text FROM conversations)"

_TITLE = (
    r"(regexp_matches({w}, '[\p{Lu}\p{Lt}]') AND NOT regexp_matches({w}, '(^|[^\p{Lu}\p{Lt}\p{Ll}])\p{Ll}') "
    r"AND NOT regexp_matches({w}, '[\p{Lu}\p{Lt}\p{Ll}][\p{Lu}\p{Lt}]'))"
)
_UPPER = r"(regexp_matches(w, '\p{Lu}') AND NOT regexp_matches(w, '[\p{Ll}\p{Lt}]'))"


@register(
    f"""WITH a AS (SELECT doc_id, {Q.tokens('text')} AS t FROM {TURNS}),
      u AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS i, t FROM a),
      f AS (SELECT doc_id, i - 1 AS pos, t[i] AS w, i = 1 AS bos, i = len(t) AS eos FROM u),
      g AS (SELECT *, lower(w) AS lower, {_TITLE.replace('{w}', 'w')} AS is_title FROM f)
    SELECT doc_id, pos, 1.0::DOUBLE AS bias, lower, right(w, 3) AS suffix, {_UPPER} AS is_upper, is_title,
      regexp_matches(w, '^\\p{{Nd}}+$') AS is_digit,
      lag(lower) OVER s AS prev_lower, lag(is_title) OVER s AS prev_is_title,
      lead(lower) OVER s AS next_lower, lead(is_title) OVER s AS next_is_title, bos, eos
    FROM g WINDOW s AS (PARTITION BY doc_id ORDER BY pos)"""
)
def token_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns(spark, sf_dir).select("doc_id", B.ner_tokenize(F.col("text")).alias("tokens"))
    features = rows.select("doc_id", F.inline(B.token_features(F.col("tokens"))))
    return features.withColumn("pos", F.col("pos").cast("long"))


_HASHED = ["B-HOTEL", "B-HOTEL", "I-HOTEL", "I-HOTEL", "I-HOTEL", "B-LOC", "I-LOC", "B-ASPECT", "I-ASPECT"]


def hashed_labels(tokens: Column) -> Column:
    """Repeatable labels of every kind, orphans included."""
    digit = F.transform(tokens, lambda t: F.conv(F.substring(F.md5(t), 1, 1), 16, 10).cast("int"))
    options = F.array(*[F.lit(x) for x in _HASHED])
    return F.transform(digit, lambda d: F.coalesce(F.get(options, d), F.lit("O")))


@register(
    f"""WITH a AS (SELECT doc_id, {Q.tokens('text')} AS t FROM documents),
      u AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS i, t FROM a),
      l AS (SELECT doc_id, i - 1 AS pos, t[i] AS token,
              coalesce({_HASHED}[('0x' || substr(md5(t[i]), 1, 1))::INT + 1], 'O') AS label FROM u),
      p AS (SELECT *, lag(label) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM l),
      b AS (SELECT *, CASE WHEN label LIKE 'I-%' AND substr(label, 3) = substr(prev, 3) AND prev <> 'O' THEN 0 ELSE 1 END AS opens
            FROM p),
      r AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM b)
    SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS text, substr(arg_min(label, pos), 3) AS type,
      min(pos) AS "start", max(pos) + 1 AS "end" FROM r GROUP BY doc_id, run HAVING arg_min(label, pos) LIKE 'B-%'"""
)
def bio_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", B.ner_tokenize(F.col("text")).alias("tokens"))
    tagged = docs.withColumn("labels", hashed_labels(F.col("tokens")))
    found = tagged.select("doc_id", F.inline(B.bio_decode(F.col("tokens"), F.col("labels"))))
    return found.withColumn("start", F.col("start").cast("long")).withColumn("end", F.col("end").cast("long"))


@register(
    f"""WITH {keyword_labels_sql('documents', 'doc_id', 'lang', KEYWORDS, Q.words('text'))},
      u AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS i, t, labels FROM kw)
    SELECT doc_id, t[i] AS token, arg_max(labels[i], i) AS label FROM u GROUP BY doc_id, t[i]"""
)
def token_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("t", T.split_words(F.col("text")))
    tagged = docs.withColumn("labels", B.keyword_bio_tag(F.col("t"), F.col("lang"), KEYWORDS))
    pairs = tagged.select("doc_id", F.explode(B.token_label_map(F.col("t"), F.col("labels"))))
    return pairs.toDF("doc_id", "token", "label")


def _wrapped_sql(source: str) -> str:
    """CTE ``wr`` with ``doc_id, role, text, hotel, loc, sentence``; parts name the hotels, nations the places."""
    options = "[" + ", ".join(f"'{t}'" for t in TEMPLATES) + "]"
    return f"""
      picked AS (SELECT *, {Q.pick('doc_id', '42:hotel', '(SELECT count(*) FROM part)')} AS h,
                   {Q.pick('doc_id', '42:loc', '(SELECT count(*) FROM nation)')} AS l,
                   {options}[1 + {Q.pick('doc_id', '42:template', str(len(TEMPLATES)))}] AS template FROM {source}),
      wr AS (SELECT doc_id, role, text, p_name AS hotel, n_name AS loc,
               replace(replace(replace(template, '{{hotel}}', p_name), '{{loc}}', n_name), '{{snippet}}', text) AS sentence
             FROM picked JOIN part ON p_partkey = h JOIN nation ON n_nationkey = l)"""


def _gazetteers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("idx"), F.col("p_name").alias("value"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("idx"), F.col("n_name").alias("value"))
    return parts, nations


def _wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.wrap_snippets(turns(spark, sf_dir), "doc_id", "text", *_gazetteers(spark, sf_dir), TEMPLATES, SEED)


@register(f"WITH {_wrapped_sql(TURNS)} SELECT doc_id, hotel, loc, sentence FROM wr")
def template_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wrapped(spark, sf_dir).select("doc_id", "hotel", "loc", "sentence")


# Every phrase here has two different words, so a match cannot overlap itself.
_SPANS = f"""
      sp0 AS (SELECT doc_id, hotel, loc, {Q.words('sentence')} AS t FROM wr),
      sp1 AS (SELECT doc_id, loc, t, unnest(range(1, len(t) + 1)) AS i, string_split(hotel, ' ') AS h FROM sp0),
      sp AS (SELECT doc_id, i - 1 AS pos, t[i] AS token, CASE WHEN t[i] = h[1] AND t[i + 1] = h[2] THEN 'B-HOTEL'
               WHEN i > 1 AND t[i - 1] = h[1] AND t[i] = h[2] THEN 'I-HOTEL' WHEN t[i] = loc THEN 'B-LOC' END AS span
             FROM sp1)"""


@register(f"WITH {_wrapped_sql(TURNS)}, {_SPANS} SELECT doc_id, pos, token, span FROM sp WHERE span IS NOT NULL")
def gazetteer_bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _wrapped(spark, sf_dir).withColumn("t", T.split_words(F.col("sentence")))
    spans = B.gazetteer_span_tag(F.col("t"), F.col("hotel"), F.col("loc"))
    pairs = rows.select(
        "doc_id", F.posexplode(F.arrays_zip(F.col("t").alias("token"), spans.alias("span")))
    ).select("doc_id", F.col("pos").cast("long").alias("pos"), "col.token", "col.span")
    return pairs.where("span IS NOT NULL")


def _corpus_sql(source: str) -> str:
    return f"""WITH {_wrapped_sql(source)}, {_SPANS},
      {keyword_labels_sql('wr', 'doc_id', 'role', TURN_KEYWORDS, Q.words('text'))},
      ku AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS i, t, labels FROM kw),
      known AS (SELECT doc_id, t[i] AS token, arg_max(labels[i], i) AS label FROM ku GROUP BY doc_id, t[i])
    SELECT s.doc_id, s.pos, s.token, coalesce(span, label, 'O') AS label
    FROM sp s LEFT JOIN known k ON k.doc_id = s.doc_id AND k.token = trim(s.token, ',.:')"""


def _long(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pos", F.col("pos").cast("long"))


@register(_corpus_sql(TURNS))
def project_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token labels of all turns."""
    corpus = plans.label_sentences(_wrapped(spark, sf_dir), "doc_id", "text", "role", TURN_KEYWORDS)
    return _long(plans.bio_table(corpus, "doc_id"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sampled token corpus of 400 sentences."""
    parts, nations = _gazetteers(spark, sf_dir)
    return plans.build_bio_corpus(
        turns(spark, sf_dir), "doc_id", "text", "role", TURN_KEYWORDS, parts, nations, TEMPLATES, 400, SEED
    )


def whole_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The token corpus of every turn."""
    return plans.label_sentences(_wrapped(spark, sf_dir), "doc_id", "text", "role", TURN_KEYWORDS)


TOKEN_LABELS = _corpus_sql(TURNS)


@register(
    f"""SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS tokens, string_agg(label, ' ' ORDER BY pos) AS labels
    FROM ({TOKEN_LABELS}) GROUP BY doc_id"""
)
def sentence_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token rows gathered into sentences, and the tokens and labels of each."""
    found = sentences(plans.bio_table(whole_corpus(spark, sf_dir), "doc_id"))
    lists = {"tokens": B.tokens_of(F.col("sentence")), "labels": B.labels_of(F.col("sentence"))}
    return found.select("doc_id", *[F.array_join(x, " ").alias(name) for name, x in lists.items()])


SAMPLED = f"(SELECT * FROM {TURNS} ORDER BY {Q.first_of('doc_id')} LIMIT 400)"


@register(_corpus_sql(SAMPLED))
def bio_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _long(plans.bio_table(corpus(spark, sf_dir), "doc_id"))


@register(
    f"""WITH b AS ({_corpus_sql(TURNS)}),
      p AS (SELECT label, lag(label) OVER (PARTITION BY doc_id ORDER BY pos) AS prev FROM b)
    SELECT prev, label, count(*) AS n FROM p GROUP BY prev, label"""
)
def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = plans.label_sentences(_wrapped(spark, sf_dir), "doc_id", "text", "role", TURN_KEYWORDS)
    return transition_counts(labelled, "labels")


@register(
    f"""WITH {keyword_labels_sql('documents', 'doc_id', 'lang', KEYWORDS, Q.tokens('text'))}
    SELECT doc_id, {Q.joined('t')} AS tokens, {Q.joined('labels')} AS labels FROM kw WHERE len(t) > 0"""
)
def sentence_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences gathered from the token table, taken apart into tokens and labels again."""
    docs = table(spark, sf_dir, "documents").withColumn("tokens", B.ner_tokenize(F.col("text")))
    tagged = docs.withColumn("labels", B.keyword_bio_tag(F.col("tokens"), F.col("lang"), KEYWORDS))
    gathered = sentences(plans.bio_table(tagged, "doc_id"))
    parts = [F.array_join(f(F.col("sentence")), " ").alias(n) for f, n in ((B.tokens_of, "tokens"), (B.labels_of, "labels"))]
    return gathered.select("doc_id", *parts)
