"""Text functions, joins on words and similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reviewlens.catalog import sql as Q
from reviewlens.catalog.registry import (
    INSULTS, KEYWORDS, SLANG, STEMS, STOPWORDS, register, table,
)
from reviewlens.functions import bio as B, text as T
from reviewlens.operators import joins, labels, similarity


def _documents(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *[c.alias(n) for n, c in columns.items()])


@register("SELECT doc_id, lower(text) AS folded FROM documents")
def case_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, folded=T.case_folding(F.col("text")))


_PLAIN = "abcdefghijklmnopqrstuvwxyz"


@register("SELECT doc_id, text AS normalized FROM documents")
def nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose plain small letters were widened; composition takes them back."""
    wide = F.translate("text", _PLAIN, "".join(chr(ord(c) + 0xFEE0) for c in _PLAIN))
    return _documents(spark, sf_dir, normalized=T.normalize_nfkc(wide))


@register(f"SELECT doc_id, {Q.strip_urls('text')} AS stripped FROM documents")
def strip_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, stripped=T.strip_urls(F.col("text")))


@register(f"SELECT doc_id, {Q.strip_mentions('text')} AS stripped FROM documents")
def strip_mention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, stripped=T.strip_mentions(F.col("text")))


@register(f"SELECT doc_id, {Q.strip_hash('text')} AS stripped FROM documents")
def strip_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, stripped=T.strip_hash_signs(F.col("text")))


@register(f"SELECT doc_id, {Q.strip_symbols('text')} AS stripped FROM documents")
def strip_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, stripped=T.strip_symbols(F.col("text")))


@register(f"SELECT doc_id, {Q.collapse('text')} AS collapsed FROM documents")
def collapse_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, collapsed=T.collapse_spaces(F.col("text")))


@register(f"SELECT doc_id, {Q.clean('text')} AS cleaned FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, cleaned=T.clean_text(F.col("text")))


@register(f"SELECT doc_id, {Q.slang('lower(text)', SLANG)} AS replaced FROM documents")
def slang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, replaced=T.normalize_slang(F.lower("text"), SLANG))


@register(
    f"SELECT doc_id, {Q.joined('t')} AS tokens, len(t) AS n FROM (SELECT doc_id, {Q.tokens('lower(text)')} AS t FROM documents)"
)
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = _documents(spark, sf_dir, t=T.tokenize(F.lower("text")))
    return tokens.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").cast("long").alias("n"))


@register(
    f"SELECT doc_id, pos - 1 AS pos, t[pos] AS token FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS pos "
    f"FROM (SELECT conv_id || '-' || turn AS doc_id, {Q.tokens('text')} AS t FROM conversations))"
)
def ner_tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    key = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    exploded = turns.select(key.alias("doc_id"), F.posexplode(B.ner_tokenize(F.col("text"))))
    return exploded.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("col").alias("token"))


@register(
    f"SELECT doc_id, {Q.joined(Q.drop_words(Q.tokens('lower(text)'), STOPWORDS))} AS kept FROM documents"
)
def stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = T.remove_stopwords(T.tokenize(F.lower("text")), STOPWORDS)
    return _documents(spark, sf_dir, kept=F.array_join(kept, " "))


@register(f"WITH {Q.stages('documents', 'doc_id', SLANG, STOPWORDS)} SELECT doc_id, clean FROM s4")
def preprocess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, clean=T.preprocess(F.col("text"), SLANG, STOPWORDS))


@register(
    f"""WITH {Q.stages('documents', 'doc_id', SLANG, STOPWORDS)}
    SELECT doc_id, raw, folded AS after_case_folding, cleaned AS after_cleaning,
           replaced AS after_slang_normalization, clean AS after_stopword_removal FROM s4"""
)
def stage_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, s=T.stage_trace(F.col("text"), SLANG, STOPWORDS)).select("doc_id", "s.*")


# Ratings do not occur in the texts, so both engines write them from the line items.
_RATED = """
    CASE l_linenumber % 5 WHEN 0 THEN 'bintang ' || l_linenumber
      WHEN 1 THEN 'nilai ' || CAST(l_orderkey % 20 AS {string}) || '/5 bagus'
      WHEN 2 THEN CAST(l_orderkey % 6 AS {string}) || ',' || CAST(l_partkey % 10 AS {string}) || ' Dari  5'
      WHEN 3 THEN 'hotel ' || CAST(l_suppkey % 5 AS {string}) || '.' || CAST(l_partkey % 10 AS {string}) || 'BINTANG'
      ELSE 'rating ' || CAST(l_suppkey % 7 AS {string}) || ' / 5, dulu 1/5' END"""


@register(
    rf"""WITH t AS (SELECT l_orderkey, l_linenumber, {_RATED.format(string="VARCHAR")} AS text FROM lineitem)
    SELECT l_orderkey, l_linenumber, text,
      CAST(replace(nullif(regexp_extract(text, '(?i)(\d([.,]\d)?)\s*(/\s*5|dari\s*5|bintang)', 1), ''), ',', '.') AS DOUBLE)
        AS rating FROM t"""
)
def rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", f"{_RATED.format(string='STRING')} AS text"
    )
    return rated.withColumn("rating", T.extract_rating(F.col("text")))


_STEM_COLUMNS = ", ".join(
    f"CASE WHEN regexp_matches(lower(text), '{Q.stem_pattern(*parts)}') THEN '{name}' END"
    for name, parts in STEMS.items()
)


@register(
    f"SELECT doc_id, array_to_string(list_filter([{_STEM_COLUMNS}], lambda x: x IS NOT NULL), ',') AS aspects FROM documents"
)
def aspect_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, aspects=F.array_join(T.detect_candidate_aspects(F.col("text"), STEMS), ","))


@register(
    f"WITH {Q.stages('documents', 'doc_id', SLANG, STOPWORDS)} SELECT doc_id, len({Q.words('clean')}) AS n FROM s4"
)
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(
        spark, sf_dir, n=T.token_count(T.preprocess(F.col("text"), SLANG, STOPWORDS)).cast("long")
    )


@register("SELECT p_partkey, levenshtein(p_name, lower(p_type)) AS distance FROM part")
def levenshtein(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", T.edit_distance(F.col("p_name"), F.lower("p_type")).cast("long").alias("distance")
    )


# Without their letters most texts are only spaces and marks; without the marks too some are blank.
_LEFT = r"[\x21-\x7e]"


@register(
    f"""WITH t AS (SELECT doc_id, regexp_replace(text, '{_LEFT}', '', 'g') AS rest FROM documents)
    SELECT doc_id, rest FROM t WHERE regexp_replace(rest, '[{Q.SPACE}]+', '', 'g') <> ''"""
)
def nonblank(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = _documents(spark, sf_dir, rest=F.regexp_replace("text", _LEFT, ""))
    return labels.nonblank_rows(rest, "rest")


_TAGGED = "concat('@', p_type, CASE WHEN p_size > 25 THEN concat(' ', p_name) ELSE '' END)"


@register(
    f"""WITH t AS (SELECT p_partkey, {_TAGGED} AS text FROM part),
      {Q.stages('t', 'p_partkey', SLANG, STOPWORDS)}
    SELECT p_partkey, CASE WHEN trim(clean) = '' THEN lower(raw) ELSE clean END AS clean_text FROM s4"""
)
def clean_or_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey", f"{_TAGGED} AS text")
    clean = T.clean_or_lower(T.preprocess(F.col("text"), SLANG, STOPWORDS), F.col("text"))
    return parts.select("p_partkey", clean.alias("clean_text"))


# The check engine measures bytes, so the letters of the texts are mapped to single bytes first.
_LETTERS, _BYTES = "ßäçèéêíñóöü", "ABCDEFGHIJK"
_WORDS = rf"SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[{Q.WORD}]+')) AS word FROM"


def _nearest_sql(vocabulary: str) -> str:
    return f"""
      words AS MATERIALIZED ({_WORDS} documents),
      w AS MATERIALIZED (SELECT word, translate(word, '{_LETTERS}', '{_BYTES}') AS b FROM words),
      v AS MATERIALIZED (SELECT rank, word AS corrected, translate(word, '{_LETTERS}', '{_BYTES}') AS b FROM ({vocabulary})),
      vx AS MATERIALIZED (SELECT *, length(b) + unnest([-2, -1, 0, 1, 2]) AS len FROM v),
      near AS MATERIALIZED (SELECT * FROM (SELECT w.word, corrected, rank, levenshtein(w.b, vx.b) AS distance
               FROM w JOIN vx ON length(w.b) = vx.len) WHERE distance <= 2),
      best AS MATERIALIZED (SELECT word, arg_min(corrected, (distance, rank)) AS corrected, min(distance) AS distance FROM near GROUP BY word)
      """


#: Cosine from which texts are similar.
SIMILAR = 0.45
_VOCABULARY = [*INSULTS, "other", "then", "station", "letter", "elle", "keiten", "erlich"]
_VOCABULARY_SQL = "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{w}')" for i, w in enumerate(_VOCABULARY)) + ") x(rank, word)"


@register(
    f"""WITH {_nearest_sql(_VOCABULARY_SQL)}
    SELECT word, coalesce(corrected, word) AS corrected, distance FROM words w LEFT JOIN best b USING (word)"""
)
def typo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of the documents against a short word list."""
    words = _documents(spark, sf_dir, w=F.regexp_extract_all(F.lower("text"), F.lit(rf"[{T.WORD}]+"), F.lit(0)))
    words = words.select(F.explode("w").alias("word"))
    found = similarity.correct_words(words, similarity.vocabulary_of(_VOCABULARY, words))
    return found.withColumn("distance", F.col("distance").cast("long"))


@register(
    f"""WITH {_nearest_sql(f"SELECT word AS rank, word FROM ({_WORDS} benchmark)")}
    SELECT word, coalesce(corrected, word) AS corrected, distance FROM words w LEFT JOIN best b USING (word)"""
)
def typo_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of the documents against all words of the benchmark texts."""
    pattern = F.lit(rf"[{T.WORD}]+")
    words = _documents(spark, sf_dir, w=F.regexp_extract_all(F.lower("text"), pattern, F.lit(0)))
    known = table(spark, sf_dir, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), pattern, F.lit(0))).alias("word")
    )
    vocabulary = known.distinct().select("word", F.col("word").alias("rank"))
    found = similarity.correct_words(words.select(F.explode("w").alias("word")), vocabulary)
    return found.withColumn("distance", F.col("distance").cast("long"))


@register(
    f"""WITH {_nearest_sql(_VOCABULARY_SQL)},
      fixes AS (SELECT word, corrected FROM best WHERE word <> corrected),
      t AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM
             (SELECT doc_id, regexp_extract_all(lower(text), '[{Q.WORD}]+') AS w FROM documents)),
      fixed AS (SELECT doc_id, pos, coalesce(corrected, w[pos]) AS word FROM t LEFT JOIN fixes f ON f.word = w[pos])
    SELECT d.doc_id, coalesce(string_agg(f.word, ' ' ORDER BY pos), '') AS fixed
    FROM documents d LEFT JOIN fixed f ON d.doc_id = f.doc_id GROUP BY d.doc_id"""
)
def typo_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with every word corrected."""
    words = _documents(spark, sf_dir, w=F.regexp_extract_all(F.lower("text"), F.lit(rf"[{T.WORD}]+"), F.lit(0)))
    vocabulary = similarity.vocabulary_of(_VOCABULARY, words)
    fixed = similarity.correct_typos(words, "doc_id", "w", vocabulary, "fixed")
    return fixed.select("doc_id", F.array_join("fixed", " ").alias("fixed"))


@register(
    f"""WITH dict AS ({_WORDS} benchmark),
      t AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM
             (SELECT doc_id, {Q.words('lower(text)')} AS w FROM documents)),
      done AS (SELECT doc_id, pos, CASE WHEN word IS NULL THEN w[pos] ELSE '<' || word || '>' END AS word
               FROM t LEFT JOIN dict ON word = w[pos])
    SELECT d.doc_id, coalesce(string_agg(f.word, ' ' ORDER BY pos), '') AS replaced
    FROM documents d LEFT JOIN done f ON d.doc_id = f.doc_id GROUP BY d.doc_id"""
)
def slang_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word replacement from a dictionary table: the words of the benchmark in brackets."""
    pattern = F.lit(rf"[{T.WORD}]+")
    known = table(spark, sf_dir, "benchmark").select(
        F.explode(F.regexp_extract_all(F.lower("text"), pattern, F.lit(0))).alias("word")
    )
    dictionary = known.distinct().withColumn("replacement", F.concat(F.lit("<"), F.col("word"), F.lit(">")))
    words = _documents(spark, sf_dir, w=T.split_words(F.lower("text")))
    done = joins.replace_words(words, "doc_id", "w", dictionary, "replaced")
    return done.select("doc_id", F.array_join("replaced", " ").alias("replaced"))


@register(
    f"""WITH t AS (SELECT conv_id, turn, unnest({Q.words('lower(text)')}) AS term FROM conversations),
      tf AS (SELECT conv_id, turn, term, count(*) AS tf FROM t GROUP BY ALL),
      norms AS (SELECT conv_id, turn, sqrt(sum(tf * tf)) AS norm FROM tf GROUP BY ALL),
      dots AS (SELECT a.conv_id, a.turn, sum(a.tf * b.tf) AS dot FROM tf a JOIN tf b
               ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 AND a.term = b.term GROUP BY ALL)
    SELECT a.conv_id, a.turn, round(coalesce(dot / (x.norm * y.norm), 0), 6) AS cosine
    FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
    LEFT JOIN norms x ON x.conv_id = a.conv_id AND x.turn = a.turn
    LEFT JOIN norms y ON y.conv_id = b.conv_id AND y.turn = b.turn
    LEFT JOIN dots d ON d.conv_id = a.conv_id AND d.turn = a.turn"""
)
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of each turn to the next one of its conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", T.split_words(F.lower("text")).alias("a"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    pairs = similarity.pair_cosine(turns.join(following, ["conv_id", "turn"]), "a", "b")
    return pairs.select("conv_id", "turn", F.round("cosine", 6).alias("cosine"))


@register(
    f"""WITH words AS (SELECT 'i' AS side, item_id AS id, unnest({Q.words('lower(text)')}) AS term FROM benchmark
                       UNION ALL SELECT 'd', doc_id, unnest({Q.words('lower(text)')}) FROM documents),
      tf AS (SELECT side, id, term, count(*) AS tf FROM words GROUP BY ALL),
      norms AS (SELECT side, id, sqrt(sum(tf * tf)) AS norm FROM tf GROUP BY ALL),
      dots AS (SELECT a.id AS item_id, b.id AS doc_id, sum(a.tf * b.tf) AS dot FROM tf a JOIN tf b
               ON a.side = 'i' AND b.side = 'd' AND a.term = b.term GROUP BY ALL)
    SELECT item_id, doc_id, round(dot / (x.norm * y.norm), 6) AS cosine
    FROM dots JOIN norms x ON x.side = 'i' AND x.id = item_id JOIN norms y ON y.side = 'd' AND y.id = doc_id
    WHERE dot / (x.norm * y.norm) >= {SIMILAR} - {similarity.ROUNDING}"""
)
def cosine_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose words resemble those of a benchmark item."""
    side = lambda name, key: table(spark, sf_dir, name).select(key, T.split_words(F.lower("text")).alias("w"))
    items, docs = side("benchmark", "item_id"), side("documents", "doc_id")
    found = similarity.cosine_join(items, docs, SIMILAR, "item_id", "doc_id", "w", "w")
    return found.select("item_id", "doc_id", F.round("cosine", 6).alias("cosine"))


def keyword_labels_sql(source: str, key: str, aspect: str, keywords: dict[str, list[str]], tokens: str) -> str:
    """CTEs that end in ``kw (key, t, labels)``."""
    cases = " ".join(f"WHEN '{a}' THEN {['' + w for w in ws]}" for a, ws in keywords.items())
    return f"""
      k0 AS (SELECT {key}, {tokens} AS t, CASE {aspect} {cases} ELSE []::VARCHAR[] END AS kw FROM {source}),
      k1 AS (SELECT {key}, t, list_transform(t, lambda x: list_contains(kw, lower(x))) AS hit FROM k0),
      kw AS (SELECT {key}, t, list_transform(hit, lambda h, i: CASE WHEN NOT h THEN 'O'
               WHEN i > 1 AND hit[i - 1] THEN 'I-ASPECT' ELSE 'B-ASPECT' END) AS labels FROM k1)"""


@register(
    f"""WITH {keyword_labels_sql('documents', 'doc_id', 'lang', KEYWORDS, Q.tokens('text'))}
    SELECT doc_id, {Q.joined('labels')} AS labels FROM kw"""
)
def keyword_bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("t", T.tokenize(F.col("text")))
    tags = B.keyword_bio_tag(F.col("t"), F.col("lang"), KEYWORDS)
    return docs.select("doc_id", F.array_join(tags, " ").alias("labels"))


@register(
    f"""WITH {keyword_labels_sql('documents', 'doc_id', 'lang', KEYWORDS, Q.tokens('text'))},
      h AS (SELECT doc_id, list_transform(t, lambda x, i: CASE WHEN labels[i] = 'O' THEN x ELSE
        '<span style="background-color:#BFDBFE; padding:2px 4px; border-radius:4px; margin:0 1px;" title="' ||
        labels[i] || '">' || x || '</span>' END) AS parts
        FROM (SELECT doc_id, labels, list_transform(t, lambda x: replace(replace(replace(replace(
          x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS t FROM kw))
    SELECT doc_id, {Q.joined('parts')} AS html FROM h"""
)
def highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("t", T.tokenize(F.col("text")))
    tagged = docs.withColumn("labels", B.keyword_bio_tag(F.col("t"), F.col("lang"), KEYWORDS))
    return tagged.select("doc_id", B.highlight(F.col("t"), F.col("labels")).alias("html"))
