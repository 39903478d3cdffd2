"""Queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from reviewlens.llm import brown_lm
from reviewlens.llm.common import documents, id_bucket, labelled_sample, text_or_empty
from reviewlens.llm.decontamination import contaminated
from reviewlens.llm.exact_dedup import exact_groups
from reviewlens.llm.hard_negatives import hard_negatives
from reviewlens.llm.language_id import classify, dictionaries
from reviewlens.llm.lexical_search import search
from reviewlens.llm.mixing import mix
from reviewlens.llm.packing import pack
from reviewlens.llm.quality import quality
from reviewlens.llm.secrets import KINDS, listed, secrets
from reviewlens.llm.simhash import hex_digits, near_duplicates
from reviewlens.llm.toxicity import REJECT, ToxicityModel, fit_toxicity
from reviewlens.llm.url_filter import derived_entries, host_of, judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def register(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return add


def trained_toxicity(spark: SparkSession, sf_dir: str, max_labelled: int = 20_000) -> ToxicityModel:
    """Fitted on at most about ``max_labelled`` labelled documents outside the held-out quarter."""
    wanted = id_bucket(F.col("doc_id"), 4) != 2
    return fit_toxicity(labelled_sample(documents(spark, sf_dir), labels(spark, sf_dir), "toxic", wanted, max_labelled))


@register()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    score = trained_toxicity(spark, sf_dir).score(F.col("text"))
    scored = docs.select("doc_id", (id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= REJECT).cast("int"))


@register(
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """
)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


@register()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = near_duplicates(documents(spark, sf_dir))
    return marks.select("doc_id", hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


@register()
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register()
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


@register()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = id_bucket(F.col("doc_id"), 3) == 1
    learned = dictionaries(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), classify(F.col("text"), learned).alias("_found"))
    return found.select("doc_id", "held_out", F.col("_found.lang").alias("lang_pred"), "_found.score", "_found.margin", "_found.reliable")


@register()
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(documents(spark, sf_dir))
    counts = [F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]  # noqa: B023
    every = F.array_sort(F.concat("base", "random"))
    return found.select(
        "doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(every).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


@register(
    r"""
    WITH captures AS (
        SELECT page_id, url, DATE '2024-01-01' + CAST((page_id * 37) % 365 AS INTEGER) AS day,
               lower(regexp_extract(url, '^(?i:[a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/:?#]+)', 1)) AS host
        FROM pages
    ), parts AS (
        SELECT *, string_split(host, '.') AS labels,
               list_filter(string_split(regexp_extract(url, '^[^/?#]*//[^/?#]*/([^?#]*)', 1), '/'), lambda x: x <> '') AS segs
        FROM captures
    ), keyed AS (
        SELECT page_id, url, day, i AS rank, ks[i] AS key FROM (
            SELECT *, list_concat(
                list_transform(list_reverse(range(1, len(segs) + 1)), lambda i: host || '/' || array_to_string(segs[1:i], '/')),
                list_transform(range(1, greatest(len(labels) - 1, 1) + 1), lambda i: array_to_string(labels[i:], '.'))) AS ks
            FROM parts WHERE host <> ''), range(1, len(ks) + 1) AS t(i)
    ), listed AS (
        SELECT key, n, (n // 5) % 200 AS d FROM (
            SELECT key, CAST('0x' || substr(md5(key), 1, 7) AS BIGINT) AS n FROM (SELECT DISTINCT key FROM keyed))
        WHERE n % 5 = 0
    ), events AS (
        SELECT key, n, d, CASE WHEN n % 3 = 0 THEN 'allow' ELSE 'block' END AS action FROM listed
        UNION ALL SELECT key, n, d + 30 + n % 50, 'remove' FROM listed WHERE (n // 15) % 2 = 0
        UNION ALL SELECT key, n, d + 120, 'block' FROM listed WHERE (n // 30) % 2 = 0
    ), dated AS (
        SELECT key, DATE '2024-01-01' + CAST(d AS INTEGER) AS since, max(action) AS action, max('c' || (n % 4)) AS category
        FROM events GROUP BY ALL
    ), latest AS (
        SELECT k.page_id, k.url, k.day, k.rank, k.key, max_by(e.action, e.since) AS action,
               max_by(e.category, e.since) AS category, max(e.since) AS since
        FROM keyed k JOIN dated e ON e.key = k.key AND e.since <= k.day GROUP BY ALL
    ), best AS (
        SELECT page_id, url, day, min_by(struct_pack(key := key, action := action, category := category, since := since), rank) AS b
        FROM latest WHERE action <> 'remove' GROUP BY ALL
    )
    SELECT c.page_id, c.url, CAST(c.day AS VARCHAR) AS day, c.host, coalesce(b.action = 'block', false) AS blocked, b.key AS matched_key,
           b.action AS action, b.category AS category, CAST(b.since AS VARCHAR) AS since
    FROM captures c LEFT JOIN best USING (page_id, url, day)
    """
)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages carry no fetch time and no list comes with them, so both derive from the table itself."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    day = F.date_add(F.lit("2024-01-01").cast("date"), ((F.col("page_id") * 37) % 365).cast("int"))
    captures = pages.select("page_id", "url", day.alias("day"), host_of(F.col("url")).alias("host"))
    judged = judge_urls(captures, derived_entries(pages.select("url")))
    return judged.withColumns({c: F.col(c).cast("string") for c in ("day", "since")})


@register()
def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = (id_bucket(F.col("doc_id"), 7) == 2).alias("held_out")
    docs = documents(spark, sf_dir).select("doc_id", held_out, "text")
    model = brown_lm.train(docs.where("not held_out").select(text_or_empty(F.col("text")).alias("text")))
    return brown_lm.score(docs, model)


@register()
def op5_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir), labels(spark, sf_dir), id_bucket(F.col("doc_id"), 5) == 2)


@register(
    r"""
    WITH texts AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
    ), counts AS (
        SELECT doc_id, term, count(*) AS tf FROM texts GROUP BY ALL
    ), lengths AS (
        SELECT doc_id, count(*) AS n FROM texts GROUP BY ALL
    ), totals AS (
        SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
        FROM (SELECT term, count(*) AS df FROM counts GROUP BY ALL), totals
    ), asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL
    ), scored AS (
        SELECT item_id, doc_id,
               CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
        FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (doc_id), totals GROUP BY ALL
    )
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 50
    """
)
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register(
    """
    WITH clean AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same,
               CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
        FROM clean a, clean c WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id
    ), positives AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
    )
    SELECT anchor_id, positive_id, row_number() OVER best AS rank, other_id AS negative_id, positive_score,
           score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
    QUALIFY row_number() OVER best <= 10
    """
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives for every hundredth vector and its positives."""
    return hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@register()
def op12_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents in sequences of 1024 ids; ``tokenizer`` is the path of a vocabulary file."""
    packed = pack(documents(spark, sf_dir), tokenizer or public_tokenizers.path("byte_bpe_50k.json"))
    checksum = F.crc32("ids").alias("ids_crc32")
    return packed.select("doc_id", "start", "length", checksum, "doc_tokens", "sequence_id", "offset")
