"""SQL fragments for the checks. They follow the definitions step by step, not the Spark plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"


def text_list(items: Sequence[str]) -> str:
    return "(" + ", ".join(f"'{x}'" for x in items) + ")"


def text_map(mapping: Mapping[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in mapping.items()) + "}"


def replace_all(column: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({column}, '{pattern}', '{by}', 'g')"


def strip_urls(c: str) -> str:
    return replace_all(c, f"http[^{SPACE}]+|www\\.[^{SPACE}]+")


def strip_mentions(c: str) -> str:
    return replace_all(c, f"@[{WORD}]+")


def strip_hash(c: str) -> str:
    return replace_all(c, "#")


def strip_symbols(c: str) -> str:
    return replace_all(c, f"[^{WORD}{SPACE}.,!?]")


def collapse(c: str) -> str:
    return f"trim({replace_all(c, f'[{SPACE}]+')})"


def clean(c: str) -> str:
    return collapse(strip_symbols(strip_hash(strip_mentions(strip_urls(c)))))


def words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '[{SPACE}]+'), lambda x: x <> '')"


def tokens(c: str) -> str:
    return words(replace_all(c, "([.,!?])", r" \1 "))


def joined(items: str) -> str:
    return f"array_to_string({items}, ' ')"


def slang(c: str, mapping: Mapping[str, str]) -> str:
    return joined(f"list_transform({words(c)}, lambda w: coalesce({text_map(mapping)}[w], w))")


def drop_words(items: str, stop: Sequence[str]) -> str:
    return f"list_filter({items}, lambda t: t NOT IN {text_list(stop)})"


def stages(source: str, key: str, mapping: Mapping[str, str], stop: Sequence[str], text: str = "text") -> str:
    """CTEs ``s1 .. s4`` that end in column ``clean``."""
    return f"""
      s1 AS (SELECT {key}, {text} AS raw, lower({text}) AS folded FROM {source}),
      s2 AS (SELECT *, {clean("folded")} AS cleaned FROM s1),
      s3 AS (SELECT *, {slang("cleaned", mapping)} AS replaced FROM s2),
      s4 AS (SELECT *, {joined(drop_words(tokens("replaced"), stop))} AS clean FROM s3)"""


def stem_pattern(prefixes: Sequence[str], whole: Sequence[str]) -> str:
    return f"(^|[^{WORD}])(" + "|".join([*prefixes, *[f"{w}([^{WORD}]|$)" for w in whole]]) + ")"


def first_of(key: str, seed: object = 42) -> str:
    """The sampling order."""
    return f"md5(concat('{seed}:', {key})), {key}"


def pick(key: str, seed: object, n: str) -> str:
    return f"(('0x' || substr(md5(concat('{seed}:', {key})), 1, 8))::BIGINT % {n})"


def stratified(source: str, label: str, key: str, fraction: float = 0.2, seed: object = 42) -> str:
    """CTEs that end in ``split`` with ``key``, ``label`` and ``is_test``."""
    return f"""
      counts AS (SELECT {label}, count(*) AS n FROM {source} GROUP BY {label}),
      totals AS (SELECT sum(n)::BIGINT AS n_all, (sum(n) - ceil(sum(n) * {fraction}::DOUBLE))::BIGINT AS n_train FROM counts),
      shares AS (SELECT {label}, n, n_all, n_train, (n * n_train) // n_all AS fl, (n * n_train) % n_all AS rest
                 FROM counts, totals),
      placed AS (SELECT *, row_number() OVER (ORDER BY rest DESC, {label}) AS place, n_train - sum(fl) OVER () AS more
                 FROM shares),
      quota AS (SELECT {label}, n - fl - (CASE WHEN place <= more THEN 1 ELSE 0 END) AS take FROM placed),
      split AS (SELECT s.{key}, s.{label},
                  row_number() OVER (PARTITION BY s.{label} ORDER BY {first_of("s." + key, seed)}) <= take AS is_test
                FROM {source} s JOIN quota q ON s.{label} = q.{label})"""


def terms(source: str, key: str, text: str = "text", bigrams: bool = True) -> str:
    """CTEs that end in ``tf (key, term, tf)``."""
    both = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
      ws AS (SELECT {key}, regexp_extract_all(lower({text}), '[{WORD}]{{2,}}') AS w FROM {source}),
      ts AS (SELECT {key}, unnest({both if bigrams else "w"}) AS term FROM ws),
      tf AS (SELECT {key}, term, count(*) AS tf FROM ts GROUP BY ALL)"""


def idf(count_of: str, min_df: int = 2, top: int | None = 5000, tf: str = "tf") -> str:
    """CTE ``vocab (term, tf, df, idf)``."""
    limit = f"ORDER BY tf DESC, term LIMIT {top}" if top else ""
    return f"""
      picked AS (SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df FROM {tf} GROUP BY term
                 HAVING count(*) >= {min_df} {limit}),
      vocab AS (SELECT *, ln((1 + n) / (1 + df)::DOUBLE) + 1 AS idf
                FROM picked, (SELECT count(*) AS n FROM {count_of}))"""


def weights(key: str, tf: str = "tf", name: str = "tfidf") -> str:
    """CTE with ``(key, term, weight)``."""
    return f"""
      {name} AS (SELECT {key}, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY {key})) AS weight
                 FROM (SELECT t.{key}, t.term, t.tf, v.idf FROM {tf} t JOIN vocab v ON t.term = v.term))"""
