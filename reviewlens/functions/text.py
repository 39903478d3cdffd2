"""Text cleaning, tokenizing and extraction as Column expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

from reviewlens.functions.arrays import let

# Character classes with the meaning they have for Unicode text; Java's \w, \s and \d are ASCII only.
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x1f\x85\p{Z}"
SPACE_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_DECIMALS = [chr(c) for c in range(0x80, sys.maxunicode + 1) if chr(c).isdecimal()]
DECIMAL_CHARS = "".join(_DECIMALS)
DECIMAL_VALUES = "".join(str(int(c)) for c in _DECIMALS)

URL = rf"http[^{SPACE}]+|www\.[^{SPACE}]+"
MENTION = rf"@[{WORD}]+"
# Fixed value: a rating out of five, the number first.
RATING = rf"(?iu)(\p{{Nd}}(?:[.,]\p{{Nd}})?)[{SPACE}]*(?:/[{SPACE}]*5|dari[{SPACE}]*5|bintang)"
# Characters that NFKC never changes unless a character outside this class stands in the text.
NFKC_UNSTABLE = r"[^\x00-\x7fÀ-ı]"
PUNCTUATION = ".,!?"


def case_folding(text: Column) -> Column:
    return F.lower(text)


@F.arrow_udf(StringType())
def _nfkc(values: pa.Array) -> pa.Array:
    # Not the Arrow kernel of that name: it leaves a letter and its combining mark apart.
    return pa.array([v if v is None else unicodedata.normalize("NFKC", v) for v in values.to_pylist()], pa.string())


def normalize_nfkc(text: Column) -> Column:
    """Compatibility composition. Texts that cannot change travel to Python as null."""
    return F.coalesce(_nfkc(F.when(text.rlike(NFKC_UNSTABLE), text)), text)


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, " ")


def strip_hash_signs(text: Column) -> Column:
    return F.translate(text, "#", " ")


def strip_symbols(text: Column) -> Column:
    return F.regexp_replace(text, rf"[^{WORD}{SPACE}{PUNCTUATION}]", " ")


def collapse_spaces(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, rf"[{SPACE}]+", " "))


def strip_spaces(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def clean_text(text: Column, nfkc: bool = True) -> Column:
    """Normalize, then drop links, mentions and symbols, then collapse spaces.

    Hash signs, symbols and space runs all end as one space, so they share one pass.
    """
    if nfkc:
        text = normalize_nfkc(text)
    text = strip_mentions(strip_urls(text))
    return F.trim(F.regexp_replace(text, rf"[^{WORD}{PUNCTUATION}]+", " "))


def split_words(text: Column) -> Column:
    """Words between runs of white space, without empty ones."""
    spaced = F.translate(text, SPACE_CHARS, " " * len(SPACE_CHARS))
    return F.array_remove(F.split(spaced, " "), "")


def normalize_slang(text: Column, slang: Mapping[str, str]) -> Column:
    """Replace whole words found in ``slang``; runs of white space become one space."""
    if not slang:
        return F.array_join(split_words(text), " ")
    entries = F.create_map(*[F.lit(x) for pair in slang.items() for x in pair])
    # The set test is hashed, the map lookup is not, so only hits pay for the lookup.
    replaced = F.transform(
        split_words(text),
        lambda w: F.when(w.isin(*slang), F.element_at(entries, w)).otherwise(w),
    )
    return F.array_join(replaced, " ")


def tokenize(text: Column) -> Column:
    """Words and single punctuation marks; case is kept."""
    for mark in PUNCTUATION:
        text = F.replace(text, F.lit(mark), F.lit(f" {mark} "))
    return split_words(text)


def remove_stopwords(tokens: Column, stopwords: Sequence[str]) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*stopwords)) if stopwords else tokens


def preprocess(
    text: Column,
    slang: Mapping[str, str],
    stopwords: Sequence[str],
    use_stopword_removal: bool = True,
    nfkc: bool = True,
) -> Column:
    """Fold, clean, replace slang, tokenize, drop stopwords and join with one space."""
    tokens = tokenize(normalize_slang(clean_text(case_folding(text), nfkc), slang))
    if use_stopword_removal:
        tokens = remove_stopwords(tokens, stopwords)
    return F.array_join(tokens, " ")


def stage_trace(
    text: Column, slang: Mapping[str, str], stopwords: Sequence[str], nfkc: bool = True
) -> Column:
    """A struct with the text before and after every stage; each stage runs once."""
    cleaned = clean_text(case_folding(text), nfkc)
    return let(
        cleaned,
        lambda c: let(
            normalize_slang(c, slang),
            lambda replaced: F.struct(
                text.alias("raw"),
                case_folding(text).alias("after_case_folding"),
                c.alias("after_cleaning"),
                replaced.alias("after_slang_normalization"),
                F.array_join(remove_stopwords(tokenize(replaced), stopwords), " ").alias("after_stopword_removal"),
            ),
        ),
    )


def clean_or_lower(clean: Column, text: Column) -> Column:
    """The preprocessed text, or the lowercased raw one where nothing was left."""
    return let(clean, lambda c: F.when(nonblank(c), c).otherwise(F.lower(text)))


def nonblank(text: Column) -> Column:
    return strip_spaces(text) != ""


def token_count(text: Column) -> Column:
    return F.size(split_words(text))


def extract_rating(text: Column) -> Column:
    """First rating such as ``4/5``, ``4,5 dari 5`` or ``4 bintang``; null without one."""
    number = F.translate(F.regexp_extract(text, RATING, 1), DECIMAL_CHARS + ",", DECIMAL_VALUES + ".")
    return F.nullif(number, F.lit("")).try_cast("double")


def aspect_pattern(prefixes: Sequence[str], words: Sequence[str] = ()) -> str:
    """Regex for a word that begins with one of ``prefixes`` or is one of ``words``."""
    whole = [rf"{w}(?:[^{WORD}]|$)" for w in words]
    return rf"(?:^|[^{WORD}])(?:{'|'.join([*prefixes, *whole])})"


def detect_candidate_aspects(
    text: Column, stems: Mapping[str, tuple[Sequence[str], Sequence[str]]]
) -> Column:
    """Names of the aspects whose words occur, in lexicon order."""
    folded = F.lower(text)
    hits = [
        F.when(folded.rlike(aspect_pattern(prefixes, words)), F.lit(name))
        for name, (prefixes, words) in stems.items()
    ]
    return F.when(text.isNotNull(), F.array_compact(F.array(*hits)))


def edit_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance with unit costs, by code point."""
    return F.levenshtein(a, b)
