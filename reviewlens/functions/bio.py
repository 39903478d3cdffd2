"""BIO tagging on token arrays: features, weak labels, entities, highlighting.

A sentence stays one row, so neighbours are reached by position and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from reviewlens.functions.arrays import let, positions_where, runs
from reviewlens.functions.fixed_values import ENTITY_COLORS, OTHER_COLOR, SPAN_FORMAT
from reviewlens.functions.text import split_words, tokenize

UPPER = r"\p{Lu}\p{Lt}"
CASED = r"\p{Lu}\p{Lt}\p{Ll}"


def ner_tokenize(text: Column) -> Column:
    """Tokens of the raw text; no cleaning."""
    return tokenize(text)


def tokens_of(sentence: Column) -> Column:
    return sentence["token"]


def labels_of(sentence: Column) -> Column:
    return sentence["label"]


def is_upper(word: Column) -> Column:
    return word.rlike(r"\p{Lu}") & ~word.rlike(r"[\p{Ll}\p{Lt}]")


def is_title(word: Column) -> Column:
    lower_first = rf"(?:^|[^{CASED}])\p{{Ll}}"
    upper_inside = rf"[{CASED}][{UPPER}]"
    return word.rlike(rf"[{UPPER}]") & ~word.rlike(lower_first) & ~word.rlike(upper_inside)


def is_digit(word: Column) -> Column:
    return word.rlike(r"^\p{Nd}+$")


def token_features(tokens: Column) -> Column:
    """Word shape and neighbour features per token, as an array of structs."""

    def shapes(words: Column) -> Column:
        return F.transform(
            words,
            lambda w: F.struct(
                F.lower(w).alias("lower"),
                F.right(w, F.lit(3)).alias("suffix"),
                is_upper(w).alias("is_upper"),
                is_title(w).alias("is_title"),
                is_digit(w).alias("is_digit"),
            ),
        )

    def with_context(own: Column) -> Column:
        return F.transform(
            own,
            lambda f, i: F.struct(
                i.alias("pos"),
                F.lit(1.0).alias("bias"),
                f["lower"].alias("lower"),
                f["suffix"].alias("suffix"),
                f["is_upper"].alias("is_upper"),
                f["is_title"].alias("is_title"),
                f["is_digit"].alias("is_digit"),
                F.get(own, i - 1)["lower"].alias("prev_lower"),
                F.get(own, i - 1)["is_title"].alias("prev_is_title"),
                F.get(own, i + 1)["lower"].alias("next_lower"),
                F.get(own, i + 1)["is_title"].alias("next_is_title"),
                (i == 0).alias("bos"),
                (i == F.size(own) - 1).alias("eos"),
            ),
        )

    return let(shapes(tokens), with_context)


def feature_names(feature: Column) -> Column:
    """One ``token_features`` struct as ``name=value`` strings for hashing."""

    def named(name: str) -> Column:
        return F.when(feature[name].isNotNull(), F.concat(F.lit(f"{name}="), feature[name].cast("string")))

    names = [
        "bias", "lower", "suffix", "is_upper", "is_title", "is_digit",
        "prev_lower", "prev_is_title", "next_lower", "next_is_title",
    ]
    ends = [F.when(feature[name], F.lit(name)) for name in ("bos", "eos")]
    return F.array_compact(F.array(*[named(n) for n in names], *ends))


def _entity_type(label: Column) -> Column:
    return F.when(label.startswith("B-") | label.startswith("I-"), F.substr(label, F.lit(3)))


def bio_decode(tokens: Column, labels: Column) -> Column:
    """Whole entities as ``array<struct<text,type,start,end>>``; ``end`` is exclusive.

    A run breaks unless the label is ``I-X`` after a label of type X. Runs that do not open with
    ``B-`` are orphans and are dropped.
    """

    def decode(tags: Column) -> Column:
        breaks = positions_where(
            tags,
            lambda tag, i: ~(
                tag.startswith("I-") & F.substr(tag, F.lit(3)).eqNullSafe(_entity_type(F.get(tags, i - 1)))
            ),
        )
        spans = let(
            breaks,
            lambda starts: runs(starts, F.size(tags), lambda s, n: F.struct(s.alias("start"), n.alias("n"))),
        )
        opened = F.filter(spans, lambda r: F.get(tags, r["start"]).startswith("B-"))
        return let(
            tokens,
            lambda words: F.transform(
                opened,
                lambda r: F.struct(
                    F.array_join(F.slice(words, r["start"] + 1, r["n"]), " ").alias("text"),
                    F.substr(F.get(tags, r["start"]), F.lit(3)).alias("type"),
                    r["start"].alias("start"),
                    (r["start"] + r["n"]).alias("end"),
                ),
            ),
        )

    return let(labels, decode)


def keyword_bio_tag(tokens: Column, aspect: Column, lexicon: Mapping[str, Sequence[str]]) -> Column:
    """``B-ASPECT`` / ``I-ASPECT`` on keywords of the row's own aspect, ``O`` elsewhere."""
    by_aspect = F.create_map(
        *[x for name, words in lexicon.items() for x in (F.lit(name), F.array(*[F.lit(w) for w in words]))]
    )
    no_words = F.array().cast("array<string>")
    flags = let(
        F.coalesce(F.element_at(by_aspect, aspect), no_words),
        lambda words: F.transform(tokens, lambda t: F.array_contains(words, F.lower(t))),
    )
    return let(
        flags,
        lambda hit: F.transform(
            hit,
            lambda h, i: F.when(~h, F.lit("O"))
            .when(F.coalesce(F.get(hit, i - 1), F.lit(False)), F.lit("I-ASPECT"))
            .otherwise(F.lit("B-ASPECT")),
        ),
    )


def wrap_in_template(template: Column, hotel: Column, loc: Column, snippet: Column) -> Column:
    """Fill the three slots of a carrier sentence; the snippet goes in last."""
    for slot, value in (("{hotel}", hotel), ("{loc}", loc), ("{snippet}", snippet)):
        template = F.replace(template, F.lit(slot), value)
    return template


def token_label_map(tokens: Column, labels: Column) -> Column:
    """``map<token,label>``; of a repeated token the last label wins."""

    def last_of_each(entries: Column) -> Column:
        kept = F.filter(entries, lambda e, i: ~e["token"].eqNullSafe(F.get(entries, i + 1)["token"]))
        return let(
            labels,
            lambda tags: F.map_from_entries(
                F.transform(kept, lambda e: F.struct(e["token"].alias("token"), F.get(tags, e["pos"]).alias("label")))
            ),
        )

    placed = F.transform(tokens, lambda t, i: F.struct(t.alias("token"), i.alias("pos")))
    return let(F.sort_array(placed), last_of_each)


def gazetteer_span_tag(tokens: Column, phrase: Column, place: Column) -> Column:
    """Label of the tokens covered by the row's own phrase or place, null elsewhere.

    Tokens hold no white space. So each is wrapped in spaces, the phrase is replaced from left to
    right without overlap by tab-marked labels, and single places are taken from what is left.
    """
    wrapped = F.concat(F.lit(" "), F.array_join(tokens, "  "), F.lit(" "))

    def mark(parts: Column) -> Column:
        needle = F.concat(F.lit(" "), F.array_join(parts, "  "), F.lit(" "))
        marks = F.concat(F.lit(" \tB-HOTEL "), F.repeat(F.lit(" \tI-HOTEL "), F.size(parts) - 1))
        return F.replace(wrapped, F.when(F.size(parts) > 0, needle).otherwise(F.lit("")), marks)

    marked = F.array_remove(F.split(let(split_words(phrase), mark), " "), "")
    return let(
        place,
        lambda city: F.transform(
            marked, lambda t: F.when(t.startswith("\t"), F.substr(t, F.lit(2))).when(t == city, F.lit("B-LOC"))
        ),
    )


def project_snippet_labels(tokens: Column, spans: Column, snippet_labels: Column) -> Column:
    """Span labels first, then the snippet's label of the stripped token, then ``O``."""
    # Only labelled words can change the outcome, and the lexicon bounds how many there are.
    marked = F.map_filter(snippet_labels, lambda _, label: label != "O")
    return let(
        marked,
        lambda known: F.zip_with(
            tokens,
            spans,
            lambda t, s: F.coalesce(s, F.try_element_at(known, F.btrim(t, F.lit(",.:"))), F.lit("O")),
        ),
    )


def escape_html(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def highlight(
    tokens: Column, labels: Column, colors: Mapping[str, str] = ENTITY_COLORS, escape: bool = True
) -> Column:
    """Tokens joined by spaces, each labelled one in a coloured span."""
    palette = F.create_map(*[F.lit(x) for pair in colors.items() for x in pair])

    def show(token: Column, label: Column) -> Column:
        shown = escape_html(token) if escape else token
        color = F.coalesce(F.try_element_at(palette, F.substring_index(label, "-", -1)), F.lit(OTHER_COLOR))
        return F.when(label == "O", shown).otherwise(F.format_string(SPAN_FORMAT, color, label, shown))

    return F.array_join(F.zip_with(tokens, labels, show), " ")
