"""Language identification by compression: the dictionary that encodes a text shortest names its language."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

LETTERS = re.compile(r"[^\W\d_]+")
#: Characters of training text per language, texts they are drawn from, and characters taken of each.
DICTIONARY, TEXTS, EXCERPT = 48_000, 400, 600
PIECE, LEVEL, MARGIN = 4096, 9, 0.01
#: All dictionaries are sent to the executors; more languages than this need smaller ones.
MAX_BROADCAST = 64 << 20
UNKNOWN = "und"


def letters_of(text: str) -> bytes:
    """The words of a text in lower case, as they are compressed; digits and symbols say little of a language."""
    return " ".join(LETTERS.findall(text.lower())).encode()


class CompressionClassifier:
    def __init__(self, dictionaries: dict[str, bytes], margin: float):
        self.languages, self.margin, self.compressors = sorted(dictionaries), margin, []
        for language in self.languages:
            raw = zstandard.ZstdCompressionDict(dictionaries[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=LEVEL)
            options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            self.compressors.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, **options))

    def classify(self, text: str) -> tuple[str, float, float, bool]:
        """``(language, score, margin, reliable)``.

        Pieces of the whole text are encoded one by one, since a long text would soon serve as its own
        dictionary. The score is a softmax over the bits per byte that each dictionary leaves.
        """
        data = letters_of(text)
        if not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, 0.0, False
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        sizes = np.array([sum(len(c.compress(p)) for p in pieces) for c in self.compressors], float)
        order = np.argsort(sizes, kind="stable")
        best = int(order[0])
        margin = float((sizes[order[1]] - sizes[best]) / sizes[best]) if len(order) > 1 else 1.0
        shares = np.exp((sizes[best] - sizes) * 8 / np.sqrt(len(data)))
        return self.languages[best], float(1 / shares.sum()), margin, margin >= self.margin


def dictionaries(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """Raw-content dictionaries per language from ``labelled`` rows; rows without text or language do not count.

    Of each language about ``TEXTS`` different texts, chosen by hash, give an excerpt each. The excerpt
    starts where the hash says, and what comes to the driver is bounded by languages times ``DICTIONARY``.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if len(sizes) * DICTIONARY > MAX_BROADCAST:
        raise ValueError("too many languages for the size of the dictionaries")
    if not sizes:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, TEXTS / n))]), F.col("lang"))
    place = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 40))
    chosen = rows.where(place < share * (1 << 40)).dropDuplicates(["lang", "text"])
    start = F.pmod(F.xxhash64("text", F.lit("start")), F.greatest(F.length("text") - EXCERPT, F.lit(1))) + 1
    chosen = chosen.select("lang", place.alias("place"), F.substring("text", start.cast("int"), F.lit(EXCERPT)).alias("part"))
    parts: dict[str, list[bytes]] = {}
    for row in chosen.orderBy("lang", "place", "part").collect():
        parts.setdefault(row["lang"], []).append(letters_of(row["part"]))
    # What stands last in a dictionary is cheapest to refer to; every language gets the same number of bytes.
    joined = {lang: b" ".join(ps) for lang, ps in parts.items()}
    least = min(DICTIONARY, *(max(len(d), 8) for d in joined.values())) if len(joined) > 1 else DICTIONARY
    least = max(least, 2_000)
    return {lang: d[:least] for lang, d in joined.items() if d}


def classify(text: Column, learned: dict[str, bytes], margin: float = MARGIN) -> Column:
    """``struct<lang, score, margin, reliable>``; ``und``, 0, 0, false for null and for texts without a letter.

    A margin is how much longer the second shortest encoding is. Below ``margin`` the language is still
    named but rejected as not ``reliable``. Equal sizes go to the language first in code point order.
    """

    built: list[CompressionClassifier] = []

    @F.arrow_udf("struct<lang: string, score: double, margin: double, reliable: boolean>")
    def of(texts: pa.Array) -> pa.Array:
        if not built:
            built.append(CompressionClassifier(learned, margin))
        rows = [built[0].classify(t) if t is not None else (UNKNOWN, 0.0, 0.0, False) for t in texts.to_pylist()]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["lang", "score", "margin", "reliable"])

    return of(text)
