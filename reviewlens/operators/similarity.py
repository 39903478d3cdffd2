"""Typo correction and cosine similarity."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from reviewlens.functions.arrays import cosine_similarity, term_counts
from reviewlens.operators.joins import BROADCAST_ROWS, bounded, lookup_join, replace_words
from reviewlens.session import stored

# The match function travels to the workers by value, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cosines this little below a threshold count as equal to it: products of square roots are not exact.
ROUNDING = 1e-12
#: Pairs of texts, and products of their counts, that are held at once.
PAIRS_AT_ONCE, PRODUCTS_AT_ONCE = 1 << 19, 1 << 21
#: Rows of a typo index that is sent to the tasks.
INDEX_ROWS = 200_000
#: Words that are counted at once; a longer text stands alone.
WORDS_AT_ONCE = 1 << 19


def _piece(length: Column, number: int, pieces: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a piece when ``length`` characters are cut evenly, longer pieces last."""
    long_ones = length % pieces
    start = number * F.floor(length / pieces) + F.greatest(number - (pieces - long_ones), F.lit(0))
    return start, F.floor(length / pieces) + (long_ones > pieces - 1 - number).cast("long")


def _key(length: Column, number: int, piece: Column) -> Column:
    return F.concat_ws(":", length, F.lit(number), piece)


def index_keys(word: Column, distance: int) -> Column:
    """A vocabulary word by its ``distance + 1`` pieces, with their places and its length."""
    size = F.char_length(word)
    cuts = [_piece(size, i, distance + 1) for i in range(distance + 1)]
    return F.array(*[_key(size, i, F.substring(word, (at + 1).cast("int"), n.cast("int"))) for i, (at, n) in enumerate(cuts)])


def probe_keys(word: Column, distance: int) -> Column:
    """The keys that a vocabulary word within ``distance`` edits of ``word`` can have.

    Edits touch at most ``distance`` of the pieces, so some piece is found unchanged in ``word``, and there is one with at most
    as many edits before it as pieces, and with no more after it than are left. So piece ``i`` is shifted by ``i`` at most from
    the left, and by ``distance - i`` from the right. That makes 19 keys for a distance of 2, whatever the word's length.
    """
    size, keys = F.char_length(word), []
    for other in range(-distance, distance + 1):
        length = size + other
        for i in range(distance + 1):
            at, n = _piece(length, i, distance + 1)
            for shift in range(max(-i, -other - distance + i), min(i, -other + distance - i) + 1):
                begin = at + shift
                piece = F.substring(word, (begin + 1).cast("int"), n.cast("int"))
                keys.append(F.when((length > 0) & (begin >= 0) & (begin + n <= size), _key(length, i, piece)))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def correct_words(words: DataFrame, vocabulary: DataFrame, max_distance: int = 2) -> DataFrame:
    """Nearest vocabulary word for each distinct ``word``: ``(word, corrected, distance)``.

    ``vocabulary`` has ``word`` and ``rank``; of equally near words the lowest rank wins. Without
    one in ``max_distance`` the word stays and the distance is null. Words are joined on unchanged pieces,
    so no pair is missed and only likely pairs are compared; hot pieces are split. Words longer
    than the longest vocabulary word and ``max_distance`` have no near word and are not looked up.
    """
    distinct = stored(words.select("word").distinct(), "words")
    index = vocabulary.where(F.char_length("word") > 0).select("rank", F.col("word").alias("to"))
    longest = index.agg(F.max(F.char_length("to"))).first()[0] or 0
    index = index.select("rank", "to", F.explode(index_keys(F.col("to"), max_distance)).alias("_key"))
    tried = distinct.where(F.char_length("word") <= longest + max_distance)
    tried = tried.select("word", F.explode(probe_keys(F.col("word"), max_distance)).alias("_key"))
    # The keys of the words are many times the words, so an index that tasks can hold is worth sending; its bytes are checked.
    met = lookup_join(tried, stored(index, "index"), ["_key"], ["word"], how="inner", max_rows=INDEX_ROWS)
    found = met.withColumn("distance", F.levenshtein(F.col("word"), F.col("to"), max_distance))
    best = found.where("distance >= 0").groupBy("word").agg(F.min(F.struct("distance", "rank", "to")).alias("_best"))
    return distinct.join(best, "word", "left").select(
        "word",
        F.coalesce(F.col("_best.to"), F.col("word")).alias("corrected"),
        F.col("_best.distance").alias("distance"),
    )


def vocabulary_of(words: Sequence[str], like: DataFrame) -> DataFrame:
    """A word list as a vocabulary table; earlier words rank lower."""
    return like.sparkSession.createDataFrame(list(enumerate(words)), "rank int, word string").select("word", "rank")


def correct_typos(
    texts: DataFrame, id_col: str, words_col: str, vocabulary: DataFrame, out: str, max_distance: int = 2
) -> DataFrame:
    """Correct the words of an array column; every distinct word is looked up once."""
    words = texts.select(F.explode(words_col).alias("word"))
    corrections = correct_words(words, vocabulary, max_distance)
    changed = corrections.where("distance > 0").select("word", F.col("corrected").alias("replacement"))
    return replace_words(texts, id_col, words_col, stored(changed, "typos"), out)


def pair_cosine(pairs: DataFrame, words_a: str, words_b: str, out: str = "cosine") -> DataFrame:
    """Cosine of the bags of words of two array columns; each pair is one row."""
    return pairs.withColumn(out, cosine_similarity(term_counts(F.col(words_a)), term_counts(F.col(words_b))))


def _terms(side: DataFrame, id_col: str, words_col: str) -> DataFrame:
    """``(id, term, tf, square)``: the bag of words of every text, and the sum of the squares of its counts."""
    bags = side.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), term_counts(F.col(f"`{words_col}`")).alias("bag"))
    square = F.aggregate("bag", F.lit(0).cast("long"), lambda s, e: s + e["tf"].cast("long") * e["tf"].cast("long"))
    rows = bags.select("id", square.alias("square"), F.explode("bag").alias("e"))
    return rows.select("id", "e.term", F.col("e.tf").cast("long").alias("tf"), "square")


def _prefix(terms: DataFrame, frequency: DataFrame, threshold: float) -> DataFrame:
    """The rarest terms of each text, with ``rest``, the squares of a term and all more frequent ones.

    What follows the last kept term is too short for the threshold, whatever the other text holds of it.
    """
    ranked = lookup_join(terms, frequency, ["term"], ["id"], how="inner")
    later = Window.partitionBy("id").orderBy("df", "term").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = ranked.withColumn("rest", F.sum(F.col("tf") * F.col("tf")).over(later))
    return ranked.where(F.col("rest") >= threshold**2 * F.col("square") * (1 - 1e-9)).select("id", "term", "square", "rest")


def _bags(words: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row, place in the returned dictionary and count of every distinct word of a row, in the order of the rows.

    Null words count for nothing, as in ``term_counts``.
    """
    lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = words.flatten()
    row = np.repeat(np.arange(len(lengths), dtype=np.int64), lengths)[flat.is_valid().to_numpy(zero_copy_only=False)]
    coded = flat.drop_null().dictionary_encode()
    size = max(len(coded.dictionary), 1)
    cells, tf = np.unique(row * size + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    return cells // size, cells % size, tf.astype(np.float64), coded.dictionary


def _matches(
    ids: pa.Array, known: pa.ListArray, threshold: float, known_first: bool, names: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Task function: the texts of a batch ``(id, words)`` against all ``known`` ones, through lists of the texts of each word.

    Counts, squares and products are whole numbers, so the sums are exact in any order.
    """
    row, place, tf, vocabulary = _bags(known)
    n = len(known)
    norms = np.sqrt(np.bincount(row, weights=tf * tf, minlength=n))
    order = np.argsort(place, kind="stable")
    texts, counts = row[order], tf[order]
    begins = np.searchsorted(place[order], np.arange(len(vocabulary) + 1))

    def products(rows: np.ndarray, terms: np.ndarray, tf: np.ndarray, n_rows: int) -> np.ndarray:
        dots, sizes = np.zeros(n_rows * n), begins[terms + 1] - begins[terms]
        upto, at = np.cumsum(sizes), 0
        while at < len(rows):
            before = upto[at - 1] if at else 0
            end = max(int(np.searchsorted(upto, before + PRODUCTS_AT_ONCE, side="right")), at + 1)
            each = sizes[at:end]
            own = np.arange(upto[end - 1] - before) + np.repeat(begins[terms[at:end]] - (upto[at:end] - each - before), each)
            first = rows[at] * n
            cell = np.repeat(rows[at:end] * n - first, each) + texts[own]
            found = np.bincount(cell, weights=np.repeat(tf[at:end], each) * counts[own])
            dots[first : first + len(found)] += found
            at = end
        return dots.reshape(n_rows, n)

    def match_piece(piece: pa.RecordBatch) -> pa.RecordBatch:
        rows, local, tf, words = _bags(piece.column(1))
        norm = np.sqrt(np.bincount(rows, weights=tf * tf, minlength=piece.num_rows))
        terms = pc.index_in(words, value_set=vocabulary).fill_null(-1).to_numpy(zero_copy_only=False)[local]
        hit = terms >= 0
        dots = products(rows[hit], terms[hit].astype(np.int64), tf[hit], piece.num_rows)
        here, there = np.nonzero(dots)
        cosine = dots[here, there] / (norm[here] * norms[there])
        near = cosine >= threshold - ROUNDING
        both = [ids.take(pa.array(there[near])), piece.column(0).take(pa.array(here[near]))]
        return pa.RecordBatch.from_arrays([*(both if known_first else reversed(both)), pa.array(cosine[near])], names)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = max(PAIRS_AT_ONCE // max(n, 1), 1)
        for batch in batches:
            upto = np.cumsum(batch.column(1).value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                before = upto[at - 1] if at else 0
                end = int(np.searchsorted(upto, before + WORDS_AT_ONCE, side="right"))
                end = min(max(end, at + 1), at + most)
                yield match_piece(batch.slice(at, end - at))
                at = end

    return match


def cosine_join(
    left: DataFrame, right: DataFrame, threshold: float, left_id: str, right_id: str, words_a: str, words_b: str,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``(left_id, right_id, cosine)`` of all pairs whose bags of words have at least the cosine ``threshold``.

    ``words_a`` and ``words_b`` are arrays; ids must be unique. No pair is missed. Null ids, null and empty texts match nothing.

    A side of checked size goes to the tasks as lists of the texts of each word; the other side is read once and not
    shuffled, and no pair below the threshold leaves its task. Two larger sides are joined on their rarest words.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    sides = [
        side.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{words}`").isNotNull()).select(F.col(f"`{key}`"), F.col(f"`{words}`"))
        for side, key, words in ((left, left_id, words_a), (right, right_id, words_b))
    ]
    for known, others in ((0, 1), (1, 0)):
        small = bounded(sides[known], max_rows)
        if small is None:
            continue
        held = small.toArrow().combine_chunks()
        ids, words = (c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in held.columns)
        fields = [left.schema[left_id], right.schema[right_id], StructField("cosine", DoubleType())]
        task = _matches(ids, words, threshold, known == 0, [left_id, right_id, "cosine"])
        return sides[others].mapInArrow(task, StructType(fields))
    return _rare_word_join(left, right, threshold, left_id, right_id, words_a, words_b)


def _rare_word_join(
    left: DataFrame, right: DataFrame, threshold: float, left_id: str, right_id: str, words_a: str, words_b: str
) -> DataFrame:
    """``cosine_join`` of two large sides.

    Terms are ordered by rarity in both tables. Two texts that are
    similar enough share one of the rarest terms of either, namely of those without which the rest of the text is too short
    for the threshold. Texts meet on these only, hot terms are split, and at the first term they share what is left of both
    bounds the product, so few pairs reach the comparison.
    """
    terms = [stored(_terms(left, left_id, words_a), "terms"), stored(_terms(right, right_id, words_b), "terms")]
    frequency = stored(terms[0].unionByName(terms[1]).groupBy("term").agg(F.count("*").alias("df")), "frequency")
    one, other = (_prefix(t, frequency, threshold).select("term", F.struct("id", "square", "rest").alias(x)) for t, x in zip(terms, "ab"))
    met = lookup_join(other, one, ["term"], ["b"], how="inner")
    product = lambda name: F.col(f"a.{name}").cast("double") * F.col(f"b.{name}")
    met = met.where(product("rest") >= threshold**2 * product("square") * (1 - 1e-9))
    pairs = met.select(F.col("a.id").alias(left_id), F.col("b.id").alias("_other")).distinct()
    for side, key, words, own in ((left, left_id, words_a, "_a"), (right, "_other", words_b, "_b")):
        source = left_id if key == left_id else right_id
        bags = side.select(F.col(f"`{source}`").alias(key), F.col(f"`{words}`").alias(own)).where(F.col(key).isNotNull())
        pairs = lookup_join(pairs, bags, [key], [left_id, "_other"], how="inner")
    found = pair_cosine(pairs, "_a", "_b").where(F.col("cosine") >= threshold - ROUNDING)
    return found.select(left_id, F.col("_other").alias(right_id), "cosine")
