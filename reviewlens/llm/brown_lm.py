"""Class-based bigram language model: exchange clustering, class transitions, word emissions.

Counts of words and bigrams are Spark aggregations over all training texts. Every word of ``MIN_COUNT`` or more
is clustered, until that makes the training text hardly any likelier. Tasks and driver hold nine bytes for each
of these words, a key and a class, and the counts of at most ``1 / LISTED`` of them; the bigrams stay in a table.
All other words are counted, joined and scored as well, in classes by their endings.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import small_batches, text_or_empty
from reviewlens.session import stored

LISTED, MIN_COUNT = 1e-6, 5
CLASSES, ENDINGS, PRIOR = 64, 64, 20.0
#: The exchange ends when a turn of all words gains less than this per token, in natural logarithms.
TOLERANCE = 1e-3
#: Words of a turn are moved in so many batches at first, and at most.
BATCHES, MOST_BATCHES = 2, 64
_FLUSH = 500_000
#: Pairs of a packed row, and about those that are gathered to be added up at once.
PACKED, PAIRS = 1 << 17, 1 << 21


def words_of(text: bytes) -> list[bytes]:
    """ASCII lower case, split at ASCII whitespace: what ``bytes`` does by itself."""
    return text.lower().split()


def ending(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def ending_of(word: Column) -> Column:
    """``ending`` for a binary column."""
    return F.pmod(F.crc32(F.substring(word, -3, 3)), F.lit(ENDINGS)).cast("int")


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for text in batch.column(0).cast(pa.large_binary()):
        yield text.as_buffer().to_pybytes()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for text in _texts(batch):
            counts.update(words_of(text))
            if len(counts) > _FLUSH:
                yield flush()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` for a table with one text column; tasks count their own texts first."""
    return texts.mapInArrow(_count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def key_of(word: bytes) -> int:
    """A signed number of 64 bits. Two words with the same one, which a million words have once in 40 million cases, share a class."""
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little", signed=True)


def symbols_of(keys: np.ndarray) -> Callable[[list[bytes]], list[int]]:
    """Function from words to symbols: 0 ends a text, then the words of the sorted ``keys`` from 1, then one per ending."""
    known: dict[bytes, int] = {}

    def symbols(words: list[bytes]) -> list[int]:
        found = [known.get(w) for w in words]
        if None in found:
            if len(known) > _FLUSH:
                known.clear()
            new = [w for w in dict.fromkeys(words) if w not in known]
            own = np.array([key_of(w) for w in new], np.int64)
            at = np.searchsorted(keys, own)
            hit = keys[np.minimum(at, len(keys) - 1)] == own if len(keys) else np.zeros(len(new), bool)
            known.update((w, i + 1 if h else len(keys) + 1 + ending(w)) for w, i, h in zip(new, at.tolist(), hit.tolist()))
            found = [known[w] for w in words]
        return found

    return symbols


def _coded(pairs: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending numbers and their counts, in some three bytes each: differences, byte by byte."""
    both = np.concatenate([np.diff(pairs, prepend=0), n]).astype("<i8")
    return pa.compress(both.view(np.uint8).reshape(-1, 8).T.tobytes(), "zstd", asbytes=True)


def _decoded(code: pa.Buffer, size: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(code, 16 * size, "zstd"), np.uint8).reshape(8, -1)
    both = np.ascontiguousarray(planes.T).view("<i8").ravel()
    return np.cumsum(both[:size]), both[size:]


def _bounds(n_keys: int, buckets: int) -> np.ndarray:
    """The first symbol of every bucket: the end and each ending have one of their own, words are dealt in the order of their keys."""
    words = 1 + np.arange(buckets) * n_keys // buckets
    return np.concatenate([[0], words, n_keys + 1 + np.arange(ENDINGS)]).astype(np.int64)


def _count_bigrams(keys: np.ndarray, buckets: int):
    """Neighbours of every symbol on both sides with their counts, ``w << 32 | other << 1 | before``, coded per bucket of ``w``.

    The end stands before a text as well.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, parts, size, bounds = symbols_of(keys), [], 0, _bounds(len(keys), buckets)

        def flush() -> pa.RecordBatch:
            pairs, n = np.unique(np.concatenate(parts or [np.zeros(0, np.int64)]), return_counts=True)
            parts.clear()
            a, b = pairs >> 32, pairs & 0xFFFFFFFF
            pairs, n = np.concatenate([a << 32 | b << 1, b << 32 | a << 1 | 1]), np.concatenate([n, n])
            order = np.argsort(pairs)
            pairs, n = pairs[order], n[order]
            at = [*np.searchsorted(pairs, bounds << 32).tolist(), len(pairs)]
            rows = [(i, y - x, _coded(pairs[x:y], n[x:y])) for i, (x, y) in enumerate(zip(at, at[1:])) if y > x]
            types = (pa.int32(), pa.int32(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["bucket", "size", "code"])

        for batch in batches:
            for text in _texts(batch):
                found = words_of(text)
                line = np.zeros(len(found) + 2, np.int64)
                line[1:-1] = symbols(found)
                parts.append(line[:-1] << 32 | line[1:])
                size += len(line)
                if size > 8 * _FLUSH:
                    yield flush()
                    size = 0
        yield flush()

    return count


@dataclass
class Clustering:
    """Classes of the exchanged words in the order of their keys, 1 to ``CLASSES``; class 0 is the end, endings come after."""

    keys: np.ndarray
    classes: np.ndarray

    def of_symbols(self) -> np.ndarray:
        return np.concatenate([[0], self.classes, CLASSES + 1 + np.arange(ENDINGS)]).astype(np.uint8)


TOTAL = CLASSES + 1 + ENDINGS

_SIDES = [f"{what}_{side}" for side in ("after", "before") for what in ("sizes", "others", "counts")]
_TYPES = {"words": np.int32, **{c: np.int64 if c.startswith("counts") else np.int32 for c in _SIDES}}


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers with the sums of their counts, in order."""
    pairs, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    begins = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    return pairs[begins], np.add.reduceat(n[order], begins)


def _packed(part: bool, pairs: np.ndarray, n: np.ndarray) -> tuple:
    """One row: its words, and per side how many neighbours each has, which, and how often."""
    words, place = np.unique(pairs >> 32, return_inverse=True)
    row = [words]
    for side in (pairs & 1 == 0, pairs & 1 == 1):
        row += [np.bincount(place[side], minlength=len(words)), (pairs[side] & 0xFFFFFFFF) >> 1, n[side]]
    return (part, *(x.astype(t).tobytes() for x, t in zip(row, _TYPES.values())))


def _pieces(pairs: np.ndarray, n: np.ndarray, most: int) -> Iterator[tuple]:
    """Rows of at most ``most`` pairs. A word is whole in its row, unless the row is marked as a part and holds this word alone."""
    begin = 0
    while begin < len(pairs):
        end = min(begin + most, len(pairs))
        if end < len(pairs):
            end = int(np.searchsorted(pairs, pairs[end] >> 32 << 32))  # where the word that goes on begins
        if end > begin:
            yield _packed(False, pairs[begin:end], n[begin:end])
        else:
            end = int(np.searchsorted(pairs, ((pairs[begin] >> 32) + 1) << 32))
            for x in range(begin, end, most):
                yield _packed(True, pairs[x : min(x + most, end)], n[x : min(x + most, end)])
        begin = end


def _merge(most: int):
    """Task function: rows of coded pairs, ordered by bucket, become packed rows.

    A bucket is held as its different pairs and up to as many more, 4 million at least, that are not added up yet.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, least, now = [], 0, 8 * _FLUSH, None

        def rows() -> Iterator[pa.RecordBatch]:
            types = (pa.bool_(), *[pa.binary()] * len(_TYPES))
            for row in _pieces(*_added(held), most):
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], ["part", *_TYPES])

        for batch in batches:
            for bucket, n, code in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if bucket != now:
                    if held:
                        yield from rows()
                    held, size, least, now = [], 0, 8 * _FLUSH, bucket
                held.append(_decoded(code.as_buffer(), n))
                size += n
                if size > least:
                    held = [_added(held)]
                    size = len(held[0][0])
                    least = max(least, 2 * size)
        if held:
            yield from rows()

    return merge


def contexts(texts: DataFrame, keys: np.ndarray, tokens: int, most: int = PACKED) -> DataFrame:
    """The neighbours of every symbol on both sides, counted and packed, in rows of at most ``most`` pairs."""
    buckets = max(1, math.ceil(2 * tokens / PAIRS))
    coded = texts.mapInArrow(_count_bigrams(keys, buckets), "bucket int, size int, code binary")
    ordered = coded.repartition("bucket").sortWithinPartitions("bucket")
    return stored(ordered.mapInArrow(_merge(most), "part boolean, " + ", ".join(f"{c} binary" for c in _TYPES)), "contexts")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: v[i].as_py() if c == "part" else np.frombuffer(v[i].as_buffer(), _TYPES[c]) for c, v in zip(batch.schema.names, batch.columns)}


def transition_counts(packed: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of class pairs; every task adds up its own first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(TOTAL * TOTAL)
        for row in _rows(batches):
            first = np.repeat(classes[row["words"]].astype(np.int64) * TOTAL, row["sizes_after"])
            table += np.bincount(first + classes[row["others_after"]], row["counts_after"], TOTAL * TOTAL)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at].astype(np.int64))], ["pair", "n"])

    after = packed.select("words", "sizes_after", "others_after", "counts_after")
    rows = after.mapInArrow(add, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(TOTAL * TOTAL)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(TOTAL, TOTAL)


def probabilities(counts: np.ndarray) -> np.ndarray:
    """Transition probabilities, drawn towards the class frequencies by ``PRIOR`` observations."""
    overall = (counts.sum(axis=0) + 1) / (counts.sum() + TOTAL)
    return (counts + PRIOR * overall) / (counts.sum(axis=1, keepdims=True) + PRIOR)


def likelihood(counts: np.ndarray) -> float:
    """Log-likelihood of the training text given the counts of class pairs, less what no clustering changes."""
    size = counts.sum(axis=1)[1 : CLASSES + 1]
    return float((counts * np.log(probabilities(counts))).sum() - (size * np.log(np.maximum(size, 1))).sum())


def _cost(size: np.ndarray) -> np.ndarray:
    """What the occurrences of a class of this size pay for its size, as words of it and before their transitions."""
    return size * (np.log(np.maximum(size, 1)) + np.log(size + PRIOR))


def _fits(own: np.ndarray, seen: np.ndarray, table: np.ndarray) -> np.ndarray:
    """How well words of the classes ``own`` suit every class, given the counts of class pairs.

    A row of ``seen`` holds the neighbours of a word, counted by class, after it and before it. What sizes cost is exact; what
    neighbours are worth is the slope at the counts as they are, which favours the own class, so a word that moves alone gains.
    """
    after, before, size = seen[:, :TOTAL], seen[:, TOTAL:], table.sum(axis=1)[1 : CLASSES + 1]
    logs = np.log(probabilities(table))
    worth = logs[1 : CLASSES + 1] + np.log(size + PRIOR)[:, None]
    n, every = after.sum(axis=1), np.arange(len(own))
    fits = after @ worth.T + before @ logs[:, 1 : CLASSES + 1] - (_cost(size + n[:, None]) - _cost(size))
    stays = _cost(size[own - 1]) - _cost(size[own - 1] - n)
    fits[every, own - 1] += _cost(size[own - 1] + n) - _cost(size[own - 1]) - stays
    return fits


def _better(own: np.ndarray, seen: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words have a better class than their ``own``, and the best class of each."""
    fits, every = _fits(own, seen, table), np.arange(len(own))
    best = fits.argmax(axis=1)
    return fits[every, best] > fits[every, own - 1], best + 1


def _moves(classes: np.ndarray, table: np.ndarray, batch: int, batches: int):
    """Task function: ``(w, k, 0)`` for the words of this batch that suit another class ``k`` better.

    For parts of words ``(w, -1 - c, n)``: neighbours by class, to be added up before.
    """

    def move(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(rows):
            words = row["words"]
            # Neighbours in the order of keys, which are hashes, are not related.
            mine = (words % batches == batch) & (words >= 1) & (words < len(classes) - ENDINGS)
            if not mine.any():
                continue
            own, at = words[mine], np.cumsum(mine) - 1
            seen = np.zeros((2, len(own) * TOTAL))
            for counted, side in zip(seen, ("after", "before")):
                sizes = row[f"sizes_{side}"]
                pairs = np.repeat(mine, sizes)
                cell = np.repeat(at * TOTAL, sizes)[pairs] + classes[row[f"others_{side}"][pairs]]
                counted += np.bincount(cell, row[f"counts_{side}"][pairs], len(counted))
            seen = np.concatenate([x.reshape(len(own), TOTAL) for x in seen], axis=1)
            if row["part"]:
                c = np.flatnonzero(seen[0])
                columns = [np.full(len(c), own[0]), -1 - c, seen[0, c]]
            else:
                moved, best = _better(classes[own].astype(np.int64), seen, table)
                columns = [own[moved], best[moved], np.zeros(moved.sum())]
            types = (np.int32, np.int32, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(t)) for x, t in zip(columns, types)], ["w", "k", "n"])

    return move


def moves(packed: DataFrame, clustering: Clustering, table: np.ndarray, batch: int, batches: int) -> Clustering:
    """Every word of a batch in its best class given all others and the counts of class pairs, ``table``."""
    classes = clustering.of_symbols()
    found = packed.mapInArrow(_moves(classes, table, batch, batches), "w int, k int, n long")
    found = found.groupBy("w", "k").agg(F.sum("n").alias("n")).toArrow()
    w, k, n = (found[c].to_numpy() for c in ("w", "k", "n"))
    to, whole = clustering.classes.copy(), k > 0
    to[w[whole] - 1] = k[whole]
    own, at = np.unique(w[~whole], return_inverse=True)
    if len(own):
        seen = np.zeros((len(own), 2 * TOTAL))
        seen[at, -1 - k[~whole]] = n[~whole]
        moved, best = _better(classes[own].astype(np.int64), seen, table)
        to[own[moved] - 1] = best[moved]
    return Clustering(clustering.keys, to)


def exchange(packed: DataFrame, clustering: Clustering, tolerance: float = TOLERANCE) -> tuple[Clustering, np.ndarray]:
    """Move words to the class that makes the training text likeliest, in batches, and the counts of class pairs at the end.

    ``packed`` holds the ``contexts`` of each symbol. Every word of a batch moves to its best class given all others,
    then the transitions are counted again. A batch that makes the text less likely is undone, and batches are halved from
    there on. It ends when a turn of all words gains no more than ``tolerance`` per token.
    """
    table = transition_counts(packed, clustering.of_symbols())
    value, tokens, gained, batch, batches = likelihood(table), max(table.sum(), 1), 0.0, 0, BATCHES
    while len(clustering.keys):
        moved = moves(packed, clustering, table, batch, batches)
        if (moved.classes != clustering.classes).any():
            counted = transition_counts(packed, moved.of_symbols())
            gain = likelihood(counted) - value
            if gain > 0:
                clustering, table, value, gained = moved, counted, value + gain, gained + gain
            elif batches < MOST_BATCHES:
                batch, batches, gained = 0, 2 * batches, 0.0
                continue
        batch += 1
        if batch == batches:
            if gained <= tolerance * tokens:
                break
            batch, gained = 0, 0.0
    return clustering, table


@dataclass
class BrownModel:
    """A trained model: counts and classes of the listed words, classes of all that were exchanged, transitions, sizes of all classes."""

    vocabulary: DataFrame
    listed: dict[bytes, int]
    classes: np.ndarray
    counts: np.ndarray
    clustering: Clustering
    sizes: np.ndarray
    transitions: np.ndarray
    ending_mass: np.ndarray
    tokens: int
    types: int
    ends: int


def _start(own: dict[bytes, int]):
    """Task function: the key of every word and the class it begins in, its ``own`` or one by its ending."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w.as_py() for w in batch.column(0)]
            classes = [own.get(w) or 1 + zlib.crc32(w[-2:]) % CLASSES for w in words]
            yield pa.RecordBatch.from_arrays([pa.array([key_of(w) for w in words], pa.int64()), pa.array(classes, pa.int8())], ["key", "k"])

    return start


def train(texts: DataFrame, tolerance: float = TOLERANCE) -> BrownModel:
    """Count and cluster the words of a table with one non-null text column. Frequent words start in a class each, the others by their endings."""
    texts = small_batches(texts)
    vocabulary = stored(word_counts(texts), "vocabulary")
    size = vocabulary.agg(F.sum("n"), F.count("*")).first()
    ends = texts.count()
    tokens, types = (size[0] or 0) + ends, size[1] + (ends > 0)
    bar = max(MIN_COUNT, math.ceil(tokens * LISTED))
    rows = vocabulary.where(F.col("n") >= bar).orderBy(F.desc("n"), "word").collect()
    listed, counts = [bytes(r["word"]) for r in rows], np.array([r["n"] for r in rows], float)
    own = {w: i + 1 for i, w in enumerate(listed[:CLASSES])}
    found = vocabulary.where(F.col("n") >= MIN_COUNT).select("word").mapInArrow(_start(own), "key long, k byte").toArrow()
    keys, first = np.unique(found["key"].to_numpy(), return_index=True)
    clustering = Clustering(keys, found["k"].to_numpy()[first].astype(np.uint8))
    packed = contexts(texts, keys, tokens)
    clustering, table = exchange(packed, clustering, tolerance)
    mass = np.ones(ENDINGS)  # of an ending class: tokens, one more per type, and one for a word never seen
    rest = vocabulary.where(F.col("n") < MIN_COUNT).groupBy(ending_of(F.col("word")).alias("e"))
    for row in rest.agg((F.sum("n") + F.count("*")).alias("m")).collect():
        mass[row["e"]] += row["m"]
    classes = clustering.of_symbols()[symbols_of(keys)(listed)].astype(np.int32)
    names, sizes = {w: i for i, w in enumerate(listed)}, table.sum(axis=1)[: CLASSES + 1]
    return BrownModel(
        vocabulary.where(F.col("n") < bar), names, classes, counts, clustering, sizes, probabilities(table), mass, tokens, types, ends
    )


LINE = "struct<n_tokens: long, n_known: long, base: double, score: double, rare: array<struct<word: binary, n: long, kind: int>>>"
_RARE = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64()), ("kind", pa.int32())]))


def _score_lines(model: BrownModel):
    # Only these go to the tasks, not the vocabulary table.
    listed, classes, counts = model.listed, model.classes, model.counts
    smooth = math.log10(model.tokens + model.types + 1)
    logs, ends = np.log10(model.transitions), model.ends
    keys, kinds = model.clustering.keys, model.clustering.of_symbols()
    emit = np.log10(np.maximum(counts, 1)) - np.log10(np.maximum(model.sizes[classes], 1))  # all listed words are exchanged
    base, end_base = np.log10(counts + 1) - smooth, math.log10(ends + 1) - smooth
    symbols = None

    def score(texts: pa.Array) -> pa.Array:
        nonlocal symbols
        symbols = symbols or symbols_of(keys)
        out: list[list] = [[] for _ in range(5)]
        for text in texts.cast(pa.large_binary()):
            words = words_of(text.as_buffer().to_pybytes())
            ids = np.fromiter((listed.get(w, -1) for w in words), np.int64, len(words))
            line = np.zeros(len(words) + 2, np.int64)
            line[1:-1] = classes[ids] if len(classes) else 0
            unlisted = np.flatnonzero(ids < 0).tolist()
            rare = Counter(words[i] for i in unlisted)
            kind = dict(zip(rare, kinds[symbols(list(rare))].tolist())) if rare else {}
            line[[i + 1 for i in unlisted]] = [kind[words[i]] for i in unlisted]
            known = ids[ids >= 0]
            out[0].append(len(words) + 1)
            out[1].append(len(known) + (ends > 0))
            out[2].append(float(base[known].sum()) + end_base)
            out[3].append(float(emit[known].sum() + logs[line[:-1], line[1:]].sum()))
            out[4].append([{"word": w, "n": n, "kind": kind[w]} for w, n in rare.items()])
        types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), _RARE)
        names = ["n_tokens", "n_known", "base", "score", "rare"]
        return pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(out, types)], names)

    return F.arrow_udf(score, LINE)


def score(docs: DataFrame, model: BrownModel, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    A text is scored where it lies with the listed words. Its other words go to the table of their counts,
    and what they add comes back as one row per task and text. Null and empty texts score their end alone.
    Every row returns once: rows are told apart by a number that is written with them, so ids may repeat or be null.
    Columns of ``docs`` with one of the new names are replaced.
    """
    added = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (text_col, *added)]
    line = _score_lines(model)(text_or_empty(F.col(f"`{text_col}`")))
    key = F.monotonically_increasing_id().alias("_key")
    lines = stored(small_batches(docs).select(key, F.struct(*others).alias("_row"), line.alias("_line")), "lines")
    rare = lines.select("_key", F.explode("_line.rare").alias("_w")).select("_key", "_w.*")
    found = rare.join(model.vocabulary.withColumnRenamed("n", "c"), "word", "left")
    seen = F.log10(F.coalesce("c", F.lit(0)) + 1)
    # Of all classes by their number; what a word counts in an exchanged one, and in one by ending, where it has one more.
    mass = F.element_at(F.array(*[F.lit(math.log10(max(m, 1))) for m in [*model.sizes, *model.ending_mass]]), F.col("kind") + 1)
    emitted = F.when(F.col("kind") <= CLASSES, F.log10(F.greatest(F.coalesce("c", F.lit(1)), F.lit(1)))).otherwise(seen) - mass
    smooth = math.log10(model.tokens + model.types + 1)
    sums = found.groupBy("_key").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("_known"),
        F.sum(F.col("n") * (seen - smooth)).alias("_base"),
        F.sum(F.col("n") * emitted).alias("_score"),
    )
    with_rest = lambda a, b: F.col(f"_line.{a}") + F.coalesce(b, F.lit(0))
    return lines.join(sums, "_key", "left").select(
        "_row.*", "_line.n_tokens", with_rest("n_known", "_known").alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        with_rest("base", "_base").alias("base_score"), with_rest("score", "_score").alias("score"),
    )
