"""Benchmark decontamination: BM25 retrieval of test items for every training passage, then overlap checks.

The test items are the index, since they are the small side; training texts stream past it where they
lie and are never shuffled. Scores are divided by the score of an item against itself, so one
threshold fits items of any length. Block-max WAND finds every item at or above it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from reviewlens.llm.common import small_batches, text_or_empty

WORDS = re.compile(r"\w+")
PASSAGE, THRESHOLD, OVERLAP = 64, 0.6, 0.8
#: A stretch of text compared with ``n`` words has ``n // SLACK`` words more, room for words that were put in.
SLACK = 4
K1, B, BLOCK = 1.2, 0.75, 8
#: Items of this many characters make one index; more items make more of them.
INDEX_CHARS = 16 << 20
HITS = "array<struct<item_id: long, score: double, question_overlap: double, answer_overlap: double, word: int>>"


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """A test item without an answer of its own: its last third of words is the answer."""
    words = words_of(text)
    cut = len(words) - len(words) // 3
    return words[:cut], words[cut:]


def aligned(wanted: list[str], words: list[str], least: float = 0.0) -> float:
    """Share of ``wanted`` that stands in ``words`` in the same order, best over all stretches as long as ``wanted``.

    The longest common subsequence with the stretch that starts at a word, so an edited word costs one word, and the
    words of an item scattered over a long text are none of it. Stretches start at words of ``wanted`` only.
    A part without words counts as found. Shares below ``least`` may be given as 0.
    """
    if not wanted:
        return 1.0
    size = len(wanted) + max(len(wanted) // SLACK, 1)
    known = {w: sum(1 << i for i, x in enumerate(wanted) if x == w) for w in set(wanted)}
    masks = [known.get(w, 0) for w in words]
    whole, last = (1 << len(wanted)) - 1, len(words)
    best = max(math.ceil(least * len(wanted) - 1e-9) - 1, 0)  # only more than this many words are of interest
    found = 0
    hits = np.concatenate([[0], np.cumsum(np.fromiter((m != 0 for m in masks), np.int64, last))]).tolist()
    for start, mask in enumerate(masks):
        stop = min(start + size, last)
        if not mask or hits[stop] - hits[start] <= best:
            continue
        # One bit per word of ``wanted``, zero where a common subsequence got longer (Hyyrö 2004).
        row = whole
        for m in masks[start:stop]:
            if m:
                met = row & m
                row = ((row + met) | (row - met)) & whole
        length = len(wanted) - row.bit_count()
        if length > best:
            best = found = length
        if found == len(wanted):
            break
    return found / len(wanted)


class ItemIndex:
    """Inverted index of item passages with a maximum per block, and the words of the items.

    An item longer than ``passage`` words is indexed in pieces. ``statistics`` are the document
    frequencies, number and mean length of the pieces of *all* items, so scores do not depend on how
    items are dealt to indexes.
    """

    def __init__(self, items: list[tuple[int, list[str], list[str]]], statistics, passage: int):
        frequency, pieces, mean = statistics
        self.items = items
        postings = defaultdict(list)
        self.owner: list[int] = []
        for n, (_, question, answer) in enumerate(items):
            for piece in split(question + answer, passage):
                counts = Counter(piece)
                weight = {}
                for word, tf in counts.items():
                    idf = math.log(1 + (pieces - frequency[word] + 0.5) / (frequency[word] + 0.5))
                    weight[word] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(piece) / mean))
                whole = sum(weight.values())
                for word, w in weight.items():
                    postings[word].append((len(self.owner), w / whole))
                self.owner.append(n)
        self.terms = {word: t for t, word in enumerate(sorted(postings))}
        lists = [postings[word] for word in self.terms]
        self.docs = [[d for d, _ in entries] for entries in lists]
        self.weights = [[w for _, w in entries] for entries in lists]
        self.term_max = [max(ws) for ws in self.weights]
        self.blocks, self.block_max = [], []
        for entries in lists:
            top: dict[int, float] = {}
            for d, w in entries:
                top[d // BLOCK] = max(top.get(d // BLOCK, 0.0), w)
            self.blocks.append(np.fromiter(top, np.int64, len(top)))
            self.block_max.append(np.fromiter(top.values(), np.float64, len(top)))
        self.bounds = np.array([0.0, *self.term_max])

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: all pieces whose score for the distinct ``terms`` reaches ``threshold``.

        Blocks are ranges of pieces. The maxima of the terms' blocks add up to a bound for each range, and
        WAND runs in the ranges where that bound reaches the threshold.
        """
        found: list[tuple[int, float]] = []
        if not terms:
            return found
        blocks = np.concatenate([self.blocks[t] for t in terms])
        bounds = np.bincount(blocks, np.concatenate([self.block_max[t] for t in terms]))
        for block in np.flatnonzero(bounds >= threshold).tolist():
            self._wand(terms, threshold, block * BLOCK, (block + 1) * BLOCK, found)
        return found

    def _wand(self, terms: list[int], threshold: float, low: int, high: int, found: list) -> None:
        """WAND over the pieces ``low`` to ``high - 1``."""
        order = []  # lists by the piece they stand at
        for t in terms:
            at = bisect_left(self.docs[t], low)
            if at < len(self.docs[t]) and self.docs[t][at] < high:
                order.append((self.docs[t][at], t, at))
        while True:
            order.sort()
            bound, pivot = 0.0, -1
            for n, (_, t, _) in enumerate(order):
                bound += self.term_max[t]
                if bound >= threshold:
                    pivot = n
                    break
            if pivot < 0:
                return
            doc = order[pivot][0]
            if order[0][0] == doc:  # every list before the pivot stands at it: score it in full
                here = [(t, at) for d, t, at in order if d == doc]
                score = sum(self.weights[t][at] for t, at in here)
                if score >= threshold:
                    found.append((doc, score))
                moved = [(t, at + 1) for t, at in here]
            else:
                here = [(t, at) for d, t, at in order if d < doc]
                moved = [(t, bisect_left(self.docs[t], doc, at)) for t, at in here]
            order[: len(here)] = [
                (self.docs[t][at], t, at) for t, at in moved if at < len(self.docs[t]) and self.docs[t][at] < high
            ]

    def hits(self, text: str, passage: int, threshold: float, overlap: float) -> list[dict]:
        """Best verified hit of each item in the text. Passages overlap by half and cover every word."""
        words = words_of(text)
        if not words:
            return []
        get = self.terms.get
        ids = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        sums = np.concatenate([[0.0], np.cumsum(self.bounds[ids + 1])])
        starts = np.arange(0, max(len(words) - passage, 1), passage)
        reach = sums[np.minimum(starts + 2 * passage, len(words))] - sums[starts]
        best: dict[int, dict] = {}
        for start in starts[reach >= threshold - 1e-9].tolist():
            terms = set(ids[start : start + 2 * passage].tolist()) - {-1}
            for piece, score in self.search(list(terms), threshold - 1e-9):
                n = self.owner[piece]
                item, question, answer = self.items[n]
                if item in best and best[item]["score"] >= score:
                    continue
                size = (len(question) + len(answer)) * (SLACK + 1) // SLACK + 1
                around = words[max(start - size, 0) : start + 2 * passage + size]
                q = aligned(question, around, overlap)
                a = aligned(answer, around, overlap) if q >= overlap else 0.0
                if min(q, a) >= overlap:
                    best[item] = {
                        "item_id": item, "score": float(score), "question_overlap": q, "answer_overlap": a, "word": start,
                    }
        return [best[i] for i in sorted(best)]


def split(words: list[str], passage: int) -> list[list[str]]:
    return [words[i : i + passage] for i in range(0, len(words), passage)]


def leaks(
    text: Column,
    items: DataFrame,
    passage: int = PASSAGE,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_chars: int = INDEX_CHARS,
) -> Column:
    """The test items that ``text`` leaks, as ``HITS``; empty for null, empty and clean texts.

    ``items`` has ``item_id`` and ``text``, or ``question`` and ``answer``. A passage is
    ``2 * passage`` words and starts every ``passage`` words. An item hits if BM25 reaches ``threshold``
    of its own score and at least ``overlap`` of its question's and of its answer's words stand around there in
    their order, close together (``aligned``). Items without a word or an id never hit; of repeated ids each
    version is tried. The items are read in indexes of at most ``index_chars`` characters each, so what
    is sent to the executors at once is bounded; further indexes are searched in turn.
    """
    columns = ["item_id", *(["question", "answer"] if "question" in items.columns else ["text"])]
    indexes: list[list] = [[]]
    size, seen, pieces, length = 0, Counter(), 0, 0
    rows = items.where("item_id is not null").select(*columns).distinct().orderBy(*columns)
    for row in rows.toLocalIterator():
        if len(columns) == 3:
            question, answer = words_of(row["question"] or ""), words_of(row["answer"] or "")
        else:
            question, answer = question_and_answer(row["text"] or "")
        if not question and not answer:
            continue
        for piece in split(question + answer, passage):
            seen.update(set(piece))
            pieces, length = pieces + 1, length + len(piece)
        if size > index_chars:
            indexes.append([])
            size = 0
        indexes[-1].append((row["item_id"], question, answer))
        size += sum(map(len, question)) + sum(map(len, answer))
    statistics = (seen, pieces, length / max(pieces, 1))

    def search(part: list) -> Column:
        built: list[ItemIndex] = []

        @F.arrow_udf(HITS)
        def of(texts: pa.Array) -> pa.Array:
            if not built:
                built.append(ItemIndex(part, statistics, passage))
            found = [built[0].hits(t.as_py(), passage, threshold, overlap) for t in texts]
            return pa.array(found, pa.list_(_STRUCT))

        return of.asNondeterministic()(text_or_empty(text))

    return reduce(lambda a, b: F.concat(a, b), [search(part) for part in indexes])


_SHARES = [(name, pa.float64()) for name in ("score", "question_overlap", "answer_overlap")]
_STRUCT = pa.struct([("item_id", pa.int64()), *_SHARES, ("word", pa.int32())])


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row per document and leaked item: ``(doc_id, item_id, score, question_overlap, answer_overlap, word)``."""
    found = small_batches(docs).select(F.col(id_col).alias("doc_id"), leaks(F.col(text_col), items, **settings).alias("_hits"))
    return found.select("doc_id", F.explode("_hits").alias("_hit")).select("doc_id", "_hit.*")


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that leak no test item, with their own columns."""
    return small_batches(docs).where(F.size(leaks(F.col(f"`{text_col}`"), items, **settings)) == 0)
