"""Ranked lexical search: short lists are summed term at a time, long lists are skipped through document at a time.

The texts are read once, into an inverted index of segments: a row per segment and term, and one per segment for its
documents. Statistics of the whole table come from that index. A task then searches one segment for one block of items,
with block maxima of every list, and only the best of a segment are ranked against those of the others.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from reviewlens.llm.common import small_batches, text_or_empty
from reviewlens.operators.joins import lookup_join
from reviewlens.session import stored

TOP = 50
#: Fixed values of the ranking: terms, weights and saturation in integers.
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE, WEIGHT, LENGTH_BASE, LENGTH_SLOPE = 1_000_000_000, 1000, 50, 50
#: Documents and postings of a segment, items searched by a task, and terms that are sent to the tasks that index.
SEGMENT_DOCS, SEGMENT_POSTINGS, BLOCK_ITEMS, SENT_TERMS = 1 << 16, 1 << 20, 256, 200_000
#: Documents of a block with a maximum of its own, and of a step of the search.
BLOCK, STEP = 64, 2048

_TERM_BYTES = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256))
_FOLD = bytes(b if b in _TERM_BYTES else 32 for b in range(256)).lower()
_POSTINGS = "segment long, term string, ordinals array<int>, counts array<int>, ids array<long>, n_docs long, n_terms long"
_POSTINGS_ARROW = pa.schema(
    [("segment", pa.int64()), ("term", pa.string()), ("ordinals", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())),
     ("ids", pa.list_(pa.int64())), ("n_docs", pa.int64()), ("n_terms", pa.int64())]
)


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of letters and digits in ASCII, lower-cased, and of all other characters."""
    return text.translate(_FOLD).split()


class _Segment:
    """Postings of consecutive documents, as flat arrays until they are written."""

    def __init__(self, number: int):
        self.number, self.vocabulary = number, {}
        self.terms, self.at, self.counts = array("i"), array("i"), array("i")
        self.ids, self.lengths, self.n_docs, self.n_terms = [], array("i"), 0, 0

    def add(self, doc_id: int | None, text: bytes, wanted: frozenset[bytes] | None) -> None:
        words = terms_of(text)
        self.n_docs += bool(words)
        self.n_terms += len(words)
        found = Counter(words if wanted is None else filter(wanted.__contains__, words))
        if found:
            number = self.vocabulary
            self.terms.extend(number.setdefault(w, len(number)) for w in found)
            self.counts.extend(found.values())
            self.at.extend([len(self.ids)] * len(found))
            self.ids.append(doc_id)
            self.lengths.append(len(words))

    def full(self) -> bool:
        return len(self.terms) >= SEGMENT_POSTINGS or len(self.ids) >= SEGMENT_DOCS

    def batches(self) -> Iterator[pa.RecordBatch]:
        terms = np.frombuffer(self.terms, np.int32)
        order = np.argsort(terms, kind="stable")
        ends = np.cumsum(np.bincount(terms, minlength=len(self.vocabulary)))
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(x, np.int32)[order])) for x in (self.at, self.counts)]
        n = len(self.vocabulary)
        none = [pa.nulls(n, t) for t in (pa.list_(pa.int64()), pa.int64(), pa.int64())]
        words = pa.array([w.decode() for w in self.vocabulary], pa.string())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([self.number] * n, pa.int64()), words, *lists, *none], schema=_POSTINGS_ARROW)
        own = [[self.number], [None], [None], [list(self.lengths)], [self.ids], [self.n_docs], [self.n_terms]]
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(own, _POSTINGS_ARROW)], schema=_POSTINGS_ARROW)


def build_index(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored inverted index of ``docs``: a row per segment and term, and one with null ``term`` per segment.

    With ``terms`` (one column ``term``) only their postings are kept, unless they are too many to be sent to the tasks;
    then all are, and the search picks its own. Document and term counts cover every text either way.
    """
    wanted = None
    if terms is not None:
        some = [r["term"].encode() for r in terms.limit(SENT_TERMS + 1).collect()]  # bounded, whatever the items
        wanted = frozenset(some) if len(some) <= SENT_TERMS else None

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 32
        segment = _Segment(first)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist()):
                segment.add(doc_id, text, wanted)
                if segment.full():
                    yield from segment.batches()
                    segment = _Segment(segment.number + 1)
        if segment.n_docs:
            yield from segment.batches()

    rows = small_batches(docs).select(F.col(f"`{id_col}`").alias("id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    return stored(rows.mapInArrow(index, _POSTINGS), "lexical-index")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(item_id, term)``, each once; rows without an id or a term have none, and rows with one id are one item."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    folded = F.translate(F.col(f"`{text_col}`"), upper, upper.lower())
    rows = items.where(F.col(f"`{id_col}`").isNotNull())
    found = F.explode(F.array_distinct(F.regexp_extract_all(folded, F.lit(TERMS), F.lit(0))))
    return rows.select(F.col(f"`{id_col}`").alias("item_id"), found.alias("term")).distinct()


class PostingList:
    """Documents of one list in ascending order, their parts of the score, and the maxima of its blocks."""

    def __init__(self, docs: np.ndarray, parts: np.ndarray, n_blocks: int):
        self.docs, self.parts = docs, parts
        self.top = int(parts.max()) if len(parts) else 0
        self.blocks = np.zeros(n_blocks, np.int64)
        if len(docs):
            starts = np.flatnonzero(np.diff(docs // BLOCK, prepend=-1))
            self.blocks[docs[starts] // BLOCK] = np.maximum.reduceat(parts, starts)

    def least_kth(self, k: int) -> int:
        """So much the ``k``-th best document scores at least, by this list alone."""
        return int(np.partition(self.parts, -k)[-k]) if len(self.parts) >= k else 0


def accumulators(lists: list[PostingList], n_blocks: int) -> PostingList:
    """The summed parts of short lists, term at a time, as one list."""
    docs = np.concatenate([x.docs for x in lists])
    order = np.argsort(docs, kind="stable")
    docs, parts = docs[order], np.concatenate([x.parts for x in lists])[order]
    starts = np.flatnonzero(np.diff(docs, prepend=-1))
    return PostingList(docs[starts], np.add.reduceat(parts, starts), n_blocks)


def best_of(lists: list[PostingList], tie: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(documents, scores)`` of the ``k`` documents with the highest positive sums over ``lists``; ties by ``tie``.

    The shortest lists, together no longer than the longest one, become accumulators. They are one more list with
    tight maxima in the document-at-a-time part. That goes through the documents in steps: blocks whose maxima do not
    add up to the ``k``-th score so far are jumped over, the lists that can lift a document there propose candidates,
    and the other, long ones are only probed for candidates that can still get there.
    """
    nothing = np.zeros(0, np.int64)
    if not lists:
        return nothing, nothing
    n_blocks = len(lists[0].blocks)
    lists = sorted(lists, key=lambda x: len(x.docs))
    sums = np.cumsum([len(x.docs) for x in lists])
    short = min(int(np.searchsorted(sums, sums[-1] - (sums[-2] if len(sums) > 1 else 0), "right")), len(lists) - 1)
    if short > 1:
        lists = [accumulators(lists[:short], n_blocks), *lists[short:]]
    lists.sort(key=lambda x: -x.top)
    rest = np.append(np.cumsum([x.top for x in lists][::-1])[::-1], 0)  # most that lists from here on can add
    reach = np.add.reduce([x.blocks for x in lists])
    least = max(1, *(x.least_kth(k) for x in lists))
    docs, scores = nothing, nothing
    for low in range(0, n_blocks, STEP // BLOCK):
        live = reach[low : low + STEP // BLOCK] >= least
        if not live.any():
            continue
        start, end = low * BLOCK, (low + len(live)) * BLOCK
        essential = max(int(np.searchsorted(-rest, -least, "right")), 1)  # without these lists no document gets there
        sums = np.zeros(end - start, np.int64)
        for x in lists[:essential]:
            a, b = np.searchsorted(x.docs, (start, end))
            sums[x.docs[a:b] - start] += x.parts[a:b]
        found = np.flatnonzero((sums > 0) & (sums + rest[essential] >= least) & np.repeat(live, BLOCK))
        got = sums[found]
        found = found + start
        for n, x in enumerate(lists[essential:], essential):
            if not len(found):
                break
            at = np.minimum(np.searchsorted(x.docs, found), len(x.docs) - 1)
            got = got + np.where(x.docs[at] == found, x.parts[at], 0)
            may = got + rest[n + 1] >= least
            found, got = found[may], got[may]
        if len(found):
            docs, scores = np.concatenate([docs, found]), np.concatenate([scores, got])
            order = np.lexsort((tie[docs], -scores))[:k]
            docs, scores = docs[order], scores[order]
            if len(docs) == k:
                least = max(least, int(scores[-1]))
    return docs, scores


def search_segment(
    postings: dict[str, tuple[int, np.ndarray, np.ndarray]],
    lengths: np.ndarray,
    ids: list[int | None],
    items: list[tuple[int, list[str]]],
    n_docs: int,
    n_terms: int,
    k: int,
) -> Iterator[tuple[int, int | None, int]]:
    """``(item_id, doc_id, score)`` of the best documents of a segment; ``postings``: term to weight, documents, counts."""
    tie = np.empty(len(ids), np.int64)
    tie[sorted(range(len(ids)), key=lambda n: (ids[n] is None, ids[n] or 0))] = np.arange(len(ids))
    norm = 100 - LENGTH_BASE + (LENGTH_SLOPE * lengths * n_docs) // n_terms
    n_blocks = -(-len(ids) // BLOCK)
    ready = {}
    for term, (weight, docs, counts) in postings.items():
        parts = weight * ((SCALE * counts) // (1000 * counts + 20 * norm[docs]))
        ready[term] = PostingList(docs, parts, n_blocks)
    for item, terms in items:
        docs, scores = best_of([ready[t] for t in terms if t in ready], tie, k)
        for doc, score in zip(docs.tolist(), scores.tolist()):
            yield item, ids[doc], score


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents of each item with the highest scores above zero.

    A term weighs ``floor(1000 ln((2N+2)/(2df+1)))``; a document adds that times its count, saturated by its length in
    terms, in whole numbers. Equal scores rank by ascending id, null ids last; repeated rows rank as rows of their own.
    Null and empty texts have no terms; items without an id are left out, those without a known term return nothing,
    and of an item id that occurs again the terms of all its rows count. Texts of any length are read whole; other
    columns are not read. Empty tables on either side give no rows.
    """
    asked = stored(item_terms(items), "item-terms")
    index = build_index(docs, asked.select("term").distinct(), id_col, text_col)
    totals = index.where("term is null").agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_docs, n_terms = totals["n"] or 0, totals["l"] or 0
    blocks = -(-asked.select("item_id").distinct().count() // BLOCK_ITEMS) or 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))

    frequency = index.where("term is not null").groupBy("term").agg(F.sum(F.size("ordinals")).alias("df"))
    weight = F.floor(F.lit(float(WEIGHT)) * F.log((2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0)))
    by_block = asked.select("block", "term").distinct().join(frequency, "term")
    by_block = by_block.select("block", "term", weight.cast("long").alias("weight"))
    lists = lookup_join(index.where("term is not null").select("segment", "term", "ordinals", "counts"), by_block, ["term"], ["segment"], "inner")

    packed = asked.groupBy("block", "item_id").agg(F.collect_list("term").alias("terms"))
    packed = packed.groupBy("block").agg(F.collect_list(F.struct("item_id", "terms")).alias("items"))
    own = index.where("term is null").select("segment", "counts", "ids", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    own = own.withColumn("block", F.col("block").cast("long")).join(packed, "block")
    rows = lists.select("segment", "block", "term", "weight", "ordinals", "counts").unionByName(own, allowMissingColumns=True)

    def best(table: pa.Table) -> pa.Table:
        found = []
        postings, head = {}, None
        for batch in table.to_batches():
            terms, weights = batch.column("term"), batch.column("weight")
            for n in range(batch.num_rows):
                if not terms[n].is_valid:
                    head = (batch.column("counts")[n].values.to_numpy().astype(np.int64), batch.column("ids")[n].as_py(), batch.column("items")[n].as_py())
                    continue
                arrays = [batch.column(c)[n].values.to_numpy().astype(np.int64) for c in ("ordinals", "counts")]
                postings[terms[n].as_py()] = (weights[n].as_py(), *arrays)
        if head and postings:
            items_here = [(x["item_id"], x["terms"]) for x in head[2]]
            found = list(search_segment(postings, head[0], head[1], items_here, n_docs, n_terms, k))
        columns = list(zip(*found)) or [[], [], []]
        return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("item_id", "doc_id", "score"), columns)})

    local = rows.groupBy("segment", "block").applyInArrow(best, "item_id long, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
