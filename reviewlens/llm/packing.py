"""Packing of token ids into sequences: first-fit decreasing over a tournament tree of free room, in randomised groups.

Texts are tokenised once and stored in pieces of at most one sequence. A piece as long as a sequence is one. The others, at
most one a document, are dealt at random to groups of bounded size, and each group is packed in a task of its own.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reviewlens.llm.common import small_batches, text_or_empty
from reviewlens.session import shared_dir

SEQUENCE, GROUP_DOCS, END = 1024, 4096, 0
#: Bytes of ids in a batch that a task returns.
FLUSH_BYTES = 4 << 20
#: Fixed values of byte-level vocabularies: the pattern that splits a text, and the bytes that stand for themselves.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Characters that every version of Unicode classes alike: ASCII and Latin letters.
COMMON = re.compile("[\t\n\r -~À-ɏ]*")
_PIECE = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
     ("number", pa.int64())]
)
_PACKED = pa.schema([f for f in _PIECE if f.name != "number"] + [pa.field("sequence_id", pa.int64()), pa.field("offset", pa.int64())])


class Encoder:
    """Ids of a text by a tokenizer file, as little-endian unsigned 32-bit integers.

    A byte-level vocabulary whose merges are numbered in their order is also read by an encoder that merges by rank. It gives
    the same ids four times as fast, and takes the texts of common characters; all others, texts that spell a special token
    and other kinds of vocabularies go to the tokenizer itself.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        state = json.loads(self.tokenizer.to_str())
        kind, model, own = state["pre_tokenizer"] or {}, state["model"], state["added_tokens"]
        self.special = [t["content"] for t in own]
        plain = kind.get("type") == "ByteLevel" and kind.get("use_regex") and not kind.get("add_prefix_space")
        known = model.get("vocab", {})
        merged = [known["".join(pair)] for pair in model.get("merges", [])] if plain else []
        settings = [state["normalizer"], *(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "end_of_word_suffix"))]
        self.by_rank = self._by_rank(known) if merged and merged == sorted(merged) and not any(settings) else None

    def _by_rank(self, known: dict[str, int]):
        import tiktoken

        rest = [b for b in range(256) if b not in PLAIN_BYTES]
        byte = {chr(b): b for b in PLAIN_BYTES} | {chr(256 + n): b for n, b in enumerate(rest)}
        ranks = {bytes(byte[c] for c in token): i for token, i in known.items() if token not in self.special}
        return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> bytes:
        if self.by_rank and COMMON.fullmatch(text) and not any(t in text for t in self.special):
            return np.array(self.by_rank.encode_ordinary(text), "<u4").tobytes()
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def tokenised(docs: DataFrame, tokenizer: str, length: int, end: int, id_col: str, text_col: str) -> DataFrame:
    """Stored pieces of at most ``length`` ids: ``(doc_id, start, length, ids, doc_tokens, number)``, ``number`` unique."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = Encoder(tokenizer)
        number = TaskContext.get().partitionId() << 40
        rows, held = [], 0
        last = np.array([end], "<u4").tobytes()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.ids(text) + last
                for at in range(0, len(ids), 4 * length):
                    piece = ids[at : at + 4 * length]
                    rows.append((doc_id, at // 4, len(piece) // 4, piece, len(ids) // 4, number))
                    number, held = number + 1, held + len(piece)
                    if held >= FLUSH_BYTES:
                        yield _batch(rows, _PIECE)
                        rows, held = [], 0
        if rows:
            yield _batch(rows, _PIECE)

    rows = small_batches(docs).select(F.col(f"`{id_col}`").alias("doc_id"), text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    path = shared_dir(docs.sparkSession, "pieces")
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, number long"
    rows.mapInArrow(pieces, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: the longest items first, each into the first bin with room for it.

    The leaves of the tree are bins, a node has the most free room below it, so the first bin with room is found by one
    descent. Equal sizes keep their order.
    """
    leaves = 1 << max(len(sizes) - 1, 0).bit_length()
    room, bins = [capacity] * (2 * leaves), []
    for item in sorted(range(len(sizes)), key=lambda n: -sizes[n]):
        size, at = sizes[item], 1
        while at < leaves:
            at *= 2
            at += room[at] < size
        if at - leaves == len(bins):
            bins.append([])
        bins[at - leaves].append(item)
        room[at] -= size
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
    return bins


def filled_up(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(item, from, to)`` without padding: the emptiest bins are cut to fill the gaps of the others.

    Items of bins that stay are whole. What is left in the end, less than a sequence, is cut into powers of two.
    """
    fill = [sum(sizes[n] for n in items) for items in bins]
    order = sorted(range(len(bins)), key=lambda b: -fill[b])
    whole = sum(fill) // capacity
    spare = [(n, 0, sizes[n]) for b in reversed(order[whole:]) for n in bins[b]][::-1]

    def take(wanted: int) -> list[tuple[int, int, int]]:
        taken = []
        while wanted:
            n, low, high = spare.pop()
            cut = min(high, low + wanted)
            taken.append((n, low, cut))
            wanted -= cut - low
            if cut < high:
                spare.append((n, cut, high))
        return taken

    out = [[*((n, 0, sizes[n]) for n in bins[b]), *take(capacity - fill[b])] for b in order[:whole]]
    left = sum(high - low for _, low, high in spare)
    return out + [take(1 << bit) for bit in reversed(range(left.bit_length())) if left >> bit & 1]


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = SEQUENCE,
    group_docs: int = GROUP_DOCS,
    end: int = END,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, start, length, ids, doc_tokens, sequence_id, offset)``: one row per piece of a document.

    A document is the ids of its text by the ``tokenizer`` file, without special tokens added, then ``end``; null text
    counts as empty and is ``end`` alone. Documents longer than a sequence fill whole ones with all but their rest. Rests
    and shorter documents are dealt to groups by the hash of a running number, so neither repeated rows and ids nor null ids
    gather, and packed there by first-fit decreasing. Gaps are filled with cuts of the least filled sequences, hence only
    the last few sequences of a group, of a power of two each, are shorter than ``length``.
    ``ids`` are little-endian unsigned 32-bit integers. Other columns are not read; no rows give none.
    """
    pieces = tokenised(docs, tokenizer, length, end, id_col, text_col)
    full = pieces.where(F.col("length") == length).withColumn("sequence_id", 2 * F.col("number")).withColumn("offset", F.lit(0).cast("long"))
    rests = pieces.where(F.col("length") < length)
    groups = max(-(-rests.count() // group_docs), 1)

    def packed(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("number")
        group = table["group"][0].as_py() if len(table) else 0
        columns = {c: table[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens", "length")}
        sizes, rows = columns["length"], []
        for n, sequence in enumerate(filled_up(first_fit_decreasing(sizes, length), sizes, length)):
            offset = 0
            for item, low, high in sequence:
                ids = columns["ids"][item][4 * low : 4 * high]
                start, total = columns["start"][item] + low, columns["doc_tokens"][item]
                rows.append((columns["doc_id"][item], start, high - low, ids, total, 2 * (group << 24 | n) + 1, offset))
                offset += high - low
        return pa.Table.from_batches([_batch(rows, _PACKED)] if rows else [], _PACKED)

    rests = rests.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return full.drop("number").unionByName(rests.groupBy("group").applyInArrow(packed, schema))


def sequences(packed: DataFrame, length: int = SEQUENCE, pad: int = END) -> DataFrame:
    """``(sequence_id, n_tokens, ids)`` of the rows of ``pack``: whole sequences, padded to ``length`` but at a power of two.

    A sequence has at most ``length`` pieces, so no group grows with the data.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ordered.alias("_pieces"))
    hexed = F.array_join(F.transform("_pieces", lambda p: F.hex(p["ids"])), "")
    missing = F.when(F.bit_count("n_tokens") == 1, F.lit(0)).otherwise(length - F.col("n_tokens")).cast("int")
    padding = F.repeat(F.lit(np.array([pad], "<u4").tobytes().hex()), missing)
    return rows.select("sequence_id", "n_tokens", F.unhex(F.concat(hexed, padding)).alias("ids"))
