"""Packing: exact ids, exact round trip, first fit as by hand, little padding."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from reviewlens.llm import packing as pk
from reviewlens.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_those_of_the_tokenizer(tokenizer, rows):
    encoder, draw = pk.Encoder(PATH), random.Random(1)
    assert encoder.by_rank
    bits = ["a", "don't", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "é", "ñ1", "😀", "<|endoftext|>", "'s", "...", "\r\n", "\x00", "漢字", "​", "᠎", "ABC", "Ÿ", "0x1f", "ǅ", "×"]
    made = ["".join(draw.choices(bits, k=draw.randint(0, 12))) for _ in range(4000)]
    for text in [*made, *(r["text"] or "" for r in rows)]:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() + [0] == ids_of(tokenizer, text), repr(text)


def test_ids_of_other_kinds_of_tokenizers():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, plain = pk.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.by_rank
    text = "Some  Words, and more\n"
    assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(20))
def test_first_fit_decreasing_as_by_hand(seed):
    draw = random.Random(seed)
    capacity = draw.choice([7, 64, 1024])
    sizes = [draw.randint(1, capacity) for _ in range(draw.choice([0, 1, 2, 17, 300]))]
    bins, room = [], []
    for n in sorted(range(len(sizes)), key=lambda n: -sizes[n]):
        at = next((b for b, r in enumerate(room) if r >= sizes[n]), len(bins))
        if at == len(bins):
            bins.append([])
            room.append(capacity)
        bins[at].append(n)
        room[at] -= sizes[n]
    assert pk.first_fit_decreasing(sizes, capacity) == bins
    filled = pk.filled_up(bins, sizes, capacity)
    assert [sum(b - a for _, a, b in s) for s in filled] == [capacity] * (sum(sizes) // capacity) + [
        1 << b for b in range(20, -1, -1) if sum(sizes) % capacity >> b & 1
    ]
    covered = sorted(p for s in filled for p in s)
    for n, size in enumerate(sizes):
        own = [p for p in covered if p[0] == n]
        assert own[0][1] == 0 and own[-1][2] == size and all(a[2] == b[1] for a, b in zip(own, own[1:]))


def check(rows, texts, tokenizer, length):
    """``rows`` with ids; ``texts``: (doc_id, text), ids unique."""
    documents, inside = {}, {}
    for r in rows:
        documents.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"], r["length"]))
        inside.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(documents) == {i for i, _ in texts}
    for i, text in texts:
        want, at = ids_of(tokenizer, text), 0
        for start, ids, total, n in sorted(documents[i]):
            assert start == at and ids == want[at : at + n] and len(ids) == n and total == len(want)
            at += n
        assert at == len(want)
    padding = 0
    for pieces in inside.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


@pytest.mark.parametrize("length, group_docs", [(1024, 4096), (64, 20)])
def test_round_trip_without_padding(docs, rows, tokenizer, length, group_docs):
    packed = pk.pack(docs, PATH, length, group_docs)
    assert check(packed.collect(), [(r["doc_id"], r["text"]) for r in rows], tokenizer, length) == 0
    whole = pk.sequences(packed, length).collect()
    assert all(len(r["ids"]) in (4 * r["n_tokens"], 4 * length) and r["n_tokens"] <= length for r in whole)
    assert sum(r["n_tokens"] for r in whole) == sum(len(ids_of(tokenizer, r["text"])) for r in rows)


def test_odd_tables(spark, odd, none, tokenizer):
    got = pk.pack(odd, PATH).collect()
    assert sum(r["length"] for r in got) == sum(len(ids_of(tokenizer, r["text"])) for r in odd.collect())
    by_id = sorted(r["doc_tokens"] for r in got if r["start"] == 0)
    assert by_id == sorted(len(ids_of(tokenizer, r["text"])) for r in odd.collect())
    assert pk.pack(none, PATH).count() == 0 and pk.sequences(pk.pack(none, PATH)).count() == 0
    padded = pk.sequences(spark.createDataFrame([(1, 3, b"\x01\0\0\0" * 3, 0)], "sequence_id long, length long, ids binary, offset long"), 8).first()
    assert bytes(padded["ids"]) == b"\x01\0\0\0" * 3 + bytes(20)


def test_query(spark, sf_dir, rows, tokenizer):
    got = QUERIES["op12_packing"](spark, sf_dir)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    texts = {r["doc_id"]: np.array(ids_of(tokenizer, r["text"]), "<u4") for r in rows}
    for r in got.collect():
        assert r["ids_crc32"] == zlib.crc32(texts[r["doc_id"]][r["start"] : r["start"] + r["length"]].tobytes())
